"""From standardised records to golden records, as one chain of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import quality, survivorship
from assay.operators.matching import Matched, match_records
from assay.operators.standardize import latest_per_record, publish, standardize, union_all, with_provenance, with_record_key
from assay.session import cut
from assay.sources.files import read_batch
from assay.specs import EntitySpec


@dataclass
class Mastered:
    """Every layer of one run of one entity."""

    scored: DataFrame
    rejected: DataFrame
    passed: DataFrame
    quarantine: DataFrame
    matched: Matched
    groups: DataFrame
    golden: DataFrame

    def published(self, entity: EntitySpec) -> DataFrame:
        """Golden rows in their published columns, with the ids of all members."""
        return publish(survivorship.with_member_lists(self.golden, self.groups), entity)

    @property
    def members(self) -> DataFrame:
        return survivorship.golden_members(self.groups)


def standardized_batch(spark: SparkSession, entity: EntitySpec, as_of, paths: dict[str, str] | None = None) -> DataFrame:
    """Read, tag and standardise every source of an entity."""
    frames = []
    for source in entity.sources:
        raw = read_batch(spark, source, (paths or {}).get(source.name))
        frames.append(standardize(with_provenance(raw, source, as_of), entity, source))
    return union_all(frames)


def master(
    standardized: DataFrame,
    entity: EntitySpec,
    as_of,
    approved: DataFrame | None = None,
    enforce_gold: bool = True,
    scorer: quality.Scorer | None = None,
) -> Mastered:
    """Score, gate, match, cluster and merge the standardised records of one entity.

    ``approved`` lists the record keys a steward let through despite a low score; ``scorer`` replaces the
    entity's rules as the source of scores.
    """
    rules, minimum = entity.rules, entity.min_score
    kept, rejected = quality.expect_all_or_drop(
        (scorer or quality.RuleScorer(rules)).score(standardized), quality.identity_expectations(entity.id_column, entity.name_column)
    )
    latest = latest_per_record(with_record_key(kept, entity.id_column))
    # read by both sides of the gate, by matching, grouping and merging
    scored = cut(quality.flag_overrides(latest, approved, minimum, "record_key"))
    passed = scored.filter((F.col("dq_score") >= F.lit(minimum)) | F.col("steward_override"))
    low = scored.filter((F.col("dq_score") < F.lit(minimum)) & ~F.col("steward_override"))
    to_match = passed
    if entity.match.match_invalid == "null":
        to_match = quality.blank_invalid(passed, rules, [a.column for a in entity.match.attributes])
    matched = match_records(to_match, entity.match)
    groups = cut(matched.groups())
    # built and checked in one pass, then published from the same rows
    golden = survivorship.golden_records(passed, groups, entity.survivorship, as_of)
    if enforce_gold:
        golden, check = quality.expect_on_write(golden, quality.gold_expectations(minimum))
        golden = cut(golden)
        check()
    else:
        golden = cut(golden)
    return Mastered(scored, rejected, passed, low.drop("steward_override"), matched, groups, golden)
