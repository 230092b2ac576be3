"""Pair confidence, match groups and member confidence."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions.similarity import jaro_winkler
from assay.operators import blocking
from assay.operators.components import connected_components, label_nodes
from assay.operators.forest import spanning_forest
from assay.operators.skew import hot_limit, join_unique
from assay.session import cut
from assay.specs import MatchSpec

MEMBER = "member_customer_id"
CONTRACT = ("golden_id", MEMBER, "match_confidence")


class Matcher(Protocol):
    """Anything that assigns records to match groups."""

    def match(self, df: DataFrame) -> DataFrame: ...


def score_pairs(candidates: DataFrame, spec: MatchSpec) -> DataFrame:
    """(id_a, id_b, n_a, n_b, match_confidence) of the candidates at or above the threshold.

    Similarities are computed one attribute after the other, heaviest first; a pair that can no
    longer reach the threshold, given the bounds of the attributes still open, is dropped between.
    """
    terms: dict = {}
    for attr in spec.attributes:
        if attr.method == "exact":
            same = F.col(f"sim_{attr.column}")
            terms[attr] = F.coalesce(same, F.lit(0.0)) if spec.null_policy == "zero" else same
        else:
            terms[attr] = F.col(f"most_{attr.column}")
    pairs = candidates
    open_ = sorted((a for a in spec.attributes if a.method != "exact"), key=lambda a: -a.weight)
    for attr in open_:
        pairs = pairs.withColumn(f"sim_{attr.column}", jaro_winkler(f"{attr.column}_a", f"{attr.column}_b"))
        terms[attr] = F.col(f"sim_{attr.column}")
        if attr is not open_[-1]:
            best = blocking.confidence(spec, [terms[a] for a in spec.attributes])
            pairs = pairs.filter(best >= F.lit(spec.threshold - blocking.SLACK))
    return (
        pairs.withColumn("match_confidence", blocking.confidence(spec, [terms[a] for a in spec.attributes]))
        .filter(F.col("match_confidence") >= F.lit(spec.threshold))
        .select("id_a", "id_b", "n_a", "n_b", "match_confidence")
    )


@dataclass
class Matched:
    """Records reduced to profiles, and the profile pairs that match.

    ``edges`` lists the pairs when first asked for. ``groups`` needs sums of them only, and where a key is crowded
    it takes these without a list; see ``blocking.pairs_and_sums``.
    """

    keyed: DataFrame
    profiles: DataFrame
    spec: MatchSpec
    tile_rows: int = blocking.TILE_ROWS
    sign_above: int = blocking.SIGN_ABOVE

    @cached_property
    def edges(self) -> DataFrame:
        candidates = blocking.candidate_pairs(self.profiles, self.spec, self.tile_rows, self.sign_above)
        return cut(score_pairs(candidates, self.spec))

    @cached_property
    def _summed(self) -> tuple[DataFrame, DataFrame | None]:
        """Edges, and sums of all others: every matching pair is in one of both."""
        if "edges" in self.__dict__:
            return self.edges, None
        pairs, sums = blocking.pairs_and_sums(self.profiles, self.spec, self.tile_rows, self.sign_above)
        listed = cut(score_pairs(pairs, self.spec))
        if sums is None:
            self.__dict__["edges"] = listed
            return listed, None
        return listed, cut(sums)

    def pairs(self) -> DataFrame:
        """Matching profile pairs with how many record pairs each stands for.

        Copies inside one profile match each other; they appear as one row with id_a = id_b.
        """
        across = self.edges.select(
            "id_a", "id_b", (F.col("n_a") * F.col("n_b")).alias("record_pairs"), "match_confidence"
        )
        inside = self.profiles.filter(_copies_match(self.spec)).select(
            F.col("id").alias("id_a"),
            F.col("id").alias("id_b"),
            (F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("record_pairs"),
            F.col("self_confidence").alias("match_confidence"),
        )
        return across.unionByName(inside)

    def at(self, threshold: float) -> "Matched":
        """The same pairs at a higher threshold, without scoring again."""
        if threshold < self.spec.threshold:
            raise ValueError("pairs below the scored threshold were not kept")
        higher = Matched(
            self.keyed, self.profiles, self.spec.with_options(threshold=threshold), self.tile_rows, self.sign_above
        )
        higher.__dict__["edges"] = self.edges.filter(F.col("match_confidence") >= F.lit(threshold))
        return higher

    def groups(self) -> DataFrame:
        """(golden_id, member, match_confidence) for every record.

        golden_id is the smallest record key of the component; the confidence of a member is the
        mean over its matching pairs, 1.0 without any.
        """
        edges, sums = self._summed
        links, incident = edges.select("id_a", "id_b"), self._incident(edges)
        if sums is not None:
            links = links.unionAll(sums.select("id", "lo"))
            partly = incident.unionByName(sums.select(F.lit(0).alias("_level"), "id", "others", "mass"))
            incident = partly.groupBy("_level", "id").agg(F.sum("others").alias("others"), F.sum("mass").alias("mass"))
        labelled = label_nodes(self.profiles, connected_components(links, "id_a", "id_b"))
        return self._groups(labelled, incident, []).drop("_level")

    def groups_at(self, thresholds: list[float]) -> DataFrame:
        """``groups`` at several thresholds, with a column ``threshold``, from one component search.

        A spanning forest of the scored pairs holds the components of every threshold; its edges count
        once per threshold they reach, as edges of that threshold's own nodes.
        """
        if min(thresholds) < self.spec.threshold:
            raise ValueError("pairs below the scored threshold were not kept")
        levels = F.array(
            *[F.struct(F.lit(i).alias("_level"), F.lit(float(t)).alias("threshold")) for i, t in enumerate(thresholds)]
        )

        def met(confidence: str):
            return F.filter(levels, lambda x: F.col(confidence) >= x["threshold"])

        def own(node: str):
            return F.concat(F.col("_level").cast("string"), F.lit("|"), F.col(node))

        forest = spanning_forest(self.edges, "id_a", "id_b", "match_confidence")
        linked = forest.select("a", "b", F.inline(met("weight"))).select(own("a").alias("a"), own("b").alias("b"))
        found = connected_components(linked, "a", "b")
        parts = [F.regexp_extract(c, r"^\d+\|([\s\S]*)$", 1).alias(c) for c in ("id", "component")]
        labels = found.select(F.substring_index("id", "|", 1).cast("int").alias("_level"), *parts)
        nodes = self.profiles.select("*", F.inline(levels))
        labelled = nodes.join(labels, on=["_level", "id"], how="left").withColumn("component", F.coalesce("component", "id"))
        return self._groups(labelled, self._incident(self.edges, met("match_confidence")), ["threshold"]).drop("_level")

    def _incident(self, edges: DataFrame, levels=None) -> DataFrame:
        """How many records each profile matches, and the sum of the confidences; per level, if given."""
        rows = edges.select("*", F.inline(levels)) if levels is not None else edges.withColumn("_level", F.lit(0))
        ends = rows.select("_level", F.col("id_a").alias("id"), F.col("n_b").alias("others"), "match_confidence").unionAll(
            rows.select("_level", F.col("id_b").alias("id"), F.col("n_a").alias("others"), "match_confidence")
        )
        return ends.groupBy("_level", "id").agg(
            F.sum("others").alias("others"), F.sum(F.col("others") * F.col("match_confidence")).alias("mass")
        )

    def _groups(self, labelled: DataFrame, incident: DataFrame, by: list[str]) -> DataFrame:
        if "_level" not in labelled.columns:
            labelled = labelled.withColumn("_level", F.lit(0))
        limit_of = F.col("threshold") if by else F.lit(self.spec.threshold)
        match_each_other = F.coalesce((F.col("n") > 1) & (F.col("self_confidence") >= limit_of), F.lit(False))
        copies = F.when(match_each_other, F.col("n") - 1).otherwise(F.lit(0))
        others = F.coalesce("others", F.lit(0)) + copies
        mass = F.coalesce("mass", F.lit(0.0)) + copies * F.coalesce("self_confidence", F.lit(0.0))
        # copies that do not match each other (nothing to compare them on) stay apart
        verdict = labelled.join(incident, on=["_level", "id"], how="left").select(
            "profile",
            *by,
            F.when(others == 0, F.lit(None)).otherwise(F.col("component")).alias("golden_id"),
            F.when(others > 0, mass / others).otherwise(F.lit(1.0)).alias("match_confidence"),
        )
        size = self.profiles.agg(F.sum("n").alias("total"), F.max("n").alias("widest")).first()
        limit = hot_limit(size["total"] or 0)
        hot = self.profiles.filter(F.col("n") > limit).select("profile") if (size["widest"] or 0) > limit else None
        return join_unique(self.keyed.select("record_key", "profile"), verdict, "profile", hot).select(
            *by,
            F.coalesce("golden_id", "record_key").alias("golden_id"),
            F.col("record_key").alias(MEMBER),
            "match_confidence",
        )


def _copies_match(spec: MatchSpec):
    return F.coalesce((F.col("n") > 1) & (F.col("self_confidence") >= F.lit(spec.threshold)), F.lit(False))


def match_records(
    df: DataFrame, spec: MatchSpec, tile_rows: int = blocking.TILE_ROWS, sign_above: int = blocking.SIGN_ABOVE
) -> Matched:
    """Score everything in ``df`` (one row per ``record_key``) that can match.

    Profile keys and profiles are each materialised once, because several later steps read them; so are
    matching pairs, when they are asked for.
    """
    keyed = cut(
        blocking.with_profile_key(df, spec).select(
            "record_key",
            "profile",
            *[a.column for a in spec.attributes],
            *[f"_block{i}" for i in range(len(spec.blocking))],
        )
    )
    prof = cut(blocking.profiles(keyed, spec))
    return Matched(keyed, prof, spec, tile_rows, sign_above)


def match_groups(df: DataFrame, spec: MatchSpec) -> DataFrame:
    return match_records(df, spec).groups()


def check_contract(groups: DataFrame) -> DataFrame:
    missing = [c for c in CONTRACT if c not in groups.columns]
    if missing:
        raise ValueError(f"match groups lack {missing}")
    return groups


@dataclass(frozen=True)
class WeightedMatcher:
    """The rule-based matcher behind the ``Matcher`` protocol."""

    spec: MatchSpec

    def match(self, df: DataFrame) -> DataFrame:
        return check_contract(match_groups(df, self.spec))
