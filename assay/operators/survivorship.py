"""One golden record per match group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions import text
from assay.operators.matching import MEMBER
from assay.session import cut
from assay.specs import SurvivorshipSpec

_LAST = 2**62


def source_rank(source_priority, column: str = "_source_system") -> Column:
    """Position in the priority list; null for a source that is not listed."""
    ranks = [F.when(F.col(column) == F.lit(s), F.lit(i)) for i, s in enumerate(source_priority)]
    return F.coalesce(*ranks) if ranks else F.lit(None).cast("int")


def survivor_order(spec: SurvivorshipSpec, key: str, recency: str = "updated_at", parsed: bool = False) -> Column:
    """Smallest wins: best source first, then most recent, then the key, so no tie remains."""
    when = F.col(recency) if parsed else text.parse_updated_at(F.col(recency))
    return F.struct(
        F.coalesce(source_rank(spec.source_priority), F.lit(len(spec.source_priority))).alias("rank"),
        F.coalesce(-F.unix_micros(when.cast("timestamp")), F.lit(_LAST)).alias("age"),
        F.col(key).alias("tie"),
    )


def review_status(count: Column, confidence: Column, auto_merge_threshold: float) -> Column:
    return (
        F.when(count == 1, F.lit("single_source"))
        .when(confidence >= F.lit(auto_merge_threshold), F.lit("auto_merged"))
        .otherwise(F.lit("needs_review"))
    )


def surviving_rows(joined: DataFrame, spec: SurvivorshipSpec, group: str, key: str, **order) -> DataFrame:
    """Whole-record survivorship: the best row of every group.

    An aggregate, not a window: every task first keeps one row per group, so a group holding a
    large share of all rows shuffles one row per task.
    """
    columns = [c for c in joined.columns if c != group]
    best = F.min_by(F.struct(*columns), survivor_order(spec, key, **order)).alias("best")
    return joined.groupBy(group).agg(best).select(group, *[F.col("best")[c].alias(c) for c in columns])


def surviving_values(joined: DataFrame, spec: SurvivorshipSpec, group: str, key: str, columns, **order) -> DataFrame:
    """Attribute survivorship: for every column the best non-null value of the group."""
    rank = survivor_order(spec, key, **order)
    return joined.groupBy(group).agg(*[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns])


def roll_up(groups: DataFrame) -> DataFrame:
    """Member count and mean confidence of every group, combined before the shuffle."""
    return groups.groupBy("golden_id").agg(
        F.count("*").alias("source_record_count"), F.avg("match_confidence").alias("match_confidence")
    )


def golden_members(groups: DataFrame) -> DataFrame:
    """(golden_id, member): which record went into which golden record, one row each."""
    return groups.select("golden_id", F.col(MEMBER).alias("member")).distinct()


# Members from which a group's list is put together from parts that several tasks have sorted.
CROWDED = 100_000


def with_member_lists(golden: DataFrame, groups: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Golden rows with ``source_customer_ids``, the sorted ids of all members, whatever their number.

    Members of a crowded group (by ``source_record_count``) are dealt out by range, each task sorts and lists
    its own, and the lists are put one behind the other. The row itself holds the whole list: where groups of
    many millions are expected, publish ``golden_members`` and leave the list out.
    """
    members = golden_members(groups)
    large = golden.filter(F.col("source_record_count") > crowded).select("golden_id")
    sorted_list = F.array_sort(F.collect_list("member"))
    if large.isEmpty():
        listed = members.groupBy("golden_id").agg(sorted_list.alias("source_customer_ids"))
        return golden.join(listed, on="golden_id")
    plain = members.join(large, on="golden_id", how="left_anti").groupBy("golden_id").agg(sorted_list.alias("source_customer_ids"))
    held = members.join(large, on="golden_id", how="left_semi")
    # ranges without common keys: a task has all of a stretch of members
    dealt = cut(held.repartitionByRange("golden_id", "member").withColumn("part", F.spark_partition_id()))
    parts = dealt.groupBy("golden_id", "part").agg(sorted_list.alias("list"))
    whole = F.flatten(F.col("parts.list")).alias("source_customer_ids")
    joined = parts.groupBy("golden_id").agg(F.array_sort(F.collect_list(F.struct("part", "list"))).alias("parts"))
    return golden.join(plain.unionByName(joined.select("golden_id", whole)), on="golden_id")


def golden_records(
    passed: DataFrame,
    groups: DataFrame,
    spec: SurvivorshipSpec,
    as_of,
    member_key: str = "record_key",
    **order,
) -> DataFrame:
    """Surviving record of every group with its size, confidence and review status."""
    members = groups.select("golden_id", F.col(MEMBER).alias(member_key))
    joined = passed.join(members, on=member_key)
    winners = surviving_rows(joined, spec, "golden_id", member_key, **order)
    rolled = roll_up(groups)
    return winners.join(rolled, on="golden_id").select(
        "*",
        F.lit(as_of).cast("timestamp").alias("merged_at"),
        review_status(F.col("source_record_count"), F.col("match_confidence"), spec.auto_merge_threshold).alias(
            "review_status"
        ),
    )
