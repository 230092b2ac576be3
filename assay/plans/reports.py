"""Trend and service-level reports over the logs and layers.

All are one aggregate with map-side combine; entities are unioned before the aggregate, so a
report over any number of them is still one shuffle. ``since`` bounds the time range and reaches
the scan as a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators.standardize import union_all


def _since(df: DataFrame, column: str, since) -> DataFrame:
    return df if since is None else df.filter(F.col(column) >= F.lit(since).cast("timestamp"))


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _percent(part: Column, whole: Column) -> Column:
    return F.round(part * F.lit(100.0) / whole, 1)


def by_entity(tables: dict[str, DataFrame]) -> DataFrame:
    """The tables of several entities as one, tagged with the entity."""
    return union_all([df.withColumn("entity", F.lit(name)) for name, df in tables.items()])


def freshness_compliance(log: DataFrame, since=None) -> DataFrame:
    ok = _count_if(F.col("status") == "ok")
    return (
        _since(log, "checked_at", since)
        .groupBy("entity", "source", F.to_date("checked_at").alias("check_date"))
        .agg(F.count("*").alias("total_checks"), ok.alias("ok_checks"), _percent(ok, F.count("*")).alias("compliance_pct"))
        .orderBy(F.col("check_date").desc(), "entity", "source")
    )


def dq_trend(scored: DataFrame, min_score: float, since=None, loaded: str = "_ingested_at") -> DataFrame:
    low = _count_if(F.col("dq_score") < F.lit(min_score))
    return (
        _since(scored, loaded, since)
        .groupBy("entity", F.to_date(loaded).alias("d"))
        .agg(
            F.count("*").alias("total"),
            F.avg("dq_score").alias("avg_dq_score"),
            low.alias("quarantined"),
            _percent(low, F.count("*")).alias("quarantine_pct"),
        )
        .orderBy(F.col("d").desc(), "entity")
    )


def merge_trend(golden: DataFrame, since=None, merged: str = "merged_at") -> DataFrame:
    status = F.col("review_status")
    return (
        _since(golden, merged, since)
        .groupBy("entity", F.to_date(merged).alias("d"))
        .agg(
            F.count("*").alias("golden_records"),
            F.sum("source_record_count").alias("source_records_consumed"),
            F.round(F.avg("match_confidence"), 3).alias("avg_match_confidence"),
            _count_if(status == "auto_merged").alias("auto_merged"),
            _count_if(status == "needs_review").alias("needs_review"),
            _count_if(status == "single_source").alias("single_source"),
        )
        .orderBy(F.col("d").desc(), "entity")
    )


def elapsed_hours(start: str, as_of) -> Column:
    """Whole hours between a timestamp column and ``as_of``."""
    return F.timestamp_diff("HOUR", F.col(start).cast("timestamp"), F.lit(as_of).cast("timestamp"))


def backlog_age(queue: DataFrame, as_of) -> DataFrame:
    age = elapsed_hours("detected_at", as_of)
    return (
        queue.groupBy("entity", "record_type")
        .agg(
            F.count("*").alias("backlog_size"),
            F.round(F.avg(age), 1).alias("avg_age_hours"),
            F.max(age).alias("oldest_item_hours"),
        )
        .orderBy(F.col("backlog_size").desc(), "entity", "record_type")
    )


def decision_throughput(decisions: DataFrame, since=None) -> DataFrame:
    return (
        _since(decisions, "decided_at", since)
        .groupBy("entity", "record_type", "decision", F.to_date("decided_at").alias("d"))
        .agg(F.count("*").alias("decisions"))
        .orderBy(F.col("d").desc(), "entity", "record_type", "decision")
    )


def _minutes(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(60_000_000.0)


def kpis(
    scored: DataFrame,
    golden: DataFrame,
    queue: DataFrame,
    required: DataFrame,
    glossary: DataFrame,
    min_score: float,
    loaded: str = "_ingested_at",
) -> DataFrame:
    """One row per entity: quality, de-duplication, review and coverage figures.

    ``scored`` needs (entity, dq_score, steward_override), ``golden`` (entity, golden columns, load time of the
    surviving record). A record passes by its score or by a steward's approval; what does not pass is
    quarantined. Time to gold is the mean time from load to merge over golden records.
    """
    passes = (F.col("dq_score") >= F.lit(min_score)) | F.coalesce("steward_override", F.lit(False))
    quality = scored.groupBy("entity").agg(
        F.count("*").alias("scored_records"),
        _count_if(passes).alias("passed_records"),
        F.avg(F.when(passes, 1.0).otherwise(0.0)).alias("dq_pass_rate"),
        F.avg(F.when(passes, 0.0).otherwise(1.0)).alias("quarantine_rate"),
    )
    status = F.col("review_status")
    merged = golden.groupBy("entity").agg(
        F.count("*").alias("golden_records"),
        F.sum("source_record_count").alias("_consumed"),
        F.avg("match_confidence").alias("avg_match_confidence"),
        _count_if(status == "auto_merged").alias("auto_merged"),
        _count_if(status == "needs_review").alias("needs_review"),
        _count_if(status == "single_source").alias("single_source"),
        F.avg(_minutes(F.col(loaded), F.col("merged_at"))).alias("time_to_gold_minutes"),
    )
    backlog = queue.groupBy("entity").agg(F.count("*").alias("review_backlog"))
    known = glossary.select("entity", "column_name").distinct().withColumn("_known", F.lit(1))
    coverage = (
        required.join(known, on=["entity", "column_name"], how="left")
        .groupBy("entity")
        .agg((F.count("_known") / F.count("*")).alias("glossary_coverage"))
    )
    joined = (
        quality.join(merged, on="entity", how="left")
        .join(backlog, on="entity", how="left")
        .join(coverage, on="entity", how="left")
    )
    return joined.select(
        "entity",
        "scored_records",
        "passed_records",
        "dq_pass_rate",
        "quarantine_rate",
        "golden_records",
        (1 - F.col("golden_records") / F.col("_consumed")).alias("dedup_rate"),
        "avg_match_confidence",
        "auto_merged",
        "needs_review",
        "single_source",
        F.coalesce("review_backlog", F.lit(0)).alias("review_backlog"),
        "glossary_coverage",
        "time_to_gold_minutes",
    )
