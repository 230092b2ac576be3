"""Checks around a run. Each returns status rows; ``enforce`` is what stops the run.

A status row has (check, subject, status, detail); status 'ok', 'warn' and 'skipped' let the run
go on, 'failed', 'stale' and 'error' do not.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from assay.operators.quality import GateFailure
from assay.operators.standardize import union_all
from assay.sources.files import latest_file
from assay.specs import CostSpec

# Limits of the shipped checks.
Z_LIMIT = 3.0
QUARANTINE_LIMIT = 0.15
MIN_HISTORY_DAYS = 3
VOLUME_LOOKBACK_DAYS = 8
LINEAGE_WINDOW_DAYS = 1

STOPPING = ("failed", "stale", "error")


def enforce(status: DataFrame) -> DataFrame:
    """Raise when any status row stops the run, with how many there are per status and the first of each."""
    first = F.min(F.struct(F.col("subject").cast("string").alias("subject"), F.col("detail").cast("string").alias("detail")))
    bad = (
        status.filter(F.col("status").isin(*STOPPING))
        .groupBy("status")
        .agg(F.count("*").alias("n"), first.alias("first"))
        .orderBy("status")
        .collect()  # a row for each of STOPPING at most
    )
    if bad:
        told = [f"{r['status']}: {r['n']}, first {r['first']['subject']} ({r['first']['detail']})" for r in bad]
        raise GateFailure("; ".join(told))
    return status


def _hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3_600_000_000.0)


def freshness(latest: DataFrame, sla: DataFrame, as_of) -> DataFrame:
    """Age of the newest file or event of every source against its allowed hours.

    ``latest`` has (entity, source, latest, problem), ``sla`` (entity, source, sla_hours). A source
    without any file is an error.
    """
    now = F.lit(as_of).cast("timestamp")
    joined = sla.join(latest, on=["entity", "source"], how="left").withColumn(
        "age_hours", _hours_between(now, F.col("latest").cast("timestamp"))
    )
    late = F.col("age_hours") > F.col("sla_hours")
    status = F.when(F.col("latest").isNull(), "error").when(late, "stale").otherwise("ok")
    detail = F.when(F.col("latest").isNull(), F.coalesce("problem", F.lit("nothing has arrived"))).when(
        late,
        F.concat(
            F.lit("newest arrival "), F.format_string("%.1f", "age_hours"), F.lit(" hours ago, allowed "),
            F.format_string("%.0f", "sla_hours"),
        ),
    )
    return joined.select(
        "entity", "source", status.alias("status"), detail.alias("detail"), "age_hours",
        F.col("sla_hours").cast("double").alias("sla_hours"), now.alias("checked_at"),
    )


def landing_freshness(spark: SparkSession, sources, as_of, paths: dict | None = None) -> DataFrame:
    """Freshness of the landing folders; only file listings are read."""
    latest = union_all([latest_file(spark, s, (paths or {}).get((s.entity, s.name))) for s in sources])
    sla = spark.createDataFrame(
        [(s.entity, s.name, float(s.freshness_sla_hours)) for s in sources], "entity string, source string, sla_hours double"
    )
    return freshness(latest, sla, as_of)


def event_freshness(events: DataFrame, sla: DataFrame, as_of, source: str, ts: str, entity: str) -> DataFrame:
    """Freshness from the newest event of each source in a table."""
    latest = events.groupBy(F.lit(entity).alias("entity"), F.col(source).alias("source")).agg(F.max(ts).alias("latest"))
    return freshness(latest.withColumn("problem", F.lit(None).cast("string")), sla, as_of)


def as_status(check: str, df: DataFrame, subject: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), subject.alias("subject"), "status", F.col("detail").cast("string").alias("detail"))


def daily_counts(df: DataFrame, entity: str, ts: str, as_of: date, lookback: int = VOLUME_LOOKBACK_DAYS) -> DataFrame:
    """(entity, d, row_count) of the last days."""
    start = F.lit(as_of - timedelta(days=lookback)).cast("timestamp")
    return (
        df.filter(F.col(ts) >= start)
        .groupBy(F.col(entity).alias("entity"), F.to_date(ts).alias("d"))
        .agg(F.count("*").alias("row_count"))
    )


def volume_anomaly(counts: DataFrame, z_limit: float = Z_LIMIT) -> DataFrame:
    """Last day of every entity against the days before it.

    ``counts`` is one row per entity and day, so the window holds a handful of rows.
    """
    newest = W.partitionBy("entity").orderBy(F.col("d").desc())
    ranked = counts.withColumn("_n", F.row_number().over(newest))
    before = F.when(F.col("_n") > 1, F.col("row_count").cast("double"))
    stats = ranked.groupBy("entity").agg(
        F.max(F.when(F.col("_n") == 1, F.col("d"))).alias("d"),
        F.max(F.when(F.col("_n") == 1, F.col("row_count"))).alias("row_count"),
        F.count("*").alias("days"),
        F.avg(before).alias("baseline_mean"),
        F.stddev_samp(before).alias("baseline_std"),
    )
    spread = F.when(F.col("baseline_std") == 0, 1.0).otherwise(F.col("baseline_std"))
    z = F.when(F.col("days") >= MIN_HISTORY_DAYS, (F.col("row_count") - F.col("baseline_mean")) / spread)
    scored = stats.withColumn("z", z)
    status = (
        F.when(F.col("days") < MIN_HISTORY_DAYS, "skipped").when(F.abs("z") > z_limit, "failed").otherwise("ok")
    )
    return scored.select(
        "entity", "d", "row_count", "days", "baseline_mean", "baseline_std", "z", status.alias("status"),
        F.format_string("z-score %.2f over %d days", "z", "days").alias("detail"),
    )


def quarantine_rate(
    scored: DataFrame, entities: list[str], min_score: float, day: date, ts: str, limit: float = QUARANTINE_LIMIT
) -> DataFrame:
    """Share of the records since ``day`` that were quarantined, one row per listed entity.

    A record with a low score that a steward let through (``steward_override``, if there is that column)
    was not quarantined. The day is a filter on the scan, so older records are not read.
    """
    low = F.col("dq_score") < F.lit(min_score)
    if "steward_override" in scored.columns:
        low = low & ~F.coalesce("steward_override", F.lit(False))
    counts = (
        scored.filter(F.col(ts) >= F.lit(day).cast("timestamp"))
        .groupBy("entity")
        .agg(F.count(F.when(low, 1)).alias("quarantined"), F.count("*").alias("scored"))
    )
    listed = scored.sparkSession.createDataFrame([(e,) for e in entities], "entity string")
    rate = F.col("quarantined") * 1.0 / F.greatest(F.col("scored"), F.lit(1))
    return (
        listed.join(counts, on="entity", how="left")
        .fillna(0, ["quarantined", "scored"])
        .withColumn("rate", rate.cast("double"))
        .select(
            "*",
            F.when(F.col("rate") > limit, "failed").otherwise("ok").alias("status"),
            F.format_string("%.1f%% quarantined", F.col("rate") * 100).alias("detail"),
        )
    )


def glossary_coverage(required: DataFrame, glossary: DataFrame) -> DataFrame:
    """Required (entity, column_name) rows that nobody registered."""
    return required.join(glossary.select("entity", "column_name"), on=["entity", "column_name"], how="left_anti")


def missing_lineage(expected: DataFrame, lineage: DataFrame, as_of: date, days: int = LINEAGE_WINDOW_DAYS) -> DataFrame:
    """Expected (source_table, target_table) edges without a lineage event in the time window."""
    recent = lineage.filter(F.col("event_time") >= F.lit(as_of - timedelta(days=days)).cast("timestamp")).select(
        F.col("source_table_full_name").alias("source_table"), F.col("target_table_full_name").alias("target_table")
    )
    return expected.join(recent, on=["source_table", "target_table"], how="left_anti")


def missing_status(check: str, entities: DataFrame, missing: DataFrame, subject: Column) -> DataFrame:
    """One status row per entity from a table of missing things."""
    gaps = missing.groupBy("entity").agg(F.count("*").alias("_gaps"), F.min(subject).alias("_first"))
    return entities.select("entity").distinct().join(gaps, on="entity", how="left").select(
        F.lit(check).alias("check"),
        F.col("entity").alias("subject"),
        F.when(F.col("_gaps") > 0, "failed").otherwise("ok").alias("status"),
        F.when(F.col("_gaps") > 0, F.concat(F.col("_gaps"), F.lit(" missing, first: "), F.col("_first"))).alias("detail"),
    )


def tagged_usage(usage: DataFrame, tag: str) -> DataFrame:
    """Usage rows of a project, by tag or by job name; an empty tag would match every job."""
    if not tag:
        raise ValueError("usage needs a project tag")
    job = F.col("usage_metadata.job_name")
    return usage.filter((F.col("custom_tags")["project"] == F.lit(tag)) | job.contains(tag))


def cost_by_sku(usage: DataFrame, prices: dict[str, float], start: date, end: date) -> DataFrame:
    """Units and estimated spend per SKU in [start, end).

    The price list is configuration, so it becomes a literal lookup and not a join.
    """
    known = [(k, v) for k, v in prices.items() if k != "default"]
    price = F.coalesce(
        *[F.when(F.col("sku_name") == F.lit(k), F.lit(v)) for k, v in known], F.lit(prices["default"])
    )
    summed = (
        usage.filter((F.col("usage_date") >= F.lit(start)) & (F.col("usage_date") < F.lit(end)))
        .groupBy("sku_name")
        .agg(F.coalesce(F.sum(F.col("usage_quantity").cast("double")), F.lit(0.0)).alias("dbus"))
    )
    return summed.select(
        F.lit(start).alias("window_start"),
        F.lit(end).alias("window_end"),
        "sku_name",
        "dbus",
        (F.col("dbus") * price).alias("estimated_usd"),
    )


def cost_status(by_sku: DataFrame, spec: CostSpec) -> DataFrame:
    """Total spend against the soft and the hard limit, in one row."""
    total = by_sku.agg(F.count("*").alias("skus"), F.coalesce(F.sum("estimated_usd"), F.lit(0.0)).alias("total_usd"))
    status = (
        F.when(F.col("skus") == 0, "skipped")
        .when(F.col("total_usd") > spec.hard_limit_usd, "failed")
        .when(F.col("total_usd") > spec.daily_budget_usd, "warn")
        .otherwise("ok")
    )
    return total.select("*", status.alias("status"), F.format_string("$%.2f over %d SKUs", "total_usd", "skus").alias("detail"))
