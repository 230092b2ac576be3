"""Raw source rows to the canonical schema, and the published projection back out.

Everything here is a narrow projection, so it runs the same on batch and streaming input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions import text
from assay.specs import EntitySpec, SourceSpec

PROVENANCE = ("_source_system", "_source_priority", "_ingested_at", "_source_file")
MASK = "***MASKED***"


def with_provenance(df: DataFrame, source: SourceSpec, as_of, file_column: Column | None = None) -> DataFrame:
    """Tag rows with source, priority, load time and file."""
    file = F.col("_metadata.file_path") if file_column is None else file_column
    return df.select(
        "*",
        F.lit(source.name).alias("_source_system"),
        F.lit(source.priority).cast("int").alias("_source_priority"),
        F.lit(as_of).cast("timestamp").alias("_ingested_at"),
        file.alias("_source_file"),
    )


def standardize(df: DataFrame, entity: EntitySpec, source: SourceSpec, collapse_ws: bool = False) -> DataFrame:
    """Canonical columns in canonical order; a column the source lacks is a null string."""
    known = set(df.columns)

    def canonical(name: str) -> Column:
        raw = source.columns.get(name)
        if raw is None or raw not in known:
            return F.lit(None).cast("string")
        value = text.clean(F.col(raw), collapse_ws)
        if name in entity.title_case:
            return F.initcap(value)
        if name in entity.lower_case:
            return F.lower(value)
        if name in entity.upper_case:
            return F.upper(value)
        return value

    out = df.select(
        *[canonical(c).alias(c) for c in entity.canonical],
        *[c for c in PROVENANCE if c in known],
    )
    if entity.email_domain_from:
        out = out.withColumn("email_domain", text.email_domain(F.col(entity.email_domain_from)))
    return out


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def with_record_key(df: DataFrame, id_column: str) -> DataFrame:
    """Source-qualified key: raw ids may collide between sources."""
    return df.withColumn("record_key", text.record_key(F.col("_source_system"), F.col(id_column)))


def latest_per_record(df: DataFrame, recency: str = "updated_at") -> DataFrame:
    """One row per ``record_key``, the most recent one, with how many there were.

    Aggregates instead of a window, so copies of a hot key are reduced before the shuffle.
    Rows tied on recency fall back to their values in column order, so the choice repeats.
    """
    columns = [c for c in df.columns if c != "record_key"]
    row = F.struct(text.parse_updated_at(F.col(recency)).alias("_recency"), *columns)
    picked = df.groupBy("record_key").agg(F.max(row).alias("row"), F.count("*").alias("duplicate_count"))
    return picked.select("record_key", *[F.col("row")[c].alias(c) for c in columns], "duplicate_count")


def mask_columns(df: DataFrame, columns, unmasked: bool = False) -> DataFrame:
    """Replace PII by a fixed text unless the caller is privileged; nulls are masked as well."""
    if unmasked:
        return df
    return df.select(*[F.lit(MASK).alias(c) if c in set(columns) else F.col(c) for c in df.columns])


def publish(golden: DataFrame, entity: EntitySpec) -> DataFrame:
    """Published golden projection of an entity."""
    return golden.select(
        "golden_id",
        *[F.col(c).alias(name) for c, name in entity.gold_columns],
        "dq_score",
        "dq_issues",
        "match_confidence",
        "source_record_count",
        "source_customer_ids",
        F.col("_source_system").alias("surviving_source_system"),
        "review_status",
        "merged_at",
    )
