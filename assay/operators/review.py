"""Steward review queue, approved overrides and the business glossary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators.upsert import latest_per_key, upsert

# Record types and column lists of the control tables.
DQ_QUARANTINE = "dq_quarantine"
LOW_CONFIDENCE = "low_confidence_match"
STEWARD_DECISIONS = (
    "decision_id string, entity string, record_type string, business_key string, "
    "decision string, reviewer string, notes string, decided_at timestamp"
)
REVIEW_QUEUE = (
    "entity string, record_type string, business_key string, reason string, "
    "detected_at timestamp, queued_at timestamp"
)
GLOSSARY_SUBMISSIONS = (
    "submission_id string, entity string, column_name string, proposed_term string, "
    "proposed_definition string, submitted_by string, submitted_at timestamp, status string, "
    "reviewed_by string, reviewed_at timestamp, review_notes string"
)
BUSINESS_GLOSSARY = (
    "entity string, column_name string, glossary_term string, steward string, registered_at timestamp"
)
GLOSSARY_KEY = ["entity", "column_name"]


def quarantine_items(entity: str, quarantined: DataFrame, key: str, as_of, detected: str = "_ingested_at") -> DataFrame:
    return quarantined.select(
        F.lit(entity).alias("entity"),
        F.lit(DQ_QUARANTINE).alias("record_type"),
        F.col(key).cast("string").alias("business_key"),
        F.col("dq_issues").alias("reason"),
        F.col(detected).cast("timestamp").alias("detected_at"),
        F.lit(as_of).cast("timestamp").alias("queued_at"),
    )


def low_confidence_items(entity: str, golden: DataFrame, as_of) -> DataFrame:
    return golden.filter(F.col("review_status") == "needs_review").select(
        F.lit(entity).alias("entity"),
        F.lit(LOW_CONFIDENCE).alias("record_type"),
        F.col("golden_id").cast("string").alias("business_key"),
        F.concat(F.lit("match_confidence="), F.round("match_confidence", 3)).alias("reason"),
        F.col("merged_at").cast("timestamp").alias("detected_at"),
        F.lit(as_of).cast("timestamp").alias("queued_at"),
    )


def review_queue(items: list[DataFrame], decisions: DataFrame | None = None, include_decided: bool = False) -> DataFrame:
    """Everything waiting for a steward; what was already decided leaves the queue."""
    queue = items[0]
    for more in items[1:]:
        queue = queue.unionByName(more)
    if decisions is None or include_decided:
        return queue
    key = ["entity", "record_type", "business_key"]
    return queue.join(decisions.select(*key), on=key, how="left_anti").select(*queue.columns)


def approved_overrides(decisions: DataFrame, entity: str, record_type: str = DQ_QUARANTINE) -> DataFrame:
    """Distinct approved keys, as a table to join with."""
    return (
        decisions.filter(
            (F.col("entity") == entity) & (F.col("record_type") == record_type) & (F.col("decision") == "approved")
        )
        .select("business_key")
        .distinct()
    )


def configured_terms(spark: SparkSession, entities, steward: str, as_of) -> DataFrame:
    """Glossary rows declared in the entity settings."""
    rows = [(e.entity, column, term, steward) for e in entities for column, term in e.glossary.items()]
    declared = spark.createDataFrame(rows, "entity string, column_name string, glossary_term string, steward string")
    return declared.withColumn("registered_at", F.lit(as_of).cast("timestamp"))


def register_terms(glossary: DataFrame, terms: DataFrame) -> DataFrame:
    return upsert(glossary, terms, GLOSSARY_KEY, "registered_at")


def approved_terms(submissions: DataFrame) -> DataFrame:
    """Approved submissions as glossary rows; the last review of a key wins."""
    rows = submissions.filter(F.col("status") == "approved").select(
        "entity",
        "column_name",
        F.col("proposed_term").alias("glossary_term"),
        F.col("submitted_by").alias("steward"),
        F.col("reviewed_at").alias("registered_at"),
    )
    return latest_per_key(rows, GLOSSARY_KEY, "registered_at")


def apply_submissions(glossary: DataFrame, submissions: DataFrame) -> DataFrame:
    return upsert(glossary, approved_terms(submissions), GLOSSARY_KEY, "registered_at")
