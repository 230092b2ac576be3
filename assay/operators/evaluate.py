"""Match quality against known truth, by counting instead of listing pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators.matching import MEMBER, Matched
from assay.session import cut

# Limits behind the tuning advice.
MAX_QUARANTINE_RATE = 0.15
MIN_PRECISION = 0.90
MIN_RECALL = 0.80


def _pairs(n: Column) -> Column:
    wide = n.cast("decimal(38,0)")
    return (wide * (wide - 1) / 2).cast("decimal(38,0)")


def pairwise_quality(
    predicted: DataFrame, truth: DataFrame, member: str = MEMBER, all_truth: bool = False
) -> DataFrame:
    """tp, fp, fn, precision, recall and f1 over record pairs, in one row.

    ``predicted`` has (member, golden_id), ``truth`` (member, true_id). Pairs are counted from a
    contingency table, so a group of any size costs one counter. A member without truth belongs
    to no true pair. True pairs are counted among the predicted members only, so records lost before
    matching do not lower the recall; ``all_truth`` counts them over the whole truth table.
    """
    cells = (
        predicted.select(F.col(member).alias("_m"), "golden_id")
        .join(truth.select(F.col(member).alias("_m"), "true_id"), on="_m", how="left")
        .groupBy("golden_id", "true_id")
        .agg(F.count("*").alias("n"))
    )
    known = F.col("true_id").isNotNull()
    tp = cells.agg(F.sum(F.when(known, _pairs(F.col("n")))).alias("tp"))
    guessed = cells.groupBy("golden_id").agg(F.sum("n").alias("n")).agg(F.sum(_pairs(F.col("n"))).alias("guessed"))
    if all_truth:
        per_truth = truth.groupBy("true_id").agg(F.count("*").alias("n"))
    else:
        per_truth = cells.filter(known).groupBy("true_id").agg(F.sum("n").alias("n"))
    actual = per_truth.agg(F.sum(_pairs(F.col("n"))).alias("actual"))
    zero = F.lit(0).cast("decimal(38,0)")
    # three single-row sides
    row = (
        tp.withColumn("_k", F.lit(1))
        .join(guessed.withColumn("_k", F.lit(1)), on="_k")
        .join(actual.withColumn("_k", F.lit(1)), on="_k")
    )
    counts = row.select(
        F.coalesce("tp", zero).alias("tp"),
        (F.coalesce("guessed", zero) - F.coalesce("tp", zero)).cast("decimal(38,0)").alias("fp"),
        (F.coalesce("actual", zero) - F.coalesce("tp", zero)).cast("decimal(38,0)").alias("fn"),
    )
    return with_rates(counts)


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall and f1 of tp/fp/fn counts; empty denominators give 1, 1 and 0."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(1.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(1.0))
    rated = counts.select("*", precision.alias("precision"), recall.alias("recall"))
    both = F.col("precision") + F.col("recall")
    return rated.select(
        "*", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(F.lit(0.0)).alias("f1")
    )


def group_summary(groups: DataFrame) -> DataFrame:
    """Golden count, de-duplication rate and mean confidence, in one row."""
    per_group = groups.groupBy("golden_id").agg(F.count("*").alias("n"), F.sum("match_confidence").alias("c"))
    return per_group.agg(
        F.count("*").alias("golden_records"),
        F.sum("n").alias("records"),
        (1 - F.count("*") / F.sum("n")).alias("dedup_rate"),
        (F.sum("c") / F.sum("n")).alias("avg_match_confidence"),
    )


def threshold_sweep(matched: Matched, thresholds, truth: DataFrame, member: str = MEMBER) -> DataFrame:
    """Quality and golden count at each threshold; pairs are scored once, components are searched once."""
    groups = cut(matched.groups_at(list(thresholds)))
    cells = (
        groups.select("threshold", F.col(member).alias("_m"), "golden_id")
        .join(truth.select(F.col(member).alias("_m"), "true_id"), on="_m", how="left")
        .groupBy("threshold", "golden_id", "true_id")
        .agg(F.count("*").alias("n"))
    )
    known = F.col("true_id").isNotNull()

    def pairs(rows: DataFrame, group: str, name: str) -> DataFrame:
        sizes = rows.groupBy("threshold", group).agg(F.sum("n").alias("n"))
        return sizes.groupBy("threshold").agg(F.sum(_pairs(F.col("n"))).alias(name))

    tp = cells.filter(known).groupBy("threshold").agg(F.sum(_pairs(F.col("n"))).alias("tp"))
    per_group = groups.groupBy("threshold", "golden_id").agg(F.count("*").alias("n"), F.sum("match_confidence").alias("c"))
    summary = per_group.groupBy("threshold").agg(
        F.count("*").alias("golden_records"),
        F.sum("n").alias("records"),
        (1 - F.count("*") / F.sum("n")).alias("dedup_rate"),
        (F.sum("c") / F.sum("n")).alias("avg_match_confidence"),
    )
    row = summary
    for part in (tp, pairs(cells, "golden_id", "guessed"), pairs(cells.filter(known), "true_id", "actual")):
        row = row.join(part, on="threshold", how="left")  # one row per threshold
    zero = F.lit(0).cast("decimal(38,0)")
    counts = row.select(
        F.coalesce("tp", zero).alias("tp"),
        (F.coalesce("guessed", zero) - F.coalesce("tp", zero)).cast("decimal(38,0)").alias("fp"),
        (F.coalesce("actual", zero) - F.coalesce("tp", zero)).cast("decimal(38,0)").alias("fn"),
        "golden_records",
        "records",
        "dedup_rate",
        "avg_match_confidence",
        "threshold",
    )
    return with_rates(counts)


def tuning_advice(quality: DataFrame, quarantine_rate: Column) -> DataFrame:
    """Flag what the rates suggest to change."""
    return quality.select(
        "*",
        (quarantine_rate > F.lit(MAX_QUARANTINE_RATE)).alias("lower_min_score"),
        (F.col("precision") < F.lit(MIN_PRECISION)).alias("raise_match_threshold"),
        (F.col("recall") < F.lit(MIN_RECALL)).alias("lower_match_threshold"),
    )
