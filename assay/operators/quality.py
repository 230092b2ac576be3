"""Weighted quality rules, row gates and the quarantine split."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from assay.specs import RuleSpec


class GateFailure(RuntimeError):
    """A gate that must stop the run was not met."""


def rule_condition(rule: RuleSpec, null_as_fail: bool = True) -> Column:
    """True when the row satisfies the rule. With ``null_as_fail`` a null value is a plain
    failure; without it an allowed-values rule on a null value is unknown."""
    value = F.col(rule.column)
    if rule.type == "not_null":
        return value.isNotNull()
    if rule.type == "regex":
        return value.isNotNull() & value.rlike(rule.pattern)
    passed = value.isin(*rule.values)
    return F.coalesce(passed, F.lit(False)) if null_as_fail else passed


def score(df: DataFrame, rules, null_as_fail: bool = True) -> DataFrame:
    """Add ``dq_score`` (share of rule weight met) and ``dq_issues`` (failed rules, in order)."""
    total = sum(r.weight for r in rules)
    passed = [(r, rule_condition(r, null_as_fail)) for r in rules]
    met = reduce(lambda a, b: a + b, [F.when(ok, F.lit(r.weight)).otherwise(F.lit(0.0)) for r, ok in passed])
    failed = F.concat_ws(",", *[F.when(~ok, F.lit(r.name)) for r, ok in passed])
    return df.select("*", (met / F.lit(total)).alias("dq_score"), failed.alias("dq_issues"))


def expect_all_or_drop(df: DataFrame, expectations: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (kept, rejected); rejected rows carry the names of what they failed."""
    checks = {name: F.coalesce(F.expr(sql), F.lit(False)) for name, sql in expectations.items()}
    all_met = reduce(lambda a, b: a & b, checks.values())
    failed = F.concat_ws(",", *[F.when(~ok, F.lit(name)) for name, ok in checks.items()])
    return df.filter(all_met), df.filter(~all_met).withColumn("failed_expectations", failed)


def identity_expectations(id_column: str, name_column: str) -> dict[str, str]:
    return {f"has_{id_column}": f"{id_column} IS NOT NULL", "has_name": f"{name_column} IS NOT NULL"}


def violation_counts(df: DataFrame, expectations: dict[str, str]) -> DataFrame:
    """One row per expectation with the number of violating rows, from one pass over ``df``."""
    counts = df.agg(
        *[
            F.count(F.when(~F.coalesce(F.expr(sql), F.lit(False)), 1)).alias(name)
            for name, sql in expectations.items()
        ]
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("expectation"), F.col(n).alias("violations")) for n in expectations])
    return counts.select(F.inline(pairs))


def gold_expectations(min_score: float, honour_override: bool = True) -> dict[str, str]:
    """Conditions every golden row must meet. A steward-approved low score is accepted."""
    scored = f"dq_score >= {min_score}D"
    return {
        "has_golden_id": "golden_id IS NOT NULL",
        "min_dq_score": f"({scored}) OR coalesce(steward_override, false)" if honour_override else scored,
    }


def expect_or_fail(df: DataFrame, expectations: dict[str, str]) -> DataFrame:
    """Return ``df`` unchanged, or raise before anything is published."""
    broken = [r for r in violation_counts(df, expectations).collect() if r["violations"]]
    if broken:
        raise GateFailure(", ".join(f"{r['expectation']}: {r['violations']} rows" for r in broken))
    return df


def expect_on_write(df: DataFrame, expectations: dict[str, str]) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` that counts its violations while it is written, and a check to call once it is.

    The check raises like ``expect_or_fail``, without reading the rows again; publish only after it.
    """
    seen = Observation()
    counts = [F.count(F.when(~F.coalesce(F.expr(sql), F.lit(False)), 1)).alias(n) for n, sql in expectations.items()]

    def check() -> None:
        broken = {n: v for n, v in seen.get.items() if v}
        if broken:
            raise GateFailure(", ".join(f"{n}: {v} rows" for n, v in broken.items()))

    return df.observe(seen, *counts), check


def flag_overrides(scored: DataFrame, approved: DataFrame | None, min_score: float, key: str) -> DataFrame:
    """Mark low-score rows that a steward approved. Approvals are joined, never listed."""
    if approved is None:
        return scored.withColumn("steward_override", F.lit(False))
    keys = approved.select(F.col("business_key").alias(key)).distinct().withColumn("_approved", F.lit(True))
    low = F.col("dq_score") < F.lit(min_score)
    return (
        scored.join(keys, on=key, how="left")
        .withColumn("steward_override", low & F.coalesce(F.col("_approved"), F.lit(False)))
        .drop("_approved")
        .select(*scored.columns, "steward_override")
    )


def passed(scored: DataFrame, min_score: float, approved: DataFrame | None = None, key: str = "record_key") -> DataFrame:
    """Rows at or above the minimum, plus approved ones below it."""
    flagged = flag_overrides(scored, approved, min_score, key)
    return flagged.filter((F.col("dq_score") >= F.lit(min_score)) | F.col("steward_override"))


def quarantined(
    scored: DataFrame, min_score: float, approved: DataFrame | None = None, key: str = "record_key"
) -> DataFrame:
    """Rows below the minimum that nobody approved."""
    low = scored.filter(F.col("dq_score") < F.lit(min_score))
    if approved is None:
        return low
    return low.join(approved.select(F.col("business_key").alias(key)), on=key, how="left_anti").select(*scored.columns)


class Scorer(Protocol):
    """Anything that adds ``dq_score`` (0 to 1) and ``dq_issues`` to records; a run may bring its own."""

    def score(self, df: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class RuleScorer:
    """The scorer of a run that brings none: weighted rules."""

    rules: tuple[RuleSpec, ...]
    null_as_fail: bool = True

    def score(self, df: DataFrame) -> DataFrame:
        return score(df, self.rules, self.null_as_fail)


def score_distribution(scored: DataFrame, min_score: float, *by: str) -> DataFrame:
    """Count, mean, sample deviation, quartiles and quarantine rate of the scores.

    Scores are sums over a fixed rule list, so few distinct values exist: the exact percentile
    keeps one counter per distinct value and is combined before the shuffle.
    """
    s = F.col("dq_score")
    return scored.groupBy(*by).agg(
        F.count("*").alias("count"),
        F.avg(s).alias("mean"),
        F.stddev_samp(s).alias("std"),
        F.min(s).alias("min"),
        F.percentile(s, 0.25).alias("p25"),
        F.percentile(s, 0.5).alias("p50"),
        F.percentile(s, 0.75).alias("p75"),
        F.max(s).alias("max"),
        F.avg(F.when(s < F.lit(min_score), 1.0).otherwise(0.0)).alias("quarantine_rate"),
    )


def blank_invalid(df: DataFrame, rules, columns) -> DataFrame:
    """Null every listed column whose own rule failed, so junk cannot agree with junk."""
    by_column: dict[str, list[RuleSpec]] = {}
    for rule in rules:
        if rule.column in columns:
            by_column.setdefault(rule.column, []).append(rule)
    fixed = {
        c: F.when(reduce(lambda a, b: a & b, [rule_condition(r) for r in rs]), F.col(c)) for c, rs in by_column.items()
    }
    return df.withColumns(fixed) if fixed else df
