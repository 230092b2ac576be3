import pytest

from assay.operators import evaluate
from assay.operators.matching import MEMBER
from pyspark.sql import functions as F


def quality(spark, predicted, truth):
    p = spark.createDataFrame(predicted, f"{MEMBER} string, golden_id string")
    t = spark.createDataFrame(truth, f"{MEMBER} string, true_id string")
    return evaluate.pairwise_quality(p, t).first()


def test_one_false_merge(spark):
    merged = [(f"m{n}", "g") for n in range(6)]
    row = quality(spark, merged, [(m, "x" if m < "m4" else "y") for m, _ in merged])
    assert (int(row.tp), int(row.fp), int(row.fn)) == (7, 8, 0)
    assert row.precision == pytest.approx(7 / 15) and row.recall == 1.0 and row.f1 == pytest.approx(14 / 22)


def test_missed_pair_and_unknown_member(spark):
    row = quality(spark, [("A", "G1"), ("B", "G2"), ("X", "G1"), ("Y", "G1")], [("A", "T1"), ("B", "T1")])
    assert (int(row.tp), int(row.fp), int(row.fn)) == (0, 3, 1)
    assert row.precision == 0.0 and row.recall == 0.0 and row.f1 == 0.0


def test_empty_denominators(spark):
    row = quality(spark, [("A", "G1"), ("B", "G2")], [("A", "T1"), ("B", "T2")])
    assert (row.precision, row.recall, row.f1) == (1.0, 1.0, 1.0)
    row = quality(spark, [], [])
    assert (int(row.tp), int(row.fp), int(row.fn)) == (0, 0, 0)


def test_huge_groups_do_not_overflow(spark):
    n = F.lit(10_000_000_000).cast("long")
    assert int(spark.range(1).select(evaluate._pairs(n)).first()[0]) == 10_000_000_000 * 9_999_999_999 // 2


def test_advice(spark):
    df = spark.createDataFrame([(0.8, 0.9)], "precision double, recall double")
    row = evaluate.tuning_advice(df, F.lit(0.2)).first()
    assert (row.lower_min_score, row.raise_match_threshold, row.lower_match_threshold) == (True, True, False)


def test_summary(spark):
    groups = spark.createDataFrame([("G", "a", 0.8), ("G", "b", 1.0), ("H", "c", 1.0)], f"golden_id string, {MEMBER} string, match_confidence double")
    row = evaluate.group_summary(groups).first()
    assert (row.golden_records, row.records) == (2, 3) and row.dedup_rate == pytest.approx(1 / 3)
