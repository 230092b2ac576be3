import pytest

from assay.operators import quality
from assay.operators.quality import GateFailure
from assay.specs import RuleSpec, load_entity

ENTITY = load_entity("customer")
RULES = ENTITY.rules
FULL = {
    "customer_id": "NL7", "full_name": "Ines Okafor", "email": "ines@okafor.example", "tax_id": "NL-20-774",
    "address_line1": "4 Quay Row", "country_code": "DE", "postal_code": "20457",
}
COLUMNS = ", ".join(f"{c} string" for c in FULL)


def scored(spark, *changes):
    rows = [tuple((FULL | c).values()) for c in changes]
    return {r.customer_id: r for r in quality.score(spark.createDataFrame(rows, COLUMNS), RULES).collect()}


def test_every_rule_costs_its_weight_and_is_listed_alone(spark):
    broken = {"not_null": None, "regex": "~", "allowed_values": "nowhere"}
    total = sum(r.weight for r in RULES)
    for rule in RULES:
        change = {rule.column: broken[rule.type]}
        (row,) = scored(spark, change).values()
        hit = [r for r in RULES if r.column == rule.column and (r.type == rule.type or change[rule.column] is None)]
        assert row.dq_issues == ",".join(r.name for r in hit)
        assert row.dq_score == pytest.approx(1 - sum(r.weight for r in hit) / total)


def test_a_full_row_has_no_issue(spark):
    row = scored(spark, {})["NL7"]
    assert (row.dq_score, row.dq_issues) == (1.0, "")


def test_breaking_everything_scores_nothing(spark):
    (row,) = scored(spark, {r.column: None for r in RULES}).values()
    assert row.dq_score == 0.0 and row.dq_issues.split(",") == [r.name for r in RULES]


def test_null_under_allowed_values_is_listed_unless_told_otherwise(spark):
    rule = RuleSpec("country", "c", "allowed_values", "warn", values=("US",))
    df = spark.createDataFrame([(None,)], "c string")
    assert tuple(quality.score(df, [rule]).first())[1:] == (0.0, "country")
    assert tuple(quality.score(df, [rule], null_as_fail=False).first())[1:] == (0.0, "")


def test_empty_string_is_not_null(spark):
    assert scored(spark, {"customer_id": "", "full_name": ""})[""].dq_issues == ""


def test_drop_expectations_lose_no_row(spark):
    df = spark.createDataFrame([("1", "a"), (None, "b"), ("3", None), (None, None)], "customer_id string, full_name string")
    kept, rejected = quality.expect_all_or_drop(df, quality.identity_expectations("customer_id", "full_name"))
    assert [r.customer_id for r in kept.collect()] == ["1"]
    assert sorted(r.failed_expectations for r in rejected.collect()) == ["has_customer_id", "has_customer_id,has_name", "has_name"]


def test_split_and_overrides(spark):
    df = spark.createDataFrame([("a", 0.9), ("b", 0.5), ("c", 0.5), ("d", 0.85)], "record_key string, dq_score double")
    approved = spark.createDataFrame([("b",), ("b",), ("d",), ("zz",)], "business_key string")
    passed = {r.record_key: r.steward_override for r in quality.passed(df, 0.85, approved).collect()}
    assert passed == {"a": False, "b": True, "d": False}
    assert [r.record_key for r in quality.quarantined(df, 0.85, approved).collect()] == ["c"]
    assert {r.record_key for r in quality.passed(df, 0.85).collect()} == {"a", "d"}
    assert {r.record_key for r in quality.quarantined(df, 0.85).collect()} == {"b", "c"}


def test_gold_gate_accepts_override_only(spark):
    df = spark.createDataFrame([("g", 0.5, True)], "golden_id string, dq_score double, steward_override boolean")
    assert quality.expect_or_fail(df, quality.gold_expectations(0.85)) is df
    with pytest.raises(GateFailure, match="min_dq_score: 1"):
        quality.expect_or_fail(df, quality.gold_expectations(0.85, honour_override=False))
    with pytest.raises(GateFailure, match="has_golden_id"):
        bad = spark.createDataFrame([(None, 1.0, False)], df.schema)
        quality.expect_or_fail(bad, quality.gold_expectations(0.85))


def test_distribution(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (1.0,), (0.75,)], "dq_score double")
    row = quality.score_distribution(df, 0.85).first()
    assert (row["count"], row["min"], row["p50"], row["max"], row.quarantine_rate) == (4, 0.5, 0.875, 1.0, 0.5)
    assert row["mean"] == 0.8125 and row["std"] == pytest.approx(0.2393568)


def test_blank_invalid(spark):
    df = spark.createDataFrame([tuple((FULL | {"email": "nobody"}).values())], COLUMNS)
    row = quality.blank_invalid(df, RULES, ["email", "tax_id"]).first()
    assert row.email is None and row.tax_id == "NL-20-774"


def test_a_gate_in_the_write_counts_what_is_written(spark, tmp_path):
    rules = {"low": "v < 3", "known": "v IS NOT NULL"}
    for name, rows, broken in (("a", [1, 2], None), ("b", [], None), ("c", [1, 5, None], "low: 2 rows, known: 1 rows")):
        df = spark.createDataFrame([(r,) for r in rows], "v int")
        counted, check = quality.expect_on_write(df, rules)
        counted.write.parquet(str(tmp_path / name))
        if broken:
            with pytest.raises(quality.GateFailure, match=broken):
                check()
        else:
            check()
