from datetime import datetime
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from assay.operators import survivorship
from assay.operators.matching import MEMBER
from assay.operators.standardize import publish
from assay.specs import SurvivorshipSpec, load_entity

AS_OF = datetime(2026, 1, 1)
ROW = (
    "customer_id string, full_name string, email string, tax_id string, address_line1 string, "
    "country_code string, postal_code string, updated_at string, _source_system string"
)
SPEC = SurvivorshipSpec("customer_id", ("ledger", "shop", "forms"), 0.8)


def person(id_, updated, source, name="Ines Okafor", email="ines@okafor.example"):
    return (id_, name, email, "NL-20-774", "4 Quay Row", "NL", "3011AB", updated, source)


def golden(spark, rows, groups, spec=SPEC, **kw):
    passed = spark.createDataFrame(rows, ROW)
    members = spark.createDataFrame(groups, f"golden_id string, {MEMBER} string, match_confidence double")
    made = survivorship.golden_records(passed, members, spec, AS_OF, member_key="customer_id", **kw)
    return survivorship.with_member_lists(made, members).collect()


@pytest.mark.parametrize("order", list(permutations(["shop", "ledger", "forms"])))
def test_source_order_beats_recency_in_any_row_order(spark, order):
    rows = [person(f"k{n}", f"2025-0{n + 1}-11", source) for n, source in enumerate(order)]
    (row,) = golden(spark, rows, [("k0", r[0], 0.5 + 0.2 * n) for n, r in enumerate(rows)])
    assert row._source_system == "ledger" and row.customer_id == f"k{order.index('ledger')}"
    assert (row.source_record_count, row.source_customer_ids, row.merged_at) == (3, ["k0", "k1", "k2"], AS_OF)
    assert row.match_confidence == pytest.approx(0.7) and row.review_status == "needs_review"


@pytest.mark.parametrize(
    ("older", "newer"), [("2019-03-09", "2019-03-10"), ("01/31/2022", "20220201"), ("when?", "1999-12-31"), (None, "04/05/2003")]
)
def test_recency_decides_inside_a_source(spark, older, newer):
    rows = [person("late", newer, "shop"), person("early", older, "shop"), person("other", "2030-01-01", "forms")]
    (row,) = golden(spark, rows, [("early", r[0], 0.8) for r in rows])
    assert row.customer_id == "late" and row.review_status == "auto_merged"


def test_records_of_their_own(spark):
    rows = [person(f"s{n}", "2021-01-01", "forms") for n in range(4)]
    got = golden(spark, rows, [(r[0], r[0], 1.0) for r in rows])
    assert {(r.golden_id, r.review_status, r.source_record_count) for r in got} == {(f"s{n}", "single_source", 1) for n in range(4)}


def test_other_entities_bring_their_own_columns(spark):
    rows = spark.createDataFrame(
        [("z9", "Polder Mills", "2020-05-05", "shop", 7), ("z1", "Polder Mill", "2018-05-05", "ledger", None)],
        "plant_id string, plant string, updated_at string, _source_system string, lines int",
    )
    groups = spark.createDataFrame([("z1", "z9", 0.81), ("z1", "z1", 0.81)], f"golden_id string, {MEMBER} string, match_confidence double")
    (row,) = survivorship.golden_records(rows, groups, SPEC, AS_OF, member_key="plant_id").collect()
    assert (row.plant_id, row.plant, row.lines, row.review_status) == ("z1", "Polder Mill", None, "auto_merged")


def test_a_very_large_group_lists_every_member(spark):
    n = 150_000
    groups = spark.range(n).selectExpr("'g' AS golden_id", f"format_string('%07d', id) AS {MEMBER}", "0.9D AS match_confidence")
    rolled = survivorship.roll_up(groups)
    (row,) = survivorship.with_member_lists(rolled, groups).selectExpr("*", "size(source_customer_ids) AS listed").collect()
    assert row.source_record_count == row.listed == n
    assert (row.source_customer_ids[0], row.source_customer_ids[-1]) == ("0000000", f"{n - 1:07d}")
    assert survivorship.golden_members(groups).count() == n


def test_unknown_source_ranks_last_and_ties_end_at_the_key(spark):
    (row,) = golden(
        spark,
        [person("C9", "2025-01-01", "mystery"), person("C3", "2020-01-01", "shop"), person("C2", "2020-01-01", "shop")],
        [("G", c, 0.9) for c in ("C9", "C3", "C2")],
    )
    assert row.customer_id == "C2"


def test_attribute_level_takes_first_non_null(spark):
    df = spark.createDataFrame(
        [person("C1", "2024-01-01", "ledger", email=None), person("C2", "2024-06-01", "shop", name="I. O.")], ROW
    ).withColumn("golden_id", F.lit("G"))
    (row,) = survivorship.surviving_values(df, SPEC, "golden_id", "customer_id", ["full_name", "email"]).collect()
    assert (row.full_name, row.email) == ("Ines Okafor", "ines@okafor.example")


def test_published_columns(spark):
    entity = load_entity("customer")
    rows = spark.createDataFrame([person("C1", "2024-01-01", "erp")], ROW).select(
        "*", F.lit(1.0).alias("dq_score"), F.lit("").alias("dq_issues")
    )
    groups = spark.createDataFrame([("G1", "C1", 1.0)], f"golden_id string, {MEMBER} string, match_confidence double")
    made = survivorship.golden_records(rows, groups, SPEC, AS_OF, member_key="customer_id")
    out = publish(survivorship.with_member_lists(made, groups), entity)
    assert out.columns == [
        "golden_id", "customer_name", "email", "tax_id", "address_line1", "country_code", "postal_code", "dq_score",
        "dq_issues", "match_confidence", "source_record_count", "source_customer_ids", "surviving_source_system",
        "review_status", "merged_at",
    ]
    assert len(load_entity("account").gold_columns) + 9 == 16


def test_lists_of_crowded_groups_are_put_together_from_parts(spark):
    groups = spark.range(5_000).selectExpr(
        "if(id % 3 = 0, 'a', if(id % 100 = 1, 'b', 'c')) AS golden_id", f"sha2(string(id), 256) AS {MEMBER}", "1.0D AS match_confidence"
    )
    rolled = survivorship.roll_up(groups)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        held = [
            {r.golden_id: r.source_customer_ids for r in survivorship.with_member_lists(rolled, groups, crowded).collect()}
            for crowded in (10**9, 1_000)
        ]
    finally:
        spark.conf.unset(key)
    assert held[0] == held[1] and held[0]["a"] == sorted(held[0]["a"]) and len(held[0]["a"]) == 1_667
