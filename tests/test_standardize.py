from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from assay.functions import text
from assay.operators.standardize import (
    latest_per_record,
    mask_columns,
    standardize,
    union_all,
    with_provenance,
    with_record_key,
)
from assay.specs import load_entity

ENTITY = load_entity("customer")
AS_OF = datetime(2026, 1, 1)


def test_canonical_projection(spark):
    raw = spark.createDataFrame(
        [(" 7 ", " ANNA-MARIA o'brien ", " A@B.COM ", "us", 1234)],
        "cust_no string, cust_name string, email_addr string, ctry_cd string, zip_cd int",
    )
    out = standardize(with_provenance(raw, ENTITY.source("erp"), AS_OF, F.lit("f")), ENTITY, ENTITY.source("erp"))
    row = out.first()
    assert out.columns[:8] == list(ENTITY.canonical)
    assert (row.customer_id, row.full_name, row.email, row.country_code) == ("7", "Anna-maria O'brien", "a@b.com", "US")
    assert row.postal_code == "1234" and dict(out.dtypes)["postal_code"] == "string"
    assert row.tax_id is None and dict(out.dtypes)["tax_id"] == "string"
    assert row.email_domain == "b.com"
    assert (row._source_system, row._source_priority, row._ingested_at, row._source_file) == ("erp", 1, AS_OF, "f")


def test_domain_without_at_is_empty_and_null_stays_null(spark):
    df = spark.createDataFrame([("x",), (None,)], "email string")
    assert [r[0] for r in df.select(text.email_domain(F.col("email"))).collect()] == ["", None]


def test_trim_keeps_tabs_unless_collapsing(spark):
    df = spark.createDataFrame([("\tJane  Doe ",)], "n string")
    assert df.select(text.clean(F.col("n"))).first()[0] == "\tJane  Doe"
    assert df.select(text.clean(F.col("n"), collapse_ws=True)).first()[0] == "Jane Doe"


def test_mixed_dates_parse_and_junk_is_null(spark):
    values = ["2026-03-01", "07/15/2026", "20260201", "not-a-date", None, "2026-13-01", "2026-03-01 10:00:00"]
    df = spark.createDataFrame([(v,) for v in values], "u string")
    got = [r[0] for r in df.select(text.parse_updated_at(F.col("u"))).collect()]
    assert got == [
        datetime(2026, 3, 1), datetime(2026, 7, 15), datetime(2026, 2, 1), None, None, None, datetime(2026, 3, 1, 10),
    ]


def test_same_record_key_keeps_latest_and_counts(spark):
    df = spark.createDataFrame(
        [("1", "old", "20240101", "erp"), ("1", "new", "02/01/2024", "erp"), ("1", "other", "2020-01-01", "crm")],
        "customer_id string, full_name string, updated_at string, _source_system string",
    )
    rows = {r.record_key: r for r in latest_per_record(with_record_key(df, "customer_id")).collect()}
    assert rows["erp:1"].full_name == "new" and rows["erp:1"].duplicate_count == 2
    assert rows["crm:1"].duplicate_count == 1


def test_mask(spark):
    df = spark.createDataFrame([("a", None, "c")], "email string, tax_id string, city string")
    assert tuple(mask_columns(df, ["email", "tax_id"]).first()) == ("***MASKED***", "***MASKED***", "c")
    assert tuple(mask_columns(df, ["email", "tax_id"], unmasked=True).first()) == ("a", None, "c")


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "y int, x int")
    assert sorted(map(tuple, union_all([a, b]).collect())) == [(1, 2), (4, 3)]


def test_account_keeps_revenue_as_text(spark):
    account = load_entity("account")
    raw = spark.createDataFrame([("A1", 5000)], "acct_no string, annual_rev int")
    out = standardize(raw, replace(account), account.source("erp"))
    assert out.first().annual_revenue == "5000" and "email_domain" not in out.columns
