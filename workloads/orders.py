"""Survivorship, roll-up, upsert and change feed over orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators import survivorship
from assay.operators.matching import MEMBER
from assay.operators.upsert import changes
from assay.session import new_shared_path
from assay.sources.bucketed import BucketedTable
from assay.specs import SurvivorshipSpec
from workloads.registry import query, r, table

SPEC = SurvivorshipSpec("o_orderkey", ("1-URGENT", "2-HIGH", "3-MEDIUM"), 0.93)


def members(spark, sf_dir) -> DataFrame:
    """Orders as the records of one group per customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("golden_id"),
        F.col("o_orderkey").alias("record_key"),
        F.col("o_orderpriority").alias("_source_system"),
        "o_orderdate",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("o_totalprice"),
    )


_MEMBERS = """members AS (
    SELECT o_custkey AS golden_id, o_orderkey AS record_key, o_orderpriority, o_orderdate,
           CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS o_totalprice FROM orders)"""
_ORDER = """ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 3 END,
            o_orderdate DESC NULLS LAST, record_key"""


@query(
    "survivor_record",
    f"""WITH {_MEMBERS} SELECT golden_id, record_key, o_orderpriority AS source, o_orderstatus, o_totalprice
    FROM (SELECT *, row_number() OVER (PARTITION BY golden_id {_ORDER}) AS rn FROM members) WHERE rn = 1""",
)
def survivor_record(spark, sf_dir):
    best = survivorship.surviving_rows(
        members(spark, sf_dir), SPEC, "golden_id", "record_key", recency="o_orderdate", parsed=True
    )
    return best.select("golden_id", "record_key", F.col("_source_system").alias("source"), "o_orderstatus", "o_totalprice")


def _first(column: str) -> str:
    return f"arg_min({column}, rn) FILTER (WHERE {column} IS NOT NULL) AS {column}"


@query(
    "survivor_attribute",
    f"""WITH {_MEMBERS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY golden_id {_ORDER}) AS rn FROM members)
    SELECT golden_id, {_first('o_orderpriority')}, {_first('o_orderstatus')}, {_first('o_totalprice')}
    FROM ranked GROUP BY golden_id""",
)
def survivor_attribute(spark, sf_dir):
    best = survivorship.surviving_values(
        members(spark, sf_dir), SPEC, "golden_id", "record_key",
        ["_source_system", "o_orderstatus", "o_totalprice"], recency="o_orderdate", parsed=True,
    )
    return best.withColumnRenamed("_source_system", "o_orderpriority")


def groups(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("golden_id"),
        F.format_string("%012d", "o_orderkey").alias(MEMBER),
        (1 - (F.col("o_orderkey") % 17) / 100).alias("match_confidence"),
    )


_GROUPS = """groups AS (SELECT o_custkey AS golden_id, lpad(o_orderkey::VARCHAR, 12, '0') AS member,
    1 - (o_orderkey % 17) / 100::DOUBLE AS match_confidence FROM orders)"""


@query(
    "golden_rollup",
    f"""WITH {_GROUPS} SELECT golden_id, count(*) AS source_record_count, round(avg(match_confidence), 6) AS match_confidence,
    array_to_string(list_sort(list(DISTINCT member)), ',') AS source_customer_ids FROM groups GROUP BY golden_id""",
)
def golden_rollup(spark, sf_dir):
    held = groups(spark, sf_dir)
    out = survivorship.with_member_lists(survivorship.roll_up(held), held)
    return out.withColumns(
        {"source_customer_ids": F.array_join("source_customer_ids", ","), "match_confidence": r("match_confidence")}
    )


@query("golden_members", f"WITH {_GROUPS} SELECT DISTINCT golden_id, member FROM groups")
def golden_members(spark, sf_dir):
    return survivorship.golden_members(groups(spark, sf_dir))


@query(
    "review_status",
    f"""WITH {_GROUPS}, g AS (SELECT golden_id, count(*) AS n, round(avg(match_confidence), 6) AS c FROM groups GROUP BY 1)
    SELECT golden_id, CASE WHEN n = 1 THEN 'single_source' WHEN c >= 0.93 THEN 'auto_merged' ELSE 'needs_review' END
    AS review_status FROM g""",
)
def review_status(spark, sf_dir):
    rolled = survivorship.roll_up(groups(spark, sf_dir))
    status = survivorship.review_status(F.col("source_record_count"), r("match_confidence"), SPEC.auto_merge_threshold)
    return rolled.select("golden_id", status.alias("review_status"))


def _snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    old = rows.filter(F.col("o_orderkey") % 10 != 0)
    new = rows.filter(F.col("o_orderkey") % 11 != 0).withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    )
    return old, new


_SNAPSHOTS = """old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 <> 0),
    new AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
            FROM orders WHERE o_orderkey % 11 <> 0)"""


@query(
    "change_feed",
    f"""WITH {_SNAPSHOTS},
    changed AS (SELECT n.o_orderkey AS k FROM old o JOIN new n USING (o_orderkey)
                WHERE o.o_orderstatus IS DISTINCT FROM n.o_orderstatus OR o.o_totalprice IS DISTINCT FROM n.o_totalprice)
    SELECT o_orderkey, 'insert' AS change_type, o_orderstatus, o_totalprice FROM new ANTI JOIN old USING (o_orderkey)
    UNION ALL SELECT o_orderkey, 'delete', o_orderstatus, o_totalprice FROM old ANTI JOIN new USING (o_orderkey)
    UNION ALL SELECT o_orderkey, 'update_preimage', o_orderstatus, o_totalprice FROM old WHERE o_orderkey IN (SELECT k FROM changed)
    UNION ALL SELECT o_orderkey, 'update_postimage', o_orderstatus, o_totalprice FROM new WHERE o_orderkey IN (SELECT k FROM changed)""",
)
def change_feed(spark, sf_dir):
    return changes(*_snapshots(spark, sf_dir), "o_orderkey")


@query(
    "upsert_latest",
    """WITH source AS (
        SELECT o_custkey, max(o_orderdate) AS last_order, arg_max(o_totalprice, struct_pack(a := o_orderdate, b := o_totalprice))
               AS amount FROM orders GROUP BY 1)
    SELECT c_custkey AS o_custkey, coalesce(amount, c_acctbal) AS amount, last_order IS NOT NULL AS updated
    FROM customer LEFT JOIN source ON c_custkey = o_custkey""",
)
def upsert_latest(spark, sf_dir):
    """Each customer's balance replaced by the last order, several candidates per key."""
    target = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.lit(None).cast("timestamp_ntz").alias("last_order"),
        F.col("c_acctbal").alias("amount"),
    )
    source = (
        table(spark, sf_dir, "orders")
        .select("o_custkey", F.col("o_orderdate").cast("timestamp_ntz").alias("last_order"), F.col("o_totalprice").alias("amount"))
    )
    balances = BucketedTable(spark, new_shared_path(spark, "balances"), ["o_custkey"], 32)
    balances.replace(target)
    balances.merge(source, "last_order")
    return balances.read().select("o_custkey", "amount", F.col("last_order").isNotNull().alias("updated"))
