"""Collects the queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

AS_OF = datetime(2024, 1, 31)
AS_OF_DAY = date(2024, 1, 31)
# Records of one JSON array: some megabytes, so that files grow with the input no faster than its bytes need.
ARRAY_RECORDS = 20_000


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_landing(df: DataFrame, kind: str, path: str) -> None:
    """Landing files of a format; JSON as files of one array of at most ARRAY_RECORDS records each."""
    if kind == "csv":
        df.write.options(header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    elif kind == "parquet":
        df.write.parquet(path)
    else:
        chunk = F.expr(f"monotonically_increasing_id() div {ARRAY_RECORDS}").alias("chunk")
        arrays = df.select(chunk, F.to_json(F.struct("*")).alias("record")).groupBy("chunk").agg(
            F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("value")
        )
        arrays.write.partitionBy("chunk").text(path)


def r(column: str | Column, digits: int = 6) -> Column:
    """Rounded for comparison, under the same name when given one."""
    rounded = F.round(column, digits)
    return rounded.alias(column) if isinstance(column, str) else rounded


def components_sql(nodes: str, edges: str) -> str:
    """CTEs from ``nodes(id)`` and ``edges(a, b)`` to ``labels(id, component)``."""
    return f"""
    both_ways AS (SELECT a AS src, b AS dst FROM {edges} UNION SELECT b, a FROM {edges}),
    reach(id, lab) AS (
        SELECT id, id FROM {nodes}
        UNION
        SELECT both_ways.dst, reach.lab FROM reach JOIN both_ways ON both_ways.src = reach.id
    ),
    labels AS (SELECT id, min(lab) AS component FROM reach GROUP BY id)"""
