"""Keyed upsert and the change feed between two snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], recency: str) -> DataFrame:
    """One row per key, the most recent; ties fall back to the values in column order."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(F.col(recency).alias("_recency"), *rest)
    return df.groupBy(*keys).agg(F.max(row).alias("row")).select(*[
        F.col(c) if c in keys else F.col("row")[c].alias(c) for c in df.columns
    ])


def upsert(target: DataFrame, source: DataFrame, keys: list[str], recency: str) -> DataFrame:
    """Target with every source row inserted, or put in place of the row of the same key."""
    incoming = latest_per_key(source, keys, recency).select(*target.columns)
    return target.join(incoming.select(*keys), on=keys, how="left_anti").select(*target.columns).unionByName(incoming)


def changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Row-level changes from ``old`` to ``new``: insert, delete, update_preimage, update_postimage.

    One full join on the key; the before and after image of an update come out of the same row.
    """
    columns = [c for c in new.columns if c != key]
    before = old.select(key, F.struct(*columns).alias("before"))
    after = new.select(key, F.struct(*columns).alias("after"))
    joined = before.join(after, on=key, how="full_outer")
    differs = reduce(
        lambda x, y: x | y, [~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")) for c in columns], F.lit(False)
    )

    def image(kind: str, side: str):
        return F.struct(F.lit(kind).alias("change_type"), F.col(side).alias("row"))

    images = (
        F.when(F.col("before").isNull(), F.array(image("insert", "after")))
        .when(F.col("after").isNull(), F.array(image("delete", "before")))
        .when(differs, F.array(image("update_preimage", "before"), image("update_postimage", "after")))
    )
    exploded = joined.select(key, images.alias("images")).filter(F.col("images").isNotNull())
    return exploded.select(key, F.inline("images")).select(key, "change_type", *[F.col("row")[c].alias(c) for c in columns])
