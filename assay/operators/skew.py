"""Joins and groupings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are fewer than
# HOT_SHARE hot keys whatever the data: that is the size bound of every broadcast made here.
HOT_SHARE = 1000
# Below this many rows a key is never worth splitting.
HOT_MIN_ROWS = 200_000


def hot_limit(total_rows: int) -> int:
    return max(HOT_MIN_ROWS, total_rows // HOT_SHARE)


def join_unique(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right`` on ``key``, where ``right`` has one row per key.

    ``hot`` lists the hot keys of ``left`` (fewer than HOT_SHARE rows). Their few right rows are
    broadcast, so left rows of a hot key stay where they are; all others shuffle as usual.
    """
    if hot is None:
        return left.join(right, on=key, how=how)
    hot = F.broadcast(hot.select(key))
    right_hot = F.broadcast(right.join(hot, on=key, how="left_semi"))
    in_place = left.join(hot, on=key, how="left_semi").join(right_hot, on=key, how=how)
    shuffled = left.join(hot, on=key, how="left_anti").join(right, on=key, how=how)
    return in_place.unionByName(shuffled)
