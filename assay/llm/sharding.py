"""Sharding along a Hilbert curve.

Metadata dimensions are quantised, rows are ordered by the index of their cell on the Hilbert curve
and the order is cut into runs with row counts at most one apart, so each shard covers a compact
region of all dimensions at once and its minima and maxima (``manifest``) let a reader skip it.

Only cell counts are summed in order, at most 2 ** (bits * dimensions) of them; rows of a cell are
split by a hash before they are ranked, so a cell that holds a third of all rows is no hot task.

Edge cases: null metadata count as empty, a null text as 0 bytes; an empty table gives no rows; rows
that are equal in every respect get different slots; there may be fewer rows than shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.common import keep, slots

BITS = 5


def curve_steps(dims: int, bits: int, xor: str = "({0} ^ {1})") -> list[dict[str, str]]:
    """SQL that turns axes x0, x1, ... into the transposed Hilbert index, as successive assignments.

    Skilling, "Programming the Hilbert curve" (2004): undo excess work from the top bit down, then
    Gray-encode. ``xor`` is how the dialect writes exclusive or.
    """

    def x(a: str, b: str) -> str:
        return xor.format(a, b)

    steps = []
    for bit in range(bits - 1, 0, -1):
        q, p = 1 << bit, str((1 << bit) - 1)
        for i in range(dims):
            swap = f"({x('x0', f'x{i}')} & {p})"
            step = {"x0": f"CASE WHEN (x{i} & {q}) <> 0 THEN {x('x0', p)} ELSE {x('x0', swap)} END"}
            if i:
                step[f"x{i}"] = f"CASE WHEN (x{i} & {q}) <> 0 THEN x{i} ELSE {x(f'x{i}', swap)} END"
            steps.append(step)
    for i in range(1, dims):
        steps.append({f"x{i}": x(f"x{i}", f"x{i - 1}")})
    last = f"x{dims - 1}"
    flips = "0"
    for bit in range(bits - 1, 0, -1):
        flips = x(flips, f"(CASE WHEN ({last} & {1 << bit}) <> 0 THEN {(1 << bit) - 1} ELSE 0 END)")
    steps.append({"flip": flips})
    steps.append({f"x{i}": x(f"x{i}", "flip") for i in range(dims)})
    return steps


def curve_index(dims: int, bits: int) -> str:
    """SQL for the index from the transposed form: bits taken in turn from every axis."""
    places = [f"x{i}" for i in range(dims)]
    parts = []
    for bit in range(bits):
        for i, name in enumerate(places):
            weight = 1 << (bit * dims + dims - 1 - i)
            parts.append(f"(CASE WHEN ({name} & {1 << bit}) <> 0 THEN {weight} ELSE 0 END)")
    return " + ".join(parts)


def with_curve(df: DataFrame, axes: list[Column], bits: int = BITS, name: str = "hilbert") -> DataFrame:
    """``df`` with the Hilbert index of its quantised ``axes`` (integers of ``bits`` bits, columns of a table)."""
    helpers = [f"x{i}" for i in range(len(axes))]
    out = df.withColumns(dict(zip(helpers, axes, strict=True)))
    for step in curve_steps(len(axes), bits):
        out = out.withColumns({k: F.expr(v) for k, v in step.items()})
    return out.withColumn(name, F.expr(curve_index(len(axes), bits)).cast("int")).drop(*helpers, "flip")


def size_axis(size: Column, bits: int = BITS) -> Column:
    """Half octaves of a size: the position of its top bit and the bit below."""
    digits = F.bin(size)
    half = (F.length(digits) - 1) * 2 + F.coalesce(F.substring(digits, 2, 1).try_cast("int"), F.lit(0))
    return F.least(half, F.lit((1 << bits) - 1)).cast("int")


def label_axis(label: str, bits: int = BITS) -> Column:
    """A name as a number of ``bits`` bits, by hash, so that any number of names may come."""
    digest = F.md5(F.coalesce(F.col(label).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("int").bitwiseAND((1 << bits) - 1)


def shard_by_curve(df: DataFrame, shards: int, doc_id: str = "doc_id", index: str = "hilbert") -> DataFrame:
    """``df`` with shard (0 to shards - 1) and slot (rank in the shard, from 0), by curve index.

    ``df`` is read more than once: materialise it first if it is costly.
    """
    ordered = slots(df, [index], doc_id)
    before = Window.orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    cells = df.groupBy(index).agg(F.count("*").alias("_n"))
    starts = cells.select(
        index,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    rank = F.col("_before") + F.col("slot")
    placed = ordered.join(F.broadcast(starts), index).withColumn("_rank", rank)  # at most one row per cell
    placed = placed.withColumn("shard", F.expr(f"int((_rank * {shards}) div _total)"))
    first = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return placed.withColumn("slot", (F.col("_rank") - first).cast("long")).drop("_before", "_total", "_rank")


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, source, lang, hilbert) of every document, materialised."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        "source",
        "lang",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    axes = {"_size": size_axis(F.col("size")), "_source": label_axis("source"), "_lang": label_axis("lang")}
    # written first: axes that are constants in the plan would be copied into every step of the curve
    flat = keep(rows.withColumns(axes), "sharding-axes")
    return keep(with_curve(flat, [F.col(a) for a in axes]).drop(*axes), "sharding")


def manifest(sharded: DataFrame) -> DataFrame:
    """What a reader needs to skip shards: rows and the range of every dimension."""
    ranges = [f(c).alias(f"{f.__name__}_{c}") for c in ("size", "source", "lang") for f in (F.min, F.max)]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ranges)
