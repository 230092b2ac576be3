"""Fixity audit of archived records by Merkle trees.

Records are hashed and ordered by id; a node covers the ids that share a prefix, which is a
contiguous range of offsets in the archive. Its hash is that of its children in order, its size
their sum. Two replicas are compared from the roots down: only children of nodes that differ are
looked at, so an intact branch costs one comparison whatever its size. Offsets are handed down the
same tree (a node starts where its elder sibling ends), so no task ever sums over all records.

Only records that share an id meet before they are hashed, and those as sums of their digests (order
does not matter), combined before the shuffle. Nothing but the key range reaches the driver.

Edge cases: records without an id are a leaf of their own outside the tree, before all others; null parts
of a record are empty; repeated rows belong to one leaf, which differs if their number does; a record in one replica only is ``missing`` or ``extra``; an
empty table on either side makes all records of the other missing or extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.common import keep

# Bits of an id per level: 256 children at most.
FAN_BITS = 8
# Hexadecimal digits of a digest summed as one number.
PIECE = 15


def leaves(records: DataFrame, record_id: str, parts: list[str]) -> DataFrame:
    """(key, n, bytes, digest, hash): per id the number and size of its records and their hash."""
    body = F.concat_ws("\n", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])
    rows = records.select(
        F.col(record_id).cast("long").alias("key"), body.cast("binary").alias("body")
    ).select("key", F.octet_length("body").cast("long").alias("bytes"), F.sha2("body", 256).alias("digest"))
    sums = [
        F.sum(F.conv(F.substring("digest", 1 + at, PIECE), 16, 10).cast("decimal(20,0)")).alias(f"s{at}")
        for at in range(0, 64, PIECE)
    ]
    held = rows.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.min("digest").alias("digest"), *sums
    )
    pieces = [F.col(f"s{at}").cast("string") for at in range(0, 64, PIECE)]
    whole = F.sha2(F.concat_ws(":", F.col("n").cast("string"), *pieces).cast("binary"), 256)
    return held.select("key", "n", "bytes", "digest", whole.alias("hash"))


def parent(key: str = "key") -> Column:
    return F.shiftright(F.col(key), FAN_BITS)


def level_up(nodes: DataFrame) -> DataFrame:
    """Parents of ``nodes`` (key, bytes, hash)."""
    child = F.struct("key", "hash")
    listed = F.transform(F.sort_array(F.collect_list(child)), lambda c: F.concat_ws(":", c["key"].cast("string"), c["hash"]))
    return nodes.groupBy(parent().alias("key")).agg(
        F.sum("bytes").alias("bytes"), F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("hash")
    )


def tree(held: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes of every level, leaves first, each materialised."""
    out = [held]
    for _ in range(levels):
        out.append(keep(level_up(out[-1].select("key", "bytes", "hash")), "fixity-level"))
    return out


def depth(*replicas: DataFrame) -> int:
    """Levels above the leaves until one node covers all keys of all replicas."""
    ranges = [r.agg(F.min("key").alias("lo"), F.max("key").alias("hi")).first() for r in replicas]
    keys = [k for r in ranges for k in (r["lo"], r["hi"]) if k is not None]
    if not keys:
        return 0
    lo, hi, levels = min(keys), max(keys), 0
    while lo != hi and levels * FAN_BITS < 64:
        lo, hi, levels = lo >> FAN_BITS, hi >> FAN_BITS, levels + 1
    return levels


def differing(ours: list[DataFrame], theirs: list[DataFrame]) -> list[DataFrame]:
    """Per level, root first, the keys of nodes that differ below differing parents."""
    found: list[DataFrame] = []
    for a, b in zip(reversed(ours), reversed(theirs), strict=True):
        a, b = a.select("key", "hash"), b.select("key", F.col("hash").alias("other"))
        if found:
            suspects = found[-1].select(F.col("key").alias("_parent"))
            a, b = (x.withColumn("_parent", parent()).join(suspects, "_parent", "left_semi").drop("_parent") for x in (a, b))
        both = a.join(b, "key", "full")
        found.append(keep(both.filter(~F.col("hash").eqNullSafe(F.col("other"))), "fixity-differing"))
    return found


def with_offsets(levels: list[DataFrame]) -> DataFrame:
    """Leaves with ``offset``, the bytes of all records before them in the order of their keys."""
    before = Window.partitionBy("_parent").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    above = None
    for nodes in reversed(levels):
        # the top has a node for ids below zero and one for others at most
        own = nodes.withColumn("_parent", F.lit(0) if above is None else parent()).withColumn("offset", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
        if above is not None:
            starts = above.select(F.col("key").alias("_parent"), F.col("offset").alias("_start"))
            own = own.join(starts, "_parent").withColumn("offset", F.col("offset") + F.col("_start")).drop("_start")
        above = own.drop("_parent")
    return above


def audit(archive: DataFrame, replica: DataFrame, record_id: str, parts: list[str]) -> DataFrame:
    """(record_id, offset, n_records, n_bytes, digest, status) of every record id in either replica.

    status is ok, corrupt, missing (from the replica) or extra (only there, without an offset).
    """
    held = [keep(leaves(r, record_id, parts), "fixity-leaves") for r in (archive, replica)]
    a, b = (h.filter("key IS NOT NULL") for h in held)
    unnamed = [h.filter("key IS NULL") for h in held]  # one row at most
    shift = unnamed[0].agg(F.coalesce(F.sum("bytes"), F.lit(0)).cast("long")).first()[0]
    levels = depth(a, b)
    ours, theirs = tree(a, levels), tree(b, levels)
    broken = differing(ours, theirs)[-1]
    status = (
        F.when(F.col("_hash").isNull() & F.col("other").isNull(), "ok")
        .when(F.col("other").isNull(), "missing")
        .otherwise("corrupt")
    )
    marks = broken.withColumnRenamed("hash", "_hash")
    known = with_offsets(ours).join(marks, "key", "left").select("key", "offset", "n", "bytes", "digest", status.alias("status"))
    extra = broken.filter("hash IS NULL").select("key").join(theirs[0], "key")
    extra = extra.select("key", F.lit(None).cast("long").alias("offset"), "n", "bytes", "digest", F.lit("extra").alias("status"))
    both = unnamed[0].select("key", F.lit(0).cast("long").alias("offset"), "n", "bytes", "digest", "hash").join(
        unnamed[1].select(F.col("n").alias("_n"), F.col("bytes").alias("_bytes"), F.col("digest").alias("_digest"), F.col("hash").alias("_hash")),
        F.lit(True),
        "full",
    )
    verdict = F.when(F.col("hash").isNull(), "extra").when(F.col("_hash").isNull(), "missing").when(
        F.col("hash") == F.col("_hash"), "ok"
    ).otherwise("corrupt")
    nameless = both.select(
        "key", "offset", F.coalesce("n", "_n").alias("n"), F.coalesce("bytes", "_bytes").alias("bytes"),
        F.coalesce("digest", "_digest").alias("digest"), verdict.alias("status"),
    )
    known = known.withColumn("offset", F.col("offset") + shift)
    return known.unionByName(extra).unionByName(nameless).select(
        F.col("key").alias(record_id),
        F.col("offset").cast("long").alias("offset"),
        F.col("n").alias("n_records"),
        F.col("bytes").cast("long").alias("n_bytes"),
        "digest",
        "status",
    )
