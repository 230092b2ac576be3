"""Benchmark decontamination by winnowing.

A text keeps the smallest k-gram hash of every sliding window of w = span - k + 1 k-grams; runs of
windows with the same minimum are one fingerprint. Two texts that share ``span`` words share a
window of hashes and so its minimum: joining fingerprints misses no shared span. Hits are extended
to the windows of words they stand for, and those are compared word for word.

Items shorter than the span are found as a whole, with k as their length and w = 1. Benchmark
fingerprints and windows are counted first: up to ``broadcast_rows`` they are broadcast and hits found where the
documents are read; beyond that fingerprints are shuffled and only documents with hits read again.

Only DataFrame expressions are used. Items found are worked out once per distinct set of windows,
so copies of a document cost one lookup.

Edge cases: null and word-less texts have no words and no hits; an item without words never occurs;
without items the SHA-256 is that of the empty text; rows that share an id are told apart by their
text; items that repeat an id count once; a null item id counts as a hit but is not listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import keep, union_all
from assay.llm.words import alnum_words, indexes, item, ngram_hashes, word_count

SPAN = 10
K = 5
# Fingerprints (8 bytes) and windows (some 100 bytes) that are broadcast at most: about 20 MB.
BROADCAST_ROWS = 200_000


def fingerprints(df: DataFrame, span: int, k: int) -> DataFrame:
    """``df`` (with ``words``) with ``mins``, the minimum of every window, and ``starts`` of its runs."""
    w = span - k + 1
    out = df.withColumn("hashes", ngram_hashes("words", k))
    if w == 1:
        out = out.withColumnRenamed("hashes", "mins")
    else:
        out = out.withColumn(
            "mins",
            F.transform(
                indexes(F.size("hashes") - (w - 1)), lambda i: F.least(*[item("hashes", i + j) for j in range(w)])
            ),
        ).drop("hashes")
    changes = F.filter(indexes(F.size("mins")), lambda i: (i == 0) | (item("mins", i) != item("mins", i - 1)))
    return out.withColumn("starts", changes)


def exploded(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per fingerprint: ``keys``, fp, and the windows first to last - 1 that it stands for."""
    # the outer form: for the inner one the optimiser would test the array's size before it is made,
    # by working out every step once more for each element
    rows = df.select(*keys, "mins", "starts", F.posexplode_outer("starts").alias("_at", "first"))
    last = F.coalesce(item("starts", F.col("_at") + 1), F.size("mins"))
    return rows.select(*keys, item("mins", F.col("first")).alias("fp"), "first", last.alias("last"))


def window_text(start: str, span: int) -> Column:
    return F.array_join(F.slice("words", F.col(start) + 1, F.lit(span)), " ")


def find(docs: DataFrame, items: DataFrame, span: int, k: int, broadcast_rows: int) -> DataFrame:
    """(_id, _th, at, span, window): every occurrence of a ``span``-word window of ``items`` in ``docs``."""
    marked = keep(exploded(fingerprints(items, span, k), []).select("fp").distinct(), "benchmark-prints")
    windows = items.select(F.explode(indexes(F.size("words") - (span - 1))).alias("at"), "words")
    windows = keep(windows.select(window_text("at", span).alias("window")).distinct(), "benchmark-windows")
    small = max(marked.count(), windows.count()) <= broadcast_rows
    rows = fingerprints(docs, span, k)
    if small:
        hits = exploded(rows, ["_id", "_th", "words"]).join(F.broadcast(marked), "fp")
        windows = F.broadcast(windows)
    else:
        held = keep(exploded(rows, ["_id", "_th"]).join(marked, "fp", "left_semi").drop("fp"), "benchmark-hits")
        hits = docs.join(held, ["_id", "_th"])
    at = hits.select("_id", "_th", "words", F.explode(F.sequence("first", F.col("last") - 1)).alias("at"))
    found = at.select("_id", "_th", "at", window_text("at", span).alias("window")).join(windows, "window")
    return found.select("_id", "_th", "at", F.lit(span).alias("span"), "window")


def covered(spans: Column) -> Column:
    """Words inside any of the (at, span) pairs of an array."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(held: Column, s: Column) -> Column:
        stop = (s["at"] + s["span"]).cast("long")
        fresh = F.greatest(F.lit(0).cast("long"), stop - F.greatest(held["end"], s["at"].cast("long")))
        return F.struct((held["n"] + fresh).alias("n"), F.greatest(held["end"], stop).alias("end"))

    return F.aggregate(F.sort_array(spans), start, add, lambda held: held["n"])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. A window is ``span`` words in a row of an
    item, or all words of a shorter item; a word inside an occurrence of a window is hit.
    """
    return contamination(docs, benchmark, span, k, broadcast_rows).drop("_th")


def contamination(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``decontaminate`` with ``_th``, the xxhash64 of the row's text."""
    keyed = docs.select(F.coalesce(F.col("doc_id"), F.lit(0)).alias("_id"), F.xxhash64("text").alias("_th"), "text")
    worded = keyed.select("_id", "_th", alnum_words("text").alias("words"))
    items = keep(
        benchmark.select("item_id", alnum_words("text").alias("words")).filter(F.size("words") > 0), "benchmark-words"
    )
    sizes = items.select(F.least(F.size("words"), F.lit(span)).alias("span")).distinct().collect()  # 1 to span
    hits = [
        find(
            worded.filter(F.size("words") >= r["span"]),
            items.filter(F.least(F.size("words"), F.lit(span)) == r["span"]),
            r["span"],
            min(k, span) if r["span"] == span else r["span"],
            broadcast_rows,
        )
        for r in sizes
    ]
    plain = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id"), F.lit(0)).alias("_id"),
        F.xxhash64("text").alias("_th"),
        word_count("text").alias("n_words"),
    )
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    if not hits:
        none = F.lit(0).cast("long")
        return plain.select(
            "doc_id", "_th", "n_words", none.alias("n_hit"), none.alias("n_items"), nothing.alias("items_sha256"),
            F.lit(False).alias("contaminated"),
        )
    found = keep(
        union_all(hits).withColumn("window", F.md5(F.col("window").cast("binary")))
        .groupBy("_id", "_th")
        .agg(covered(F.collect_set(F.struct("at", "span"))).alias("n_hit"), F.sort_array(F.collect_set("window")).alias("windows"))
        .withColumn("set", F.md5(F.array_join("windows", "").cast("binary"))),
        "benchmark-found",
    )
    span_of = F.least(F.size("words"), F.lit(span))
    item_windows = items.select(
        "item_id",
        F.explode(
            F.transform(
                indexes(F.size("words") - span_of + 1),
                lambda i: F.md5(F.array_join(F.slice("words", i + 1, span_of), " ").cast("binary")),
            )
        ).alias("window"),
    ).distinct()
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    listed = (
        found.select("set", "windows").dropDuplicates(["set"])
        .select("set", F.explode("windows").alias("window"))
        .join(item_windows, "window")
        .groupBy("set")
        .agg(ids.alias("ids"))
        .select(
            "set",
            F.size("ids").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "ids").cast("binary"), 256).alias("items_sha256"),
        )
    )
    per_doc = found.select("_id", "_th", "n_hit", "set").join(keep(listed, "benchmark-sets"), "set")
    return plain.join(per_doc, ["_id", "_th"], "left").select(
        "doc_id",
        "_th",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", nothing).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )

