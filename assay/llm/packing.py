"""Packing into optimal length buckets.

The global histogram of lengths goes to the driver, where dynamic programming picks the bucket
boundaries that minimise padding. Inside a bucket texts are ranked in the order of a hash and cut
into batches whose padded size stays within a token budget.

The histogram has a row per length that occurs, so fewer than the square root of twice the tokens there
are. Cuts move up with the length, so each is looked for only between those of its neighbours.

Edge cases: a null or empty text has 0 tokens and sits in the first bucket; a text longer than the
budget is a batch of its own, marked ``oversize``; fewer lengths than buckets give fewer buckets; an
empty table gives no rows; of equally good boundaries the smaller ones win, from the last bucket on.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import keep, slots
from assay.llm.kernels import row_chunks, text_bytes, tidy

cloudpickle.register_pickle_by_value(sys.modules[__name__])

def _length_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        lengths = np.zeros(batch.num_rows, np.int64)
        for lo, hi in row_chunks(offsets):
            inside = ~blank[data[offsets[lo] : offsets[hi]]]
            own = offsets[lo : hi + 1] - offsets[lo]
            begins = inside.copy()
            begins[1:] &= ~inside[:-1]
            starts = own[:-1][own[:-1] < own[1:]]
            begins[starts] = inside[starts]
            sums = np.zeros(len(begins) + 1, np.int64)
            np.cumsum(begins, out=sums[1:])
            lengths[lo:hi] = np.diff(sums[own])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths)], ["doc_id", "n_tokens"])


def word_lengths(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens): words between ASCII blanks in the whole text."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(_length_kernel), f"doc_id {kind}, n_tokens long")


def boundaries(lengths: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least padding, for ascending ``lengths``."""
    n = len(lengths)
    c = np.concatenate([[0], np.cumsum(counts)])
    t = np.concatenate([[0], np.cumsum(totals)])
    # best[i]: least padding of the first i lengths; the last bucket pads lengths j+1..i to lengths[i]
    best = np.concatenate([[0], lengths * c[1:] - t[1:]])
    chosen = []
    for _ in range(1, min(buckets, n)):
        following, cut = best.copy(), np.zeros(n + 1, np.int64)
        # (first, last, least cut, largest cut) of stretches whose middle is still to be settled
        open_ = [(1, n, 0, n - 1)]
        while open_:
            first, last, low, high = open_.pop()
            i = (first + last) // 2
            j = slice(low, min(high, i - 1) + 1)
            cost = best[j] + lengths[i - 1] * (c[i] - c[j]) - (t[i] - t[j])
            cut[i] = low + np.argmin(cost)
            following[i] = cost[cut[i] - low]
            if first < i:
                open_.append((first, i - 1, low, int(cut[i])))
            if i < last:
                open_.append((i + 1, last, int(cut[i]), high))
        best = following
        chosen.append(cut)
    ends, i = [], n
    for cut in reversed(chosen):
        if i:
            ends.append(int(lengths[i - 1]))
            i = int(cut[i])
    if i:
        ends.append(int(lengths[i - 1]))
    return sorted(ends)


def pack(lengths: DataFrame, buckets: int = 8, token_budget: int = 32_768, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, bucket, padded_length, batch, slot, oversize) of every row.

    ``lengths`` has the id and ``n_tokens``. batch counts from 0 in its bucket, slot from 0 in its batch.
    """
    held = keep(lengths.select(doc_id, "n_tokens"), "lengths")
    histogram = (
        held.groupBy(F.col("n_tokens").alias("length"))
        .agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens"))
        .orderBy("length")
        .collect()
    )
    columns = [np.array([r[k] for r in histogram], np.int64) for k in ("length", "n", "tokens")]
    ends = boundaries(*columns, buckets) if histogram else [0]
    bucket, padded = F.lit(len(ends) - 1), F.lit(ends[-1]).cast("long")
    for k in range(len(ends) - 2, -1, -1):
        bucket = F.when(F.col("n_tokens") <= ends[k], k).otherwise(bucket)
        padded = F.when(F.col("n_tokens") <= ends[k], F.lit(ends[k]).cast("long")).otherwise(padded)
    placed = slots(held.withColumn("bucket", bucket.cast("int")).withColumn("padded_length", padded), ["bucket"], doc_id)
    fits = F.greatest(F.lit(1), F.expr(f"{token_budget} div greatest(padded_length, 1)")).cast("long")
    return placed.select(
        doc_id,
        "n_tokens",
        "bucket",
        "padded_length",
        (F.col("slot") - F.col("slot") % fits).alias("_first"),
        fits.alias("_fits"),
        "slot",
    ).select(
        doc_id,
        "n_tokens",
        "bucket",
        "padded_length",
        F.expr("_first div _fits").alias("batch"),
        (F.col("slot") - F.col("_first")).alias("slot"),
        (F.col("padded_length") > token_budget).alias("oversize"),
    )
