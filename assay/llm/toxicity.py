"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Training takes a bounded sample of labelled texts of either label. Tasks count in how many texts of
each label every n-gram occurs; the n-grams whose counts differ most (likelihood ratio) become
features, each with its log-count ratio as value where it occurs; logistic regression weighs them
and its intercept is moved to the share of label 1 among all labelled rows. Scoring is one pass over
whole texts without a shuffle.

Edge cases: a null or empty text, or one without any known n-gram, gets the score of the intercept;
labels that are null are ignored; a document labelled twice counts as toxic if either label says so;
of rows that share a labelled id the text with the smallest hash is learned from.
Without a labelled row of each kind every score is the share of label 1 (0 without labels).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import keep
from assay.llm.kernels import row_chunks, text_bytes, tidy, words64

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes per n-gram, with an odd multiplier each that spreads them over the buckets.
GRAMS = {4: 0x9E3779B97F4A7C15, 5: 0xC2B2AE3D27D4EB4F, 6: 0xD6E8FEB86659FD93}
BUCKET_BITS = 22
# Letters are lower-cased; ASCII characters that are no letters count as blanks.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


@dataclass
class ToxicityModel:
    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ratios: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = -30.0


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For every n the bucket of the n-gram at each position, -1 where it would leave its text."""
    folded = np.frombuffer(data.tobytes().translate(FOLD), np.uint8)
    x = words64(folded)
    ends = offsets[1:]
    for n, multiplier in GRAMS.items():
        masked = x & np.uint64((1 << (8 * n)) - 1)
        bucket = ((masked * np.uint64(multiplier)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        for back in range(1, n):
            at = ends - back
            bucket[at[at >= offsets[:-1]]] = -1
        yield bucket


def present(data: np.ndarray, offsets: np.ndarray, number: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs without repetition; ``number`` maps buckets to features, -1 for none."""
    pairs = []
    for bucket in gram_buckets(data, offsets):
        feature = number[bucket]  # bucket -1 reads the last entry, which stands for none
        at = np.nonzero(feature >= 0)[0]
        row = np.searchsorted(offsets, at, side="right") - 1
        pairs.append(row.astype(np.int64) * features + feature[at])
    found = np.unique(np.concatenate(pairs))
    return found // features, found % features


def feature_numbers(buckets: np.ndarray) -> np.ndarray:
    number = np.full((1 << BUCKET_BITS) + 1, -1, np.int32)
    number[buckets] = np.arange(len(buckets), dtype=np.int32)
    return number


def _count_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each label a bucket occurs, summed over all texts of the task."""
    counts = np.zeros((2, (1 << BUCKET_BITS) + 1), np.int32)
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        label = batch.column("toxic").to_numpy(zero_copy_only=False)
        for row in range(batch.num_rows):
            lo, hi = offsets[row], offsets[row + 1]
            found = np.unique(np.concatenate([*gram_buckets(data[lo:hi], np.array([0, hi - lo]))]))
            counts[label[row], found] += 1  # -1 falls into the spare last entry
    seen = np.nonzero(counts[:, :-1].any(axis=0))[0]
    for lo in range(0, len(seen), 100_000):
        part = seen[lo : lo + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array(counts[0, part], pa.int64()), pa.array(counts[1, part], pa.int64())],
            ["bucket", "df0", "df1"],
        )


def _sparse_kernel(buckets: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = feature_numbers(buckets)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_chunks(offsets):
                own = offsets[lo : hi + 1] - offsets[lo]
                row, feature = present(data[offsets[lo] : offsets[hi]], own, number, len(buckets))
                bounds = np.searchsorted(row, np.arange(hi - lo + 1))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(feature, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("toxic")[lo:hi], lists], ["toxic", "features"])

    return run


def labelled_rows(labels: DataFrame, seen: Column | None = None) -> DataFrame:
    """(doc_id, toxic) once per labelled document; ``seen`` says which ids may be learned from."""
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna().filter("toxic IN (0, 1)")
    if seen is not None:
        rows = rows.filter(seen)
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    seen: Column | None = None,
    fit_rows: int = 8_000,
    features: int = 4_096,
    smoothing: float = 1.0,
    penalty: float = 2.0,
    rounds: int = 300,
) -> ToxicityModel:
    """Train on at most ``fit_rows`` labelled documents, half of each label where there are enough.

    ``fit_rows`` bounds what is broadcast (ids and labels), the texts learned from (one per id) and what
    reaches the driver (their feature numbers); ``features`` bounds the model. The sample is the rows with the
    smallest hash of the id, so it does not depend on how the tables are laid out.
    """
    rows = labelled_rows(labels, seen)
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        share = n1 / max(1, n0 + n1)
        return ToxicityModel(intercept=30.0 if share else -30.0)
    half = [
        rows.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows // 2)
        for label in (0, 1)
    ]
    sample = keep(
        docs.select("doc_id", "text")
        .join(F.broadcast(half[0].unionAll(half[1])), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
        .select("first.text", "toxic"),
        "toxicity-sample",
    )
    taken = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    m0, m1 = taken.get(0, 0), taken.get(1, 0)
    if not m0 or not m1:
        return ToxicityModel(intercept=float(np.log(n1 / n0)))
    counted = sample.mapInArrow(tidy(_count_kernel), "bucket long, df0 long, df1 long")
    df0, df1 = F.col("df0"), F.col("df1")

    def surprise(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    both = df0 + df1
    gain = (
        surprise(df1, both * m1 / (m0 + m1))
        + surprise(df0, both * m0 / (m0 + m1))
        + surprise(m1 - df1, (m0 + m1 - both) * m1 / (m0 + m1))
        + surprise(m0 - df0, (m0 + m1 - both) * m0 / (m0 + m1))
    )
    best = (
        counted.groupBy("bucket")
        .agg(F.sum("df0").alias("df0"), F.sum("df1").alias("df1"))
        .filter(df0 + df1 >= 3)
        .withColumn("gain", gain)
        .orderBy(F.desc("gain"), "bucket")
        .limit(features)
        .collect()
    )
    if not best:
        return ToxicityModel(intercept=float(np.log(n1 / n0)))
    buckets = np.array([r["bucket"] for r in best], np.int64)
    c0, c1 = (np.array([r[k] for r in best], float) for k in ("df0", "df1"))
    ratios = np.log((c1 + smoothing) / (m1 + 2 * smoothing)) - np.log((c0 + smoothing) / (m0 + 2 * smoothing))
    lists = sample.mapInArrow(tidy(_sparse_kernel(buckets)), "toxic int, features array<int>").collect()
    lists.sort(key=lambda r: (r["toxic"], r["features"]))  # sums do not depend on the order of arrival
    y = np.array([r["toxic"] for r in lists], float)
    row = np.repeat(np.arange(len(lists)), [len(r["features"]) for r in lists])
    col = np.concatenate([np.asarray(r["features"], np.int64) for r in lists])
    weights, intercept = logistic(row, col, ratios, y, penalty, rounds)
    intercept += np.log(n1 / n0) - np.log(m1 / m0)
    return ToxicityModel(buckets, ratios, weights, float(intercept))


def logistic(
    row: np.ndarray, col: np.ndarray, ratios: np.ndarray, y: np.ndarray, penalty: float, rounds: int
) -> tuple[np.ndarray, float]:
    """Weights of ridge-penalised logistic regression on value ``ratios[col]`` at (row, col), by Adam."""
    value = ratios[col]
    w, b = np.zeros(len(ratios)), 0.0
    m, v = np.zeros(len(ratios) + 1), np.zeros(len(ratios) + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(row, value * w[col], len(y)) + b
        error = sigmoid(z) - y
        g = np.append(np.bincount(col, value * error[row], len(ratios)) + penalty * w, error.sum()) / len(y)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def score_kernel(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = feature_numbers(model.buckets)
        value = model.ratios * model.weights
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            z = np.full(batch.num_rows, model.intercept)
            for lo, hi in row_chunks(offsets) if len(value) else ():
                own = offsets[lo : hi + 1] - offsets[lo]
                row, feature = present(data[offsets[lo] : offsets[hi]], own, number, len(value))
                z[lo:hi] += np.bincount(row, value[feature], hi - lo)
            columns = [c for name, c in zip(batch.schema.names, batch.columns, strict=True) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sigmoid(z))], [*names, "score"])

    return run


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row; score is the probability that the text is toxic."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(score_kernel(model)), f"doc_id {kind}, score double")


def _clean_kernel(model: ToxicityModel, below: float):
    scored = score_kernel(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (out,) = scored(iter([batch.select(["text"])]))
            yield batch.filter(pa.array(out.column("score").to_numpy() < below))

    return run


def clean(docs: DataFrame, model: ToxicityModel, below: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the limit."""
    return docs.mapInArrow(tidy(_clean_kernel(model, below)), docs.schema)
