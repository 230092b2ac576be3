"""Quality rules: exact base rules and gradient-boosted trees over statistics of a text.

Trees are grown on a bounded labelled sample with monotonic constraints on chosen statistics (more
repeated lines or symbols never raise a score) and flattened into arrays of nodes, so scoring walks
all rows of a batch through a tree at once. One pass over whole texts, without a shuffle.

Edge cases: a null or blank text has no words and fails the base rules; without labels of both
kinds the trees are empty and every text that passes the base rules is kept; a document labelled
twice counts as good only if both labels say so; null labels are ignored; of rows that share a labelled
id the text with the smallest hash is learned from.
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

from assay.llm.kernels import WordHashes, row_chunks, shingle_hashes, text_bytes, tidy

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Statistics the trees see, and the direction in which each may move the score (0: either).
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_char": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "digit_share": -1,
    "punctuation_share": 0,
    "distinct_words": 0,
    "words_per_line": 0,
}


def _class_table(chars: bytes) -> np.ndarray:
    held = np.zeros(256, np.int64)
    held[list(chars)] = 1
    return held


BLANKS = bytes([32, *range(9, 14)])
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
CLASSES = {
    "continuation": _class_table(bytes(range(128, 192))),
    "blank": _class_table(BLANKS),
    "symbol": _class_table(SYMBOLS),
    "upper": _class_table(bytes(range(65, 91))),
    "digit": _class_table(bytes(range(48, 58))),
    "punctuation": _class_table(PUNCTUATION),
}


def repeated_words(shingles: np.ndarray, size: int) -> int:
    """Words inside a run of ``size`` words that occurs twice or more."""
    ordered = np.sort(shingles)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.nonzero(np.isin(shingles, twice))[0]
    gaps = np.diff(starts)
    return int(np.minimum(gaps, size).sum()) + size


def statistics(data: np.ndarray, offsets: np.ndarray, hashes: WordHashes) -> dict[str, np.ndarray]:
    """Counts per text: the base columns and what the trees need besides."""
    rows = len(offsets) - 1
    held = {name: np.zeros(rows, np.int64) for name in (*BASE, "n_lines", "n_distinct", *CLASSES)}
    for lo, hi in row_chunks(offsets):
        part = data[offsets[lo] : offsets[hi]]
        own = offsets[lo : hi + 1] - offsets[lo]
        for name, flags in CLASSES.items():
            sums = np.zeros(len(part) + 1, np.int64)
            np.cumsum(flags[part], out=sums[1:])
            held[name][lo:hi] = np.diff(sums[own])
        raw = part.tobytes()
        for k in range(lo, hi):
            text = raw[own[k - lo] : own[k - lo + 1]]
            words = text.split()
            lines = [line for line in text.split(b"\n") if line and not line.isspace()]
            held["n_words"][k] = len(words)
            held["n_lines"][k] = len(lines)
            held["n_dup_lines"][k] = len(lines) - len(set(lines))
            if words:
                codes = hashes.of(words)
                held["n_distinct"][k] = len(set(words))
                if len(words) >= WINDOW:
                    held["n_repeat_words"][k] = repeated_words(shingle_hashes(codes, WINDOW), WINDOW)
    held["n_symbols"] = held["symbol"]
    held["chars"] = np.diff(offsets) - held["continuation"]
    held["word_chars"] = held["chars"] - held["blank"]
    return held


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    lines = np.maximum(s["n_lines"], 1)
    return np.column_stack(
        [
            np.log1p(s["n_words"]),
            s["word_chars"] / words,
            s["n_symbols"] / chars,
            s["n_dup_lines"] / lines,
            s["n_repeat_words"] / words,
            s["upper"] / chars,
            s["digit"] / chars,
            s["punctuation"] / chars,
            s["n_distinct"] / words,
            words / lines,
        ]
    )


@dataclass
class Trees:
    """Flat nodes of all trees: a leaf points at itself, so every row takes ``depth`` steps."""

    roots: list[int] = field(default_factory=list)
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    depth: int = 0
    start: float = 30.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return total


def grow(
    x: np.ndarray,
    y: np.ndarray,
    directions: list[int],
    trees: int = 80,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 64,
    least: int = 20,
    penalty: float = 1.0,
) -> Trees:
    """Boosted trees for the logistic loss. A constrained split keeps its children in order, and their
    middle bounds everything below, so a score is monotonic in each constrained statistic."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = [np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    p = min(max(y.mean(), 1e-3), 1 - 1e-3)
    start = float(np.log(p / (1 - p)))
    margin = np.full(len(y), start)
    least = min(least, max(1, len(y) // 10))

    def leaf(weight: float) -> int:
        node = len(feature)
        for held, new in ((feature, 0), (threshold, np.inf), (left, node), (right, node), (value, weight)):
            held.append(new)
        return node

    for _ in range(trees):
        q = 1 / (1 + np.exp(-margin))
        g, h = q - y, np.maximum(q * (1 - q), 1e-6)

        def build(rows: np.ndarray, low: float, high: float, level: int) -> int:
            gs, hs = g[rows].sum(), h[rows].sum()  # noqa: B023
            weight = float(np.clip(-gs / (hs + penalty), low, high))
            node = leaf(rate * weight)
            best = (1e-6, None)
            if level < depth and len(rows) >= 2 * least:
                for j, codes in enumerate(binned):
                    if not len(cuts[j]):
                        continue
                    own = codes[rows]
                    size = len(cuts[j]) + 1
                    gl, hl, nl = (np.cumsum(np.bincount(own, v, size))[:-1] for v in (g[rows], h[rows], None))  # noqa: B023
                    wl = np.clip(-gl / (hl + penalty), low, high)
                    wr = np.clip(-(gs - gl) / (hs - hl + penalty), low, high)
                    ok = (nl >= least) & (len(rows) - nl >= least) & (directions[j] * (wr - wl) >= 0)

                    def loss(w, gg, hh):
                        return -(gg * w + 0.5 * (hh + penalty) * w * w)

                    gain = loss(wl, gl, hl) + loss(wr, gs - gl, hs - hl) - loss(weight, gs, hs)
                    k = int(np.argmax(np.where(ok, gain, -np.inf)))
                    if ok[k] and gain[k] > best[0]:
                        best = (gain[k], (j, k, wl[k], wr[k]))
            if best[1] is None:
                margin[rows] += rate * weight
                return node
            j, k, wl, wr = best[1]
            middle = (wl + wr) / 2
            down, up = (low, middle), (middle, high)
            if directions[j] == 0:
                down = up = (low, high)
            elif directions[j] < 0:
                down, up = up, down
            side = binned[j][rows] <= k
            feature[node], threshold[node] = j, float(cuts[j][k])
            left[node] = build(rows[side], *down, level + 1)
            right[node] = build(rows[~side], *up, level + 1)
            return node

        roots.append(build(np.arange(len(y)), -np.inf, np.inf, 0))
    arrays = (np.array(feature, np.int32), np.array(threshold), np.array(left, np.int32), np.array(right, np.int32))
    return Trees(roots, *arrays, np.array(value), depth, start)


def _feature_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        x = features(statistics(*text_bytes(batch.column("text")), hashes))
        lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("quality"), lists], ["quality", "x"])


def fit(docs: DataFrame, labels: DataFrame, seen: Column | None = None, fit_rows: int = 20_000, **options) -> Trees:
    """Grow trees on at most ``fit_rows`` labelled documents, those with the smallest hash of the id, one text each."""
    rows = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).dropna().filter("quality IN (0, 1)")
    if seen is not None:
        rows = rows.filter(seen)
    rows = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = F.broadcast(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    texts = docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id", "quality")
    held = (
        texts.agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
        .select("first.text", "quality")
        .mapInArrow(tidy(_feature_kernel), "quality int, x array<double>")
        .collect()
    )
    held.sort()  # the trees do not depend on the order of arrival
    y = np.array([r["quality"] for r in held], float)
    if not len(y) or y.min() == y.max():
        return Trees()
    return grow(np.array([r["x"] for r in held]), y, list(FEATURES.values()), **options)


def _verdict_kernel(trees: Trees, threshold: float):
    cut = float(np.log(threshold / (1 - threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            s = statistics(*text_bytes(batch.column("text")), hashes)
            margin = trees.margin(features(s))
            failed = (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])
            columns = [pa.array(s[name], pa.int64()) for name in BASE]
            columns += [pa.array(failed), pa.array(~failed & (margin >= cut))]
            columns += [pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))))]
            names = ["doc_id", *BASE, "base_failed", "kept", "quality_score"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    return run


def judge(docs: DataFrame, trees: Trees, threshold: float = 0.5) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and ``quality_score`` of every row."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in BASE)
    return rows.mapInArrow(
        tidy(_verdict_kernel(trees, threshold)),
        f"doc_id {kind}, {counts}, base_failed boolean, kept boolean, quality_score double",
    )
