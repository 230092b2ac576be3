"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed byte n-grams. From a bounded sample of labelled texts every
language gets a few centroids (spherical k-means, a task per language); a text takes the language of
the centroid with the largest cosine. The driver gets document frequencies and centroids. A text farther from every centroid than the rejection distance of the nearest
one (a low quantile of the cosines of that centroid's own texts) is marked ``rejected``.

Edge cases: a null text or one without a letter is ``und`` with score 0; so is every text when
nothing could be learned. Rows equal in id and text are learned from once; rows that share an id, or have
none, are told apart by their text.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import keep
from assay.llm.kernels import row_chunks, text_bytes, tidy, words64

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"
DIMENSIONS = 2048
GRAMS = {1: 0x9E3779B97F4A7C15, 2: 0xC2B2AE3D27D4EB4F, 3: 0xD6E8FEB86659FD93}
# ASCII letters in lower case, everything else in ASCII a blank, UTF-8 bytes as they are.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
ASCII_LETTER = re.compile(rb"[A-Za-z]")
# Texts whose vectors are held at a time.
ROWS = 256
# Places of the hash that picks the sample.
PLACES = 1 << 40


@dataclass
class LanguageModel:
    languages: list[str]
    centroids: np.ndarray  # one row each, unit length
    owner: np.ndarray  # number of the language of each centroid
    idf: np.ndarray
    floor: np.ndarray  # smallest accepted cosine of each centroid


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often every hashed n-gram occurs in each text."""
    rows = len(offsets) - 1
    x = words64(np.frombuffer(data.tobytes().translate(FOLD), np.uint8))
    row = np.repeat(np.arange(rows), np.diff(offsets)) * DIMENSIONS
    total = np.zeros(rows * DIMENSIONS, np.int64)
    ends = offsets[1:]
    shift = np.uint64(64 - DIMENSIONS.bit_length() + 1)
    for n, multiplier in GRAMS.items():
        masked = x & np.uint64((1 << (8 * n)) - 1)
        at = row + ((masked * np.uint64(multiplier)) >> shift).astype(np.int64)
        inside = np.ones(len(x), bool)
        for back in range(1, n):
            last = ends - back
            inside[last[last >= offsets[:-1]]] = False
        total += np.bincount(at[inside], minlength=len(total))
    return total.reshape(rows, DIMENSIONS)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def vectors(data: np.ndarray, offsets: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(term_counts(data, offsets).astype(np.float32)) * idf)


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def small_chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    for lo, hi in row_chunks(offsets):
        for at in range(lo, hi, ROWS):
            yield at, min(hi, at + ROWS)


def _count_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for lo, hi in small_chunks(offsets):
            counts = term_counts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]).astype(np.int32)
            packed = pa.array([row.tobytes() for row in counts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("lang")[lo:hi], packed], ["lang", "counts"])


def sample(docs: DataFrame, seen: Column, per_language: int, fit_rows: int) -> DataFrame:
    """About ``per_language`` rows (lang, text) of each language, chosen by a hash of id and text.

    With many languages each gets fewer, so that all together are some ``fit_rows``; but each has a row as
    long as there are no more languages than that.
    """
    rows = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & seen)
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit("language")), F.lit(PLACES))
    placed = rows.select("lang", "text", place.alias("place"))
    counts = keep(placed.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("least")), "languages")
    each = max(1, min(per_language, fit_rows // max(1, counts.count())))
    share = F.lit(float(each) if each > 1 else 0.0) / F.col("n") * PLACES
    upto = F.greatest(F.col("least").cast("double"), share)
    shares = counts.orderBy(F.desc("n"), "lang").limit(fit_rows).select("lang", upto.alias("upto"))
    taken = placed.join(F.broadcast(shares), "lang").filter(F.col("place") <= F.col("upto"))
    return taken.dropDuplicates(["lang", "place"]).select("lang", "text")


def _frequency_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of the task every n-gram occurs."""
    n, found = 0, np.zeros(DIMENSIONS, np.int64)
    for batch in batches:
        for packed in batch.column("counts"):
            found += np.frombuffer(packed.as_buffer(), np.int32) > 0
        n += batch.num_rows
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([found.tobytes()], pa.binary())], ["n", "found"])


def _centroid_kernel(idf: np.ndarray, clusters: int, quantile: float):
    def run(table: pa.Table) -> pa.Table:
        """Centroids of the texts of one language, each with the cosine below which it rejects."""
        held = sorted(table.column("counts").to_pylist())  # they do not depend on the order of arrival
        counts = np.array([np.frombuffer(c, np.int32) for c in held], np.float32)
        x = unit(np.log1p(counts) * idf)
        centres, member = cluster(x, min(clusters, len(x)))
        cosine = (x * centres[member]).sum(axis=1)
        used = [c for c in range(len(centres)) if (member == c).any()]
        return pa.table(
            {
                "lang": pa.array([table.column("lang")[0].as_py()] * len(used), pa.string()),
                "number": pa.array(used, pa.int32()),
                "centre": pa.array([centres[c].astype(np.float32).tobytes() for c in used], pa.binary()),
                "floor": pa.array([float(np.quantile(cosine[member == c], quantile)) for c in used], pa.float64()),
            }
        )

    return run


def fit(
    docs: DataFrame,
    seen: Column,
    per_language: int = 800,
    clusters: int = 4,
    quantile: float = 0.005,
    fit_rows: int = 100_000,
) -> LanguageModel:
    """Learn from ``lang`` and ``text`` of the rows for which ``seen`` is true.

    About ``per_language`` texts of each language and ``fit_rows`` of all are learned from; the driver gets
    ``clusters`` centroids (8 KB each) of every language there is.
    """
    held = keep(sample(docs, seen, per_language, fit_rows), "language-sample")
    counted = held.mapInArrow(tidy(_count_kernel), "lang string, counts binary")
    none = F.lit(bytes(4 * DIMENSIONS))
    counted = keep(counted.filter(F.col("counts") != none), "language-counts")
    sums = counted.mapInArrow(_frequency_kernel, "n long, found binary").collect()
    n = sum(r["n"] for r in sums)
    found = sum((np.frombuffer(r["found"], np.int64) for r in sums), np.zeros(DIMENSIONS, np.int64))
    idf = (np.log((1 + n) / (1 + found)) + 1).astype(np.float32)
    grouped = counted.groupBy("lang").applyInArrow(
        _centroid_kernel(idf, clusters, quantile), "lang string, number int, centre binary, floor double"
    )
    rows = sorted(grouped.collect(), key=lambda r: (r["lang"], r["number"]))
    languages = sorted({r["lang"] for r in rows})
    number = {lang: k for k, lang in enumerate(languages)}
    return LanguageModel(
        languages,
        np.array([np.frombuffer(r["centre"], np.float32) for r in rows], np.float32).reshape(-1, DIMENSIONS),
        np.array([number[r["lang"]] for r in rows], np.int64),
        idf,
        np.array([r["floor"] for r in rows], np.float32),
    )


def cluster(x: np.ndarray, k: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means; the first centre is the mean direction, the others lie farthest from all before."""
    centres = unit(x.sum(axis=0, keepdims=True))
    while len(centres) < k:
        centres = np.vstack([centres, x[np.argmin((x @ centres.T).max(axis=1))]])
    for _ in range(rounds):
        member = np.argmax(x @ centres.T, axis=1)
        sums = np.array([x[member == c].sum(axis=0) if (member == c).any() else centres[c] for c in range(k)])
        centres = unit(sums)
    return centres, np.argmax(x @ centres.T, axis=1)


def _predict_kernel(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            rows = batch.num_rows
            lang = np.full(rows, UNKNOWN, object)
            score, rejected = np.zeros(rows), np.zeros(rows, bool)
            for lo, hi in small_chunks(offsets) if model.languages else ():
                part = data[offsets[lo] : offsets[hi]]
                own = offsets[lo : hi + 1] - offsets[lo]
                cosine = vectors(part, own, model.idf) @ model.centroids.T
                best = np.argmax(cosine, axis=1)
                top = cosine[np.arange(hi - lo), best]
                raw = part.tobytes()
                lettered = np.array([has_letter(raw[own[i] : own[i + 1]]) for i in range(hi - lo)], bool)
                names = np.array(model.languages, object)[model.owner[best]]
                lang[lo:hi] = np.where(lettered, names, UNKNOWN)
                score[lo:hi] = np.where(lettered, np.clip(top, 0, 1), 0)
                rejected[lo:hi] = lettered & (top < model.floor[best])
            columns = [pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)]
            names = ["doc_id", "lang_pred", "score", "rejected"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    return run


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row; score is the cosine to the nearest centroid."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(_predict_kernel(model)), f"doc_id {kind}, lang_pred string, score double, rejected boolean")
