"""Periodic runs of words: stretches that repeat with a smallest period, by internal pattern matching.

Texts are taken some at a time as one sequence of word codes, in which no match crosses texts.
Prefix doubling gives the suffix array and, on its way, the interval of every aligned (dyadic) block of
m words, for each power of two m. A wavelet tree over the suffix array answers range successor queries:
the next place in an interval's positions, so the next occurrence of the block, at or after a
given word. A run of period q and length l holds an aligned block of m words and its copy q words on if
2m - 1 + q <= l, so each q belongs to the largest such m, and the blocks of size m look for occurrences
in a neighbouring window of some 4m words. Occurrences that overlap by half a block or more form arithmetic
progressions, which are extended and stepped over as a whole: of one that begins at the block itself
only the difference can be a smallest period. Every distance found is a candidate period; the stretch
around it is extended both ways by common extensions (62 bits of polynomial hashes, binary search)
and kept if it is long enough; of candidates with the same stretch the smallest is its period.

Work is O(n log n) per chunk in numpy, memory some 200 bytes per word of a chunk or of a longer text.

Edge cases: a null, empty or blank text has no words, no runs and an empty collapsed text; repeated rows
are reported each; nothing depends on the id, so it may be null or shared.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from assay.llm.kernels import row_chunks, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words a run must have at least.
LEAST = 12
# Bytes of text worked on as one sequence.
CHUNK = 1 << 20
# Moduli and bases of the two hashes.
HASHES = ((2_147_483_647, 911_382_323), (2_147_483_629, 972_663_749))


class _Codes(dict):
    """Numbers of words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class WaveletTree:
    """Range successor over an array of numbers below ``limit``, as a wavelet matrix: one prefix count per bit."""

    def __init__(self, values: np.ndarray, limit: int) -> None:
        self.limit, self.size, self.levels = limit, len(values), []
        for bit in range(max(1, int(limit - 1).bit_length()) - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            before = np.concatenate(([0], np.cumsum(zero))).astype(np.int32)
            self.levels.append((bit, before, int(before[-1])))
            values = np.concatenate((values[zero], values[~zero]))

    def _smaller(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of values[lo:hi] are below x."""
        count = np.zeros(len(lo), np.int64)
        for bit, before, zeros in self.levels:
            one = (x >> bit) & 1 == 1
            a, b = before[lo], before[hi]
            count += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros + lo - a, a), np.where(one, zeros + hi - b, b)
        return count

    def _select(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest of values[lo:hi]."""
        found = np.zeros(len(lo), np.int64)
        for bit, before, zeros in self.levels:
            a, b = before[lo], before[hi]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            found |= one.astype(np.int64) << bit
            lo, hi = np.where(one, zeros + lo - a, a), np.where(one, zeros + hi - b, b)
        return found

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest of values[lo:hi] that is x or more, ``limit`` if there is none."""
        found = np.full(len(lo), self.limit, np.int64)
        within = x < self.limit
        rank = self._smaller(lo[within], hi[within], x[within])
        left = rank < hi[within] - lo[within]
        at = np.nonzero(within)[0][left]
        found[at] = self._select(lo[at], hi[at], rank[left])
        return found


class Extensions:
    """How far two places of a sequence agree to the right or left, within their text."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, end: np.ndarray) -> None:
        self.first, self.end = first, end
        self.steps = [1 << i for i in range(len(codes).bit_length(), -1, -1)]
        self.tables = []
        for prime, base in HASHES:
            powers = np.ones(1, np.int64)
            while len(powers) <= len(codes):
                powers = np.concatenate((powers, powers * (int(powers[-1]) * base % prime) % prime))
            sums = np.concatenate(([0], np.cumsum((codes + 1) * powers[: len(codes)] % prime))) % prime
            self.tables.append((prime, powers, sums))

    def _same(self, at: np.ndarray, shift: np.ndarray, length: np.ndarray) -> np.ndarray:
        same = np.ones(len(at), bool)
        for prime, powers, sums in self.tables:
            here = (sums[at + length] - sums[at]) % prime
            there = (sums[at + shift + length] - sums[at + shift]) % prime
            same &= here * powers[shift] % prime == there
        return same

    def right(self, at: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Words from ``at`` on that equal those ``shift`` further."""
        room, found = self.end[at] - shift - at, np.zeros(len(at), np.int64)
        for step in self.steps:
            fits = np.nonzero(found + step <= room)[0]
            good = fits[self._same(at[fits] + found[fits], shift[fits], np.full(len(fits), step))]
            found[good] += step
        return found

    def left(self, at: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Words before ``at`` that equal those ``shift`` further."""
        room, found = at - self.first[at], np.zeros(len(at), np.int64)
        for step in self.steps:
            fits = np.nonzero(found + step <= room)[0]
            good = fits[self._same(at[fits] - found[fits] - step, shift[fits], np.full(len(fits), step))]
            found[good] += step
        return found


def period_ranges(longest: int, least: int) -> dict[int, tuple[int, int]]:
    """Block size: smallest and largest period it looks for, over all periods a text of ``longest`` words can have."""
    q = np.arange(1, longest // 2 + 1)
    room = (np.maximum(least, 2 * q) - q + 1) // 2
    size = 1 << (np.frexp(room.astype(float))[1] - 1)
    return {int(m): (int(q[size == m].min()), int(q[size == m].max())) for m in np.unique(size)}


def _block_intervals(
    codes: np.ndarray, text: np.ndarray, end: np.ndarray, ranges: dict[int, tuple[int, int]]
) -> tuple[np.ndarray, WaveletTree | None]:
    """Columns (block, size, qlo, qhi, lo, hi) of aligned blocks that occur again in their text, and the tree over the array.

    Prefix doubling sorts only what is still tied; places that share their first m words stay together
    in the array from the round of m on, so an interval found then holds in the finished array.
    """
    n = len(codes)
    key = text * (int(codes.max()) + 1) + codes
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate(([True], np.diff(key[order]) != 0))
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, slots, 0))
    found, spot, h = [], None, 1
    while True:
        tied = ~(fresh & np.append(fresh[1:], True))  # slots of groups with more than one place
        if h in ranges:
            if spot is None:
                held, spot = tied, np.concatenate(([0], np.cumsum(tied)))
            b = np.arange(0, n - h + 1, h)
            b = b[b + h <= end[b]]
            b = b[tied[rank[b]]]
            starts = np.append(np.nonzero(fresh)[0], n)
            upto = starts[np.searchsorted(starts, rank[b], side="right")]
            qlo, qhi = ranges[h]
            found.append(np.stack([b, np.full(len(b), h), np.full(len(b), qlo), np.full(len(b), qhi), spot[rank[b]], spot[upto]]))
        if h >= max(ranges) or not tied.any():
            break
        at = slots[tied]
        places = order[at]
        ahead = places + h
        inside = ahead < end[places]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[places] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        order[at], key = places[by], key[by]
        fresh[at] = np.concatenate(([True], np.diff(key) != 0))
        rank[order[at]] = np.maximum.accumulate(np.where(fresh[at], at, 0))
        h *= 2
    if not found or not sum(f.shape[1] for f in found):
        return np.zeros((6, 0), np.int64), None
    return np.concatenate(found, axis=1), WaveletTree(order[held], n)


def _candidates(blocks: np.ndarray, tree: WaveletTree, extend: Extensions) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance): where a block and a later copy of it may lie in one run of that period."""
    place, size, qlo, qhi, lo, hi = blocks
    at, since = place + 1, place.copy()  # where to look on from; the last occurrence, -1 if some were passed over
    found = []
    while len(place):
        y = tree.successor(lo, hi, at)
        go = (y < tree.limit) & (y <= place + qhi)
        place, size, qlo, qhi, lo, hi, since, y = (v[go] for v in (place, size, qlo, qhi, lo, hi, since, y))
        step = y - since
        close = np.nonzero((since >= 0) & (2 * step <= size))[0]
        last = y.copy()
        # All occurrences of a progression: as many steps as the common period carries a whole block.
        reach = since[close] + step[close] + extend.right(since[close], step[close])
        last[close] = since[close] + (reach - size[close] - since[close]) // step[close] * step[close]
        many = np.ones(len(place), np.int64)
        own = since[close] == place[close]
        many[close] = np.where(own, 1, (last[close] - y[close]) // np.maximum(step[close], 1) + 1)
        row = np.repeat(np.arange(len(place)), many)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        distance = y[row] + nth * step[row] - place[row]
        good = (distance >= qlo[row]) & (distance <= qhi[row])
        found.append((place[row[good]], distance[good]))
        at = np.maximum(last + 1, place + qlo)
        since = np.where(at > last + 1, -1, last)
    pairs = np.unique(np.concatenate([np.stack(f) for f in found], axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
    return pairs[0], pairs[1]


def find_runs(codes: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs in the texts that ``bounds`` cut the sequence into, by start, then period."""
    sizes = np.diff(bounds)
    none = np.zeros((0, 3), np.int64)
    if not len(sizes) or sizes.max() < max(2, least):
        return none
    text = np.repeat(np.arange(len(sizes)), sizes)
    first, end = bounds[:-1][text], bounds[1:][text]
    blocks, tree = _block_intervals(codes, text, end, period_ranges(int(sizes.max()), least))
    if tree is None:
        return none
    extend = Extensions(codes, first, end)
    place, period = _candidates(blocks, tree, extend)
    if not len(place):
        return none
    start = place - extend.left(place, period)
    length = place + extend.right(place, period) + period - start
    long = length >= np.maximum(least, 2 * period)
    start, length, period = start[long], length[long], period[long]
    by = np.lexsort((period, length, start))
    rows = np.stack([start, length, period], axis=1)[by]
    smallest = np.ones(len(rows), bool)
    smallest[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[smallest]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _chunk(texts: list[bytes], least: int) -> tuple[list[int], np.ndarray, np.ndarray, list[bytes]]:
    """Word counts, offsets of each text's runs, the runs with starts counted per text, and collapsed texts."""
    words = [t.split() for t in texts]  # bytes split at the six ASCII blanks, and only there
    counts = [len(w) for w in words]
    bounds = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
    number = _Codes()
    codes = np.fromiter((number[x] for w in words for x in w), np.int64, int(bounds[-1]))
    runs = find_runs(codes, bounds, least)
    at = np.searchsorted(runs[:, 0], bounds)
    covered = np.zeros(len(codes) + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
    stays = np.cumsum(covered)[:-1] == 0
    collapsed = []
    for i, w in enumerate(words):
        if at[i] < at[i + 1]:
            w = [x for x, stay in zip(w, stays[bounds[i] : bounds[i + 1]].tolist(), strict=True) if stay]
        collapsed.append(b" ".join(w))
    runs[:, 0] -= np.repeat(bounds[:-1], np.diff(at))
    return counts, at, runs, collapsed


def _runs_kernel(least: int):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lo, hi in row_chunks(offsets, CHUNK):
                texts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(lo, hi)]
                counts, at, found, collapsed = _chunk(texts, least)
                columns = [pa.array(found[:, j]) for j in range(3)]
                lists = pa.ListArray.from_arrays(
                    pa.array(at, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(kind))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(lo, hi - lo),
                        pa.array(counts, pa.int64()),
                        lists,
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    ["id", "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row, in one pass without a shuffle.

    runs has (start, length, period) in words, by start, then period; collapsed is the words joined by
    blanks without those that a run holds after its first period.
    """
    rows = docs.select(docs[doc_id].alias("id"), docs[text].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return rows.mapInArrow(_runs_kernel(least), f"id {kind}, n_words bigint, runs {runs}, collapsed string")
