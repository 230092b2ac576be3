"""Repeated passages by a logarithmic family of sparse suffix arrays.

A passage is a string of ``length`` bytes that starts at two places. Suffixes are sampled by content:
in every window of a text the start of the k-gram with the smallest hash is an anchor, so equal
passages hold equal anchors at equal offsets. An entry of a suffix array is an anchor: the leading
bytes of its suffix (the sort order), the hash of its k-gram, and the hash of its context, all bytes
that passages around this anchor can reach.

``SuffixFamily`` takes documents in batches. A batch becomes a sorted run, is merge-scanned against
the existing levels for anchors with equal k-grams, and levels of equal rank merge into one of the
next rank, so an entry is rewritten about log2(batches) times. Equal contexts of one k-gram become
one entry with a count, so thousands of copies cost one.

Matches are then settled exactly (to 64-bit hashes of bytes under an equal k-gram):

* members of a context that occurs twice lie in repeated passages as far as the context reaches;
* contexts that share their k-gram with different ones are sorted by the bytes from the anchor on and
  by the bytes before it, read backwards, like two suffix arrays. The neighbours in each order share
  the longest stretch with a context to its right and to its left, which bounds the passages repeated
  around it; where the stretches shared with these neighbours reach that bound, it is exact.
* What stays open is compared passage by passage. The offsets of the anchor in a passage form a tree of
  ``fan`` children per node. For a node, the bytes common to all its passages (core) and the bytes any of
  them covers (whole) are hashed: a core nobody else has rules the node out, a shared whole settles it,
  anything else is split further.

K-grams with at most ``GROUP`` contexts are settled where their contexts meet. For more crowded ones
every step down the tree is a grouping by hash over all tasks, whose counts combine before the shuffle.

Edge cases: null and short texts lose nothing; repeated rows count as different documents; rows that
share an id are told apart by their text; a row without an id takes a negative one from its text; a text
of one repeated character is one repeated passage.
"""

from __future__ import annotations

import hashlib
import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import Scratch, keep, text_key, union_all, unused
from assay.llm.kernels import mixed, row_chunks, text_bytes, tidy, words64

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 400
FAN = 7
LEVELS = 3
BATCHES = 4
# Contexts of one k-gram that are compared within a task at most: some 30 MB.
GROUP = 20_000
# Contexts compared at a time.
BLOCK = 1024
# Bytes of one text looked at together; longer texts are read in overlapping parts.
PART = 1 << 19
POSITION_BITS = 21
# No join may broadcast: the driver builds what is broadcast, and Spark goes by the bytes of files, of which a few MB
# hold hundreds of MB of rows where a column repeats.
JOIN = "merge"
ENTRY = "id long, th int, pos int, before int, after int, prefix long, gram long, context long"


def gram_size(length: int, fan: int) -> int:
    return length - fan**LEVELS + 1


def gram_hashes(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` (8 to 128) bytes from every position on, and the first eight bytes there."""
    first = words64(data)
    held, width = mixed(first), 8
    while width < size:
        step = min(width, size - width)
        following = np.zeros_like(held)
        following[:-step] = held[step:]
        held = held * np.uint64(0x9E3779B97F4A7C15) + following
        held ^= held >> np.uint64(29)
        width += step
    return mixed(held), first


def sliding_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values, by minima from the borders of blocks of ``w``."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, fan: int) -> tuple[np.ndarray, ...]:
    """Positions of the anchors of all texts, their k-gram hashes and leading bytes, in text order."""
    w, size = fan**LEVELS, gram_size(length, fan)
    if len(data) < length:
        return (np.zeros(0, np.int64),) + (np.zeros(0, np.uint64),) * 2
    gram, first = gram_hashes(data, size)
    low = np.uint64((1 << POSITION_BITS) - 1)
    ranked = (gram & ~low) | np.arange(len(data), dtype=np.uint64)
    smallest = sliding_minimum(ranked[: len(data) - size + 1], w)
    found = []
    for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
        if hi - lo >= length:  # only windows that lie inside a text
            at = (smallest[lo : hi - length + 1] & low).astype(np.int64)
            found.append(at[np.concatenate([[True], at[1:] != at[:-1]])])
    at = np.concatenate(found) if found else np.zeros(0, np.int64)
    return at, gram[at], first[at]


def parts(offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(start, offsets from there) of stretches of texts; a long text comes in parts that overlap."""
    for lo, hi in row_chunks(offsets, PART):
        start, end = int(offsets[lo]), int(offsets[hi])
        if end - start <= PART:
            yield start, offsets[lo : hi + 1] - start
        else:
            for at in range(start, max(start + 1, end - length + 1), PART - length):
                yield at, np.array([0, min(PART, end - at)])


def _entry_kernel(length: int, fan: int):
    reach = fan**LEVELS - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            hashes = batch.column("th").to_numpy(zero_copy_only=False)
            last = -1
            for start, own in parts(offsets, length):
                at, gram, first = anchors(data[start : start + int(own[-1])], own, length, fan)
                new = at + start > last  # parts of a long text may share their border's anchors
                at, gram, first = at[new] + start, gram[new], first[new]
                last = int(at[-1]) if len(at) else last
                row = np.searchsorted(offsets, at, side="right") - 1
                before = np.minimum(at - offsets[row], reach)
                after = np.minimum(offsets[row + 1] - at, length)
                raw = memoryview(data)
                bounds = zip((at - before).tolist(), (at + after).tolist(), before.tolist(), strict=True)
                context = [xxhash.xxh3_64_intdigest(raw[a:b], seed=c) for a, b, c in bounds]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[row], pa.int64()),
                        pa.array(hashes[row], pa.int32()),
                        pa.array((at - offsets[row]).astype(np.int32)),
                        pa.array(before.astype(np.int32)),
                        pa.array(after.astype(np.int32)),
                        pa.array(first.byteswap().view(np.int64)),
                        pa.array(gram.view(np.int64)),
                        pa.array(np.array(context, np.uint64).view(np.int64)),
                    ],
                    ["id", "th", "pos", "before", "after", "prefix", "gram", "context"],
                )

    return run


def entries(docs: DataFrame, length: int = LENGTH, fan: int = FAN) -> DataFrame:
    """Sampled suffixes of all texts of ``docs`` (id, th, text)."""
    return docs.select("id", "th", "text").mapInArrow(tidy(_entry_kernel(length, fan)), ENTRY)


class SuffixFamily:
    """Sorted runs of sampled suffixes whose ranks are all different, like the digits of a counter."""

    KEY = ("prefix", "gram", "context")

    def __init__(self, scratch: Scratch) -> None:
        self.scratch = scratch
        self.levels: list[tuple[int, DataFrame]] = []
        self.seeds: list[DataFrame] = []

    def add(self, batch: DataFrame) -> DataFrame:
        """Take in the entries of a batch; returns the k-grams it repeats, inside itself or in a level."""
        rep = F.min(F.struct("id", "th", "pos", "before", "after")).alias("rep")
        run = self._sorted(batch.groupBy(*self.KEY).agg(F.count("*").alias("n"), rep))
        own = run.groupBy("prefix", "gram").agg(F.sum("n").alias("n")).filter("n > 1")
        scans = [own.select("prefix", "gram")]
        grams = run.select("prefix", "gram").distinct()
        for _, level in self.levels:
            scans.append(grams.join(level.select("prefix", "gram").distinct().hint(JOIN), ["prefix", "gram"]))
        seeds = self.scratch.keep(union_all(scans).distinct(), "suffix-seeds")
        self.seeds.append(seeds)
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            level = self.levels.pop()[1]
            merged = self._sorted(self._merged(level.unionByName(run)))
            self.scratch.discard(level)
            self.scratch.discard(run)
            run, rank = merged, rank + 1
        self.levels.append((rank, run))
        return seeds

    def matched(self) -> DataFrame:
        """Entries (with count and first member) of all k-grams that occur twice."""
        every = union_all([level for _, level in self.levels])
        seeds = self.scratch.keep(union_all(self.seeds).distinct(), "suffix-seeds")
        # a join of its own, so that a k-gram with very many contexts can be split over tasks
        return self._merged(self.scratch.keep(every.join(seeds.hint(JOIN), ["prefix", "gram"], "left_semi"), "suffix-seeded"))

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.KEY).agg(F.sum("n").alias("n"), F.min("rep").alias("rep"))

    def _sorted(self, rows: DataFrame) -> DataFrame:
        return self.scratch.keep(rows.sortWithinPartitions(*self.KEY), "suffix-run")


def node_hashes(data: bytes, before: int, after: int, level: int, node: int, length: int, fan: int) -> tuple | None:
    """(first offset, end offset, core, whole) of a node of the offset tree as far as the context reaches.

    Offsets are distances from the start of a passage to the anchor. whole is None if the context does
    not reach all passages of the node; the result is None if it reaches none.
    """
    size = fan ** (LEVELS - level)
    lo, hi = node * size, (node + 1) * size
    first, end = max(lo, length - after), min(hi, before + 1)
    if first >= end:
        return None
    core = xxhash.xxh3_64_intdigest(data[before - lo : before - hi + 1 + length])
    whole = None
    if (first, end) == (lo, hi):
        whole = core if size == 1 else xxhash.xxh3_64_intdigest(data[before - hi + 1 : before - lo + length])
    return first, end, core, whole


def common(x: np.ndarray, i: np.ndarray, j: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows ``i`` and ``j``, zero where ``j`` is -1."""
    first = np.empty(len(i), np.int64)
    for lo in range(0, len(i), BLOCK):
        differ = x[i[lo : lo + BLOCK]] != x[j[lo : lo + BLOCK]]
        first[lo : lo + BLOCK] = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
    return np.where(j < 0, 0, np.minimum(first, np.minimum(sizes[i], sizes[j])))


def padded(texts: list[bytes], width: int) -> np.ndarray:
    """Texts as rows of ``width`` bytes, filled up with zeros."""
    out = np.zeros((len(texts), width), np.uint8)
    for row, text in zip(out, texts, strict=True):
        row[: len(text)] = np.frombuffer(text, np.uint8)
    return out


def neighbours(order: list[int], ids: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
    """For every number the one before and after it in ``order``; with ``ids`` the nearest of a smaller id."""
    m = len(order)
    before, after = np.full(m, -1), np.full(m, -1)
    if ids is None:
        before[order[1:]], after[order[:-1]] = order[:-1], order[1:]
        return before, after
    for sequence, out in ((order, before), (order[::-1], after)):
        held: list[int] = []
        for k in sequence:
            while held and ids[held[-1]] >= ids[k]:
                held.pop()
            out[k] = held[-1] if held else -1
            held.append(k)
    return before, after


def settle(group: list[tuple], length: int, fan: int, first_stays: bool) -> Iterator[tuple[int, int, int]]:
    """(number, first offset, end offset) of repeated passages among the contexts of one k-gram.

    ``group`` has (data, before, after, n, (id, th)) of every context.
    """
    m = len(group)
    reach = fan**LEVELS - 1
    data, before, after, n, ids = zip(*group, strict=True)
    sizes = np.array(before), np.array(after)
    rows, orders = [], []
    for side, width in ((0, max(1, reach)), (1, length)):
        texts = [d[b:] if side else d[:b][::-1] for d, b in zip(data, before, strict=True)]
        orders.append(sorted(range(m), key=texts.__getitem__))
        rows.append(padded(texts, width))
        del texts
    smaller = list(ids) if first_stays else None
    own = np.arange(m)
    starts, ends, bound = [], [], []
    for side, order in enumerate(orders):
        most = np.zeros(m, np.int64)
        for j in neighbours(order, smaller):
            shared = common(rows[0], own, j, sizes[0]), common(rows[1], own, j, sizes[1])
            starts.append(np.where(j < 0, length, length - shared[1]))
            ends.append(np.where(j < 0, 0, shared[0] + 1))
            most = np.maximum(most, shared[side])
        bound.append(most)
    first, end = length - bound[1], bound[0] + 1  # no passage repeats outside
    starts, ends = np.array(starts), np.array(ends)
    ends = np.where(starts < ends, ends, 0)  # too little is shared with that neighbour
    at = np.argsort(starts, axis=0)
    starts, ends = np.take_along_axis(starts, at, 0), np.take_along_axis(ends, at, 0)
    reached = np.maximum.accumulate(np.vstack([first[None], ends]), axis=0)
    closed = (starts <= reached[:-1]).all(axis=0, where=starts < end) & (reached[-1] >= end)
    wanted = first < end
    if not first_stays:
        wanted &= np.array(n) == 1
    for k in np.nonzero(wanted & closed)[0].tolist():
        yield k, int(first[k]), int(end[k])
    rest = np.nonzero(wanted & ~closed)[0].tolist()
    if rest:
        nodes = {d // fan ** (LEVELS - 1) for k in rest for d in range(int(first[k]), int(end[k]))}
        yield from settle_nodes(group, set(rest), nodes, length, fan, first_stays)


def settle_nodes(
    group: list[tuple], wanted: set[int], nodes: set[int], length: int, fan: int, first_stays: bool
) -> Iterator[tuple[int, int, int]]:
    """The same for the contexts ``wanted``, down the offset tree from its top ``nodes``, one branch at a time."""

    def walk(members: Iterable[int], node: int, level: int) -> Iterator[tuple[int, int, int]]:
        by_core = defaultdict(list)
        for k in members:
            data, before, after, _, _ = group[k]
            held = node_hashes(data, before, after, level, node, length, fan)
            if held:
                by_core[held[2]].append((k, held))
        unsettled: list[int] = []
        for sharing in by_core.values():
            if len(sharing) < 2 or not any(k in wanted for k, _ in sharing):
                continue
            wholes = {held[3] for _, held in sharing}
            if len(wholes) == 1 and None not in wholes:
                least = min(group[k][4] for k, _ in sharing)
                for k, (first, end, _, _) in sharing:
                    if k in wanted and (not first_stays or group[k][4] > least):
                        yield k, first, end
            else:
                unsettled += [k for k, _ in sharing]
        del by_core
        if level < LEVELS and unsettled:
            unsettled.sort()
            for child in range(fan):
                yield from walk(unsettled, node * fan + child, level + 1)

    for node in sorted(nodes):
        yield from walk(range(len(group)), node, 1)


def _settle_kernel(length: int, fan: int, first_stays: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by k-gram; those of one k-gram are few."""
        gram, group, where, seen = None, [], [], set()

        def done() -> pa.RecordBatch:
            ids, ths, los, his = [], [], [], []
            for k, first, end in settle(group, length, fan, first_stays) if len(group) > 1 else ():
                i, th, pos = where[k]
                ids.append(i), ths.append(th), los.append(pos - end + 1), his.append(pos - first + length)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            arrays = [pa.array(x, t) for x, t in zip((ids, ths, los, his), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["id", "th", "lo", "hi"])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("gram", "data", "before", "after", "n", "id", "th", "pos"))
            for g, data, before, after, n, i, th, pos in zip(*columns, strict=True):
                if g != gram:
                    if len(group) > 1 and (out := done()).num_rows:
                        yield out
                    gram, group, where, seen = g, [], [], set()
                if (i, th, pos) not in seen:  # a repeated row brings its context again
                    seen.add((i, th, pos))
                    group.append((data, before, after, n, (i, th)))
                    where.append((i, th, pos))
        if len(group) > 1:
            yield done()

    return run


def _node_kernel(length: int, fan: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = defaultdict(list)
            columns = (batch.column(c).to_pylist() for c in ("gram", "data", "before", "after", "n", "id", "th", "pos", "node"))
            for g, data, before, after, n, i, th, pos, parent in zip(*columns, strict=True):
                for node in range(parent * fan, (parent + 1) * fan):
                    held = node_hashes(data, before, after, level, node, length, fan)
                    if held:
                        first, end, core, whole = held
                        whole = None if whole is None else whole - (1 << 63)
                        row = (g, node, core - (1 << 63), whole, i, th, pos, n, pos - end + 1, pos - first + length)
                        for name, value in zip(NODE, row, strict=True):
                            out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in NODE.items()], list(NODE))

    return run


NODE = {
    "gram": pa.int64(),
    "node": pa.int32(),
    "core": pa.int64(),
    "whole": pa.int64(),
    "id": pa.int64(),
    "th": pa.int32(),
    "pos": pa.int32(),
    "n": pa.int64(),
    "lo": pa.int32(),
    "hi": pa.int32(),
}
NODE_DDL = "gram long, node int, core long, whole long, id long, th int, pos int, n long, lo int, hi int"


def settle_crowded(contexts: DataFrame, length: int, fan: int, first_stays: bool, scratch: Scratch) -> DataFrame:
    """(id, th, lo, hi) of repeated passages among contexts whose k-grams are too crowded for one task."""
    found, parents = [], contexts.withColumn("node", F.lit(0))
    document = F.struct("id", "th")
    for level in range(1, LEVELS + 1):
        rows = scratch.keep(parents.mapInArrow(tidy(_node_kernel(length, fan, level)), NODE_DDL), "suffix-nodes")
        sharing = (
            rows.groupBy("gram", "node", "core")
            .agg(
                F.count("*").alias("sharers"),
                F.count("whole").alias("wholes"),
                F.min("whole").alias("w0"),
                F.max("whole").alias("w1"),
                F.min(document if first_stays else "id").alias("least"),
            )
            .filter("sharers > 1")
            .withColumn("settled", F.expr("coalesce(wholes = sharers AND w0 = w1, false)"))
            .select("gram", "node", "core", "least", "settled")
        )
        both = rows.join(scratch.keep(sharing, "suffix-sharing").hint(JOIN), ["gram", "node", "core"])
        repeated = document > F.col("least") if first_stays else F.expr("n = 1")
        found.append(both.filter(F.col("settled") & repeated).select("id", "th", "lo", "hi"))
        if level < LEVELS:
            following = scratch.keep(both.filter(~F.col("settled")).select("gram", "id", "th", "pos", "node"), "suffix-open")
            parents = contexts.join(following.hint(JOIN), ["gram", "id", "th", "pos"])
    return union_all(found)


def repeated_spans(
    docs: DataFrame, length: int, fan: int, batches: int, first_stays: bool, group: int, scratch: Scratch
) -> DataFrame:
    """(id, th, lo, hi): byte ranges of ``docs`` (id, th, text) inside repeated passages, overlapping."""
    every = scratch.keep(entries(docs, length, fan), "suffix-entries")
    family = SuffixFamily(scratch)
    for k in range(batches):
        family.add(every.filter(F.pmod(F.xxhash64("id", "th"), F.lit(batches)) == k))
    matched = scratch.keep(family.matched(), "suffix-matched")
    for _, level in family.levels:
        scratch.discard(level)

    # whole contexts that occur more than once
    copies = matched.filter("n > 1").select(*SuffixFamily.KEY, F.col("rep").alias("first"))
    members = every.join(scratch.keep(copies, "suffix-copies").hint(JOIN), list(SuffixFamily.KEY))
    rows = matched.select("gram", "n", "rep.*")
    if first_stays:
        # further places of a context in its first document are settled like the first place
        again = members.filter("id = first.id AND th = first.th AND pos <> first.pos")
        rows = rows.unionByName(again.select("gram", F.lit(2).cast("long").alias("n"), "id", "th", "pos", "before", "after"))
        members = members.filter("struct(id, th) > struct(first.id, first.th)")
    spans = members.select("id", "th", (F.col("pos") - F.col("before")).alias("lo"), (F.col("pos") + F.col("after")).alias("hi"))

    # different contexts of one k-gram
    rows = scratch.keep(rows, "suffix-rows") if first_stays else rows
    crowd = scratch.keep(rows.groupBy("gram").agg(F.count("*").alias("contexts")).filter("contexts > 1"), "suffix-grams")
    contested = rows.join(crowd.hint(JOIN), "gram").select("gram", "contexts", "n", "id", "th", "pos", "before", "after")
    start, size = F.col("pos") - F.col("before") + 1, F.col("before") + F.col("after")
    data = F.substring(F.col("text").cast("binary"), start, size).alias("data")
    texts = docs.filter(F.octet_length("text") >= length)
    contexts = scratch.keep(contested.join(texts.hint(JOIN), ["id", "th"]).select(*contested.columns, data), "suffix-contexts")
    few = contexts.filter(F.col("contexts") <= group).repartition("gram").sortWithinPartitions("gram")
    settled = few.mapInArrow(tidy(_settle_kernel(length, fan, first_stays)), "id long, th int, lo int, hi int")
    many = contexts.filter(F.col("contexts") > group).dropDuplicates(["gram", "id", "th", "pos"])
    crowded = [settle_crowded(many, length, fan, first_stays, scratch)] if not many.isEmpty() else []
    return union_all([spans, settled, *crowded])


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _report_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        spans = batch.column("spans").to_pylist()
        removed, runs, digests = [], [], []
        for k in range(batch.num_rows):
            raw = data[offsets[k] : offsets[k + 1]].tobytes()
            cut = merged_spans([(s["lo"], s["hi"]) for s in spans[k] or ()])
            digest, at = hashlib.sha256(), 0
            for lo, hi in cut:
                digest.update(raw[at:lo])
                at = hi
            digest.update(raw[at:])
            removed.append(sum(hi - lo for lo, hi in cut))
            runs.append(len(cut))
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(offsets)),
                pa.array(removed, pa.int64()),
                pa.array(runs, pa.int64()),
                pa.array(digests, pa.string()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _cut_kernel(span_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts without their spans; a character that is only partly inside a span stays, a row of
        which only blanks are left goes."""
        for batch in batches:
            texts, spans = batch.column("text").to_pylist(), batch.column(span_column).to_pylist()
            left = np.ones(batch.num_rows, bool)
            for k, held in enumerate(spans):
                if held:
                    raw = texts[k].encode()
                    inside = np.zeros(len(raw) + 1, bool)
                    for lo, hi in merged_spans([(s["lo"], s["hi"]) for s in held]):
                        while lo < hi and raw[lo] & 0xC0 == 0x80:
                            lo += 1
                        while hi > lo and hi < len(raw) and raw[hi] & 0xC0 == 0x80:
                            hi -= 1
                        inside[lo:hi] = True
                    texts[k] = np.frombuffer(raw, np.uint8)[~inside[:-1]].tobytes().decode()
                    left[k] = bool(texts[k].strip())
            at = batch.schema.get_field_index("text")
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field("text").type)
            kept = [c for c, name in zip(columns, batch.schema.names, strict=True) if name != span_column]
            names = [name for name in batch.schema.names if name != span_column]
            yield pa.RecordBatch.from_arrays(kept, names).filter(pa.array(left))

    return run


def with_spans(
    docs: DataFrame, length: int = LENGTH, fan: int = FAN, batches: int = BATCHES, first_stays: bool = False, group: int = GROUP
) -> DataFrame:
    """``docs`` with one more column, the last one: the byte ranges in repeated passages (null for none).

    It is called spans, or a name like it that no column of ``docs`` has. With ``first_stays`` a passage stays in
    the document with the smallest id that holds it, of rows that share this id in the one with the
    smallest hash of the text.
    """
    i, t, s = unused(docs.columns, "_id", "_th", "spans")
    unnamed = F.xxhash64("text").bitwiseOR(F.lit(-(1 << 63)))
    keyed = docs.select("*", F.coalesce(F.col("doc_id").cast("long"), unnamed).alias(i), text_key().alias(t))
    plain = keyed.select(F.col(i).alias("id"), F.col(t).alias("th"), "text")
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    spans = repeated_spans(plain, length, fan, batches, first_stays, group, scratch)
    spans = spans.distinct().groupBy(F.col("id").alias(i), F.col("th").alias(t))
    spans = keep(spans.agg(F.collect_list(F.struct("lo", "hi")).alias(s)), "suffix-spans")
    scratch.clear()
    return keyed.join(spans.hint(JOIN), [i, t], "left").select(*docs.columns, s)


def report(marked: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of documents with spans in their last column."""
    rows = marked.select("doc_id", "text", F.col(marked.columns[-1]).alias("spans"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        tidy(_report_kernel), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def cut(marked: DataFrame) -> DataFrame:
    """The documents, their other columns as they are, without what the spans in the last column cover."""
    last = marked.columns[-1]
    return marked.mapInArrow(tidy(_cut_kernel(last)), marked.drop(last).schema)
