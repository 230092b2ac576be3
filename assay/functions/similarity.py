"""Jaro-Winkler similarity and a cheap native upper bound for it.

Spark has no Jaro-Winkler, so the exact value comes from an Arrow UDF. The bound is built from
plain columns and lets the join drop most pairs before they reach Python.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The UDF travels to the executors whole, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the Jaro-Winkler definition.
PREFIX_SCALE = 0.1
PREFIX_MAX = 4
BOOST_ABOVE = 0.7


# Words in the table of character positions: 32 MB.
POSITION_WORDS = 1 << 22


def _matrix(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as a zero-padded matrix of code points, and their lengths."""
    lengths = np.fromiter((len(v) for v in values), dtype=np.int64, count=len(values))
    width = max(int(lengths.max(initial=0)), 1)
    return np.array(values, dtype=f"<U{width}").view(np.uint32).reshape(len(values), width), lengths


def _lowest_bit(words: np.ndarray) -> np.ndarray:
    """The lowest set bit of each row of 64-bit words, alone; all zero where none is set."""
    out = np.zeros_like(words)
    todo = np.ones(words.shape[0], dtype=bool)
    for k in range(words.shape[1]):
        w = np.where(todo, words[:, k], np.uint64(0))
        out[:, k] = w & (~w + np.uint64(1))
        todo &= w == 0
    return out


def _positions(words: np.ndarray, width: int) -> np.ndarray:
    """Bit sets as a boolean matrix, one column per position."""
    as_bytes = words.astype("<u8").view(np.uint8).reshape(words.shape[0], -1)
    return np.unpackbits(as_bytes, axis=1, count=width, bitorder="little").view(bool)


def jaro_winkler_pairs(left: list[str], right: list[str], li: np.ndarray, ri: np.ndarray) -> np.ndarray:
    """Similarity of ``left[li[k]]`` and ``right[ri[k]]`` for all k; an empty side scores 0.

    For every text of ``right`` the positions of each character are kept as a bit set. All pairs
    then take one step per character of the left text: look up, mask the window, take the first
    free position.
    """
    if not len(li):
        return np.zeros(0)
    a, la_all = _matrix(left)
    b, lb_all = _matrix(right)
    alphabet, codes = np.unique(np.concatenate([a.ravel(), b.ravel()]), return_inverse=True)
    a_code, b_code = codes[: a.size].reshape(a.shape), codes[a.size :].reshape(b.shape)
    words = (b.shape[1] + 63) // 64
    where = np.zeros((len(right), len(alphabet), words), dtype=np.uint64)
    for j in range(b.shape[1]):
        rows = np.nonzero(j < lb_all)[0]
        where[rows, b_code[rows, j], j // 64] |= np.uint64(1) << np.uint64(j % 64)

    la, lb = la_all[li], lb_all[ri]
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    # position sets [0, n) for every n, to cut windows out of
    below = np.zeros((b.shape[1] + 1, words), dtype=np.uint64)
    for n in range(1, b.shape[1] + 1):
        below[n] = below[n - 1]
        below[n, (n - 1) // 64] |= np.uint64(1) << np.uint64((n - 1) % 64)
    free = np.full((len(li), words), ~np.uint64(0), dtype=np.uint64)
    used_a = np.zeros((len(li), a.shape[1]), dtype=bool)
    for i in range(a.shape[1]):
        window = below[np.minimum(i + reach + 1, b.shape[1])] & ~below[np.clip(i - reach, 0, b.shape[1])]
        spots = where[ri, a_code[li, i]] & window & free
        spots[i >= la] = 0
        first = _lowest_bit(spots)
        free &= ~first
        used_a[:, i] = first.any(axis=1)
    m = used_a.sum(axis=1)
    # matched characters of both sides in order: equal counts per row, so they line up flat
    used_b = _positions(~free, b.shape[1])
    rows, cols = np.nonzero(used_a)
    rows_b, cols_b = np.nonzero(used_b)
    differs = a[li[rows], cols] != b[ri[rows_b], cols_b]
    swaps = np.bincount(rows, weights=differs, minlength=len(li)).astype(np.int64) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - swaps) / m) / 3.0, 0.0)
    heads = min(PREFIX_MAX, a.shape[1], b.shape[1])
    same = (a[li, :heads] == b[ri, :heads]) & (a[li, :heads] != 0)
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > BOOST_ABOVE, jaro + PREFIX_SCALE * prefix * (1.0 - jaro), jaro)


def jaro_winkler_batch(left: list[str], right: list[str]) -> np.ndarray:
    at = np.arange(len(left))
    return jaro_winkler_pairs(left, right, at, at)


def _similarity(a: pa.Array, b: pa.Array) -> pa.Array:
    """Each distinct pair of a batch is scored once; long texts are scored apart from short ones."""
    x, y = a.fill_null("").dictionary_encode(), b.fill_null("").dictionary_encode()
    return pa.array(similar_pairs(x.dictionary, y.dictionary, x.indices.to_numpy(), y.indices.to_numpy()))


def similar_pairs(xs: pa.Array, ys: pa.Array, li: np.ndarray, ri: np.ndarray) -> np.ndarray:
    """Similarity of ``xs[li[k]]`` and ``ys[ri[k]]`` for all k, see ``_similarity``."""
    left, right = (d.to_numpy(zero_copy_only=False) for d in (xs, ys))
    pair, back = np.unique(li.astype(np.int64) * max(len(right), 1) + ri, return_inverse=True)
    li, ri = pair // max(len(right), 1), pair % max(len(right), 1)
    left_len, right_len = (pc.utf8_length(d).to_numpy() for d in (xs, ys))
    longest = np.maximum(left_len[li], right_len[ri])
    out = np.zeros(len(pair))
    kinds = len(set().union(*left, *right)) or 1
    for low, high in ((0, 32), (32, 64), (64, 256), (256, 1 << 62)):
        part = np.nonzero((longest > low) & (longest <= high))[0]
        # few pairs at a time where texts are long or use many characters, so the work arrays stay small
        words = (int(longest[part].max(initial=1)) + 63) // 64
        step = max(64, min(1 << 14 if high <= 256 else 256, POSITION_WORDS // (kinds * words)))
        for start in range(0, len(part), step):
            some = part[start : start + step]
            lu, lx = np.unique(li[some], return_inverse=True)
            ru, rx = np.unique(ri[some], return_inverse=True)
            out[some] = jaro_winkler_pairs(left[lu].tolist(), right[ru].tolist(), lx, rx)
    return out[back]


# Pairs of a grid looked at together: their work arrays stay in a core's cache.
GRID_PAIRS = 1 << 15


def _alike(a: np.ndarray, b: np.ndarray) -> int:
    """Number of leading characters that all rows of both matrices have in common."""
    n = min(a.shape[1], b.shape[1])
    same = ((a[:, :n] == a[0, :n]).all(axis=0)) & ((b[:, :n] == a[0, :n]).all(axis=0)) & (a[0, :n] != 0)
    return int(np.cumprod(same).sum())


def similarity_grid(left: list[str], right: list[str]) -> np.ndarray:
    """Similarity of every text of ``left`` (rows) with every text of ``right`` (columns), as ``jaro_winkler_pairs`` has it.

    What is looked up once per pair there is looked up once per row here. Leading characters that all texts have
    in common match each other, so only what follows them is compared, in words of as few bits as that needs.
    """
    out = np.zeros((len(left), len(right)))
    if not out.size:
        return out
    a, la = _matrix(left)
    b, lb = _matrix(right)
    skip = _alike(a, b)
    long = np.nonzero(lb - skip > 64)[0]
    if len(long):
        short = np.nonzero(lb - skip <= 64)[0]
        out[:, short] = similarity_grid(left, [right[k] for k in short])
        some, step = [right[k] for k in long], max(1, (1 << 17) // len(long))
        for lo in range(0, len(left), step):
            part = left[lo : lo + step]
            li, ri = (x.ravel() for x in np.indices((len(part), len(some))))
            found = similar_pairs(pa.array(part, pa.string()), pa.array(some, pa.string()), li, ri)
            out[lo : lo + step, long] = found.reshape(len(part), len(some))
        return out
    rest = b[:, skip:]
    alphabet, codes = np.unique(rest, return_inverse=True)
    if (len(alphabet) + 1) * len(right) > POSITION_WORDS and len(right) > 1:
        half = len(right) // 2
        return np.hstack([similarity_grid(left, right[:half]), similarity_grid(left, right[half:])])
    codes = codes.reshape(rest.shape)
    width = int(lb.max()) - skip
    word = next(t for t, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64)) if width <= bits)
    where = np.zeros((len(alphabet) + 1, len(right)), word)
    for j in range(width):
        cols = np.nonzero(skip + j < lb)[0]
        where[codes[cols, j], cols] |= word(1 << j)
    below = np.array([(1 << j) - 1 for j in range(width + 1)], np.uint64).astype(word)
    sizes, size_of = np.unique(lb, return_inverse=True)
    heads = min(PREFIX_MAX, a.shape[1], b.shape[1])
    for n in np.unique(la[la > 0]).tolist():
        rows = np.nonzero(la == n)[0]
        mine = a[rows, skip:n]
        found = np.minimum(np.searchsorted(alphabet, mine), len(alphabet) - 1)
        mine_codes = np.where(alphabet[found] == mine, found, len(alphabet))
        reach = np.maximum(np.maximum(n, lb) // 2 - 1, 0)
        spans = []
        for i in range(skip, n):
            upto = below[np.clip(np.minimum(i + reach + 1, lb) - skip, 0, width)]
            spans.append(upto & ~below[np.clip(i - reach - skip, 0, width)])
        scores = _scores(n, sizes)
        most_swaps, kinds = scores.shape[2], scores.shape[3]
        offset = size_of * (scores.shape[1] * most_swaps * kinds)
        scores = scores.ravel()
        step = max(1, GRID_PAIRS // len(right))
        for lo in range(0, len(rows), step):
            own, at = mine_codes[lo : lo + step], rows[lo : lo + step]
            matched, swaps = _matched(own, where, spans, below[np.clip(lb - skip, 0, width)], skip)
            prefix = min(skip, PREFIX_MAX)
            if skip < heads:
                same = np.ones(matched.shape, bool)
                prefix = np.zeros(matched.shape, np.int64)
                for k in range(heads):
                    same &= (a[at, k][:, None] == b[None, :, k]) & (a[at, k] != 0)[:, None]
                    prefix += same
            place = matched.astype(np.int64)
            place *= most_swaps
            place += swaps >> 1
            place *= kinds
            place += prefix
            place += offset
            out[at] = scores.take(place)
    return out


def _scores(n: int, sizes: np.ndarray) -> np.ndarray:
    """Similarity of a text of ``n`` characters and one of each of ``sizes``, by matches, swaps and common prefix."""
    m = np.arange(n + 1)[:, None, None]
    swaps = np.arange(n // 2 + 1)[:, None]
    prefix = np.arange(PREFIX_MAX + 1)
    out = []
    for size in sizes.tolist():
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(m > 0, (m / n + m / size + (m - swaps) / m) / 3.0, 0.0)
            out.append(np.where(jaro > BOOST_ABOVE, jaro + PREFIX_SCALE * prefix * (1.0 - jaro), jaro))
    return np.array(out)


def _matched(
    own: np.ndarray, where: np.ndarray, spans: list[np.ndarray], whole: np.ndarray, skip: int
) -> tuple[np.ndarray, np.ndarray]:
    """Matched characters, and how many of them differ in order, of texts ``own`` (codes) with all columns of ``where``."""
    shape = (len(own), where.shape[1])
    free = np.empty(shape, where.dtype)
    free[:] = whole
    matched = np.full(shape, skip, np.uint16)
    hits = []
    for code, span in zip(own.T, spans):
        spots = where.take(code, axis=0)
        spots &= free
        spots &= span
        spots &= -spots
        free ^= spots
        hits.append(spots != 0)
        matched += hits[-1]
    # matched characters of both sides in order: equal counts, so they line up
    used = ~free
    used &= whole
    swaps = np.zeros(shape, np.uint16)
    for code, hit in zip(own.T, hits):
        first = used & -used
        other = where.take(code, axis=0)
        other &= first
        swaps += hit & (other == 0)
        first *= hit
        used ^= first
    return matched, swaps


def jaro_winkler(a, b) -> Column:
    """Exact similarity column; null counts as empty.

    Marked non-deterministic although it is not: otherwise a filter on the result is pushed below
    the projection and every value is computed twice.
    """
    return F.arrow_udf(_similarity, DoubleType()).asNondeterministic()(a, b)


def char_columns(column: str) -> dict[str, Column]:
    """Plain columns holding what the bound needs to know about one text.

    ``sig`` has one bit for the first and one for the second occurrence of each of 32 character
    classes, ``extra`` counts further occurrences, ``inv`` is 1/length and ``head`` packs the first
    four characters, 15 bits each.
    """
    text = f"coalesce(`{column}`, '')"
    first = "shiftleft(1L, ascii(ch) & 31)"
    second = "shiftleft(1L, (ascii(ch) & 31) + 32)"
    add = f"""named_struct(
        'sig', acc.sig | CASE WHEN acc.sig & {first} = 0 THEN {first} WHEN acc.sig & {second} = 0 THEN {second} ELSE 0L END,
        'extra', acc.extra + CASE WHEN acc.sig & {first} <> 0 AND acc.sig & {second} <> 0 THEN 1 ELSE 0 END)"""
    counted = f"aggregate(split({text}, ''), named_struct('sig', 0L, 'extra', 0), (acc, ch) -> {add})"
    head = " + ".join(
        f"shiftleft(CAST(ascii(substring({text}, {n + 1}, 1)) & 32767 AS BIGINT), {15 * (PREFIX_MAX - 1 - n)})"
        for n in range(PREFIX_MAX)
    )
    return {
        f"_char_{column}": F.expr(counted),
        f"_inv_{column}": F.expr(f"CASE WHEN {text} = '' THEN 0D ELSE 1D / length({text}) END"),
        f"_head_{column}": F.expr(head),
    }


def jaro_winkler_at_most(column: str, a: str = "a", b: str = "b") -> str:
    """SQL text of an upper bound of the similarity, from the ``char_columns`` of two rows.

    Matched characters never exceed the shared multiset of characters, and the bound grows with
    their number; transpositions and the window only lower the true value. Written so that every
    part occurs once: it runs for every pair a join considers.
    """
    x, y = f"{a}.`_char_{column}`", f"{b}.`_char_{column}`"
    shared = f"(bit_count({x}.sig & {y}.sig) + least({x}.extra, {y}.extra))"
    inverse = f"({a}.`_inv_{column}` + {b}.`_inv_{column}`)"
    differ = f"({a}.`_head_{column}` ^ {b}.`_head_{column}`)"
    # what a common prefix leaves of the distance to 1
    steps = " ".join(
        f"WHEN {differ} < {1 << (15 * (PREFIX_MAX - n))}L THEN {1 - PREFIX_SCALE * n!r}D" for n in range(PREFIX_MAX, 0, -1)
    )
    return f"(1D - (CASE {steps} ELSE 1D END) * (2D - {shared} * {inverse}) / 3D)"


def least_jaro(least: float) -> tuple[float, float]:
    """Lowest Jaro similarity of texts whose Jaro-Winkler similarity is ``least`` or more.

    First for texts that differ within their first PREFIX_MAX characters, then for those that do not.
    """
    found = [(least - PREFIX_SCALE * n) / (1 - PREFIX_SCALE * n) for n in (PREFIX_MAX - 1, PREFIX_MAX)]
    return tuple(max(j, min(least, BOOST_ABOVE)) for j in found)


# Up to this many differing characters two groups of them must agree, beyond it one.
PAIRED_DEPTH = 6


def character_ranks(df: DataFrame, column: str, most: int) -> Column:
    """Map of the ``most`` most frequent characters of a column to their rank; only these reach the driver."""
    listed = df.select(F.explode(F.regexp_extract_all(F.col(column), F.lit("(?s)."), 0)).alias("c"))
    counts = listed.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c").limit(most)
    frequent = [r["c"] for r in counts.collect()]
    if not frequent:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    ranks = F.array(*[F.lit(i).cast("long") for i in range(len(frequent))])
    return F.map_from_arrays(F.array(*[F.lit(c) for c in frequent]), ranks)


def signatures(column: str, least: float, ranks: Column) -> Column:
    """Array of (depth, top, peers): what texts at ``least`` Jaro or more must have in common.

    The longer of two such texts having n characters, their characters, as multisets, differ in at most
    d = 3 * (1 - least) * n places. Characters are dealt into d + 2 groups (d + 1 from PAIRED_DEPTH on), the
    frequent ones in turn; at most d of the groups differ, so two (one) have the very same characters.
    ``peers`` has a hash for every choice of two groups (every group) of one depth d. ``top`` is
    the depth of the text as the longer one; it may also be the shorter one, so it has all depths up
    to that of the longest text it can be similar to. Two texts are to be compared at the larger
    of their tops.
    """
    text = F.coalesce(F.col(column), F.lit(""))

    def placed(c: Column) -> Column:
        return F.struct(F.coalesce(F.try_element_at(ranks, c), F.pmod(F.xxhash64(c), F.lit(1 << 40))).alias("r"), c.alias("c"))

    def hashes(chars: Column, depth: Column) -> Column:
        n = depth + F.when(depth <= PAIRED_DEPTH, 2).otherwise(1)

        def group(k: Column) -> Column:
            own = F.filter(chars, lambda t: F.pmod(t["r"], n) == k)
            return F.xxhash64(k, F.array_join(F.transform(own, lambda t: t["c"]), ""))

        def pairs(g: Column) -> Column:
            numbers = F.sequence(F.lit(0), n - 1)
            both = F.transform(
                numbers,
                lambda i: F.transform(
                    F.filter(numbers, lambda j: j > i), lambda j: F.xxhash64(i, j, F.get(g, i), F.get(g, j))
                ),
            )
            return F.when(depth <= PAIRED_DEPTH, F.flatten(both)).otherwise(g)

        return F.transform(F.array(F.transform(F.sequence(F.lit(0), n - 1), group)), pairs)[0]

    def by_depth(chars: Column) -> Column:
        differ = F.size(chars) * F.lit(3 * (1 - least))
        top, last = (F.floor(d + F.lit(1e-6)).cast("int") for d in (differ, differ / F.lit(3 * least - 2)))
        return F.transform(
            F.sequence(top, last),
            lambda d: F.struct(d.alias("depth"), top.alias("top"), hashes(chars, d).alias("peers")),
        )

    chars = F.array_sort(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), 0), placed))
    return F.transform(F.array(chars), by_depth)[0]
