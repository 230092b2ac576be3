"""Near-duplicate documents by an LSH forest over MinHash signatures, confirmed on full sets.

Every text gives the set of its hashed word shingles. Texts with equal sets become one class. Each
class has a MinHash signature cut into several orders (trees) of ``DEPTH`` values. Classes that share
a prefix of an order are a region of that tree. Candidates come in two steps:

1. Linear: the members of a region of ``LEAST_DEPTH`` values are sorted by their values in the order, and
   each is compared with the one before it, with which it shares the longest common prefix. A region of more
   than ``CROWD`` members is not sorted as it is but split by one more value, and again down to ``DEPTH``:
   the depth adapts to how crowded a region is. There, members are also compared with the region's first.
   The orders are taken a few at a time (``ROUNDS``). Each round looks only at regions that hold several
   of the components found so far and makes only neighbours that are in different ones, so a group of
   copies costs about its size, not its size per tree.
2. Complete: a region may still hold several components. In one of up to ``CROWD`` members, up to
   ``OUTLIERS`` outside its largest component are compared with every member of another. The members of
   all others go through an exact join instead: their shingles are ordered from rare to frequent, two sets
   that are similar enough must share one of the first (100 - percent) % of either, and where they first
   meet bounds how much they can share. Nothing is capped or left out.

Each candidate is confirmed on whole texts: rows of one first member are cut into chunks of about
``CHUNK`` partners, the first member's text goes with every chunk, and tasks read them as a stream.
Components are contracted as edge lists; no pair, component or signature reaches the driver.

A pair with Jaccard similarity s shares no region with probability (1 - s**3)**20: 6e-7 at 0.80,
5e-9 at 0.85.

Edge cases: a text without words has no shingles and links with nothing; fewer words than a shingle
count as one; a row without an id links with nothing and has a null component; repeated rows are in
one class, compared once, and are all ``kept`` if their id is the smallest; texts that share an id are
linked each by itself; an empty table gives no rows. Inside, a class goes by 64 bits of its digest.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import Scratch, keep, small_side, union_all
from assay.llm.kernels import WordHashes, row_chunks, shingle_hashes, text_bytes, tidy
from assay.operators.components import connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
TREES = 20
DEPTH = 8
LEAST_DEPTH = 3
CROWD = 64
# Orders taken together, from and up to.
ROUNDS = ((0, 2), (2, TREES))
OUTLIERS = 4
CHUNK = 100
# Shingles permuted at a time: bounds the memory for very long texts.
BLOCK = 1024


def shingle_set(text: bytes, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a lower-cased (A-Z) text."""
    return np.unique(shingle_hashes(hashes.of(text.lower().split()), size))


def multipliers() -> np.ndarray:
    return np.random.default_rng(20240131).integers(1, 1 << 32, TREES * DEPTH, dtype=np.uint32) | np.uint32(1)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Smallest product of any shingle with every factor, modulo 2 ** 32."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    held = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(short), BLOCK):
        np.minimum(held, (short[lo : lo + BLOCK, None] * factors[None, :]).min(axis=0), out=held)
    return held


def _sign_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, factors = WordHashes(), multipliers()
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        sizes, digests, signatures = [], [], []
        for lo, hi in row_chunks(offsets):
            raw = data[offsets[lo] : offsets[hi]].tobytes()
            for k in range(lo, hi):
                own = shingle_set(raw[offsets[k] - offsets[lo] : offsets[k + 1] - offsets[lo]], hashes)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                signatures.append(signature(own, factors).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("th"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(signatures, pa.binary()),
            ],
            ["doc_id", "th", "n_shingles", "digest", "signature"],
        )


def signatures(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(_sign_kernel), f"doc_id {kind}, th long, n_shingles long, digest binary, signature binary")


def region(depth: int, tree: Column | str = "tree") -> Column:
    """64 bits that name the prefix of ``depth`` values in the order ``tree``."""
    at = F.col(tree) if isinstance(tree, str) else tree
    return F.xxhash64(at, F.substring(F.col("signature"), at * (4 * DEPTH) + 1, F.lit(4 * depth)))


def _confirm_kernel(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (head, chunk), the head's own text first in each chunk."""
        hashes = WordHashes()
        key, head_set = None, np.zeros(0, np.uint64)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            heads, chunks, nodes = (batch.column(c).to_pylist() for c in ("head", "chunk", "node"))
            a, b = [], []
            for k in range(batch.num_rows):
                own = shingle_set(data[offsets[k] : offsets[k + 1]].tobytes(), hashes)
                if nodes[k] == heads[k]:
                    key, head_set = (heads[k], chunks[k]), own
                elif key == (heads[k], chunks[k]):
                    small, large = sorted((len(own), len(head_set)))
                    if 100 * small >= percent * large:
                        both = len(np.intersect1d(own, head_set, assume_unique=True))
                        if 100 * both >= percent * (small + large - both):
                            a.append(heads[k])
                            b.append(nodes[k])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def confirm(texts: DataFrame, pairs: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b) of the pairs (head, node) whose whole ``texts`` (id, text) are similar enough."""
    crowded = scratch.keep(pairs.groupBy("head").agg(F.count("*").alias("n")).filter(F.col("n") > CHUNK), "crowded")
    parts = F.ceil(F.coalesce("n", F.lit(1)) / CHUNK)
    cut = pairs.join(crowded, "head", "left").select(
        "head", F.pmod(F.xxhash64("node"), parts).cast("long").alias("chunk"), "node"
    )
    wanted = scratch.keep(cut.unionByName(cut.select("head", "chunk", F.col("head").alias("node")).distinct()), "wanted")
    own = texts.withColumnRenamed("id", "node")
    rows = own.join(small_side(wanted), "node").select("head", "chunk", "node", "text")
    spread = rows.repartition("head", "chunk").sortWithinPartitions("head", "chunk", F.col("node") != F.col("head"))
    return spread.mapInArrow(tidy(_confirm_kernel(percent)), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets; component_id
    is the smallest id reachable over links, kept says whether it is the document's own.
    """
    return near_duplicate_rows(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def near_duplicate_rows(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``near_duplicates`` with ``th``, the xxhash64 of the row's text, and ``first``.

    first says whether (doc_id, th) is the smallest of its component; it is true for rows that link with nothing.
    """
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    signed = scratch.keep(signatures(docs), "signed")
    nodes = signed.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    # equal sets have equal signatures
    grouped = nodes.groupBy("digest").agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.max("signature").alias("signature"))
    grouped = grouped.select(F.xxhash64("digest").alias("id"), "digest", "rep", "signature")
    classes = scratch.keep(grouped, "classes")
    copies = nodes.groupBy("doc_id", "th").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", "th")
    copies = scratch.keep(copies, "copies")
    labels, done, members, ids, texts = None, [], [], [], []
    for low, high in ROUNDS:
        own = mixed_regions(prefixes(placed(classes, labels, scratch), low, high), scratch)
        members.append(own.select("region", "id"))
        here = own.select("id").distinct()
        ids.append(scratch.keep(here.join(union_all(ids), "id", "left_anti") if ids else here, "ids"))
        texts.append(class_texts(docs, copies, classes.join(small_side(ids[-1]), "id"), scratch))
        pairs = forest_neighbours(own, scratch).distinct()
        done.append(scratch.keep(uncompared(pairs, done), "pairs"))
        if labels is not None and done[-1].isEmpty():
            continue
        edges = scratch.keep(confirm(union_all(texts), done[-1], percent, scratch), "edges")
        labels = scratch.keep(merged(edges, labels), "labels")

    every = union_all(texts)
    rest = scratch.keep(across(union_all(members), labels, every, percent, scratch), "across")
    further = scratch.keep(uncompared(rest, done), "further")
    if not further.isEmpty():
        more = scratch.keep(confirm(every, further, percent, scratch), "more-edges")
        labels = scratch.keep(merged(more, labels), "labels")
    labelled = scratch.keep(classes.select("id", "digest", "rep").join(labels, "id", "left"), "labelled-classes")
    least = labelled.filter("component IS NOT NULL").groupBy("component").agg(F.min("rep").alias("least"))
    named = labelled.join(least, "component", "left").select("digest", F.coalesce("least", "rep").alias("least"))
    own = signed.select("doc_id", "th", "n_shingles", "digest").join(scratch.keep(named, "named"), "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least.doc_id", "doc_id"))
    alone = F.col("doc_id").isNull() | F.col("least").isNull()
    found = keep(
        own.select(
            "doc_id", "th", "n_shingles", component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
            (alone | (F.struct("doc_id", "th") == F.col("least"))).alias("first"),
        ),
        "near-duplicates-found",
    )
    scratch.clear()
    return found


def class_texts(docs: DataFrame, copies: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, text), one row for each of ``classes`` (id, rep); ``copies`` (doc_id, th) are rows given several times."""
    ids = scratch.keep(classes.select("id", "rep.doc_id", "rep.th"), "chosen")
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    texts = scratch.keep(rows.join(small_side(ids), ["doc_id", "th"]).select("id", "text"), "texts")
    repeated = scratch.keep(ids.join(copies, ["doc_id", "th"]).select("id"), "repeated")
    if repeated.isEmpty():
        return texts
    once = texts.join(repeated, "id", "left_semi").dropDuplicates(["id"])
    return scratch.keep(texts.join(repeated, "id", "left_anti").unionByName(once), "texts")


def merged(edges: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(id, component) by ``edges`` (a, b) and earlier ``labels``, whose components are stars of edges."""
    if labels is None:
        return connected_components(edges, "a", "b")
    stars = labels.select(F.col("component").alias("a"), F.col("id").alias("b")).filter("a <> b")
    return labels if edges.isEmpty() else connected_components(edges.unionByName(stars), "a", "b")


def uncompared(pairs: DataFrame, done: list[DataFrame]) -> DataFrame:
    """``pairs`` (head, node) that were not compared before, either way round."""
    if not done:
        return pairs
    ends = [F.least("head", "node").alias("low"), F.greatest("head", "node").alias("high")]
    before = union_all(done).select(*ends)
    return pairs.select("head", "node", *ends).join(before, ["low", "high"], "left_anti").select("head", "node")


def placed(classes: DataFrame, labels: DataFrame | None, scratch: Scratch) -> DataFrame:
    """(id, component, signature) of every class; one that is linked with nothing is a component of its own."""
    own = classes.select("id", "signature")
    if labels is None:
        return own.withColumn("component", F.col("id"))
    return scratch.keep(own.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")), "placed")


def prefixes(signed: DataFrame, low: int, high: int) -> DataFrame:
    """(region, tree, id, component, rest): every class in the orders ``low`` up to ``high``.

    region names its first ``LEAST_DEPTH`` values there, rest are the others.
    """
    flat = signed.select("id", "component", F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias("tree"), "signature")
    start = F.col("tree") * (4 * DEPTH) + (1 + 4 * LEAST_DEPTH)
    rest = F.substring("signature", start, F.lit(4 * (DEPTH - LEAST_DEPTH)))
    return flat.select(region(LEAST_DEPTH).alias("region"), "tree", "id", "component", rest.alias("rest"))


def deeper(members: DataFrame) -> DataFrame:
    """Members of regions in the regions of one more value."""
    return members.select(
        F.xxhash64("region", F.substring("rest", 1, 4)).alias("region"), "tree", "id", "component",
        F.expr("substring(rest, 5)").alias("rest"),
    )


def mixed_regions(flat: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``flat`` whose region holds several components, with n, the number of its members."""
    ends = [F.min("component").alias("least"), F.max("component").alias("last"), F.count("*").alias("n")]
    shared = scratch.keep(flat.groupBy("region").agg(*ends).filter("least <> last").select("region", "n"), "shared")
    return scratch.keep(flat.join(small_side(shared), "region"), "regions")


def forest_neighbours(members: DataFrame, scratch: Scratch) -> DataFrame:
    """(head, node): in every order, members of different components that share the longest common prefix.

    ``members`` are those of mixed regions of ``LEAST_DEPTH`` values. Only regions of at most ``CROWD`` members are
    put together, to be sorted in a task; in a crowded one, members also meet the first of its largest component.
    """
    found = []
    for depth in range(LEAST_DEPTH, DEPTH + 1):
        few = members.filter(F.col("n") <= CROWD)
        ordered = few.groupBy("tree", "region").agg(
            F.array_sort(F.collect_list(F.struct("rest", "id", "component"))).alias("m")
        )
        beside = F.zip_with(
            F.slice("m", F.lit(1), F.size("m") - 1),
            F.slice("m", F.lit(2), F.size("m") - 1),
            lambda x, y: F.struct(
                F.least(x["id"], y["id"]).alias("head"),
                F.greatest(x["id"], y["id"]).alias("node"),
                (x["component"] != y["component"]).alias("apart"),
            ),
        )
        found.append(ordered.select(F.inline(F.filter(beside, lambda pair: pair["apart"]))).select("head", "node"))
        crowd = members.filter(F.col("n") > CROWD)
        if crowd.isEmpty():
            break
        if depth in (LEAST_DEPTH, DEPTH):
            heads = scratch.keep(mixed_groups(crowd, "region").select("region", "main", "head"), "heads")
            met = crowd.withColumnRenamed("region", "at").join(
                small_side(heads), F.expr("at = region AND component <> main")
            )
            found.append(met.select("head", F.col("id").alias("node")))
        if depth < DEPTH:
            members = mixed_regions(deeper(crowd), scratch)
    return union_all(found)


def across(members: DataFrame, labels: DataFrame, texts: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(head, node), head < node: pairs to compare that share a region but not yet a component."""
    labelled = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = scratch.keep(labelled.select("region", "id", "component").distinct(), "labelled")
    mixed = scratch.keep(mixed_groups(labelled, "region"), "mixed")
    held = scratch.keep(labelled.join(mixed, "region"), "held")
    small = (F.col("outliers") <= OUTLIERS) & (F.col("all") <= CROWD)
    few = outlier_pairs(held.filter(small), "region")
    crowd = scratch.keep(held.filter(~small).select("id", "component").distinct(), "crowd")
    found = [few] if crowd.isEmpty() else [few, rare_pairs(crowd, texts, percent, scratch)]
    return union_all(found).distinct()


def mixed_groups(rows: DataFrame, key: str) -> DataFrame:
    """Groups of (key, id, component) with several components: their size, the largest one, its first, how many are outside."""
    counts = rows.groupBy(key, "component").agg(F.count("*").alias("n"), F.min("id").alias("head"))
    top = F.max(F.struct("n", "component", "head")).alias("top")
    groups = counts.groupBy(key).agg(F.count("*").alias("parts"), F.sum("n").alias("all"), top).filter("parts > 1")
    outside = (F.col("all") - F.col("top.n")).alias("outliers")
    return groups.select(key, "all", F.col("top.component").alias("main"), F.col("top.head").alias("head"), outside)


def outlier_pairs(held: DataFrame, key: str, extra: tuple[str, ...] = (), condition: str = "true") -> DataFrame:
    """Members outside the main component of their group with all members of another component."""
    x = held.filter("component <> main").select(key, *[F.col(c).alias(f"{c}_x") for c in ("id", "component", *extra)])
    y = held.select(key, "main", *[F.col(c).alias(f"{c}_y") for c in ("id", "component", *extra)])
    once = "component_x <> component_y AND (component_y = main OR id_x < id_y)"
    both = x.join(y, [x[key] == y[key], F.expr(once), F.expr(condition)])
    return both.select(F.least("id_x", "id_y").alias("head"), F.greatest("id_x", "id_y").alias("node"))


def _shingle_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for lo, hi in row_chunks(offsets):
            sets = [shingle_set(data[offsets[k] : offsets[k + 1]].tobytes(), hashes) for k in range(lo, hi)]
            sizes = [len(own) for own in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(c)[lo:hi].to_numpy(), sizes), pa.int64())
                    for c in ("id", "component")
                ]
                + [pa.array(np.repeat(sizes, sizes), pa.int64()), pa.array(np.concatenate(sets).view(np.int64))],
                ["id", "component", "size", "shingle"],
            )


def rare_pairs(crowd: DataFrame, texts: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of (id, component) that share a rare enough shingle; misses no pair that is similar enough.

    With shingles ordered from rare to frequent, sets of n and m shingles that share at least
    a = ceil(percent * (n + m) / (100 + percent)) meet first at positions i and j (from 0) with
    i <= n - a, j <= m - a.
    """
    rows = texts.join(crowd, "id").select("id", "component", "text")
    rows = scratch.keep(rows.mapInArrow(tidy(_shingle_kernel), "id long, component long, size long, shingle long"), "shingles")
    counts = scratch.keep(rows.groupBy("shingle").agg(F.count("*").alias("df")), "rarity")
    ordered = rows.join(counts.filter("df > 1"), "shingle", "left").groupBy("id", "component", "size").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "shingle"))).alias("s")
    )
    longest = F.expr(f"size - (size * {percent} + 99) div 100 + 1").cast("int")
    head = ordered.select("id", "component", "size", F.posexplode(F.slice("s", F.lit(1), longest)).alias("at", "s"))
    head = head.filter("s.df > 1").select("id", "component", "size", "at", F.col("s.shingle").alias("shingle"))
    head = scratch.keep(head, "rare")
    mixed = scratch.keep(mixed_groups(head, "shingle"), "rare-mixed")
    needed = f"(({percent} * (size_x + size_y) + {99 + percent}) div {100 + percent})"
    fits = f"least(size_x - at_x, size_y - at_y) >= {needed}"
    return outlier_pairs(scratch.keep(head.join(mixed, "shingle"), "rare-held"), "shingle", ("size", "at"), fits)
