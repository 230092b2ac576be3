import zlib
from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from assay.llm import sharding


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 1)])
def test_neighbours_on_the_curve_are_neighbours_in_space(spark, dims, bits):
    names = [f"c{i}" for i in range(dims)]
    cells = spark.createDataFrame(list(product(range(1 << bits), repeat=dims)), ", ".join(f"{n} int" for n in names))
    rows = sharding.with_curve(cells, [F.col(n) for n in names], bits).orderBy("hilbert").collect()
    assert [r.hilbert for r in rows] == list(range(1 << (bits * dims)))
    for a, b in zip(rows, rows[1:], strict=False):
        assert sum(abs(a[n] - b[n]) for n in names) == 1


def test_size_axis_is_monotonic(spark):
    rows = spark.range(1, 3_000).select(sharding.size_axis(F.col("id")).alias("a")).collect()
    assert [r.a for r in rows] == sorted(r.a for r in rows)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_rows_law(odd_docs, odd_texts, shards):
    rows = sharding.shard_by_curve(sharding.described(odd_docs), shards).collect()
    assert len(rows) == len(odd_texts)
    held = defaultdict(list)
    for r in rows:
        held[r.shard].append(r)
    counts = [len(held[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    before = -1
    for s in range(shards):
        inside = sorted(held[s], key=lambda r: r.slot)
        assert [r.slot for r in inside] == list(range(len(inside)))
        for r in inside:
            assert r.hilbert >= before
            before = r.hilbert
    texts = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in odd_texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == texts


def test_a_hot_cell_and_an_empty_table(spark, no_docs):
    docs = spark.range(5_000).selectExpr("id AS doc_id", "'same' AS text", "'en' AS lang", "'src0' AS source")
    rows = sharding.shard_by_curve(sharding.described(docs), 3).groupBy("shard").agg(F.count("*"), F.count_distinct("slot"), F.max("slot")).collect()
    assert sorted(tuple(r)[1:] for r in rows) == [(1666, 1666, 1665), (1667, 1667, 1666), (1667, 1667, 1666)]
    assert sharding.shard_by_curve(sharding.described(no_docs), 3).collect() == []


def test_manifest_lets_most_shards_be_skipped(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = sharding.manifest(sharding.shard_by_curve(sharding.described(docs), 40)).collect()
    assert sum(r.rows for r in held) == 1_000
    assert sum(r.min_size > 5_000 or r.max_size < 4_000 for r in held) >= 8
