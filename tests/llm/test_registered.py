"""Every dealt query on the smallest tables, against SQL or brute force."""

import math

import brute
import duckdb
import pytest

import __spark_entry__ as entry
from assay.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return None if value is None else str(value)


@pytest.fixture(scope="module")
def checker():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_all_thirteen_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in names}
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, checker, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    result = checker.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert columns == sorted(names)
    at = [names.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=str)


def test_suffix_dedup_against_brute_force(spark, checker):
    docs = checker.execute("SELECT doc_id, text FROM documents").fetchall()
    want = sorted(brute.removal(*row) for row in brute.covered(docs, 400))
    got = QUERIES["op4_suffix_dedup"](spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(tuple(r) for r in got.collect()) == want
    assert sum(r[2] for r in want)


def test_quality_counts_against_brute_force(spark, checker):
    docs = checker.execute("SELECT doc_id, text FROM documents").fetchall()
    want = {}
    for i, text in docs:
        counts = brute.text_statistics(text)
        want[i] = (*counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
    for r in QUERIES["op5_quality"](spark, SF).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == want[r.doc_id]
        assert not (r.kept and r.base_failed)
