"""Periodic runs against comparing words at every distance."""

import random
import re

import brute
import numpy as np
import pytest

from assay.llm import queries, runs

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def made(source, n):
    """Words with few letters, planted repetitions, or the start of the Fibonacci word."""
    if source.random() < 0.1:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    w = [source.randrange(source.choice([1, 2, 3, 40])) for _ in range(n)]
    for _ in range(source.randrange(3)):
        p, a, length = source.randrange(1, max(2, n // 3)), source.randrange(n + 1), source.randrange(n + 1)
        for i in range(a, min(n, a + length)):
            w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize("least", [2, 5, 12, 20])
def test_against_every_distance(least):
    source = random.Random(least)
    for trial in range(150):
        docs = [made(source, source.randrange(300 if trial % 30 == 0 else 70)) for _ in range(source.randrange(1, 5))]
        bounds = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(np.int64)
        codes = np.array([x for d in docs for x in d], np.int64)
        want = [(s + int(lo), n, q) for d, lo in zip(docs, bounds, strict=False) for s, n, q in brute.runs_of(d, least)]
        assert [tuple(r) for r in runs.find_runs(codes, bounds, least).tolist()] == want


def test_one_repeated_word_takes_few_steps(monkeypatch):
    calls = []
    plain = runs.WaveletTree.successor
    monkeypatch.setattr(runs.WaveletTree, "successor", lambda self, *a: calls.append(1) or plain(self, *a))
    n = 100_000
    assert runs.find_runs(np.zeros(n, np.int64), np.array([0, n])).tolist() == [[0, n, 1]]
    w = np.array([0] * 20_000 + [1] + [0] * 20_000 + [1] + [0] * 20_000, np.int64)
    found = runs.find_runs(w, np.array([0, len(w)]))
    assert [0, len(w), 20_001] in found.tolist()
    assert len(calls) < 60


def test_wavelet_tree_successor():
    source = np.random.default_rng(1)
    values = source.permutation(97)
    tree = runs.WaveletTree(values, 97)
    lo, hi, x = source.integers(0, 97, 500), source.integers(0, 98, 500), source.integers(0, 99, 500)
    hi = np.maximum(lo, hi)
    want = [min([v for v in values[a:b] if v >= y], default=97) for a, b, y in zip(lo, hi, x, strict=True)]
    assert tree.successor(lo, hi, x).tolist() == want


def test_odd_documents(odd_docs, odd_texts):
    got = sorted((tuple(map(str, (r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed))) for r in runs.periodic_runs(odd_docs).collect()))
    want = []
    for i, text in odd_texts:
        words = [w for w in BLANKS.split(text or "") if w]
        found = brute.runs_of(words) if len(words) < 20_000 else []
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        want.append(tuple(map(str, (i, len(words), found, " ".join(w for k, w in enumerate(words) if k not in gone)))))
    assert got == sorted(want)


def test_no_documents(no_docs):
    assert runs.periodic_runs(no_docs).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for i, text in docs:
        want.append(brute.run_digests(i, brute.repeated_from(i, [w for w in BLANKS.split(text or "") if w])))
    got = queries.QUERIES["op13_runs"](spark, sf).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(r[1] for r in want) > 10


def test_planting_takes_odd_documents(odd_docs, odd_texts):
    got = queries.planted(odd_docs).collect()
    for (i, text), r in zip(sorted(odd_texts, key=str), sorted(map(tuple, got), key=str), strict=True):
        words = [w for w in BLANKS.split(text or "") if w]
        assert [w for w in BLANKS.split(r[1] or "") if w] == brute.repeated_from(i, words)
