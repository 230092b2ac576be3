from itertools import combinations

import numpy as np
import pytest

from assay.llm import packing


def padding(lengths, counts, totals, ends):
    total = 0
    for length, n, tokens in zip(lengths, counts, totals, strict=True):
        total += min(e for e in ends if e >= length) * n - tokens
    return total


@pytest.mark.parametrize("buckets", [1, 2, 3, 5, 9])
def test_boundaries_have_the_least_padding(buckets):
    source = np.random.default_rng(buckets)
    lengths = np.unique(source.integers(0, 60, 9))
    counts = source.integers(1, 50, len(lengths))
    totals = lengths * counts
    ends = packing.boundaries(lengths, counts, totals, buckets)
    every = [c for k in range(buckets) for c in combinations(lengths[:-1].tolist(), k)]
    best = min(padding(lengths, counts, totals, [*c, int(lengths[-1])]) for c in every)
    assert padding(lengths, counts, totals, ends) == best
    assert len(ends) <= buckets and ends[-1] == lengths[-1]


def test_batches_stay_in_budget_and_are_full(docs_of):
    docs = docs_of([(i, "w " * (i % 37)) for i in range(400)])
    rows = packing.pack(packing.word_lengths(docs), buckets=4, token_budget=100).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in rows) == [(i, i % 37) for i in range(400)]
    batches = {}
    for r in rows:
        assert r.n_tokens <= r.padded_length
        batches.setdefault((r.bucket, r.padded_length, r.batch), []).append(r.slot)
    last = {}
    for (bucket, length, batch), slots in batches.items():
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) * length <= 100
        last[bucket] = max(last.get(bucket, 0), batch)
    for (bucket, length, batch), slots in batches.items():
        if batch < last[bucket]:
            assert (len(slots) + 1) * max(length, 1) > 100


def test_boundaries_of_many_lengths_are_those_of_trying_every_cut():
    source = np.random.default_rng(4)
    lengths = np.unique(source.integers(0, 5_000, 700))
    counts = source.integers(1, 50, len(lengths)) ** 3
    totals = lengths * counts
    c, t = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, totals))
    best = np.concatenate([[0], lengths * c[1:] - t[1:]])
    for _ in range(5):
        best = np.array([0] + [min(best[j] + lengths[i - 1] * (c[i] - c[j]) - (t[i] - t[j]) for j in range(i)) for i in range(1, len(best))])
    ends = packing.boundaries(lengths, counts, totals, 6)
    assert padding(lengths, counts, totals, ends) == best[-1]


def test_a_padded_length_is_the_longest_in_its_bucket(docs_of):
    docs = docs_of([(i, "w " * n) for i, n in enumerate((3, 1_025, 1_027, 5_001, 5_003, 9_999))])
    rows = packing.pack(packing.word_lengths(docs), buckets=3).collect()
    for bucket in {r.bucket for r in rows}:
        held = [r for r in rows if r.bucket == bucket]
        assert {r.padded_length for r in held} == {max(r.n_tokens for r in held)}


def test_odd_and_empty_input(odd_docs, odd_texts, no_docs):
    rows = packing.pack(packing.word_lengths(odd_docs), token_budget=64).collect()
    assert len(rows) == len(odd_texts)
    assert [r.n_tokens for r in rows if r.doc_id == 1] == [0]
    assert all(r.oversize and r.slot == 0 for r in rows if r.doc_id in (9, 10))
    assert packing.pack(packing.word_lengths(no_docs)).collect() == []
