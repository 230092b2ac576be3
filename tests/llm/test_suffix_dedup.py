import random

import brute
import pytest

from assay.llm import suffix_dedup
from assay.llm.common import Scratch


def corpus(seed, rows=60, passages=6):
    source = random.Random(seed)

    def letters(n, kinds="abcdefghé"):
        return "".join(source.choice(kinds) for _ in range(n))

    shared = [letters(source.randrange(30, 200)) for _ in range(passages)]
    out = []
    for i in range(1, rows + 1):
        parts = [letters(source.randrange(0, 120))]
        for _ in range(source.randrange(0, 4)):
            p = source.choice(shared)
            parts += [p[source.randrange(0, 20) : len(p) - source.randrange(0, 20)], letters(source.randrange(0, 60))]
        out.append((i, "".join(parts)))
    out += [(rows + 1, out[3][1]), (rows + 2, out[3][1] + "tail"), (rows + 3, "ab" * 90), (rows + 4, "z" * 130), (rows + 5, "")]
    return out


@pytest.mark.parametrize(("seed", "batches", "group"), [(1, 1, 200), (2, 4, 200), (3, 3, 1), (4, 2, 5)])
@pytest.mark.parametrize("first_stays", [False, True])
def test_spans_against_brute_force(docs_of, seed, batches, group, first_stays):
    rows = corpus(seed)
    marked = suffix_dedup.with_spans(docs_of(rows), 40, 3, batches, first_stays, group)
    want = sorted(brute.removal(*r) for r in brute.covered(rows, 40, first_stays))
    assert sorted(tuple(r) for r in suffix_dedup.report(marked).collect()) == want
    assert sum(r[2] for r in want)


@pytest.mark.parametrize("first_stays", [False, True])
@pytest.mark.parametrize("seed", range(12))
def test_one_gram_by_orders_and_by_tree(seed, first_stays):
    source = random.Random(seed)
    length, fan = 40, 3
    gram, reach = "#" * suffix_dedup.gram_size(length, fan), fan**suffix_dedup.LEVELS - 1
    group = []
    for k in range(source.randrange(2, 40)):
        sides = [("".join(source.choice("ab") for _ in range(2)) * 30)[: source.choice([reach, 40, 9])] for _ in range(2)]
        if source.random() < 0.7:
            sides = [source.choice(["xyz", "z"]) + s if source.random() < 0.5 else s for s in sides]
        before, after = sides[0][::-1][-reach:], (gram + sides[1])[:length]
        if len(before) + len(after) >= length:
            data = (before + after).encode()
            if data not in [g[0] for g in group]:
                group.append((data, len(before), len(after), 1, source.randrange(9)))
    if len(group) < 2:
        return
    want = set()
    for k, (d, b, a, _, i) in enumerate(group):
        for off in range(max(0, length - a), b + 1):
            w = d[b - off : b - off + length]
            for j, (e, c, f, _, other) in enumerate(group):
                if j != k and length - f <= off <= c and e[c - off : c - off + length] == w:
                    if not first_stays or other < i:
                        want.add((k, off))
    got = {(k, d) for k, lo, hi in suffix_dedup.settle(group, length, fan, first_stays) for d in range(lo, hi)}
    assert got == want
    everything = set(range(len(group)))
    nodes = suffix_dedup.settle_nodes(group, everything, set(range(fan)), length, fan, first_stays)
    assert {(k, d) for k, lo, hi in nodes for d in range(lo, hi)} == want


def test_cut_keeps_whole_characters_and_other_columns(docs_of):
    rows = corpus(9)
    marked = suffix_dedup.with_spans(docs_of(rows), 40, 3, first_stays=True)
    got = {r.doc_id: r.text for r in suffix_dedup.cut(marked).collect()}
    for i, b, flags in brute.covered(rows, 40, True):
        text = brute.without(b, flags)
        assert got.get(i) == text or (any(flags) and not text.strip() and i not in got)


def test_long_texts_are_read_in_parts(docs_of, monkeypatch):
    source = random.Random(7)
    text = "".join(source.choice("abcdefgh ") for _ in range(30_000))
    rows = [(1, text), (2, text[5_000:9_000] + "!" + text[20_000:20_450]), (3, text[100:499])]
    want = sorted(brute.removal(*r) for r in brute.covered(rows, 400))
    monkeypatch.setattr(suffix_dedup, "PART", 3_000)
    assert sorted(tuple(r) for r in suffix_dedup.report(suffix_dedup.with_spans(docs_of(rows))).collect()) == want


def test_levels_are_the_digits_of_a_counter(spark, docs_of):
    family = suffix_dedup.SuffixFamily(Scratch(spark, "levels"))
    docs = docs_of(corpus(2)).selectExpr("doc_id AS id", "0 AS th", "text")
    for k in range(6):
        family.add(suffix_dedup.entries(docs.filter(f"id % 6 = {k}"), 40, 3))
    assert [rank for rank, _ in family.levels] == [2, 1]


@pytest.mark.parametrize("first_stays", [False, True])
def test_no_table_is_broadcast(docs_of, monkeypatch, first_stays):
    """The crowded path too, where the open nodes of a few contexts are a small file and very many rows."""
    plans, keep = {}, Scratch.keep

    def note(df, label):
        plans[label] = plans.get(label, "") + df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(Scratch, "keep", lambda self, df, label: (note(df, label), keep(self, df, label))[1])
    kept = suffix_dedup.keep
    monkeypatch.setattr(suffix_dedup, "keep", lambda df, label: (note(df, label), kept(df, label))[1])
    marked = suffix_dedup.with_spans(docs_of(corpus(3)), 40, 3, 3, first_stays, 1)
    note(marked, "result")
    assert {"suffix-seeds", "suffix-seeded", "suffix-contexts", "suffix-open", "suffix-nodes", "suffix-spans"} <= plans.keys()
    assert [label for label, plan in plans.items() if "Broadcast" in plan] == []
    assert "SortMergeJoin" in plans["suffix-nodes"]


def test_odd_and_empty_input(odd_docs, odd_texts, no_docs):
    marked = suffix_dedup.with_spans(odd_docs, 40, 3)
    rows = suffix_dedup.report(marked).collect()
    ids = [i if i is not None else -1 for i, _ in odd_texts]
    want = sorted(brute.removal(i, b, f) for i, (_, b, f) in zip(ids, brute.covered([(i or 0, t) for i, t in odd_texts], 40), strict=True))
    assert sorted((r.doc_id if r.doc_id is not None else -1, *r[1:]) for r in rows) == want
    assert suffix_dedup.cut(marked).columns == odd_docs.columns
    assert suffix_dedup.report(suffix_dedup.with_spans(no_docs)).collect() == []
