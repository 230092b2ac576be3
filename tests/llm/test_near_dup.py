import random

import brute
import pytest
import xxhash
from pyspark.sql import functions as F

from assay.llm import near_dup
from assay.llm.kernels import WordHashes


def corpus(seed, families=14, copies=12, words=70):
    """Families of texts with ever more words changed, and texts that have nothing in common."""
    source = random.Random(seed)

    def fresh():
        return "w" + str(source.randrange(10**6))

    out = []
    for family in range(families):
        base = [fresh() for _ in range(source.randrange(5, words))]
        for copy in range(copies):
            text = list(base)
            for _ in range(source.randrange(0, 1 + copy // 3)):
                text[source.randrange(len(text))] = fresh()
            out.append(" ".join(text) if family % 2 else " ".join(text).upper())
    source.shuffle(out)
    return list(enumerate(out, 1))


def found(docs, percent):
    rows = near_dup.near_duplicates(docs, percent).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}, rows


@pytest.mark.parametrize("percent", [80, 85])
def test_components_against_brute_force(docs_of, percent):
    rows = corpus(percent)
    got, held = found(docs_of(rows), percent)
    assert got == brute.components(rows, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in held)


@pytest.mark.parametrize("outliers", [0, 3, 1000])
def test_crowded_regions_go_deeper_and_lose_nothing(docs_of, monkeypatch, outliers):
    monkeypatch.setattr(near_dup, "OUTLIERS", outliers)
    monkeypatch.setattr(near_dup, "CROWD", 5)
    monkeypatch.setattr(near_dup, "CHUNK", 3)
    source = random.Random(1)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(1, 90):  # one crowd whose members are just below or above the limit to each other
        text = list(base)
        for at in source.sample(range(0, 100, 6), source.randrange(0, 4)):
            text[at] = f"x{source.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    got, _ = found(docs_of(rows), 80)
    assert got == brute.components(rows, 80)


def crowd(seed, n=90):
    """Texts of 100 words whose likeness is around the limit."""
    source = random.Random(seed)
    base = [f"b{i}" for i in range(100)]
    for i in range(1, n):
        text = list(base)
        for at in source.sample(range(0, 100, 6), source.randrange(0, 4)):
            text[at] = f"x{source.randrange(10**6)}"
        yield i, " ".join(text)


def test_rare_pairs_of_repeated_rows(spark, docs_of, monkeypatch):
    """Two sets of 100 shingles that share 95, each row given twice, meet in the exact join."""
    monkeypatch.setattr(near_dup, "OUTLIERS", 0)
    monkeypatch.setattr(near_dup, "region", lambda depth, tree="tree": F.xxhash64(F.lit(1)))
    monkeypatch.setattr(near_dup, "CROWD", 10**6)
    shared = [f"s{i}" for i in range(99)]
    x, y = " ".join([*(f"x{i}" for i in range(5)), *shared]), " ".join([*(f"y{i}" for i in range(5)), *shared])
    # the hub of the one region is unlike all others, so x and y meet in no first comparison
    hub = next(f"h{k} a b c d" for k in range(10**4) if smallest(f"h{k} a b c d") < min(map(smallest, (x, y))))
    rows = [(0, hub), (1, x), (1, x), (2, y), (2, y)]
    got, _ = found(docs_of(rows), 85)
    assert got == brute.components(list(dict.fromkeys(rows)), 85)
    assert got[2][1] == 1


def smallest(text):
    """The number inside of the class of a text, as Spark's xxhash64 of its digest."""
    own = near_dup.shingle_set(text.encode(), WordHashes())
    held = xxhash.xxh64_intdigest(xxhash.xxh3_128_digest(own.tobytes()), seed=42)
    return held - (1 << 64) if held >> 63 else held


@pytest.mark.parametrize("outliers", [0, 1000])
def test_repeated_rows_and_shared_ids_in_crowded_regions(docs_of, monkeypatch, outliers):
    monkeypatch.setattr(near_dup, "OUTLIERS", outliers)
    monkeypatch.setattr(near_dup, "CROWD", 5)
    monkeypatch.setattr(near_dup, "CHUNK", 3)
    base = list(crowd(1))
    # each text under its own number, twice; then two by two under one id
    got, _ = found(docs_of(base + base), 80)
    assert got == brute.components(base, 80)
    linked = brute.components(base, 80)
    shared = [((i + 1) // 2, t) for i, t in base]
    least = {}
    for (i, _), (j, _) in zip(base, shared, strict=True):
        least[linked[i][1]] = min(j, least.get(linked[i][1], j))
    want = sorted(((i + 1) // 2, linked[i][0], least[linked[i][1]]) for i, _ in base)
    rows = near_dup.near_duplicate_rows(docs_of(shared), 80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == want
    assert sum(r.first for r in rows) == len({linked[i][1] for i, _ in base if linked[i][0]})


def test_the_chance_of_a_miss_is_small():
    assert (1 - 0.80**near_dup.LEAST_DEPTH) ** near_dup.TREES < 4e-6


def test_odd_and_empty_input(odd_docs, odd_texts, no_docs):
    rows = near_dup.near_duplicates(odd_docs, 85).collect()
    assert len(rows) == len(odd_texts)
    at = {r.doc_id: r for r in rows}
    assert [(at[i].n_shingles, at[i].component_id) for i in (1, 2, 3)] == [(0, 1), (0, 2), (0, 3)]
    assert (at[4].component_id, at[5].component_id, at[5].n_shingles) == (4, 4, 1)
    assert (at[7].component_id, at[8].component_id, at[10].component_id) == (6, 6, 9)
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert near_dup.near_duplicates(no_docs, 85).collect() == []
