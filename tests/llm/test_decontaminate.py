import random

import brute
import pytest

from assay.llm import decontaminate


def cases(seed):
    source = random.Random(seed)

    def words(n):
        return [source.choice(["Ab", "cd", "éF", "7", "xy", "Of", "the"]) + str(source.randrange(4)) for _ in range(n)]

    items = [(i, " ".join(words(source.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(20)]
    items += [(20, items[5][1]), (21, None), (3, items[4][1])]
    items = [(f"i{k}", t) for k, t in items if k != 3] + [("i3", items[3][1])]
    docs = []
    for i in range(60):
        parts = words(source.randrange(0, 30))
        for _, t in source.sample(items, 2):
            piece = (t or "").split()
            at = source.randrange(0, 4)
            parts += piece[at if len(piece) > 14 else 0 :] + words(source.randrange(0, 4))
        docs.append((i, source.choice([" ", ", ", "\n-"]).join(parts)))
    return docs + [(60, None), (61, ""), (62, "?!"), (63, docs[7][1])], items


@pytest.mark.parametrize(("seed", "span", "k", "limit"), [(1, 10, 5, 10**6), (2, 10, 5, 0), (3, 4, 2, 10**6), (4, 10, 10, 10**6)])
def test_against_brute_force(spark, docs_of, seed, span, k, limit):
    docs, items = cases(seed)
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.decontaminate(docs_of(docs), benchmark, span, k, limit).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute.contamination(docs, items, span))


def test_odd_and_empty_input(spark, odd_docs, odd_texts, no_docs):
    items = spark.createDataFrame([(1, "one"), (2, None), (None, "same line"), (2, " ")], "item_id int, text string")
    rows = decontaminate.decontaminate(odd_docs, items).collect()
    assert len(rows) == len(odd_texts)
    at = {r.doc_id: r for r in rows}
    assert (at[4].n_hit, at[4].n_items, at[11].n_hit, at[11].n_items) == (1, 1, 6, 0)
    assert at[11].contaminated and not at[9].contaminated and at[9].n_words > 30_000 - 1
    assert not any(r.contaminated for r in decontaminate.decontaminate(odd_docs, items.limit(0)).collect())
    assert decontaminate.decontaminate(no_docs, items).collect() == []


def test_the_main_path_has_no_python(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontaminate.decontaminate(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan
