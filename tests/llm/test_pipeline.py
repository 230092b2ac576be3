import random

import brute
import pytest

import corpus_pipeline
from assay.llm import toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents, labels and benchmark with toxic texts, copies, shared passages and leaks, and odd rows."""
    source = random.Random(11)
    vocabulary = [f"{a}{b}" for a in ("ra", "ti", "on", "el", "mo", "éa") for b in ("n", "st", "vo", "lle", "x", "dor")]

    def words(n):
        return [source.choice(vocabulary) for _ in range(n)]

    docs, labels = [], []
    for i in range(200):
        text = words(source.randrange(20, 120))
        if i % 4 == 0:
            for _ in range(3):
                text.insert(source.randrange(len(text)), source.choice(["idiotic", "wretched"]))
        if i % 2 == 0:
            labels.append((i, 1, int(i % 4 == 0)))
        docs.append([i, " ".join(text), "en", "s", 0, 7])
    passage = " ".join(words(60))
    for i in (21, 33, 45, 57):
        docs[i][1] += " " + passage
    for i in (61, 73, 85):
        docs[i][1] = docs[1][1] + (" end" if i == 73 else "")
    items = [(k, " ".join(words(25))) for k in range(5)]
    docs[9][1] += " " + items[2][1]
    docs += [docs[13][:], [300, None, None, None, None, 7], [301, "", "en", "s", 0, 7], [None, "no id", "en", "s", 5, 7]]
    path = tmp_path_factory.mktemp("pipeline")
    for name, rows, kinds in (
        ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long, score int"),
        ("labels", labels, "doc_id long, quality int, toxic int"),
        ("benchmark", items, "item_id long, text string"),
    ):
        spark.createDataFrame([tuple(r) for r in rows], kinds).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    model = toxicity.fit(docs, labels)
    toxic = {r.doc_id for r in toxicity.score(docs, model).filter("score >= 0.5").collect()}
    assert toxic == {i for i in range(0, 200, 4)}
    left = list(dict.fromkeys((r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic))
    groups = brute.components([r for r in left if r[0] is not None], corpus_pipeline.SIMILARITY)
    assert len({g for _, g in groups.values()}) < len(groups)
    left = [(i, t) for i, t in left if i is None or groups[i][1] == i]
    flagged = brute.covered([(-1 if i is None else i, t) for i, t in left], corpus_pipeline.PASSAGE, True)
    assert any(any(f) for _, _, f in flagged)
    left = [(i, brute.without(b, f) if t is not None else None) for (i, t), (_, b, f) in zip(left, flagged, strict=True)]
    left = [(i, t) for (i, t), (_, _, f) in zip(left, flagged, strict=True) if not any(f) or t.strip()]
    hit = {r[0] for r in brute.contamination(left, items, 10) if r[5]}
    assert 9 in hit
    left = [(i, t) for i, t in left if i not in hit]
    rows = corpus_pipeline.run(spark, folder).collect()
    key = str
    assert sorted(((r.doc_id, r.n_tokens) for r in rows), key=key) == sorted(
        ((i, len(brute.BLANK_WORDS.findall(t or ""))) for i, t in left), key=key
    )


def test_stages_keep_the_columns_and_take_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        if name != "packing":
            assert out.dtypes == docs.dtypes


def words(source, n):
    return " ".join(f"w{source.randrange(10**6)}" for _ in range(n))


def left(stage, spark, rows, folder):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(((r.doc_id, r.text) for r in stage(spark, docs, folder).collect()), key=str)


def test_near_copies_go_by_row(spark, folder):
    source = random.Random(1)
    a, b, c, d, e = (words(source, 60) for _ in range(5))
    rows = [(1, a), (2, a + " end"), (2, b), (2, b), (2, e), (None, c), (None, c), (None, d), (None, None)]
    want = [(1, a), (2, b), (2, e), (None, c), (None, d), (None, None)]
    assert left(corpus_pipeline.drop_near_copies, spark, rows, folder) == sorted(want, key=str)


def test_contaminated_rows_go_by_row(spark, folder):
    source = random.Random(2)
    leak = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    clean = [words(source, 30) for _ in range(3)]
    rows = [(None, leak), (None, clean[0]), (0, clean[1]), (5, "x " + leak), (5, clean[2])]
    want = [(None, clean[0]), (0, clean[1]), (5, clean[2])]
    assert left(corpus_pipeline.drop_contaminated, spark, rows, folder) == sorted(want, key=str)


@pytest.mark.parametrize("group", [20_000, 1])
def test_a_passage_stays_once_among_rows_without_or_with_one_id(spark, group):
    source = random.Random(3)
    for ids in ((None, None, None), (None, 0, 4), (3, 3, 3), (None, 3, 3)):
        passage = words(source, 60)
        rows = [(i, f"{words(source, 20)} {passage} {words(source, 20)}") for i in ids]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        marked = corpus_pipeline.suffix_dedup.with_spans(docs, corpus_pipeline.PASSAGE, corpus_pipeline.FAN, first_stays=True, group=group)
        held = [(r.doc_id, r.text) for r in corpus_pipeline.suffix_dedup.cut(marked).collect()]
        assert len(held) == 3 and sum(passage in t for _, t in held) == 1
        assert sum(len(t) for _, t in held) < sum(len(t) for _, t in rows) - 2 * len(passage) + 10
        assert {i for i, t in held if passage in t} == {ids[0]}


def test_stages_take_columns_of_any_name(spark, folder, odd_docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, folder)
        rows = out.collect()
        assert rows
        if name != "packing":
            assert out.columns == odd_docs.columns
            assert all(r["_id"] == r["spans"] == r["_th"] == 1 for r in rows)
