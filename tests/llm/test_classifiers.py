import math
import zlib

import numpy as np
import pytest

from assay.llm import langid, quality, toxicity
from assay.llm.common import crc_remainder
from assay.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))


def test_split_follows_the_crc_of_the_id(spark):
    rows = spark.range(50).select("id", crc_remainder("id", 5).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_toxicity_on_held_out_labels(spark, tables):
    scored = QUERIES["op2_toxicity"](spark, SF)
    assert scored.count() == tables[0].count()
    rows = scored.join(tables[1], "doc_id").filter("held_out").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits >= 0.75 * sum(r.toxic for r in rows)
    assert hits >= 0.95 * sum(r.predicted for r in rows)


def test_toxicity_of_odd_texts_and_without_labels(spark, odd_docs, odd_texts, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 1), (6, 1, 0), (9, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(odd_docs, toxicity.fit(odd_docs, labels)).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r.score <= 1 for r in rows)
    model = toxicity.fit(odd_docs, labels.limit(0))
    assert {r.score < 0.5 for r in toxicity.score(odd_docs, model).collect()} == {True}
    assert toxicity.score(no_docs, model).collect() == []
    kept = toxicity.clean(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == len(odd_texts)


def test_a_score_does_not_depend_on_neighbours(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels, fit_rows=400)
    part = docs.filter("doc_id < 300")
    one = {r.doc_id: r.score for r in toxicity.score(part.coalesce(1), model).collect()}
    many = {r.doc_id: r.score for r in toxicity.score(part.repartition(40), model).collect()}
    assert one == many


def test_quality_verdicts(spark, tables):
    rows = QUERIES["op5_quality"](spark, SF).join(tables[1], "doc_id").filter("NOT base_failed").collect()
    right = sum(r.kept == bool(r.quality) for r in rows)
    assert right >= 0.95 * len(rows)
    unseen = quality.fit(*tables, seen=crc_remainder("doc_id", 5) != 0)
    judged = quality.judge(tables[0].filter(crc_remainder("doc_id", 5) == 0), unseen).join(tables[1], "doc_id")
    rows = judged.filter("NOT base_failed").collect()
    assert sum(r.kept == bool(r.quality) for r in rows) >= 0.95 * len(rows)


def test_trees_respect_directions():
    source = np.random.default_rng(3)
    x = source.random((3_000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * source.random(3_000)) > 0.6).astype(float)
    trees = quality.grow(x, y, [1, -1, 0], trees=30)
    base = source.random((200, 3))
    for j, sign in ((0, 1), (1, -1)):
        steps = []
        for v in np.linspace(0, 1, 21):
            moved = base.copy()
            moved[:, j] = v
            steps.append(trees.margin(moved))
        assert (sign * np.diff(steps, axis=0) >= -1e-9).all()
    assert ((trees.margin(x) > 0) == (y > 0.5)).mean() > 0.8


def test_quality_of_odd_texts_and_without_labels(spark, odd_docs, odd_texts, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.judge(odd_docs, quality.fit(odd_docs, none)).collect()
    assert len(rows) == len(odd_texts)
    assert all(r.kept != r.base_failed for r in rows)
    assert [r.n_words for r in rows if r.doc_id == 9] == [30_000]
    assert quality.judge(no_docs, quality.Trees()).collect() == []


def test_language_on_held_out_rows(spark, tables):
    rows = QUERIES["op6_language"](spark, SF).join(tables[0].select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)
    assert sum(r.rejected for r in rows) <= 0.05 * len(rows)


def test_language_of_odd_texts(spark, tables, odd_docs, odd_texts, no_docs):
    model = langid.fit(tables[0], crc_remainder("doc_id", 3) != 1, per_language=100)
    rows = langid.identify(odd_docs, model).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert all(r.lang_pred != "und" for r in rows if r.doc_id in (4, 9, 13))
    nothing = langid.fit(no_docs, crc_remainder("doc_id", 3) != 1)
    assert {r.lang_pred for r in langid.identify(odd_docs, nothing).collect()} == {"und"}
    digits = spark.createDataFrame([(1, "123 456 ...")], "doc_id long, text string")
    assert langid.identify(digits, model).first().lang_pred == "und"
    assert langid.identify(no_docs, model).collect() == []


def test_rejection_of_a_language_never_seen(spark, tables):
    model = langid.fit(tables[0], crc_remainder("doc_id", 3) != 1, per_language=200)
    strange = spark.createDataFrame([(1, "это совсем другой язык " * 30)], "doc_id long, text string")
    assert langid.identify(strange, model).first().rejected


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, {r.doc_id: r.text for r in docs.collect()}


def folded(text, fold):
    return (text or "").encode().translate(fold)


def grams(data, multipliers, bits):
    """Bucket of the n-gram at every place, in Python integers."""
    for n, multiplier in multipliers.items():
        for i in range(len(data) - n + 1):
            yield (int.from_bytes(data[i : i + n], "little") * multiplier & (1 << 64) - 1) >> 64 - bits


def test_toxicity_scores_against_plain_python(spark, small):
    docs, labels, texts = small
    model = toxicity.fit(docs, labels)
    value = {int(b): r * w for b, r, w in zip(model.buckets, model.ratios, model.weights, strict=True)}
    for r in toxicity.score(docs, model).collect():
        found = set(grams(folded(texts[r.doc_id], toxicity.FOLD), toxicity.GRAMS, toxicity.BUCKET_BITS))
        z = model.intercept + sum(value[b] for b in found if b in value)
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-35, min(35, z)))), abs=1e-9)


def test_language_against_plain_python(spark, small):
    docs, _, texts = small
    model = langid.fit(docs, crc_remainder("doc_id", 3) != 1)
    for r in langid.identify(docs, model).collect():
        text = texts[r.doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        x = np.zeros(langid.DIMENSIONS)
        for b in grams(folded(text, langid.FOLD), langid.GRAMS, langid.DIMENSIONS.bit_length() - 1):
            x[b] += 1
        x = np.log1p(x) * model.idf
        cosines = model.centroids.astype(float) @ (x / max(1e-12, math.sqrt((x * x).sum())))
        assert r.score == pytest.approx(min(1.0, max(0.0, cosines.max())), abs=1e-4)
        near = {model.languages[model.owner[c]] for c in np.nonzero(cosines >= cosines.max() - 1e-4)[0]}
        assert r.lang_pred in near


def test_quality_scores_against_walking_the_nodes(spark, small):
    docs, labels, texts = small
    trees = quality.fit(docs, labels)
    assert trees.roots
    names = list(texts)
    data = "".join(texts[i] or "" for i in names).encode()
    offsets = np.cumsum([0] + [len((texts[i] or "").encode()) for i in names])
    x = quality.features(quality.statistics(np.frombuffer(data, np.uint8), offsets, quality.WordHashes()))
    scores = {r.doc_id: r for r in quality.judge(docs, trees).collect()}
    for i, row in zip(names, x.tolist(), strict=True):
        margin = trees.start
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
            margin += trees.value[at]
        assert scores[i].quality_score == pytest.approx(1 / (1 + math.exp(-max(-35, min(35, margin)))), abs=1e-9)
        assert scores[i].kept == (not scores[i].base_failed and margin >= 0)


def test_every_language_is_learned_however_many(spark):
    rows = [(k * 2 + j, f"{chr(0x4E00 + k)}{chr(0x4E00 + k)} x" * 5, f"l{k:04d}") for k in range(1_300) for j in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, crc_remainder("doc_id", 3) != 7)
    assert len(model.languages) == 1_300
    few = langid.sample(docs, crc_remainder("doc_id", 3) != 7, 800, 400)
    assert few.count() == 400


def test_samples_are_bounded_where_rows_share_or_lack_ids(spark):
    rows = [(1, f"bad text {i}", "a") for i in range(300)] + [(2, "good", "a")] * 300 + [(None, f"none {i}", "b") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    toxicity.fit(docs, labels, fit_rows=2)
    quality.fit(docs, labels, fit_rows=2)
    held = langid.sample(docs, crc_remainder("doc_id", 3) != 9, 50, 10_000).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in held}.keys() == {"a", "b"}
    assert all(20 <= r["count"] <= 90 for r in held)
