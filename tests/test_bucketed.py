"""Tables of which a change rewrites only the buckets it touches."""

import pytest
from pyspark.sql import functions as F

from assay.operators.components import ComponentTable, connected_components, extend_components
from assay.operators.upsert import upsert
from assay.sources import bucketed
from assay.sources.bucketed import BucketedTable


def content(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in (root / "data").rglob("part-*")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_merge_leaves_the_files_of_other_buckets_alone(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path), ["id"], 16)
    target = spark.range(200).selectExpr("id", "id * 10 AS v", "0L AS at")
    assert table.replace(target) == 1
    before, first = content(tmp_path), table.version()
    source = spark.createDataFrame([(3, -1, 1), (3, -2, 2), (500, 5, 1)], "id long, v long, at long")
    touched = table.touched(source)
    assert table.merge(source, "at") == len(touched) <= 2
    assert rows(table.read()) == rows(upsert(target, source, ["id"], "at"))
    after, second = content(tmp_path), table.version()
    assert all(after[name] == data for name, data in before.items())
    same = {b for b, f in first["folders"].items() if second["folders"][b] == f}
    assert same == {str(b) for b in range(16)} - {str(b) for b in touched}
    assert rows(table.read(number=1)) == rows(target)
    assert table.merge(source.limit(0), "at") == 0 and table.version() == second


def test_keys_that_repeat_or_are_null_and_tables_without_rows(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path), ["a", "b"], 4)
    schema = "a string, b long, v string, at long"
    assert table.read(schema).count() == 0
    with pytest.raises(ValueError, match="nothing was written"):
        table.read()
    table.merge(spark.createDataFrame([("x", 1, "old", 1), ("x", 1, "new", 2), (None, None, "n", 1)], schema), "at")
    assert [r.v for r in table.read().orderBy("v").collect()] == ["n", "new"]
    table.replace(table.read().limit(0))
    assert table.read().count() == 0 and table.read().columns == ["a", "b", "v", "at"]
    assert table.read(number=1).count() == 2


def test_a_change_that_broke_off_is_not_seen(spark, tmp_path, monkeypatch):
    table = BucketedTable(spark, str(tmp_path), ["id"], 4)
    table.replace(spark.range(9))
    with monkeypatch.context() as m:
        m.setattr(bucketed, "create_once", lambda *a: False)
        with pytest.raises(RuntimeError, match="another writer"):
            table.replace(spark.range(3))
    assert table.read().count() == 9
    with pytest.raises(ValueError, match="not replaced"):
        table.replace(spark.range(9), table.touched(spark.range(1)))


EDGES = [(f"{i:03d}", f"{i + 1:03d}") for i in range(0, 60) if i % 7] + [("100", "101"), ("200", "200")]
LATER = [("005", "020"), ("300", "301"), ("301", "033"), ("101", "102"), ("400", "401"), ("006", "006"), ("041", "042")]


def test_components_of_two_drops_are_those_of_one_run(spark, tmp_path):
    table = ComponentTable(spark, str(tmp_path), 16)
    first, later = (spark.createDataFrame(e, "a string, b string") for e in (EDGES, LATER))
    table.add(first, "a", "b")
    before = table.table.version()
    changed = table.add(later, "a", "b")
    assert rows(table.read()) == rows(connected_components(first.unionAll(later), "a", "b"))
    assert 0 < changed < table.read().count() / 2
    after = table.table.version()
    assert any(after["folders"].get(b) == f for b, f in before["folders"].items())
    assert table.add(later, "a", "b") == 0 and table.table.version() == after


def test_what_changes_by_further_edges(spark):
    labels = spark.createDataFrame([("b", "b"), ("c", "b"), ("x", "x"), ("y", "x"), ("m", "m"), ("n", "m")], "id string, component string")
    edges = spark.createDataFrame([("y", "c"), ("a", "x"), ("q", "r")], "a string, b string")
    got = {r.id: (r.old, r.component) for r in extend_components(labels, edges, "a", "b").collect()}
    assert got == {
        "a": (None, "a"), "b": ("b", "a"), "c": ("b", "a"), "x": ("x", "a"), "y": ("x", "a"), "q": (None, "q"), "r": (None, "q"),
    }
    assert extend_components(labels, edges.filter(F.lit(False)), "a", "b").count() == 0
