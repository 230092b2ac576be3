"""Landing files that gain, lose and change columns, and appends that are repeated or broken off."""

import json

import pytest
from pyspark.sql import types as T

from assay.sources import commits, evolution
from assay.specs import SourceSpec
from assay.streaming import ingest


def source(folder, kind, mapped=("id",)):
    return SourceSpec("s", kind, "e", str(folder), 1, 24.0, {c: c for c in mapped})


def write(folder, name, kind, records, spark):
    """Records as one landing file; parquet takes the types of the values."""
    folder.mkdir(parents=True, exist_ok=True)
    if kind == "json":
        (folder / f"{name}.json").write_text(json.dumps(records))
    elif kind == "csv":
        columns = list(records[0])
        lines = [",".join(columns)] + [",".join("" if r[c] is None else str(r[c]) for c in columns) for r in records]
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    else:
        spark.createDataFrame(records).coalesce(1).write.parquet(str(folder / name))


DROPS = [
    [{"id": 1, "size": 10, "price": 1.5}, {"id": 2, "size": 20, "price": 2.25}],
    [{"price": 3.5, "id": 3, "brand": "b"}],
    [{"brand": "c", "id": 4, "size": "huge"}, {"brand": "d", "id": 5, "size": "30"}],
]
WANT = [
    (1, 10, 1.5, None, None), (2, 20, 2.25, None, None), (3, None, 3.5, "b", None),
    (4, None, None, "c", {"size": "huge"}), (5, 30, None, "d", None),
]


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
def test_three_drops_through_batch_and_stream(spark, tmp_path, kind):
    paths = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    src = source(tmp_path / "in", kind)
    for i, records in enumerate(DROPS):
        write(tmp_path / "in", f"drop{i}", kind, records, spark)
        for _ in range(2):  # the second run finds nothing new
            ingest.land_evolving(spark, src, str(tmp_path / "in"), *paths, infer=True).awaitTermination()
    streamed = ingest.read_landed(spark, paths[0])
    store = evolution.SchemaStore(spark, str(tmp_path / "store"))
    for i, records in enumerate(DROPS):
        write(tmp_path / f"in{i}", "drop", kind, records, spark)
        evolution.read_evolving(spark, src, store, str(tmp_path / f"in{i}"), infer=True)
    batch = evolution.read_evolving(spark, src, store, str(tmp_path / "in"), infer=True)
    for df in (streamed, batch):
        rows = df.select("id", "size", "price", "brand", "_rescued").orderBy("id").collect()
        assert [tuple(r) for r in rows] == WANT
    assert [f.name for f in store.latest()[1]] == [f.name for f in evolution.SchemaStore(spark, ingest.schema_path(paths[0])).latest()[1]]
    assert "brand" not in ingest.read_landed(spark, paths[0], 1).columns
    assert store.versions().count() == 2
    assert {r[0].rsplit("/", 1)[-1].split(".")[-1] for r in streamed.select("_source_file").collect()} == {kind}


def test_one_batch_of_files_that_differ(spark, tmp_path):
    for kind in ("csv", "json", "parquet"):
        for i, records in enumerate(DROPS):
            write(tmp_path / kind, f"drop{i}", kind, records, spark)
        store = evolution.SchemaStore(spark, str(tmp_path / f"store-{kind}"))
        df = evolution.read_evolving(spark, source(tmp_path / kind, kind), store, infer=True)
        held = {}
        for r in df.collect():
            rescued = r["_rescued"] or {}
            held[r["id"]] = (str(r["size"]) if r["size"] is not None else rescued.get("size"), r["price"], r["brand"])
        assert [v[0] for _, v in sorted(held.items())] == ["10", "20", None, "huge", "30"]
        assert [v[1:] for _, v in sorted(held.items())] == [(1.5, None), (2.25, None), (3.5, "b"), (None, "c"), (None, "d")]


def test_text_stays_text_where_a_type_would_change_it(spark, tmp_path):
    write(tmp_path / "a", "x", "csv", [{"id": "007", "n": "1.50", "d": "2024-01-02", "e": None}], spark)
    store = evolution.SchemaStore(spark, str(tmp_path / "store"))
    src = source(tmp_path / "a", "csv")
    df = evolution.read_evolving(spark, src, store, infer=True)
    assert df.first()["id"] == "007"
    assert [t for _, t in df.dtypes[:4]] == ["string", "string", "date", "string"]
    write(tmp_path / "b", "x", "csv", [{"id": "8", "d": "soon"}], spark)
    row = evolution.read_evolving(spark, src, store, str(tmp_path / "b"), infer=True).first()
    assert (row["id"], row["d"], row["_rescued"]) == ("8", None, {"d": "soon"})
    other = evolution.SchemaStore(spark, str(tmp_path / "other"))
    df = evolution.read_evolving(spark, src, other, types={"ID": "int"})
    assert [t for _, t in df.dtypes[:3]] == ["int", "string", "string"]
    assert (df.first()["id"], df.first()["_rescued"]) == (None, {"id": "007"})


def test_lines_that_cannot_be_parsed_and_names_that_differ_in_case(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,name\n1,x\n2,y,more\n3\n")
    store = evolution.SchemaStore(spark, str(tmp_path / "store"))
    src = source(tmp_path / "in", "csv")
    rows = evolution.read_evolving(spark, src, store).orderBy("id").collect()
    assert [(r["id"], r["name"], r["_rescued"]) for r in rows] == [
        ("1", "x", None), ("2", "y", {"_line": "2,y,more"}), ("3", None, {"_line": "3"}),
    ]
    (tmp_path / "in 2+%").mkdir()
    (tmp_path / "in 2+%" / "b %20.csv").write_text("ID,Name\n4,z\n")
    row = evolution.read_evolving(spark, src, store, str(tmp_path / "in 2+%")).first()
    assert (row["id"], row["name"], row["_rescued"]) == ("4", "z", None)
    assert store.versions().count() == 1


def test_a_mapped_column_no_file_ever_had_is_an_error(spark, tmp_path):
    write(tmp_path / "in", "a", "json", [{"id": 1}], spark)
    store = evolution.SchemaStore(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError, match="tax"):
        evolution.read_evolving(spark, source(tmp_path / "in", "json", ("id", "tax")), store)
    assert store.versions().count() == 0


def test_types_widen_only_within_their_kind():
    long, int_, text = T.LongType(), T.IntegerType(), T.StringType()
    assert evolution.wider(int_, long) == long and evolution.wider(long, int_) == long
    assert evolution.wider(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert evolution.wider(T.DecimalType(5, 2), T.DecimalType(6, 4)) == T.DecimalType(7, 4)
    assert evolution.wider(T.DecimalType(38, 0), T.DecimalType(38, 9)) == T.DecimalType(38, 0)
    assert evolution.wider(long, text) == long and evolution.wider(text, long) == text and evolution.wider(long, T.DoubleType()) == long
    known = T.StructType.fromDDL("a int, s struct<x: int>, l array<int>")
    found = T.StructType.fromDDL("B string, A bigint, s struct<y: string, x: bigint>, l array<bigint>")
    assert evolution.merge(known, found) == T.StructType.fromDDL("a bigint, s struct<x: bigint, y: string>, l array<bigint>, B string")


def test_a_widened_column_is_read_from_old_files_too(spark, tmp_path):
    src = source(tmp_path / "in", "parquet")
    paths = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    for i, kind in enumerate(("int", "bigint", "double")):
        spark.range(1).selectExpr(f"CAST({i} + 1 AS {kind}) AS id", f"CAST({i} AS {kind}) AS n").write.parquet(str(tmp_path / "in" / str(i)))
        ingest.land_evolving(spark, src, str(tmp_path / "in"), *paths).awaitTermination()
    df = ingest.read_landed(spark, paths[0])
    assert dict(df.dtypes)["id"] == "bigint"
    assert sorted((r["id"], r["n"], r["_rescued"]) for r in df.collect()) == [(1, 0, None), (2, 1, None), (3, 2, None)]


def test_a_schema_of_two_writers(spark, tmp_path, monkeypatch):
    store = evolution.SchemaStore(spark, str(tmp_path / "store"))
    faster = evolution.SchemaStore(spark, str(tmp_path / "store"))
    plain, calls = evolution.SchemaStore.latest, []

    def latest(self, version=None):
        held = plain(self, version)
        if self is store and not calls:
            calls.append(1)
            faster.evolve(T.StructType.fromDDL("a int"))
        return held

    monkeypatch.setattr(evolution.SchemaStore, "latest", latest)
    assert store.evolve(T.StructType.fromDDL("b int")) == T.StructType.fromDDL("a int, b int")
    assert store.versions().count() == 2


def test_an_append_takes_effect_once(spark, tmp_path):
    root = str(tmp_path / "log")
    assert commits.read_committed(spark, root, "id long").count() == 0
    assert commits.append_once(spark.range(3), root, "run/1 + a")
    assert not commits.append_once(spark.range(3), root, "run/1 + a")
    assert commits.append_once(spark.range(2), root, "run 2")
    assert commits.read_committed(spark, root).count() == 5
    assert sorted(r.run for r in commits.committed_runs(spark, root).collect()) == ["run 2", "run/1 + a"]


def test_a_run_that_broke_off_leaves_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "log")
    with monkeypatch.context() as m:
        m.setattr(commits, "create_once", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            commits.append_once(spark.range(3), root, "1")
    assert commits.read_committed(spark, root, "id long").count() == 0
    assert commits.append_once(spark.range(3).selectExpr("id", "id % 2 AS part"), root, "1", ("part",))
    df = commits.read_committed(spark, root)
    assert sorted(df.columns) == ["id", "part"] and df.count() == 3


def test_of_two_writers_of_a_file_one_succeeds(spark, tmp_path):
    path = str(tmp_path / "f" / "x")
    assert commits.create_once(spark, path, "one") and not commits.create_once(spark, path, "two")
    assert spark.read.text(path).first().value == "one"
    assert [p.name for p in (tmp_path / "f").iterdir() if not p.name.endswith(".crc")] == ["x"]
