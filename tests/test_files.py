import pytest

from assay.sources import files, sinks
from assay.specs import SourceSpec
from assay.streaming import ingest

MAP = {"customer_id": "id", "full_name": "name", "tax": "tax_id"}


def source(folder, kind="csv"):
    return SourceSpec("s", kind, "customer", str(folder), 1, 24.0, MAP)


def land(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


@pytest.mark.parametrize("header", ["id,name,tax_id,extra", "extra,tax_id,name,id", "name,extra,id,tax_id"])
def test_csv_goes_by_name_whatever_the_order(spark, tmp_path, header):
    row = {"id": "007", "name": "Ines, O.", "tax_id": "01-2", "extra": "kept"}
    line = ",".join(f'"{row[c]}"' for c in header.split(","))
    land(tmp_path / "in", "a.csv", f"{header}\n{line}\n")
    assert files.read_batch(spark, source(tmp_path / "in")).first().asDict() == row


def test_a_missing_mapped_column_is_an_error(spark, tmp_path):
    land(tmp_path / "in", "a.csv", "id,name\n1,x\n")
    with pytest.raises(ValueError, match="tax_id"):
        files.read_batch(spark, source(tmp_path / "in"))


def test_json_keeps_every_raw_column_as_text(spark, tmp_path):
    land(tmp_path / "in", "a.json", '[{"name": "x", "more": 1.50, "id": "01", "tax_id": null}, {"id": 2, "name": "y", "tax_id": "t"}]')
    rows = files.read_batch(spark, source(tmp_path / "in", "json")).orderBy("name").collect()
    assert [(r.id, r.name, r.tax_id, r.more) for r in rows] == [("01", "x", None, "1.50"), ("2", "y", "t", None)]


def test_a_stream_remembers_its_schema(spark, tmp_path):
    land(tmp_path / "in", "a.csv", "tax_id,extra,id,name\nt1,e1,1,a\n")
    paths = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    for text in (None, "tax_id,extra,id,name\nt2,e2,2,b\n"):
        if text:
            land(tmp_path / "in", "b.csv", text)
        ingest.ingest_source(spark, source(tmp_path / "in"), str(tmp_path / "in"), *paths).awaitTermination()
    rows = spark.read.parquet(paths[0]).orderBy("id").collect()
    assert [(r.id, r.name, r.tax_id, r.extra) for r in rows] == [("1", "a", "t1", "e1"), ("2", "b", "t2", "e2")]


def test_one_source_that_is_not_there_does_not_stop_the_others(spark, tmp_path):
    from dataclasses import replace

    from assay.specs import load_entity

    land(tmp_path / "here", "a.csv", "id,name,tax_id\n1,a,t\n")
    sources = tuple(
        SourceSpec(n, "csv", "customer", str(tmp_path / n), 1, 24.0, MAP) for n in ("gone", "here", "lost")
    )
    entity = replace(load_entity("customer"), sources=sources)
    with pytest.raises(ingest.IngestError, match="gone.*lost"):
        ingest.ingest_entity(spark, entity, str(tmp_path / "root"))
    assert spark.read.parquet(f"{tmp_path}/root/{sources[1].raw_table}").count() == 1


def test_a_snapshot_that_broke_off_is_run_again(spark, tmp_path):
    root = str(tmp_path / "t")
    (tmp_path / "t" / "data" / "version=1-half").mkdir(parents=True)
    for rows in (3, 5):
        sinks.overwrite_snapshot(spark.range(rows), root, 1)
    sinks.overwrite_snapshot(spark.range(7), root, 2)
    assert [sinks.read_snapshot(spark, root, v).count() for v in (1, 2, None)] == [5, 7, 7]
    with pytest.raises(ValueError, match="no version 9"):
        sinks.read_snapshot(spark, root, 9)
