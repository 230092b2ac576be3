from datetime import datetime

import pytest
from pilot_data import people, write
from pyspark.sql import functions as F

from assay.operators import evaluate
from assay.operators.matching import MEMBER
from assay.operators.quality import GateFailure
from assay.plans.mastering import master, standardized_batch
from assay.sources import sinks
from assay.sources.files import read_batch
from assay.specs import load_entity
from assay.streaming import ingest

ENTITY = load_entity("customer")
AS_OF = datetime(2026, 8, 1)


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    raw, truth = people()
    write(root, ENTITY, raw)
    return root, raw, truth


@pytest.fixture(scope="module")
def run(spark, landing):
    root, raw, truth = landing
    paths = {s.name: str(root / s.landing_path) for s in ENTITY.sources}
    standard = standardized_batch(spark, ENTITY, AS_OF, paths)
    return standard, master(standard, ENTITY, AS_OF), spark.createDataFrame(truth, f"{MEMBER} string, true_id string")


def test_postal_codes_keep_leading_zeros(spark, landing):
    root, raw, _ = landing
    for name in ("erp", "crm", "flatfile"):
        source = ENTITY.source(name)
        df = read_batch(spark, source, str(root / source.landing_path))
        got = sorted(r[0] for r in df.select(source.columns["postal_code"]).collect())
        assert got == sorted(r["postal_code"] for r in raw[name])


def test_every_row_is_accounted_for(run, landing):
    standard, m, _ = run
    total = sum(len(rows) for rows in landing[1].values())
    assert standard.count() == total
    assert m.rejected.count() + m.scored.count() == total
    assert m.passed.count() + m.quarantine.count() == m.scored.count()
    assert m.groups.count() == m.passed.count()
    assert m.golden.agg(F.sum("source_record_count")).first()[0] == m.passed.count()
    assert m.golden.count() == m.groups.select("golden_id").distinct().count()


def test_match_quality_against_truth(run):
    _, m, truth = run
    row = evaluate.pairwise_quality(m.groups, truth).first()
    assert row.precision >= 0.99 and row.recall >= 0.99
    over_all = evaluate.pairwise_quality(m.groups, truth, all_truth=True).first()
    assert over_all.recall < row.recall


def test_threshold_sweep_loses_recall_as_it_rises(run):
    _, m, truth = run
    rows = evaluate.threshold_sweep(m.matched, [0.65, 0.75, 0.82, 0.95], truth).orderBy("threshold").collect()
    recalls = [r.recall for r in rows]
    assert recalls == sorted(recalls, reverse=True) and recalls[0] > recalls[-1]
    assert [r.golden_records for r in rows] == sorted(r.golden_records for r in rows)


def test_second_run_gives_the_same_golden_records(run):
    standard, m, _ = run
    again = master(standard.repartition(3), ENTITY, AS_OF)
    key = lambda df: sorted(map(str, df.published(ENTITY).withColumn("match_confidence", F.round("match_confidence", 9)).collect()))
    assert key(m) == key(again)


def test_approved_record_reaches_gold(spark):
    columns = "customer_id string, full_name string, email string, tax_id string, address_line1 string, country_code string, postal_code string, updated_at string, _source_system string, _ingested_at timestamp"
    rows = spark.createDataFrame([("1", "Jane", "x", "???", "a", "ZZ", "10001", "2026-01-01", "erp", AS_OF)], columns)
    assert master(rows, ENTITY, AS_OF).golden.count() == 0
    approved = spark.createDataFrame([("erp:1",)], "business_key string")
    m = master(rows, ENTITY, AS_OF, approved)
    assert m.golden.first().golden_id == "erp:1" and m.quarantine.count() == 0


def test_streaming_two_drops_with_a_restart(spark, tmp_path):
    raw, _ = people(count=40, seed=1)
    half = {s: (rows[: len(rows) // 2], rows[len(rows) // 2 :]) for s, rows in raw.items()}
    landing, lake = tmp_path / "in", str(tmp_path / "lake")
    for drop in (0, 1):
        write(landing, ENTITY, {s: parts[drop] for s, parts in half.items()}, part=f"-{drop}")
        for _ in range(2):  # the second start finds nothing new
            tables = ingest.ingest_entity(spark, ENTITY, lake, AS_OF, landing=str(landing))
            ingest.refresh_standardized(spark, ENTITY, tables, f"{lake}/silver", f"{lake}/_checkpoints/silver")
        seen = spark.read.parquet(f"{lake}/silver")
        assert seen.count() == sum(len(p) for parts in half.values() for p in parts[: drop + 1])
    paths = {s.name: str(landing / s.landing_path) for s in ENTITY.sources}
    batch = standardized_batch(spark, ENTITY, AS_OF, paths)
    columns = [*ENTITY.canonical, "email_domain", "_source_system", "_source_priority"]
    assert sorted(map(str, seen.select(*columns).collect())) == sorted(map(str, batch.select(*columns).collect()))
    files = {r[0].rsplit("/", 1)[-1] for r in spark.read.parquet(tables["erp"]).select("_source_file").distinct().collect()}
    assert files == {"customers-0.parquet", "customers-1.parquet"}


def test_sinks(spark, tmp_path):
    log = str(tmp_path / "log")
    df = spark.createDataFrame([("a", AS_OF)], "x string, checked_at timestamp")
    sinks.append_log(df, log, "checked_at")
    sinks.append_log(df, log, "checked_at")
    assert spark.read.parquet(log).count() == 2
    root = str(tmp_path / "snap")
    sinks.overwrite_snapshot(spark.range(3), root, 1)
    sinks.overwrite_snapshot(spark.range(5), root, 2)
    assert sinks.read_snapshot(spark, root).count() == 5 and sinks.read_snapshot(spark, root, 1).count() == 3
    schema = "a string, b timestamp"
    path = str(tmp_path / "control")
    assert sinks.control_table(spark, path, schema).count() == 0
    sinks.create_if_absent(spark, path, schema)
    spark.createDataFrame([("x", AS_OF)], schema).write.mode("append").parquet(path)
    assert sinks.create_if_absent(spark, path, schema).count() == 1


def test_gold_gate_stops_the_run(spark):
    from assay.operators import quality

    bad = spark.createDataFrame([("g", 0.1, False)], "golden_id string, dq_score double, steward_override boolean")
    with pytest.raises(GateFailure):
        quality.expect_or_fail(bad, quality.gold_expectations(0.85))


def test_a_scorer_of_ones_own_decides_who_passes(spark, run):
    class Strict:
        def score(self, df):
            complete = F.col("email").isNotNull() & F.col("address_line1").isNotNull()
            return df.select("*", F.when(complete, 1.0).otherwise(0.2).alias("dq_score"), F.lit("own").alias("dq_issues"))

    standard, _, _ = run
    m = master(standard, ENTITY, AS_OF, scorer=Strict())
    assert m.passed.filter("email IS NULL OR address_line1 IS NULL").isEmpty()
    assert m.passed.count() + m.quarantine.count() == m.scored.count()
    assert {r[0] for r in m.scored.select("dq_issues").distinct().collect()} == {"own"}
