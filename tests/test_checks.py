from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from assay.operators.quality import GateFailure
from assay.plans import checks, monitoring, reports
from assay.specs import CostSpec, SourceSpec

NOW = datetime(2026, 1, 10, 12)


def test_freshness_states_and_enforcement(spark):
    latest = spark.createDataFrame(
        [("customer", "erp", datetime(2026, 1, 10, 11), None), ("customer", "crm", datetime(2026, 1, 9), None),
         ("customer", "api", None, "no such folder")],
        "entity string, source string, latest timestamp, problem string",
    )
    sla = spark.createDataFrame(
        [("customer", s, 6.0) for s in ("erp", "crm", "api", "flat")], "entity string, source string, sla_hours double"
    )
    out = checks.freshness(latest, sla, NOW)
    rows = {r.source: r for r in out.collect()}
    assert {s: r.status for s, r in rows.items()} == {"erp": "ok", "crm": "stale", "api": "error", "flat": "error"}
    assert rows["crm"].detail == "newest arrival 36.0 hours ago, allowed 6" and rows["erp"].age_hours == 1.0
    assert rows["api"].detail == "no such folder" and rows["flat"].detail == "nothing has arrived"
    status = checks.as_status("freshness", out, F.concat_ws("/", "entity", "source"))
    with pytest.raises(GateFailure, match="error: 2, first customer/api.*stale: 1, first customer/crm"):
        checks.enforce(status)
    fine = status.filter("status = 'ok'")
    assert checks.enforce(fine) is fine


def test_landing_folders(spark, tmp_path):
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "a.csv").write_text("id\n1\n")
    (tmp_path / "empty").mkdir()
    (tmp_path / "schema_only" / "_schema").mkdir(parents=True)
    specs = [SourceSpec(n, "csv", "customer", str(tmp_path / n), 1, 24.0) for n in ("good", "empty", "schema_only", "absent")]
    rows = {r.source: (r.status, r.detail) for r in checks.landing_freshness(spark, specs, datetime.now()).collect()}
    assert rows["good"] == ("ok", None)
    assert rows["empty"] == rows["schema_only"] == ("error", "nothing has arrived")
    assert rows["absent"] == ("error", "no such folder")


def counts(spark, *numbers):
    return spark.createDataFrame(
        [("customer", date(2026, 1, i + 1), n) for i, n in enumerate(numbers)], "entity string, d date, row_count long"
    )


def test_volume_anomaly(spark):
    assert checks.volume_anomaly(counts(spark, 10, 10)).first().status == "skipped"
    assert checks.volume_anomaly(counts(spark, 10, 12, 11)).first().status == "ok"
    far = checks.volume_anomaly(counts(spark, 10, 12, 11, 40)).first()
    assert far.status == "failed" and far.z == pytest.approx(29.0) and far.baseline_std == 1.0
    flat = checks.volume_anomaly(counts(spark, 10, 10, 10, 13)).first()
    assert flat.z == 3.0 and flat.status == "ok"


def test_daily_counts_window(spark):
    df = spark.createDataFrame([("customer", datetime(2026, 1, d)) for d in (1, 2, 2, 9, 10)], "e string, ts timestamp")
    got = {r.d.day: r.row_count for r in checks.daily_counts(df, "e", "ts", date(2026, 1, 10)).collect()}
    assert got == {2: 2, 9: 1, 10: 1}


def test_quarantine_rate(spark):
    df = spark.createDataFrame(
        [("a", 0.5, datetime(2026, 1, 10, 1)), ("a", 0.9, datetime(2026, 1, 10, 2)), ("a", 0.5, datetime(2026, 1, 9)),
         ("b", 0.5, datetime(2026, 1, 9))],
        "entity string, dq_score double, _ingested_at timestamp",
    )
    rows = {r.entity: r for r in checks.quarantine_rate(df, ["a", "b"], 0.85, date(2026, 1, 10), "_ingested_at").collect()}
    assert rows["a"].rate == 0.5 and rows["a"].status == "failed"
    assert rows["b"].rate == 0.0 and rows["b"].scored == 0 and rows["b"].status == "ok"


def test_glossary_is_matched_by_entity_and_column(spark):
    required = spark.createDataFrame([("customer", "dq_score"), ("account", "dq_score")], "entity string, column_name string")
    glossary = spark.createDataFrame([("account", "dq_score")], "entity string, column_name string")
    missing = checks.glossary_coverage(required, glossary)
    assert [tuple(r) for r in missing.collect()] == [("customer", "dq_score")]
    status = {r.subject: r.status for r in checks.missing_status("glossary", required, missing, F.col("column_name")).collect()}
    assert status == {"customer": "failed", "account": "ok"}


def test_lineage_window(spark):
    expected = spark.createDataFrame([("s", "g"), ("s2", "g")], "source_table string, target_table string")
    lineage = spark.createDataFrame(
        [("s", "g", datetime(2026, 1, 9, 1)), ("s2", "g", datetime(2026, 1, 8, 23))],
        "source_table_full_name string, target_table_full_name string, event_time timestamp",
    )
    assert [r.source_table for r in checks.missing_lineage(expected, lineage, date(2026, 1, 10)).collect()] == ["s2"]


def test_cost(spark):
    usage = spark.createDataFrame(
        [
            ("A", 10.0, date(2026, 1, 9), {"project": "p"}, ("x",)),
            ("A", 5.0, date(2026, 1, 9), {}, ("job-p-1",)),
            ("B", 4.0, date(2026, 1, 9), {"project": "p"}, (None,)),
            ("A", 99.0, date(2026, 1, 9), {"project": "q"}, ("x",)),
            ("A", 99.0, date(2026, 1, 10), {"project": "p"}, ("x",)),
            ("C", None, date(2026, 1, 9), {"project": "p"}, ("x",)),
        ],
        "sku_name string, usage_quantity double, usage_date date, custom_tags map<string,string>, usage_metadata struct<job_name:string>",
    )
    mine = checks.tagged_usage(usage, "p")
    by_sku = checks.cost_by_sku(mine, {"A": 2.0, "default": 0.5}, date(2026, 1, 9), date(2026, 1, 10))
    assert {r.sku_name: (r.dbus, r.estimated_usd) for r in by_sku.collect()} == {"A": (15.0, 30.0), "B": (4.0, 2.0), "C": (0.0, 0.0)}
    for soft, hard, want in ((50, 100, "ok"), (25, 100, "warn"), (10, 20, "failed")):
        assert checks.cost_status(by_sku, CostSpec("p", 1, soft, hard, {})).first().status == want
    assert checks.cost_status(by_sku.limit(0), CostSpec("p", 1, 1, 2, {})).first().status == "skipped"


def test_usage_window_reaches_the_scan(spark):
    from workloads import observe

    usage = observe._usage(spark, "/root/testdata/sf0.001")
    plan = checks.cost_by_sku(checks.tagged_usage(usage, "O"), observe.PRICES, *observe.WINDOW)._jdf.queryExecution().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line or "DataFilters" in line]
    assert any("GreaterThanOrEqual(l_shipdate" in line and "LessThan(l_shipdate" in line for line in pushed)


@pytest.mark.parametrize("figures", ["exact", "approx"])
def test_quartiles_of_many_values(spark, figures):
    df = spark.range(250_001).selectExpr("'s' AS s", "timestamp'2026-01-01' AS ts", "double(id) AS v")
    (row,) = monitoring.profile(df, ["s"], "ts", ["v"], [], figures=figures).collect()
    slack = 0 if figures == "exact" else 250_001 / monitoring.QUANTILE_ACCURACY
    assert all(abs(got - want) <= slack for got, want in zip((row.p25, row.p50, row.p75), (62_500, 125_000, 187_500)))
    with pytest.raises(ValueError, match="figures"):
        monitoring.profile(df, ["s"], "ts", ["v"], [], figures="some")


def test_quartiles_of_a_slice_that_holds_all_rows_are_found_by_all_tasks(spark, monkeypatch):
    dealt = []
    plain = monitoring.cut
    monkeypatch.setattr(monitoring, "cut", lambda df: dealt.append(plain(df)) or dealt[-1])
    df = spark.range(60_000).selectExpr("if(id < 10, null, 's') AS s", "timestamp'2026-01-01' AS ts", "double((id * 7919) % 60000) AS v")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        rows = {r.s: (r.p25, r.p50, r.p75) for r in monitoring.profile(df, ["s"], "ts", ["v"], []).collect()}
    finally:
        spark.conf.unset(key)
    values = {None: [], "s": []}
    for i in range(60_000):
        values[None if i < 10 else "s"].append(float((i * 7919) % 60_000))
    assert rows == {k: tuple(sorted(v)[-(-len(v) * q // 4) - 1] for q in (1, 2, 3)) for k, v in values.items()}
    sizes = [r["count"] for r in dealt[0].groupBy("_part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 30_000


def test_daily_sketches_merge_to_weeks_within_their_error(spark):
    df = spark.range(70_000).selectExpr(
        "if(id % 2 = 0, 'a', 'b') AS s",
        "timestamp'2026-01-05' + make_interval(0, 0, 0, int(id % 14)) AS ts",
        "if(id % 10 = 3, null, double((id * 7919) % 70001)) AS v",
        "string(id % 5000) AS c",
    )
    daily = monitoring.sketch_profile(df, ["s"], "ts", ["v"], ["c"])
    assert daily.count() == 2 * 7 * 2 and set(daily.columns) >= {"moments", "quantiles", "distinct"}
    for slices, grain in ((["s"], "week"), ([], "year")):
        days = F.to_date(F.date_trunc(grain, "ts")).alias("day")
        merged = monitoring.sketched_figures(monitoring.merge_sketches(daily, slices, grain), slices)
        exact = df.groupBy(*slices, days).agg(
            F.count("*").alias("rows"), F.count_if(F.col("v").isNull()).alias("nulls"), F.avg("v").alias("mean"),
            F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"), F.sort_array(F.collect_list("v")).alias("all"),
            F.count_distinct("v").alias("dv"), F.count_distinct("c").alias("dc"),
        )
        want = {tuple(r[c] for c in (*slices, "day")): r for r in exact.collect()}
        got = merged.collect()
        assert len(got) == 2 * len(want)
        for r in got:
            e = want[tuple(r[c] for c in (*slices, "day"))]
            assert r.rows == e.rows
            if r.column_name == "c":
                assert r.nulls == 0 and r["mean"] is None and r.p50 is None
                assert abs(r.distinct_values - e.dc) <= 0.03 * e.dc
                continue
            assert r.nulls == e.nulls and r["min"] == e["min"] and r["max"] == e["max"]
            assert r["mean"] == pytest.approx(e["mean"]) and r["std"] == pytest.approx(e["std"])
            assert abs(r.distinct_values - e.dv) <= 0.03 * e.dv
            for q, p in ((0.25, r.p25), (0.5, r.p50), (0.75, r.p75)):
                assert abs(sum(v <= p for v in e["all"]) / len(e["all"]) - q) <= 0.01


def test_profile_and_drift(spark):
    df = spark.createDataFrame(
        [("x", datetime(2026, 1, 1), 1.0), ("x", datetime(2026, 1, 1), None), ("x", datetime(2026, 1, 2), 5.0)],
        "s string, ts timestamp, v double",
    )
    prof = monitoring.profile(df, ["s"], "ts", ["v"], ["s"], figures="exact")
    rows = {(r.day.day, r.column_name): r for r in prof.collect()}
    assert len(rows) == 4 and rows[(1, "v")].nulls == 1 and rows[(1, "v")]["mean"] == 1.0 and rows[(2, "v")]["p50"] == 5.0
    assert rows[(1, "s")].distinct_values == 1 and rows[(1, "s")]["mean"] is None
    change = {r.column_name: r for r in monitoring.drift(prof, ["s"]).collect()}
    assert change["v"].rows_delta == -1 and change["v"].null_rate_delta == -0.5 and change["v"].mean_delta == 4.0
    assert monitoring.profile(df, ["s"], "ts", ["v"], []).count() == 2


def test_distribution_drift(spark):
    df = spark.createDataFrame(
        [("a", datetime(2026, 1, 1))] * 3 + [("b", datetime(2026, 1, 1))] + [("b", datetime(2026, 1, 4))] * 2, "c string, ts timestamp"
    )
    (row,) = monitoring.distribution_drift(df, "c", "ts").collect()
    assert row.day == date(2026, 1, 4) and row.total_variation == 0.75 and row.psi > 0


def test_backlog_counts_whole_hours(spark):
    df = spark.createDataFrame([("c", "q", datetime(2026, 1, 10, 10, 1))], "entity string, record_type string, detected_at timestamp")
    row = reports.backlog_age(df, NOW).first()
    assert (row.backlog_size, row.avg_age_hours, row.oldest_item_hours) == (1, 1.0, 1)


def test_reports_over_several_entities(spark):
    scored = spark.createDataFrame([(0.5, NOW), (1.0, NOW)], "dq_score double, _ingested_at timestamp")
    both = reports.by_entity({"customer": scored, "account": scored})
    rows = reports.dq_trend(both, 0.85, date(2026, 1, 1)).collect()
    assert [(r.entity, r.total, r.quarantined, r.quarantine_pct) for r in rows] == [("account", 2, 1, 50.0), ("customer", 2, 1, 50.0)]
    assert reports.dq_trend(both, 0.85, date(2026, 2, 1)).count() == 0
