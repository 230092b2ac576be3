"""Reports, checks, monitoring and streaming over events, lineitem, documents and orders."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators import quality, review
from assay.operators.standardize import union_all
from assay.plans import checks, monitoring, reports
from assay.session import cut, new_shared_path
from assay.sources import sinks
from assay.sources.bucketed import BucketedTable
from assay.sources.files import list_files, read_batch
from assay.specs import CostSpec, RuleSpec, SourceSpec, load_cost
from assay.streaming import ingest
from workloads.registry import AS_OF, AS_OF_DAY, query, r, table, write_landing

SINCE = date(2024, 1, 1)


def _day(column: str):
    return F.col(column).cast("string").alias(column)


def _log(spark, sf_dir) -> DataFrame:
    """Every event as one freshness check of a source."""
    return table(spark, sf_dir, "events").select(
        F.lit("customer").alias("entity"),
        F.concat(F.lit("src"), F.col("user_id") % 6).alias("source"),
        F.when(F.col("event_type") == "error", "stale").otherwise("ok").alias("status"),
        F.col("ts").alias("checked_at"),
    )


@query(
    "freshness_compliance",
    """SELECT 'customer' AS entity, 'src' || (user_id % 6)::VARCHAR AS source, ts::DATE::VARCHAR AS check_date,
       count(*) AS total_checks, sum((event_type <> 'error')::INT)::BIGINT AS ok_checks,
       round(sum((event_type <> 'error')::INT) * 100.0::DOUBLE / count(*), 1) AS compliance_pct
       FROM events WHERE ts >= TIMESTAMP '2024-01-01' GROUP BY ALL""",
)
def freshness_compliance(spark, sf_dir):
    return reports.freshness_compliance(_log(spark, sf_dir), SINCE).withColumn("check_date", _day("check_date"))


def _scored(spark, sf_dir) -> DataFrame:
    """Every event as one scored record; the score is derived from its value."""
    return table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 2 == 0, "customer").otherwise("account").alias("entity"),
        F.col("ts").alias("_ingested_at"),
        (1 - (F.col("event_id") % 7) / 20.0).cast("double").alias("dq_score"),
    )


_SCORED = """scored AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'customer' ELSE 'account' END AS entity, ts,
    (1 - (event_id % 7) / 20.0::DOUBLE)::DOUBLE AS dq_score FROM events)"""


@query(
    "dq_trend",
    f"""WITH {_SCORED} SELECT entity, ts::DATE::VARCHAR AS d, count(*) AS total, round(avg(dq_score), 6) AS avg_dq_score,
        sum((dq_score < 0.85)::INT)::BIGINT AS quarantined,
        round(sum((dq_score < 0.85)::INT) * 100.0::DOUBLE / count(*), 1) AS quarantine_pct
        FROM scored WHERE ts >= TIMESTAMP '2024-01-01' GROUP BY ALL""",
)
def dq_trend(spark, sf_dir):
    out = reports.dq_trend(_scored(spark, sf_dir), 0.85, SINCE)
    return out.withColumns({"d": _day("d"), "avg_dq_score": r("avg_dq_score")})


def _golden(spark, sf_dir) -> DataFrame:
    """Every order as one golden record merged on its date."""
    confidence = (1 - (F.col("o_orderkey") % 13) / 50.0).cast("double")
    count = F.col("o_orderkey") % 4 + 1
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 2 == 0, "customer").otherwise("account").alias("entity"),
        F.col("o_orderkey").cast("string").alias("golden_id"),
        F.col("o_orderdate").alias("merged_at"),
        confidence.alias("match_confidence"),
        count.alias("source_record_count"),
        F.when(count == 1, "single_source").when(confidence >= 0.9, "auto_merged").otherwise("needs_review").alias("review_status"),
    )


_GOLDEN = """golden AS (SELECT *, CASE WHEN n = 1 THEN 'single_source' WHEN conf >= 0.9 THEN 'auto_merged' ELSE 'needs_review' END AS status
    FROM (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'customer' ELSE 'account' END AS entity, o_orderkey::VARCHAR AS golden_id,
          o_orderdate AS merged_at, (1 - (o_orderkey % 13) / 50.0::DOUBLE)::DOUBLE AS conf, o_orderkey % 4 + 1 AS n FROM orders))"""


@query(
    "merge_trend",
    f"""WITH {_GOLDEN} SELECT entity, merged_at::DATE::VARCHAR AS d, count(*) AS golden_records,
        sum(n)::BIGINT AS source_records_consumed, round(avg(conf), 3) AS avg_match_confidence,
        sum((status = 'auto_merged')::INT)::BIGINT AS auto_merged, sum((status = 'needs_review')::INT)::BIGINT AS needs_review,
        sum((status = 'single_source')::INT)::BIGINT AS single_source FROM golden GROUP BY ALL""",
)
def merge_trend(spark, sf_dir):
    return reports.merge_trend(_golden(spark, sf_dir)).withColumn("d", _day("d"))


def _queue(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 2 == 0, "customer").otherwise("account").alias("entity"),
        F.when(F.col("event_type") == "error", review.DQ_QUARANTINE).otherwise(review.LOW_CONFIDENCE).alias("record_type"),
        F.col("ts").alias("detected_at"),
    )


@query(
    "backlog_age",
    """SELECT entity, record_type, count(*) AS backlog_size, round(avg(h), 1) AS avg_age_hours, max(h) AS oldest_item_hours
    FROM (SELECT CASE WHEN user_id % 2 = 0 THEN 'customer' ELSE 'account' END AS entity,
                 CASE WHEN event_type = 'error' THEN 'dq_quarantine' ELSE 'low_confidence_match' END AS record_type,
                 datesub('hour', ts, TIMESTAMP '2024-01-31') AS h FROM events) GROUP BY ALL""",
)
def backlog_age(spark, sf_dir):
    return reports.backlog_age(_queue(spark, sf_dir), AS_OF)


@query(
    "decision_throughput",
    """SELECT 'customer' AS entity, CASE WHEN user_id % 2 = 0 THEN 'dq_quarantine' ELSE 'low_confidence_match' END AS record_type,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'approved' ELSE 'rejected' END AS decision,
    ts::DATE::VARCHAR AS d, count(*) AS decisions FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY ALL""",
)
def decision_throughput(spark, sf_dir):
    decisions = table(spark, sf_dir, "events").select(
        F.lit("customer").alias("entity"),
        F.when(F.col("user_id") % 2 == 0, review.DQ_QUARANTINE).otherwise(review.LOW_CONFIDENCE).alias("record_type"),
        F.when(F.col("event_type").isin("purchase", "signup"), "approved").otherwise("rejected").alias("decision"),
        F.col("ts").alias("decided_at"),
    )
    return reports.decision_throughput(decisions, date(2024, 1, 10)).withColumn("d", _day("d"))


@query(
    "freshness_status",
    """WITH s AS (SELECT 'u' || user_id::VARCHAR AS source, user_id % 24 + 1 AS sla, max(ts) AS latest FROM events GROUP BY ALL),
    a AS (SELECT *, epoch_us(TIMESTAMP '2024-01-31') / 3.6e9 - epoch_us(latest) / 3.6e9 AS age FROM s)
    SELECT 'events' AS entity, source, CASE WHEN age > sla THEN 'stale' ELSE 'ok' END AS status, round(age, 4) AS age_hours,
           sla::DOUBLE AS sla_hours FROM a""",
)
def freshness_status(spark, sf_dir):
    """Newest event of every user against an allowed age of 1 to 24 hours."""
    events = table(spark, sf_dir, "events").withColumn("source", F.concat(F.lit("u"), F.col("user_id")))
    sla = events.select(
        F.lit("events").alias("entity"), "source", (F.col("user_id") % 24 + 1).cast("double").alias("sla_hours")
    ).distinct()
    out = checks.event_freshness(events, sla, AS_OF, "source", "ts", "events")
    return out.drop("detail", "checked_at").withColumn("age_hours", r("age_hours", 4))


@query(
    "volume_anomaly",
    """WITH c AS (SELECT event_type AS entity, ts::DATE AS d, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-22'
                  GROUP BY ALL),
    x AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY d DESC) AS rn FROM c),
    s AS (SELECT entity, max(d) FILTER (rn = 1) AS d, max(n) FILTER (rn = 1) AS row_count, count(*) AS days,
                 avg(n) FILTER (rn > 1) AS m, stddev_samp(n) FILTER (rn > 1) AS sd FROM x GROUP BY entity)
    SELECT entity, d::VARCHAR AS d, row_count, days, round(m, 6) AS baseline_mean, round(sd, 6) AS baseline_std,
           round((row_count - m) / (CASE WHEN sd = 0 THEN 1 ELSE sd END), 6) AS z,
           CASE WHEN days < 3 THEN 'skipped' WHEN abs((row_count - m) / (CASE WHEN sd = 0 THEN 1 ELSE sd END)) > 3.0
                THEN 'failed' ELSE 'ok' END AS status FROM s""",
)
def volume_anomaly(spark, sf_dir):
    counts = checks.daily_counts(table(spark, sf_dir, "events"), "event_type", "ts", date(2024, 1, 30))
    out = checks.volume_anomaly(counts).drop("detail").withColumn("d", _day("d"))
    return out.withColumns({c: r(c) for c in ("baseline_mean", "baseline_std", "z")})


@query(
    "quarantine_rate",
    f"""WITH {_SCORED} SELECT entity, count(*) FILTER (ts >= TIMESTAMP '2024-01-30' AND dq_score < 0.85) AS quarantined,
        count(*) FILTER (ts >= TIMESTAMP '2024-01-30') AS scored,
        round(count(*) FILTER (ts >= TIMESTAMP '2024-01-30' AND dq_score < 0.85)
              / greatest(count(*) FILTER (ts >= TIMESTAMP '2024-01-30'), 1), 6) AS rate,
        CASE WHEN count(*) FILTER (ts >= TIMESTAMP '2024-01-30' AND dq_score < 0.85)
              / greatest(count(*) FILTER (ts >= TIMESTAMP '2024-01-30'), 1) > 0.15 THEN 'failed' ELSE 'ok' END AS status
        FROM scored GROUP BY entity""",
)
def quarantine_rate(spark, sf_dir):
    out = checks.quarantine_rate(_scored(spark, sf_dir), ["customer", "account"], 0.85, date(2024, 1, 30), "_ingested_at")
    return out.drop("detail").withColumn("rate", r("rate"))


def _glossary(spark, sf_dir) -> DataFrame:
    """A glossary with one term per user and event type that occurred in the first days."""
    early = table(spark, sf_dir, "events").filter(F.col("ts") < F.lit(date(2024, 1, 5)).cast("timestamp"))
    return early.groupBy(F.col("user_id").cast("string").alias("entity"), F.col("event_type").alias("column_name")).agg(
        F.lit("seen").alias("glossary_term"), F.lit("team").alias("steward"),
        F.max("ts").cast("timestamp_ntz").alias("registered_at"),
    )


def _submissions(spark, sf_dir) -> DataFrame:
    """Later events as submitted terms; several approved ones may share a key."""
    late = table(spark, sf_dir, "events").filter(F.col("ts") >= F.lit(date(2024, 1, 5)).cast("timestamp"))
    return late.select(
        F.col("event_id").cast("string").alias("submission_id"),
        F.col("user_id").cast("string").alias("entity"),
        F.col("event_type").alias("column_name"),
        F.concat(F.lit("term "), F.col("event_id")).alias("proposed_term"),
        F.concat(F.lit("by "), F.col("event_id") % 5).alias("submitted_by"),
        F.when(F.col("event_id") % 3 == 0, "approved").otherwise("pending").alias("status"),
        F.col("ts").cast("timestamp_ntz").alias("reviewed_at"),
    )


_GLOSSARY = """glossary AS (SELECT user_id::VARCHAR AS entity, event_type AS column_name, 'seen' AS glossary_term, 'team' AS steward
    FROM events WHERE ts < TIMESTAMP '2024-01-05' GROUP BY ALL),
    approved AS (SELECT * FROM (SELECT user_id::VARCHAR AS entity, event_type AS column_name, 'term ' || event_id::VARCHAR AS glossary_term,
        'by ' || (event_id % 5)::VARCHAR AS steward,
        row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, 'term ' || event_id::VARCHAR DESC) AS rn
        FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND event_id % 3 = 0) WHERE rn = 1),
    merged AS (SELECT * FROM glossary ANTI JOIN approved USING (entity, column_name)
               UNION ALL SELECT * EXCLUDE (rn) FROM approved)"""


@query("glossary_upsert", f"WITH {_GLOSSARY} SELECT * FROM merged")
def glossary_upsert(spark, sf_dir):
    """Approved terms merged into a stored glossary, of which only the buckets of their keys are rewritten."""
    stored = BucketedTable(spark, new_shared_path(spark, "glossary"), list(review.GLOSSARY_KEY))
    stored.replace(_glossary(spark, sf_dir).withColumn("registered_at", F.col("registered_at").cast("timestamp_ntz")))
    stored.merge(review.approved_terms(_submissions(spark, sf_dir)), "registered_at")
    return stored.read().drop("registered_at")


@query(
    "glossary_missing",
    f"""WITH {_GLOSSARY}, required AS (SELECT DISTINCT user_id::VARCHAR AS entity, event_type AS column_name FROM events)
    SELECT * FROM required ANTI JOIN glossary USING (entity, column_name)""",
)
def glossary_missing(spark, sf_dir):
    required = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("entity"), F.col("event_type").alias("column_name")
    )
    return checks.glossary_coverage(required.distinct(), _glossary(spark, sf_dir))


@query(
    "lineage_missing",
    """WITH expected AS (SELECT DISTINCT 'silver.' || event_type AS source_table, 'gold.u' || user_id::VARCHAR AS target_table FROM events)
    SELECT * FROM expected ANTI JOIN (
        SELECT 'silver.' || event_type AS source_table, 'gold.u' || user_id::VARCHAR AS target_table FROM events
        WHERE ts >= TIMESTAMP '2024-01-29') USING (source_table, target_table)""",
)
def lineage_missing(spark, sf_dir):
    lineage = table(spark, sf_dir, "events").select(
        F.concat(F.lit("silver."), "event_type").alias("source_table_full_name"),
        F.concat(F.lit("gold.u"), "user_id").alias("target_table_full_name"),
        F.col("ts").alias("event_time"),
    )
    expected = lineage.select(
        F.col("source_table_full_name").alias("source_table"), F.col("target_table_full_name").alias("target_table")
    ).distinct()
    return checks.missing_lineage(expected, lineage, date(2024, 1, 30))


# order lines as metered usage: return flag as SKU, quantity as units, ship date as usage date
PRICES = {"A": 0.40, "N": 0.15, "default": 0.25}
WINDOW = (date(1997, 1, 1), date(1999, 1, 1))


def _usage(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("sku_name"),
        F.col("l_quantity").alias("usage_quantity"),
        F.col("l_shipdate").alias("usage_date"),
        F.create_map(F.lit("project"), F.col("l_linestatus")).alias("custom_tags"),
        F.struct(F.concat(F.lit("job-"), F.col("l_suppkey") % 10).alias("job_name")).alias("usage_metadata"),
    )


_COST = """cost AS (SELECT l_returnflag AS sku_name, sum(l_quantity) AS dbus FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'
      AND (l_linestatus = 'O' OR 'job-' || (l_suppkey % 10)::VARCHAR LIKE '%O%') GROUP BY 1)"""
_PRICE = "CASE sku_name WHEN 'A' THEN 0.40::DOUBLE WHEN 'N' THEN 0.15::DOUBLE ELSE 0.25::DOUBLE END"


@query(
    "cost_by_sku",
    f"""WITH {_COST} SELECT '1997-01-01' AS window_start, '1999-01-01' AS window_end, sku_name, round(dbus, 4) AS dbus,
        round(dbus * {_PRICE}, 4) AS estimated_usd FROM cost""",
)
def cost_by_sku(spark, sf_dir):
    out = checks.cost_by_sku(checks.tagged_usage(_usage(spark, sf_dir), "O"), PRICES, *WINDOW)
    return out.withColumns(
        {"window_start": _day("window_start"), "window_end": _day("window_end"), "dbus": r("dbus", 4), "estimated_usd": r("estimated_usd", 4)}
    )


@query(
    "cost_status",
    f"""WITH {_COST}, t AS (SELECT count(*) AS skus, sum(dbus * {_PRICE}) AS usd FROM cost)
    SELECT skus, round(usd, 4) AS total_usd, CASE WHEN usd > 100 THEN 'failed' WHEN usd > 25 THEN 'warn' ELSE 'ok' END AS status FROM t""",
)
def cost_status(spark, sf_dir):
    limits = load_cost(project_tag="O")
    spec = CostSpec(limits.project_tag, limits.lookback_days, limits.daily_budget_usd, limits.hard_limit_usd, PRICES)
    by_sku = checks.cost_by_sku(checks.tagged_usage(_usage(spark, sf_dir), "O"), PRICES, *WINDOW)
    return checks.cost_status(by_sku, spec).drop("detail").withColumn("total_usd", r("total_usd", 4))


def _profiled(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 10 != 0, F.col("value")))
    return monitoring.profile(events, ["event_type"], "ts", ["value"], ["user_id"], figures="exact")


_PROFILE = """e AS (SELECT event_type, ts::DATE AS day, CASE WHEN event_id % 10 <> 0 THEN value END AS value, user_id FROM events),
    p AS (SELECT event_type, day, 'value' AS column_name, count(*) AS rows, count(*) - count(value) AS nulls,
                 count(DISTINCT value) AS distinct_values, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
                 max(value) AS max, quantile_disc(value, 0.25) AS p25, quantile_disc(value, 0.5) AS p50,
                 quantile_disc(value, 0.75) AS p75 FROM e GROUP BY ALL
          UNION ALL
          SELECT event_type, day, 'user_id', count(*), count(*) - count(user_id), count(DISTINCT user_id),
                 NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM e GROUP BY ALL)"""
_ROUNDED = ("mean", "std", "min", "max", "p25", "p50", "p75")


@query(
    "profile",
    f"WITH {_PROFILE} SELECT event_type, day::VARCHAR AS day, column_name, rows, nulls, distinct_values, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in _ROUNDED) + " FROM p",
)
def profile(spark, sf_dir):
    return _profiled(spark, sf_dir).withColumns({"day": _day("day"), **{c: r(c) for c in _ROUNDED}})


@query(
    "weekly_profile",
    """WITH e AS (SELECT event_type, date_trunc('week', ts)::DATE AS week, CASE WHEN event_id % 10 <> 0 THEN value END AS value, user_id FROM events)
    SELECT event_type, week::VARCHAR AS week, 'value' AS column_name, count(*) AS rows, count(*) - count(value) AS nulls,
        round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max,
        true AS estimates_hold FROM e GROUP BY ALL
    UNION ALL SELECT event_type, week::VARCHAR, 'user_id', count(*), count(*) - count(user_id), NULL, NULL, NULL, NULL, true FROM e GROUP BY ALL""",
)
def weekly_profile(spark, sf_dir):
    """Weekly figures merged from stored daily sketches, and whether the estimates lie within their error bounds."""
    events = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 10 != 0, F.col("value")))
    daily = cut(monitoring.sketch_profile(events, ["event_type"], "ts", ["value"], ["user_id"]))
    weekly = cut(monitoring.sketched_figures(monitoring.merge_sketches(daily, ["event_type"]), ["event_type"]))
    quartiles = weekly.filter("column_name = 'value'").select("event_type", "day", "p25", "p50", "p75")
    held = events.withColumn("day", F.trunc(F.to_date("ts"), "week")).join(quartiles, ["event_type", "day"])
    n, slack = F.count("value"), 0.01
    within = [
        (F.count(F.when(F.col("value") < F.col(p), 1)) / n <= q + slack) & (F.count(F.when(F.col("value") <= F.col(p), 1)) / n >= q - slack)
        for p, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    ]
    exact = held.groupBy("event_type", "day").agg(
        (within[0] & within[1] & within[2]).alias("ranks_hold"),
        F.count_distinct("value").alias("value"),
        F.count_distinct("user_id").alias("user_id"),
    )
    is_value = F.col("column_name") == "value"
    distinct = F.when(is_value, F.col("value")).otherwise(F.col("user_id"))
    counted = F.abs(F.col("distinct_values") - distinct) <= distinct * 0.03 + 1
    return weekly.join(exact, ["event_type", "day"]).select(
        "event_type", _day("day").alias("week"), "column_name", "rows", "nulls",
        *[r(c) for c in ("mean", "std", "min", "max")],
        (counted & (F.col("ranks_hold") | ~is_value)).alias("estimates_hold"),
    )


@query(
    "drift",
    f"""WITH {_PROFILE}, x AS (SELECT *, lag(day) OVER w AS pd, lag(rows) OVER w AS pr, lag(nulls) OVER w AS pn, lag(mean) OVER w AS pm
        FROM p WINDOW w AS (PARTITION BY event_type, column_name ORDER BY day))
    SELECT event_type, day::VARCHAR AS day, pd::VARCHAR AS previous_day, column_name, rows - pr AS rows_delta,
           round(nulls / rows - pn / pr, 6) AS null_rate_delta, round(mean - pm, 6) AS mean_delta FROM x WHERE pd IS NOT NULL""",
)
def drift(spark, sf_dir):
    out = monitoring.drift(_profiled(spark, sf_dir), ["event_type"])
    return out.withColumns(
        {"day": _day("day"), "previous_day": _day("previous_day"), "null_rate_delta": r("null_rate_delta"), "mean_delta": r("mean_delta")}
    )


@query(
    "distribution_drift",
    """WITH c AS (SELECT ts::DATE AS day, event_type AS v, count(*) AS n FROM events GROUP BY ALL),
    t AS (SELECT day, sum(n) AS total, lag(day) OVER (ORDER BY day) AS pd FROM c GROUP BY day),
    s AS (SELECT c.day, v, n / total AS share, pd FROM c JOIN t USING (day)),
    j AS (SELECT coalesce(a.day, nx.day) AS day, coalesce(a.share, 0) AS p, coalesce(b.share, 0) AS q
          FROM (SELECT * FROM s WHERE pd IS NOT NULL) a
          FULL JOIN (SELECT s.v, s.share, t.day FROM s JOIN t ON t.pd = s.day) b ON b.day = a.day AND b.v = a.v
          LEFT JOIN t nx ON nx.day = b.day)
    SELECT day::VARCHAR AS day, count(*) AS values, round(sum(abs(p - q)) / 2, 6) AS total_variation,
           round(sum(((p + 1e-6) - (q + 1e-6)) * ln((p + 1e-6) / (q + 1e-6))), 6) AS psi FROM j GROUP BY day""",
)
def distribution_drift(spark, sf_dir):
    out = monitoring.distribution_drift(table(spark, sf_dir, "events"), "event_type", "ts")
    return out.withColumns({"day": _day("day"), "total_variation": r("total_variation"), "psi": r("psi")})


# ---- quality rules over whole document texts

DOCUMENT_RULES = (
    RuleSpec("text_not_null", "text", "not_null", "critical"),
    RuleSpec("lang_valid", "lang", "allowed_values", "warn", values=("en", "de", "fr")),
    RuleSpec("source_format", "source", "regex", "warn", pattern="^src[0-9]$"),
    RuleSpec("has_sentence_end", "text", "regex", "warn", pattern=r"[.!?]"),
)


@query(
    "dq_documents",
    """SELECT doc_id, round((1.0 + 0.5 * lang_ok + 0.5 * source_ok + 0.5 * text_ok) / 2.5, 6) AS dq_score,
       concat_ws(',', CASE WHEN lang_ok = 0 THEN 'lang_valid' END, CASE WHEN source_ok = 0 THEN 'source_format' END,
                 CASE WHEN text_ok = 0 THEN 'has_sentence_end' END) AS dq_issues
       FROM (SELECT doc_id, (lang IN ('en', 'de', 'fr'))::INT::DOUBLE AS lang_ok,
                    regexp_matches(source, '^src[0-9]$')::INT::DOUBLE AS source_ok,
                    regexp_matches(text, '[.!?]')::INT::DOUBLE AS text_ok FROM documents)""",
)
def dq_documents(spark, sf_dir):
    scored = quality.score(table(spark, sf_dir, "documents"), DOCUMENT_RULES)
    return scored.select("doc_id", r("dq_score"), "dq_issues")


# ---- streaming: the events file as a landing drop

EVENTS = SourceSpec(
    "events", "parquet", "event", "", 1, 24.0,
    {"event_id": "event_id", "event_type": "event_type", "user_id": "user_id"},
)


def _ingested(spark, sf_dir) -> DataFrame:
    root = new_shared_path(spark, "stream")
    ingest.ingest_source(
        spark, EVENTS, sf_dir, f"{root}/bronze", f"{root}/checkpoint", as_of=AS_OF,
        schema=table(spark, sf_dir, "events").schema, pattern="events.parquet",
    ).awaitTermination()
    return spark.read.parquet(f"{root}/bronze")


@query(
    "stream_ingest",
    "SELECT event_id, user_id, event_type, value, 'events' AS source_system, 1 AS source_priority, "
    "'events.parquet' AS source_file FROM events",
)
def stream_ingest(spark, sf_dir):
    return _ingested(spark, sf_dir).select(
        "event_id", "user_id", "event_type", "value",
        F.col("_source_system").alias("source_system"),
        F.col("_source_priority").alias("source_priority"),
        F.element_at(F.split("_source_file", "/"), -1).alias("source_file"),
    )


@query(
    "stream_standardize",
    "SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, upper(event_type) AS event_type, "
    "NULL::VARCHAR AS channel, 'events' AS source_system FROM events",
)
def stream_standardize(spark, sf_dir):
    """Raw and standardised stream, each with its own checkpoint."""
    from dataclasses import replace

    from assay.specs import load_entity

    entity = replace(
        load_entity("account"), entity="event", canonical=("event_id", "user_id", "event_type", "channel"),
        sources=(EVENTS,), title_case=(), upper_case=("event_type",),
    )
    root = new_shared_path(spark, "stream")
    raw = {"events": f"{root}/bronze"}
    ingest.ingest_source(
        spark, EVENTS, sf_dir, raw["events"], f"{root}/bronze-checkpoint", as_of=AS_OF,
        schema=table(spark, sf_dir, "events").schema, pattern="events.parquet",
    ).awaitTermination()
    ingest.refresh_standardized(spark, entity, raw, f"{root}/silver", f"{root}/silver-checkpoint")
    return spark.read.parquet(f"{root}/silver").select(*entity.canonical, F.col("_source_system").alias("source_system"))


def _landed(spark, sf_dir) -> tuple[str, list[str]]:
    """All orders as landing files, a source per priority, and an empty folder beside them."""
    root = new_shared_path(spark, "landing")
    orders = table(spark, sf_dir, "orders").withColumn("priority", F.substring("o_orderpriority", 1, 1))
    orders.write.partitionBy("priority").parquet(root)
    orders.limit(0).write.format("csv").save(f"{root}/priority=empty")
    return root, ["1", "2", "3", "4", "5", "empty", "absent"]


@query(
    "landing_freshness",
    """SELECT 'orders' AS entity, source,
        CASE WHEN source IN ('empty', 'absent') THEN 'error' WHEN source IN ('1', '3', '5') THEN 'ok' ELSE 'stale' END AS status
        FROM (VALUES ('1'), ('2'), ('3'), ('4'), ('5'), ('empty'), ('absent')) t(source)
        WHERE source IN ('empty', 'absent') OR source IN (SELECT DISTINCT substr(o_orderpriority, 1, 1) FROM orders)""",
)
def landing_freshness(spark, sf_dir):
    """Files landed by this query: in time, late, none in the folder, no folder."""
    root, names = _landed(spark, sf_dir)
    hours = {n: 1_000.0 if n in "135" else 24.0 for n in names}
    specs = [SourceSpec(n, "parquet", "orders", f"{root}/priority={n}", 1, hours[n]) for n in names]
    # by the files' own times, not a clock: all are 100 hours old, and only the limits differ
    newest = list_files(spark, root, "*.parquet").agg(F.max("modificationTime")).first()[0]
    return checks.landing_freshness(spark, specs, newest + timedelta(hours=100)).select("entity", "source", "status")


# ---- files of other formats: by name, with columns in another order and columns nobody asked for

_PARTS_SOURCE = {"part_id": "p_partkey", "part_name": "p_name", "brand": "p_brand", "price": "p_retailprice"}
_PARTS_SQL = """SELECT p_partkey::VARCHAR AS part_id, p_name AS part_name, p_brand AS brand,
    round(p_retailprice, 6) AS price, p_size::VARCHAR AS extra FROM part"""


def _landed_parts(spark, sf_dir, kind: str) -> tuple[SourceSpec, str]:
    path = new_shared_path(spark, f"parts-{kind}")
    part = table(spark, sf_dir, "part").select("p_size", "p_retailprice", "p_brand", "p_name", "p_type", "p_partkey")
    write_landing(part, kind, path)
    return SourceSpec("parts", kind, "part", path, 1, 24.0, _PARTS_SOURCE), path


def _named(raw: DataFrame) -> DataFrame:
    mapped = [F.col(c).alias(n) for n, c in _PARTS_SOURCE.items() if n != "price"]
    price = F.round(F.col("p_retailprice").cast("double"), 6).alias("price")
    return raw.select(*mapped, price, F.col("p_size").alias("extra"))


@query("csv_by_name", _PARTS_SQL)
def csv_by_name(spark, sf_dir):
    """All parts through CSV files whose columns are in another order than the settings."""
    return _named(read_batch(spark, _landed_parts(spark, sf_dir, "csv")[0]))


@query("json_by_name", _PARTS_SQL)
def json_by_name(spark, sf_dir):
    """All parts through JSON files of arrays of records."""
    return _named(read_batch(spark, _landed_parts(spark, sf_dir, "json")[0]))


@query("csv_stream_by_name", _PARTS_SQL)
def csv_stream_by_name(spark, sf_dir):
    """All parts through CSV files as a stream that remembers its schema."""
    source, path = _landed_parts(spark, sf_dir, "csv")
    root = new_shared_path(spark, "parts-stream")
    ingest.ingest_source(spark, source, path, f"{root}/raw", f"{root}/checkpoint", as_of=AS_OF).awaitTermination()
    return _named(spark.read.parquet(f"{root}/raw"))


# ---- landing files whose columns change

_DROPS = (
    ("p_partkey", "p_name", "p_size", "p_retailprice"),
    ("p_name", "p_partkey", "p_brand", "p_retailprice"),
    ("p_brand", "p_partkey", "concat('size ', p_size) AS p_size", "p_name"),
)
_EVOLVED_SQL = """SELECT p_partkey AS part_id, p_name AS part_name, CASE WHEN p_partkey % 3 > 0 THEN p_brand END AS brand,
    CASE WHEN p_partkey % 3 = 0 THEN p_size::BIGINT END AS size, CASE WHEN p_partkey % 3 < 2 THEN p_retailprice END AS price,
    CASE WHEN p_partkey % 3 = 2 THEN 'size ' || p_size END AS rescued_size, 'parts' AS source FROM part"""


def _evolved(spark, sf_dir, kind: str) -> DataFrame:
    """Parts in three drops: a new column and a missing one in the second, text for a number in the third."""
    root = new_shared_path(spark, f"evolved-{kind}")
    source = SourceSpec("parts", kind, "part", f"{root}/landing", 1, 24.0, {"part_id": "p_partkey", "part_name": "p_name"})
    part = table(spark, sf_dir, "part").withColumn("p_size", F.col("p_size").cast("long"))
    for i, columns in enumerate(_DROPS):
        drop = part.filter(F.col("p_partkey") % 3 == i).selectExpr(*columns)
        write_landing(drop, kind, f"{root}/landing/drop{i}")
        ingest.land_evolving(
            spark, source, f"{root}/landing", f"{root}/raw", f"{root}/checkpoint", as_of=AS_OF,
            pattern="part-*", infer=True,
        ).awaitTermination()
    landed = ingest.read_landed(spark, f"{root}/raw")
    return landed.select(
        F.col("p_partkey").alias("part_id"),
        F.col("p_name").alias("part_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
        F.try_element_at("_rescued", F.lit("p_size")).alias("rescued_size"),
        F.col("_source_system").alias("source"),
    )


@query("evolved_csv", _EVOLVED_SQL)
def evolved_csv(spark, sf_dir):
    """Three drops of CSV files through a stream whose schema follows them; no value is lost."""
    return _evolved(spark, sf_dir, "csv")


@query("evolved_json", _EVOLVED_SQL)
def evolved_json(spark, sf_dir):
    """The same from files of JSON arrays."""
    return _evolved(spark, sf_dir, "json")


@query("evolved_parquet", _EVOLVED_SQL)
def evolved_parquet(spark, sf_dir):
    """The same from Parquet files whose footers disagree."""
    return _evolved(spark, sf_dir, "parquet")


# ---- logs, snapshots and control tables, written and read back


@query("log_append", "SELECT event_id, event_type, ts::DATE::VARCHAR AS log_day FROM events")
def log_append(spark, sf_dir):
    """Events appended in two runs to a log partitioned by day, one of them repeated."""
    path = new_shared_path(spark, "log")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    for part in (0, 1, 0):
        sinks.append_log(events.filter(F.col("event_id") % 2 == part), path, "ts", run=f"part {part}")
    return sinks.read_log(spark, path).select("event_id", "event_type", _day("log_day"))


@query(
    "snapshot_versions",
    """SELECT 'first' AS which, count(*) AS orders, round(sum(o_totalprice), 4) AS total FROM orders
    UNION ALL SELECT 'current', count(*), round(sum(o_totalprice * 2), 4) FROM orders""",
)
def snapshot_versions(spark, sf_dir):
    """Two versions of a table; the older one stays readable, and writing one again replaces it."""
    root = new_shared_path(spark, "snapshot")
    orders = table(spark, sf_dir, "orders")
    sinks.overwrite_snapshot(orders.limit(0), root, 1)
    sinks.overwrite_snapshot(orders, root, 1)
    sinks.overwrite_snapshot(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), root, 2)
    held = [("first", sinks.read_snapshot(spark, root, 1)), ("current", sinks.read_snapshot(spark, root))]
    total = [F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 4).alias("total")]
    return union_all([df.agg(*total).select(F.lit(n).alias("which"), "*") for n, df in held])


@query("control_table", "SELECT c_custkey, c_name FROM customer")
def control_table(spark, sf_dir):
    """A control table created empty, created again without harm, then filled."""
    path = new_shared_path(spark, "control")
    schema = "c_custkey long, c_name string"
    for _ in range(2):
        sinks.create_if_absent(spark, path, schema)
    table(spark, sf_dir, "customer").select("c_custkey", "c_name").write.mode("append").parquet(path)
    return sinks.control_table(spark, path, schema)
