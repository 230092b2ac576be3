"""Customer mastering over four sources derived from customer, orders and supplier.

The raw expressions below are plain SQL that Spark and the check run alike; they add the usual
dirt (case, blanks, nulls, junk, mixed dates) by arithmetic on the keys. Everything after the raw
rows is done by the library on one side and by independent SQL on the other.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import blocking, evaluate, quality, review
from assay.operators.matching import MEMBER, match_records
from assay.operators.standardize import (
    latest_per_record,
    mask_columns,
    standardize,
    union_all,
    with_provenance,
    with_record_key,
)
from assay.plans import reports
from assay.plans.mastering import Mastered, master
from assay.session import cut, new_shared_path
from assay.specs import load_entity
from assay.streaming import ingest
from workloads.registry import AS_OF, components_sql, query, r, table, write_landing

ENTITY = load_entity("customer")
MIN = ENTITY.min_score


def _text(x: str) -> str:
    return f"cast({x} as string)"


def _pad(x: str, n: int) -> str:
    return f"lpad({_text(x)}, {n}, '0')"


def _country(k: str) -> str:
    return (
        f"CASE {k} % 7 WHEN 0 THEN 'US' WHEN 1 THEN 'ca' WHEN 2 THEN 'UK' WHEN 3 THEN 'IN' "
        f"WHEN 4 THEN 'de' WHEN 5 THEN 'FR' ELSE 'AU' END"
    )


def _postal(k: str) -> str:
    return _text(f"10000 + ({k} % 40) * 1000 + ({k} * 7) % 1000")


# raw rows per source: (table, {raw column: expression}, group by)
_RAW = {
    "erp": (
        "customer",
        {
            "cust_no": "'C' || " + _text("c_custkey"),
            "cust_name": "CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN upper(c_name) ELSE c_name END",
            "email_addr": "CASE WHEN c_custkey % 11 = 0 THEN 'not-an-email' ELSE 'Customer' || "
            + _pad("c_custkey", 9) + " || '@mail.example' END",
            "fed_tax_id": "CASE WHEN c_custkey % 19 = 0 THEN '???' ELSE 'TAX-' || " + _pad("c_custkey", 6) + " END",
            "addr1": _text("c_custkey % 997") + " || ' Main St'",
            "ctry_cd": _country("c_custkey"),
            "zip_cd": _postal("c_custkey"),
            "last_upd_ts": _text("1996 + c_custkey % 6") + " || '-' || " + _pad("1 + c_custkey % 12", 2)
            + " || '-' || " + _pad("1 + c_custkey % 28", 2),
        },
        "",
    ),
    "crm": (
        "orders",
        {
            "account_id": "'A' || " + _text("o_custkey"),
            "account_name": "CASE WHEN o_custkey % 5 = 0 THEN 'Customer ' || " + _pad("o_custkey", 9)
            + " WHEN o_custkey % 7 = 1 THEN '  customer#' || " + _pad("o_custkey", 9)
            + " || ' ' ELSE 'Customer#' || " + _pad("o_custkey", 9) + " END",
            "primary_email": "CASE WHEN o_custkey % 13 = 0 THEN 'not-an-email' WHEN o_custkey % 17 = 0 THEN NULL "
            "ELSE 'customer' || " + _pad("o_custkey", 9) + " || '@MAIL.example' END",
            "vat_number": "CASE WHEN o_custkey % 23 = 0 THEN NULL ELSE 'TAX-' || " + _pad("o_custkey", 6) + " END",
            "billing_address": _text("o_custkey % 997") + " || CASE WHEN o_custkey % 3 = 0 THEN ' Main Street' ELSE ' Main St' END",
            "country": "CASE WHEN o_custkey % 31 = 0 THEN 'ZZ' ELSE " + _country("o_custkey") + " END",
            "postal_code": "CASE WHEN o_custkey % 37 = 0 THEN NULL ELSE " + _postal("o_custkey") + " END",
            "modified_date": _pad("month(max(o_orderdate))", 2) + " || '/' || " + _pad("day(max(o_orderdate))", 2)
            + " || '/' || " + _text("year(max(o_orderdate))"),
        },
        "GROUP BY o_custkey, o_orderstatus",
    ),
    "flatfile": (
        "supplier",
        {
            "id": "'S' || " + _text("s_suppkey"),
            "name": "lower(s_name)",
            "email": "CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE 'supplier' || " + _pad("s_suppkey", 9) + " || '@parts.example' END",
            "tax_id": "'SUP-' || " + _pad("s_suppkey", 6),
            "address": _text("s_suppkey % 89") + " || ' Dock Rd'",
            "country": _country("s_suppkey"),
            "zip": _postal("s_suppkey"),
            "load_date": _text("1999 + s_suppkey % 3") + " || " + _pad("1 + s_suppkey % 12", 2) + " || " + _pad("1 + s_suppkey % 28", 2),
        },
        "",
    ),
    "partner_api": (
        "supplier",
        {
            "partnerCustomerId": "'P' || " + _text("s_suppkey"),
            "legalName": "CASE WHEN s_suppkey % 6 = 0 THEN 'S. #' || " + _pad("s_suppkey", 9) + " ELSE s_name END",
            "contactEmail": "'SUPPLIER' || " + _pad("s_suppkey", 9) + " || '@parts.example'",
            "taxIdentifier": "CASE WHEN s_suppkey % 8 = 0 THEN '???' ELSE 'SUP-' || " + _pad("s_suppkey", 6) + " END",
            "address": _text("s_suppkey % 89") + " || ' Dock Road'",
            "countryCode": _country("s_suppkey"),
            "postalCode": _postal("s_suppkey"),
            "lastModified": "CASE WHEN s_suppkey % 10 = 0 THEN 'unknown' ELSE '2000-' || " + _pad("1 + s_suppkey % 12", 2) + " || '-15' END",
        },
        "",
    ),
}


def raw_sql(source: str, qualifier: str = "") -> str:
    base, columns, tail = _RAW[source]
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {qualifier}{base} {tail}"


def raw(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    base, columns, tail = _RAW[source]
    rows = table(spark, sf_dir, base)
    if tail:
        grouped = rows.groupBy("o_custkey", "o_orderstatus").agg(F.max("o_orderdate").alias("_last"))
        return grouped.select(*[F.expr(e.replace("max(o_orderdate)", "_last")).alias(c) for c, e in columns.items()])
    return rows.select(*[F.expr(e).alias(c) for c, e in columns.items()])


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = []
    for source in ENTITY.sources:
        tagged = with_provenance(raw(spark, sf_dir, source.name), source, AS_OF, F.lit(source.name))
        frames.append(standardize(tagged, ENTITY, source))
    return union_all(frames)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(standardized(spark, sf_dir), ENTITY.rules)


def kept(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    checks = quality.identity_expectations(ENTITY.id_column, ENTITY.name_column)
    return quality.expect_all_or_drop(scored(spark, sf_dir), checks)


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_record(with_record_key(kept(spark, sf_dir)[0], ENTITY.id_column))


_DECISIONS = {
    "decision_id": "'D' || " + _text("c_custkey"),
    "entity": "CASE WHEN c_custkey % 15 = 14 THEN 'account' ELSE 'customer' END",
    "record_type": "CASE WHEN c_custkey % 6 = 5 THEN 'low_confidence_match' ELSE 'dq_quarantine' END",
    "business_key": "CASE WHEN c_custkey % 2 = 0 THEN 'erp:C' ELSE 'crm:A' END || " + _text("c_custkey"),
    "decision": "CASE WHEN c_custkey % 3 = 0 THEN 'approved' ELSE 'rejected' END",
    "reviewer": "c_mktsegment",
}


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    return rows.select(*[F.expr(e).alias(c) for c, e in _DECISIONS.items()])


def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passed records, materialised because matching reads them twice."""
    return cut(quality.passed(latest(spark, sf_dir), MIN, approved(spark, sf_dir)))


_DECISIONS_SQL = f"decisions AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _DECISIONS.items())} FROM customer)"
_APPROVED_SQL = (
    "approved AS (SELECT DISTINCT business_key FROM decisions "
    "WHERE entity = 'customer' AND record_type = 'dq_quarantine' AND decision = 'approved')"
)


def approved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.approved_overrides(decisions(spark, sf_dir), "customer")


def initcap_sql(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ')"


def _standard_sql() -> str:
    selects = []
    for s in ENTITY.sources:
        c = s.columns
        selects.append(
            f"SELECT trim({c['customer_id']}) AS customer_id, {initcap_sql('trim(' + c['full_name'] + ')')} AS full_name, "
            f"lower(trim({c['email']})) AS email, trim({c['tax_id']}) AS tax_id, trim({c['address_line1']}) AS address_line1, "
            f"upper(trim({c['country_code']})) AS country_code, trim({c['postal_code']}) AS postal_code, "
            f"trim({c['updated_at']}) AS updated_at, '{s.name}' AS _source_system, {s.priority} AS _source_priority "
            f"FROM ({raw_sql(s.name)})"
        )
    body = " UNION ALL ".join(selects)
    return f"""std AS (
        SELECT *, CASE WHEN email IS NULL THEN NULL ELSE regexp_extract(email, '@(.+)$', 1) END AS email_domain
        FROM ({body}))"""


_PASS = {
    "customer_id_not_null": (1.0, "customer_id IS NOT NULL"),
    "name_not_null": (1.0, "full_name IS NOT NULL"),
    "email_format_valid": (0.5, r"coalesce(regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$'), false)"),
    "country_code_valid": (0.5, "coalesce(country_code IN ('US','CA','UK','IN','DE','FR','AU'), false)"),
    "tax_id_format": (0.5, r"coalesce(regexp_matches(tax_id, '^[A-Z0-9\-]{5,20}$'), false)"),
}
_SCORED_SQL = (
    _standard_sql()
    + ", scored AS (SELECT *, ("
    + " + ".join(f"CASE WHEN {c} THEN {w}::DOUBLE ELSE 0.0::DOUBLE END" for w, c in _PASS.values())
    + ") / 3.5::DOUBLE AS dq_score, concat_ws(',', "
    + ", ".join(f"CASE WHEN NOT ({c}) THEN '{n}' END" for n, (_, c) in _PASS.items())
    + ") AS dq_issues FROM std)"
)
_TS = (
    "coalesce(try_strptime(updated_at, '%Y-%m-%d'), try_strptime(updated_at, '%m/%d/%Y'), "
    "try_strptime(updated_at, '%Y%m%d'))"
)
_LATEST_SQL = (
    _SCORED_SQL
    + f""", keyed AS (
        SELECT *, _source_system || ':' || customer_id AS record_key, {_TS} AS ts FROM scored
        WHERE customer_id IS NOT NULL AND full_name IS NOT NULL),
    latest AS (
        SELECT * EXCLUDE (rn), FROM (
            SELECT *, count(*) OVER (PARTITION BY record_key) AS duplicate_count,
                   row_number() OVER (PARTITION BY record_key ORDER BY ts DESC NULLS LAST, email DESC NULLS LAST) AS rn
            FROM keyed) WHERE rn = 1)"""
)
_PASSED_SQL = (
    f"{_LATEST_SQL}, {_DECISIONS_SQL}, {_APPROVED_SQL}, "
    f"passed AS (SELECT *, dq_score < {MIN} AS steward_override FROM latest WHERE dq_score >= {MIN} "
    "OR record_key IN (SELECT business_key FROM approved)), "
    f"quarantine AS (SELECT * FROM latest WHERE dq_score < {MIN} "
    "AND record_key NOT IN (SELECT business_key FROM approved))"
)

_BLOCK = "country_code || '|' || substr(postal_code, 1, 3)"


def _exact(c: str, policy: str = "zero") -> str:
    same = f"(a.{c} = b.{c})::INT::DOUBLE"
    return f"coalesce({same}, 0.0::DOUBLE)" if policy == "zero" else same


def _jw(c: str) -> str:
    return (
        f"CASE WHEN coalesce(a.{c}, '') = '' OR coalesce(b.{c}, '') = '' THEN 0.0::DOUBLE "
        f"ELSE jaro_winkler_similarity(a.{c}, b.{c}) END"
    )


def _edges_sql(rows: str, policy: str = "zero") -> str:
    conf = (
        f"({_jw('full_name')} * 0.35::DOUBLE + {_exact('email', policy)} * 0.25::DOUBLE + "
        f"{_exact('tax_id', policy)} * 0.25::DOUBLE + {_jw('address_line1')} * 0.15::DOUBLE) "
        "/ (0.35::DOUBLE + 0.25::DOUBLE + 0.25::DOUBLE + 0.15::DOUBLE)"
    )
    return f"""edges AS (
        SELECT a, b, confidence FROM (
            SELECT a.record_key AS a, b.record_key AS b, {conf} AS confidence
            FROM (SELECT *, {_BLOCK} AS block FROM {rows}) a JOIN (SELECT *, {_BLOCK} AS block FROM {rows}) b
              ON a.block = b.block AND a.record_key < b.record_key)
        WHERE confidence >= 0.65::DOUBLE)"""


def _groups_sql(rows: str, policy: str = "zero") -> str:
    return f"""{_edges_sql(rows, policy)},
    nodes AS (SELECT record_key AS id FROM {rows}), {components_sql('nodes', 'edges')},
    ends AS (SELECT a AS id, confidence FROM edges UNION ALL SELECT b, confidence FROM edges),
    member_conf AS (SELECT id, avg(confidence) AS confidence FROM ends GROUP BY id),
    groups AS (
        SELECT labels.component AS golden_id, labels.id AS member_customer_id,
               coalesce(member_conf.confidence, 1.0::DOUBLE) AS match_confidence
        FROM labels LEFT JOIN member_conf ON member_conf.id = labels.id)"""


_GOLDEN_SQL = (
    f"{_PASSED_SQL}, {_groups_sql('passed')}, "
    """rolled AS (
        SELECT golden_id, count(*) AS source_record_count,
               array_to_string(list_sort(list(member_customer_id)), ',') AS source_customer_ids,
               avg(match_confidence) AS match_confidence
        FROM groups GROUP BY golden_id),
    best AS (
        SELECT g.golden_id, p.*, row_number() OVER (
            PARTITION BY g.golden_id
            ORDER BY CASE p._source_system WHEN 'erp' THEN 0 WHEN 'crm' THEN 1 WHEN 'partner_api' THEN 2
                     WHEN 'flatfile' THEN 3 ELSE 4 END, p.ts DESC NULLS LAST, p.record_key) AS rn
        FROM passed p JOIN groups g ON g.member_customer_id = p.record_key),
    golden AS (
        SELECT b.*, r.source_record_count, r.source_customer_ids, r.match_confidence,
               CASE WHEN r.source_record_count = 1 THEN 'single_source'
                    WHEN r.match_confidence >= 0.93 THEN 'auto_merged' ELSE 'needs_review' END AS review_status
        FROM best b JOIN rolled r ON r.golden_id = b.golden_id WHERE b.rn = 1)"""
)


def mastered(spark: SparkSession, sf_dir: str) -> Mastered:
    return master(standardized(spark, sf_dir), ENTITY, AS_OF, approved(spark, sf_dir))


@query(
    "canonical_union",
    f"WITH {_standard_sql()} SELECT customer_id, full_name, email, tax_id, address_line1, country_code, postal_code, "
    "updated_at, email_domain, _source_system AS source_system, _source_priority AS source_priority FROM std",
)
def canonical_union(spark, sf_dir):
    std = standardized(spark, sf_dir).drop("_ingested_at", "_source_file")
    return std.withColumnsRenamed({"_source_system": "source_system", "_source_priority": "source_priority"})


# A CSV file has no empty texts: what is empty there is null.
_FILED = "CASE WHEN _source_system <> 'flatfile' OR email <> '' THEN {0} END AS {0}"


@query(
    "entity_ingest",
    f"WITH {_standard_sql()} SELECT customer_id, full_name, {_FILED.format('email')}, tax_id, address_line1, country_code, postal_code, "
    f"updated_at, {_FILED.format('email_domain')}, _source_system AS source_system, _source_priority AS source_priority FROM std",
)
def entity_ingest(spark, sf_dir):
    """All sources of an entity landed as files of their formats, ingested as streams, then standardised as one."""
    root = new_shared_path(spark, "entity")
    for source in ENTITY.sources:
        write_landing(raw(spark, sf_dir, source.name), source.format, f"{root}/{source.landing_path}")
    tables = ingest.ingest_entity(spark, ENTITY, f"{root}/raw", AS_OF, root)
    ingest.refresh_standardized(spark, ENTITY, tables, f"{root}/standard", f"{root}/standard-checkpoint")
    std = spark.read.parquet(f"{root}/standard").drop("_ingested_at", "_source_file")
    return std.withColumnsRenamed({"_source_system": "source_system", "_source_priority": "source_priority"})


@query(
    "dq_score",
    f"WITH {_SCORED_SQL} SELECT _source_system AS source_system, customer_id, updated_at, "
    "round(dq_score, 6) AS dq_score, dq_issues FROM scored",
)
def dq_score(spark, sf_dir):
    return scored(spark, sf_dir).select(
        F.col("_source_system").alias("source_system"), "customer_id", "updated_at", r("dq_score"), "dq_issues"
    )


@query(
    "dq_distribution",
    f"""WITH {_SCORED_SQL} SELECT _source_system AS source_system, count(*) AS count, round(avg(dq_score), 6) AS mean,
        round(stddev_samp(dq_score), 6) AS std, round(min(dq_score), 6) AS min,
        round(quantile_cont(dq_score, 0.25), 6) AS p25, round(quantile_cont(dq_score, 0.5), 6) AS p50,
        round(quantile_cont(dq_score, 0.75), 6) AS p75, round(max(dq_score), 6) AS max,
        round(avg(CASE WHEN dq_score < {MIN} THEN 1.0 ELSE 0.0 END), 6) AS quarantine_rate
        FROM scored GROUP BY ALL""",
)
def dq_distribution(spark, sf_dir):
    out = quality.score_distribution(scored(spark, sf_dir), MIN, "_source_system")
    return out.select(
        F.col("_source_system").alias("source_system"), "count",
        *[r(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max", "quarantine_rate")],
    )


@query(
    "drop_expectations_kept",
    f"WITH {_SCORED_SQL} SELECT _source_system AS source_system, customer_id, full_name, updated_at FROM scored "
    "WHERE customer_id IS NOT NULL AND full_name IS NOT NULL",
)
def drop_expectations_kept(spark, sf_dir):
    return kept(spark, sf_dir)[0].select(F.col("_source_system").alias("source_system"), "customer_id", "full_name", "updated_at")


@query(
    "drop_expectations_rejected",
    f"""WITH {_SCORED_SQL} SELECT _source_system AS source_system, customer_id, updated_at,
        concat_ws(',', CASE WHEN customer_id IS NULL THEN 'has_customer_id' END,
                       CASE WHEN full_name IS NULL THEN 'has_name' END) AS failed_expectations
        FROM scored WHERE customer_id IS NULL OR full_name IS NULL""",
)
def drop_expectations_rejected(spark, sf_dir):
    return kept(spark, sf_dir)[1].select(
        F.col("_source_system").alias("source_system"), "customer_id", "updated_at", "failed_expectations"
    )


@query(
    "latest_records",
    f"WITH {_LATEST_SQL} SELECT record_key, updated_at, email, duplicate_count FROM latest",
)
def latest_records(spark, sf_dir):
    return latest(spark, sf_dir).select("record_key", "updated_at", "email", "duplicate_count")


@query("approved_overrides", f"WITH {_DECISIONS_SQL}, {_APPROVED_SQL} SELECT business_key FROM approved")
def approved_overrides(spark, sf_dir):
    return approved(spark, sf_dir)


@query(
    "dq_split_passed",
    f"WITH {_PASSED_SQL} SELECT record_key, round(dq_score, 6) AS dq_score, steward_override FROM passed",
)
def dq_split_passed(spark, sf_dir):
    out = quality.passed(latest(spark, sf_dir), MIN, approved(spark, sf_dir))
    return out.select("record_key", r("dq_score"), "steward_override")


@query(
    "dq_split_quarantine",
    f"WITH {_PASSED_SQL} SELECT record_key, round(dq_score, 6) AS dq_score, dq_issues FROM quarantine",
)
def dq_split_quarantine(spark, sf_dir):
    out = quality.quarantined(latest(spark, sf_dir), MIN, approved(spark, sf_dir), "record_key")
    return out.select("record_key", r("dq_score"), "dq_issues")


def _profile_pairs_sql(policy: str) -> str:
    """Matching record pairs summed per pair of equal-looking records."""
    attrs = "full_name, email, tax_id, address_line1"
    return f"""WITH RECURSIVE {_PASSED_SQL}, {_edges_sql('passed', policy)},
    rep AS (SELECT record_key, min(record_key) OVER (PARTITION BY {attrs}, {_BLOCK}) AS id FROM passed)
    SELECT least(x.id, y.id) AS id_a, greatest(x.id, y.id) AS id_b, count(*) AS record_pairs,
           round(avg(confidence), 6) AS match_confidence
    FROM edges JOIN rep x ON x.record_key = edges.a JOIN rep y ON y.record_key = edges.b GROUP BY 1, 2"""


@query("customer_pairs", _profile_pairs_sql("zero"))
def customer_pairs(spark, sf_dir):
    passed = eligible(spark, sf_dir)
    return match_records(passed, ENTITY.match).pairs().withColumn("match_confidence", r("match_confidence"))


@query("customer_pairs_null_reject", _profile_pairs_sql("reject"))
def customer_pairs_null_reject(spark, sf_dir):
    passed = eligible(spark, sf_dir)
    spec = ENTITY.match.with_options(null_policy="reject")
    return match_records(passed, spec).pairs().withColumn("match_confidence", r("match_confidence"))


@query(
    "customer_groups",
    f"WITH RECURSIVE {_PASSED_SQL}, {_groups_sql('passed')} "
    "SELECT golden_id, member_customer_id, round(match_confidence, 6) AS match_confidence FROM groups",
)
def customer_groups(spark, sf_dir):
    passed = eligible(spark, sf_dir)
    groups = match_records(passed, ENTITY.match).groups()
    return groups.withColumn("match_confidence", r("match_confidence"))


_CLEAN_SQL = rf"""clean AS (
    SELECT * REPLACE (
        CASE WHEN regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$') THEN email END AS email,
        CASE WHEN regexp_matches(tax_id, '^[A-Z0-9\-]{{5,20}}$') THEN tax_id END AS tax_id)
    FROM passed)"""


# the check engine has no soundex: these are its values for the names that occur in the tables
_SOUNDEX = (
    "CASE WHEN full_name LIKE '%Customer#%' THEN 'C235' WHEN full_name LIKE '%Supplier#%' THEN 'S146' "
    "ELSE regexp_extract(full_name, '(\\S+)\\s*$', 1) END"
)
_TWO_BLOCKS_SQL = (
    _groups_sql("passed")
    .replace(f"{_BLOCK} AS block", f"{_BLOCK} AS block, nullif(email_domain, '') || '|' || {_SOUNDEX} AS block2")
    .replace("ON a.block = b.block AND", "ON (a.block = b.block OR a.block2 = b.block2) AND")
)


@query(
    "customer_groups_two_passes",
    f"WITH RECURSIVE {_PASSED_SQL}, {_TWO_BLOCKS_SQL} "
    "SELECT golden_id, member_customer_id, round(match_confidence, 6) AS match_confidence FROM groups",
)
def customer_groups_two_passes(spark, sf_dir):
    """Second pass on e-mail domain and soundex, where one block holds most of the customers."""
    spec = ENTITY.match.with_options(blocking=ENTITY.match.blocking + ENTITY.extra_blocking)
    groups = match_records(eligible(spark, sf_dir), spec).groups()
    return groups.withColumn("match_confidence", r("match_confidence"))


@query(
    "customer_groups_invalid_blanked",
    f"WITH RECURSIVE {_PASSED_SQL}, {_CLEAN_SQL}, {_groups_sql('clean')} "
    "SELECT golden_id, member_customer_id, round(match_confidence, 6) AS match_confidence FROM groups",
)
def customer_groups_invalid_blanked(spark, sf_dir):
    passed = eligible(spark, sf_dir)
    blanked = quality.blank_invalid(passed, ENTITY.rules, [a.column for a in ENTITY.match.attributes])
    groups = match_records(blanked, ENTITY.match).groups()
    return groups.withColumn("match_confidence", r("match_confidence"))


_PUBLISHED = (
    "golden_id, full_name AS customer_name, email, tax_id, address_line1, country_code, postal_code, "
    "round(dq_score, 6) AS dq_score, dq_issues, round(match_confidence, 6) AS match_confidence, source_record_count, "
    "source_customer_ids, _source_system AS surviving_source_system, review_status"
)


def _published(m: Mastered) -> DataFrame:
    """Published golden rows in comparable form: ids joined, scores rounded, no load time."""
    out = m.published(ENTITY).drop("merged_at")
    return out.withColumns(
        {
            "source_customer_ids": F.array_join("source_customer_ids", ","),
            "dq_score": r("dq_score"),
            "match_confidence": r("match_confidence"),
        }
    )


@query("golden_end_to_end", f"WITH RECURSIVE {_GOLDEN_SQL} SELECT {_PUBLISHED} FROM golden")
def golden_end_to_end(spark, sf_dir):
    return _published(mastered(spark, sf_dir))


@query(
    "unblocked_records",
    f"""WITH {_PASSED_SQL}, k AS (SELECT {_BLOCK} IS NOT NULL AS a FROM passed)
    SELECT blocking_pass, count(*) FILTER (a) AS blocked, count(*) FILTER (NOT a) AS unblocked
    FROM k, (VALUES (0), (NULL::INT)) p(blocking_pass) GROUP BY 1""",
)
def unblocked_records(spark, sf_dir):
    """Passed records that a null block column keeps out of matching."""
    return blocking.unblocked_records(quality.passed(latest(spark, sf_dir), MIN, approved(spark, sf_dir)), ENTITY.match)


@query(
    "mask_columns",
    f"WITH RECURSIVE {_GOLDEN_SQL} SELECT * REPLACE ('***MASKED***' AS email, '***MASKED***' AS tax_id) "
    f"FROM (SELECT {_PUBLISHED} FROM golden)",
)
def masked(spark, sf_dir):
    return mask_columns(_published(mastered(spark, sf_dir)), ENTITY.masked_columns)


@query(
    "gold_gate_violations",
    f"""WITH RECURSIVE {_GOLDEN_SQL}
    SELECT 'has_golden_id' AS expectation, count(*) FILTER (WHERE golden_id IS NULL) AS violations FROM golden
    UNION ALL SELECT 'min_dq_score', count(*) FILTER (WHERE NOT (dq_score >= {MIN})) FROM golden""",
)
def gold_gate_violations(spark, sf_dir):
    golden = mastered(spark, sf_dir).golden
    return quality.violation_counts(golden, quality.gold_expectations(MIN, honour_override=False))


_QUEUE_SQL = """queue AS (
    SELECT * FROM (
        SELECT 'customer' AS entity, 'dq_quarantine' AS record_type, record_key AS business_key, dq_issues AS reason
        FROM quarantine
        UNION ALL
        SELECT 'customer', 'low_confidence_match', golden_id, 'match_confidence=' || round(match_confidence, 3)::VARCHAR
        FROM golden WHERE review_status = 'needs_review') q
    WHERE NOT EXISTS (SELECT 1 FROM decisions d WHERE d.entity = q.entity AND d.record_type = q.record_type
                      AND d.business_key = q.business_key))"""


def queue(spark, sf_dir, m: Mastered) -> DataFrame:
    items = [
        review.quarantine_items("customer", m.quarantine, "record_key", AS_OF),
        review.low_confidence_items("customer", m.golden, AS_OF),
    ]
    return review.review_queue(items, decisions(spark, sf_dir))


@query("review_queue", f"WITH RECURSIVE {_GOLDEN_SQL}, {_QUEUE_SQL} SELECT * FROM queue")
def review_queue(spark, sf_dir):
    return queue(spark, sf_dir, mastered(spark, sf_dir)).drop("detected_at", "queued_at")


@query(
    "customer_match_quality",
    f"""WITH RECURSIVE {_PASSED_SQL}, {_groups_sql('passed')},
    t AS (SELECT golden_id, regexp_extract(member_customer_id, '[0-9]+$')
                 || CASE WHEN member_customer_id LIKE 'erp%' OR member_customer_id LIKE 'crm%' THEN 'c' ELSE 's' END AS true_id
          FROM groups),
    n AS (SELECT (SELECT sum(c * (c - 1) / 2) FROM (SELECT count(*)::DOUBLE c FROM t GROUP BY golden_id, true_id)) AS tp,
                 (SELECT sum(c * (c - 1) / 2) FROM (SELECT count(*)::DOUBLE c FROM t GROUP BY golden_id)) AS guessed,
                 (SELECT sum(c * (c - 1) / 2) FROM (SELECT count(*)::DOUBLE c FROM t GROUP BY true_id)) AS actual)
    SELECT tp, guessed - tp AS fp, actual - tp AS fn, round(tp / guessed, 6) AS precision, round(tp / actual, 6) AS recall,
           round(2 * (tp / guessed) * (tp / actual) / (tp / guessed + tp / actual), 6) AS f1,
           round(tp / guessed, 6) < 0.90 AS raise_match_threshold, round(tp / actual, 6) < 0.80 AS lower_match_threshold,
           (SELECT count(*) FROM quarantine) / (SELECT count(*) FROM latest) > 0.15 AS lower_min_score
    FROM n""",
)
def customer_match_quality(spark, sf_dir):
    flagged = cut(quality.flag_overrides(latest(spark, sf_dir), approved(spark, sf_dir), MIN, "record_key"))
    passes = (F.col("dq_score") >= MIN) | F.col("steward_override")
    passed = flagged.filter(passes)
    rate = flagged.agg(F.avg(F.when(passes, 0.0).otherwise(1.0)).alias("rate"))
    groups = match_records(passed, ENTITY.match).groups()
    kind = F.when(F.col(MEMBER).rlike("^(erp|crm):"), F.lit("c")).otherwise(F.lit("s"))
    truth = passed.withColumnRenamed("record_key", MEMBER).select(
        MEMBER, F.concat(F.regexp_extract(MEMBER, "[0-9]+$", 0), kind).alias("true_id")
    )
    measured = evaluate.pairwise_quality(groups, truth).join(rate, F.lit(True), "left")  # one row each
    advised = evaluate.tuning_advice(measured, F.col("rate")).drop("rate")
    return advised.withColumns(
        {**{c: F.col(c).cast("double") for c in ("tp", "fp", "fn")}, **{c: r(c) for c in ("precision", "recall", "f1")}}
    )


# the load times of kpi_report: a number of hours that the record key gives
_LOADED_SQL = "(TIMESTAMP '2024-01-31' - to_hours((regexp_extract({}, '[0-9]+$')::BIGINT % 48)::INT))"


@query(
    "kpi_report",
    f"""WITH RECURSIVE {_GOLDEN_SQL}, {_QUEUE_SQL},
    q AS (SELECT count(*) AS scored_records, (SELECT count(*) FROM passed) AS passed_records,
                 (SELECT count(*) FROM quarantine) AS quarantined FROM latest),
    loads AS (SELECT avg(epoch(TIMESTAMP '2024-01-31' - {_LOADED_SQL.format('record_key')}) / 60) AS minutes FROM golden),
    terms AS (SELECT count(*) FILTER (known) / count(*) AS covered
              FROM (SELECT column_name IN ('golden_id', 'email', 'tax_id') AS known
                    FROM (VALUES {', '.join(f"('{c}')" for c in ENTITY.glossary)}) t(column_name))),
    g AS (SELECT count(*) AS golden_records, sum(source_record_count) AS consumed, avg(match_confidence) AS conf,
                 sum((review_status = 'auto_merged')::INT)::BIGINT AS auto_merged,
                 sum((review_status = 'needs_review')::INT)::BIGINT AS needs_review,
                 sum((review_status = 'single_source')::INT)::BIGINT AS single_source FROM golden)
    SELECT 'customer' AS entity, scored_records, passed_records,
           round(passed_records / scored_records, 6) AS dq_pass_rate,
           round(quarantined / scored_records, 6) AS quarantine_rate, golden_records,
           round(1 - golden_records / consumed, 6) AS dedup_rate, round(conf, 6) AS avg_match_confidence,
           auto_merged, needs_review, single_source, (SELECT count(*) FROM queue) AS review_backlog,
           round(covered, 6) AS glossary_coverage, round(minutes, 6) AS time_to_gold_minutes
    FROM q, g, loads, terms""",
)
def kpi_report(spark, sf_dir):
    m = mastered(spark, sf_dir)
    required = review.configured_terms(spark, [ENTITY], "steward", AS_OF)
    glossary = required.filter(F.col("column_name").isin("golden_id", "email", "tax_id"))
    tag = F.lit("customer")
    # every record was loaded some hours before, by its key
    hours = F.pmod(F.regexp_extract("record_key", "[0-9]+$", 0).cast("long"), F.lit(48))
    loaded = (F.lit(AS_OF).cast("timestamp") - F.make_dt_interval(F.lit(0), hours.cast("int"))).alias("_ingested_at")
    out = reports.kpis(
        m.scored.withColumn("entity", tag),
        m.golden.withColumn("_ingested_at", loaded).withColumn("entity", tag),
        queue(spark, sf_dir, m),
        required,
        glossary,
        MIN,
    )
    rates = ("dq_pass_rate", "quarantine_rate", "dedup_rate", "avg_match_confidence", "glossary_coverage", "time_to_gold_minutes")
    return out.withColumns({c: r(c) for c in rates})
