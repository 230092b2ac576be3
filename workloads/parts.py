"""Matching on part and account-shaped records derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators import blocking, evaluate, quality
from assay.operators.components import ComponentTable, label_nodes
from assay.operators.matching import MEMBER, match_records
from assay.operators.standardize import standardize, union_all, with_provenance, with_record_key
from assay.plans.mastering import master
from assay.session import new_shared_path
from assay.specs import MatchAttribute, MatchSpec, load_entity
from workloads.registry import AS_OF, components_sql, query, r, table

BY_BRAND = ("p_brand", "p_type")
BY_SIZE = ("p_size", "p_name")
ATTRIBUTES = (MatchAttribute("p_name", "jaro_winkler", 0.6), MatchAttribute("p_size", "exact", 0.4))
SPEC = MatchSpec((BY_BRAND,), ATTRIBUTES, 0.66)
# name alone can reach this one, so nothing but the block is shared by every match
NAME_SPEC = SPEC.with_options(threshold=0.57)
TWO_PASSES = SPEC.with_options(blocking=(BY_BRAND, BY_SIZE))
SWEEP = (0.66, 0.72, 0.8, 0.9)


def parts(spark, sf_dir) -> DataFrame:
    key = F.format_string("p%012d", "p_partkey")
    return table(spark, sf_dir, "part").select(key.alias("record_key"), "p_name", "p_size", "p_brand", "p_type")


_PARTS = "parts AS (SELECT 'p' || lpad(p_partkey::VARCHAR, 12, '0') AS record_key, * FROM part)"
_CONF = (
    "(jaro_winkler_similarity(a.p_name, b.p_name) * 0.6::DOUBLE + (a.p_size = b.p_size)::INT::DOUBLE * 0.4::DOUBLE) "
    "/ (0.6::DOUBLE + 0.4::DOUBLE)"
)


def _scored(where: str, threshold: float) -> str:
    return f"""edges AS (
        SELECT * FROM (SELECT a.record_key AS a, b.record_key AS b, {_CONF} AS confidence
                       FROM parts a JOIN parts b ON a.record_key < b.record_key AND ({where}))
        WHERE confidence >= {threshold}::DOUBLE)"""


_SAME_BRAND = "a.p_brand = b.p_brand AND a.p_type = b.p_type"
_SAME_SIZE = "a.p_size = b.p_size AND a.p_name = b.p_name"


def _pairs_sql(edges: str, profile: str) -> str:
    return f"""WITH {_PARTS}, {edges},
    rep AS (SELECT record_key, min(record_key) OVER (PARTITION BY {profile}) AS id FROM parts)
    SELECT least(x.id, y.id) AS id_a, greatest(x.id, y.id) AS id_b, count(*) AS record_pairs,
           round(avg(confidence), 6) AS match_confidence
    FROM edges JOIN rep x ON x.record_key = edges.a JOIN rep y ON y.record_key = edges.b GROUP BY 1, 2"""


_ALL = "p_name, p_size, p_brand, p_type"


@query("pair_scores", _pairs_sql(_scored(_SAME_BRAND, 0.66), _ALL))
def pair_scores(spark, sf_dir):
    return match_records(parts(spark, sf_dir), SPEC).pairs().withColumn("match_confidence", r("match_confidence"))


@query("pair_scores_name_only", _pairs_sql(_scored(_SAME_BRAND, 0.57), _ALL))
def pair_scores_name_only(spark, sf_dir):
    return match_records(parts(spark, sf_dir), NAME_SPEC).pairs().withColumn("match_confidence", r("match_confidence"))


@query("multi_pass_pairs", _pairs_sql(_scored(f"({_SAME_BRAND}) OR ({_SAME_SIZE})", 0.66), _ALL))
def multi_pass_pairs(spark, sf_dir):
    return match_records(parts(spark, sf_dir), TWO_PASSES).pairs().withColumn("match_confidence", r("match_confidence"))


@query(
    "block_sizes",
    f"""WITH {_PARTS} SELECT p_brand || '|' || p_type AS block_key, count(*) AS records,
        (count(*) * (count(*) - 1) / 2)::BIGINT AS pairs FROM parts GROUP BY 1""",
)
def block_sizes(spark, sf_dir):
    return blocking.block_sizes(parts(spark, sf_dir), SPEC).withColumn("pairs", F.col("pairs").cast("long"))


_GROUPS = f"""nodes AS (SELECT record_key AS id FROM parts), {components_sql('nodes', 'edges')},
    ends AS (SELECT a AS id, confidence FROM edges UNION ALL SELECT b, confidence FROM edges),
    member_conf AS (SELECT id, avg(confidence) AS confidence FROM ends GROUP BY id),
    groups AS (SELECT component AS golden_id, labels.id AS member_customer_id,
                      coalesce(confidence, 1.0::DOUBLE) AS match_confidence
               FROM labels LEFT JOIN member_conf USING (id))"""


@query(
    "match_groups",
    f"WITH RECURSIVE {_PARTS}, {_scored(_SAME_BRAND, 0.66)}, {_GROUPS} "
    "SELECT golden_id, member_customer_id, round(match_confidence, 6) AS match_confidence FROM groups",
)
def match_groups(spark, sf_dir):
    return match_records(parts(spark, sf_dir), SPEC).groups().withColumn("match_confidence", r("match_confidence"))


@query(
    "match_groups_two_passes",
    f"WITH RECURSIVE {_PARTS}, {_scored(f'({_SAME_BRAND}) OR ({_SAME_SIZE})', 0.66)}, {_GROUPS} "
    "SELECT golden_id, member_customer_id, round(match_confidence, 9) AS match_confidence FROM groups",
)
def match_groups_two_passes(spark, sf_dir):
    return match_records(parts(spark, sf_dir), TWO_PASSES).groups().withColumn("match_confidence", r("match_confidence", 9))


@query(
    "match_summary",
    f"""WITH RECURSIVE {_PARTS}, {_scored(_SAME_BRAND, 0.66)}, {_GROUPS}
    SELECT count(DISTINCT golden_id) AS golden_records, count(*) AS records,
           round(1 - count(DISTINCT golden_id) / count(*), 6) AS dedup_rate,
           round(avg(match_confidence), 6) AS avg_match_confidence FROM groups""",
)
def match_summary(spark, sf_dir):
    out = evaluate.group_summary(match_records(parts(spark, sf_dir), SPEC).groups())
    return out.withColumns({c: r(c) for c in ("dedup_rate", "avg_match_confidence")})


def _truth(df: DataFrame) -> DataFrame:
    """Records of the same brand and name are taken as truly the same."""
    return df.select(F.col("record_key").alias(MEMBER), F.concat_ws("|", "p_brand", "p_name").alias("true_id"))


def _comparable(df: DataFrame) -> DataFrame:
    exact = {c: F.col(c).cast("double") for c in ("tp", "fp", "fn")}
    return df.withColumns({**exact, **{c: r(c) for c in ("precision", "recall", "f1")}})


def _quality_sql(groups: str) -> str:
    pairs = "sum(n::DOUBLE * (n - 1) / 2)"
    return f"""SELECT *, CASE WHEN precision_ + recall_ > 0 THEN 2 * precision_ * recall_ / (precision_ + recall_)
                         ELSE 0 END AS f1_ FROM (
        SELECT tp, guessed - tp AS fp, actual - tp AS fn, CASE WHEN guessed > 0 THEN tp / guessed ELSE 1 END AS precision_,
               CASE WHEN actual > 0 THEN tp / actual ELSE 1 END AS recall_
        FROM (SELECT {pairs} AS tp FROM (SELECT count(*) n FROM {groups} JOIN truth USING (member_customer_id) GROUP BY golden_id, true_id)),
             (SELECT {pairs} AS guessed FROM (SELECT count(*) n FROM {groups} GROUP BY golden_id)),
             (SELECT {pairs} AS actual FROM (SELECT count(*) n FROM truth GROUP BY true_id)))"""


_TRUTH = "truth AS (SELECT record_key AS member_customer_id, p_brand || '|' || p_name AS true_id FROM parts)"
_RATES = "tp, fp, fn, round(precision_, 6) AS precision, round(recall_, 6) AS recall, round(f1_, 6) AS f1"


@query(
    "pairwise_quality",
    f"WITH RECURSIVE {_PARTS}, {_scored(_SAME_BRAND, 0.66)}, {_GROUPS}, {_TRUTH} SELECT {_RATES} FROM ({_quality_sql('groups')})",
)
def pairwise_quality(spark, sf_dir):
    rows = parts(spark, sf_dir)
    return _comparable(evaluate.pairwise_quality(match_records(rows, SPEC).groups(), _truth(rows)))


def _sweep_sql() -> str:
    ctes, selects = [], []
    for i, t in enumerate(SWEEP):
        ctes.append(
            f"e{i} AS (SELECT * FROM edges WHERE confidence >= {t}::DOUBLE), "
            f"w{i} AS (SELECT a AS src, b AS dst FROM e{i} UNION SELECT b, a FROM e{i}), "
            f"reach{i}(id, lab) AS (SELECT id, id FROM nodes UNION SELECT w{i}.dst, reach{i}.lab FROM reach{i} "
            f"JOIN w{i} ON w{i}.src = reach{i}.id), "
            f"g{i} AS (SELECT id AS member_customer_id, min(lab) AS golden_id FROM reach{i} GROUP BY id)"
        )
        selects.append(
            f"SELECT {t}::DOUBLE AS threshold, {_RATES}, "
            f"(SELECT count(DISTINCT golden_id) FROM g{i}) AS golden_records FROM ({_quality_sql(f'g{i}')})"
        )
    return (
        f"WITH RECURSIVE {_PARTS}, {_scored(_SAME_BRAND, SWEEP[0])}, nodes AS (SELECT record_key AS id FROM parts), "
        f"{_TRUTH}, {', '.join(ctes)} {' UNION ALL '.join(selects)}"
    )


@query("threshold_sweep", _sweep_sql())
def threshold_sweep(spark, sf_dir):
    rows = parts(spark, sf_dir)
    swept = evaluate.threshold_sweep(match_records(rows, SPEC), SWEEP, _truth(rows))
    return _comparable(swept).drop("records", "dedup_rate", "avg_match_confidence")


_LINKS = "lead(record_key) OVER (PARTITION BY {} ORDER BY record_key)"
_FIRST_LINKS, _SECOND_LINKS = _LINKS.format("p_brand, p_type, p_size"), _LINKS.format("p_name, p_type, p_size")


@query(
    "component_drops",
    f"""WITH RECURSIVE {_PARTS}, edges AS (
        SELECT * FROM (SELECT record_key AS a, {_FIRST_LINKS} AS b FROM parts UNION ALL SELECT record_key, {_SECOND_LINKS} FROM parts)
        WHERE b IS NOT NULL),
    nodes AS (SELECT record_key AS id FROM parts), {components_sql('nodes', 'edges')}
    SELECT id AS record_key, component FROM labels""",
)
def component_drops(spark, sf_dir):
    """Groups of a stored component table after two drops of edges, the second of which joins groups of the first."""
    rows = parts(spark, sf_dir)
    groups = ComponentTable(spark, new_shared_path(spark, "components"))
    for links in (_FIRST_LINKS, _SECOND_LINKS):
        groups.add(rows.selectExpr("record_key AS a", f"{links} AS b").dropna(), "a", "b")
    return label_nodes(rows.select("record_key"), groups.read(), "record_key").select("record_key", "component")


# ---- accounts: part rows as the accounts of two sources

ACCOUNT = load_entity("account")


def _type_sql(n: str) -> str:
    return f"CASE {n} % 5 WHEN 0 THEN 'Prospect' WHEN 1 THEN 'Customer' WHEN 2 THEN 'Partner' WHEN 3 THEN 'Reseller' ELSE 'Other' END"


_ACCOUNT_RAW = {
    "erp": {
        "acct_no": "'N' || cast(p_partkey as string)",
        "acct_name": "p_name",
        "acct_type_cd": _type_sql("p_size"),
        "industry_cd": "CASE WHEN p_partkey % 25 = 0 THEN NULL ELSE p_type END",
        "annual_rev": "cast(p_partkey * 1000 as string)",
        "owning_cust_id": "p_brand",
        "ctry_cd": "CASE p_partkey % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'DE' ELSE 'FR' END",
        "acct_zip_cd": "cast(10000 + p_size * 100 as string)",
        "last_upd_ts": "'2020-01-' || lpad(cast(1 + p_partkey % 28 as string), 2, '0')",
    },
    "crm": {
        "account_id": "'N' || cast(p_partkey as string)",
        "name": "CASE WHEN p_partkey % 4 = 0 THEN upper(p_name) ELSE p_name || ' ltd' END",
        "type": _type_sql("p_size"),
        "industry": "p_type",
        "revenue": "cast(p_partkey * 1000 as string)",
        "owner_id": "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_brand END",
        "billing_country": "CASE p_partkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'DE' ELSE 'FR' END",
        "billing_postal_code": "cast(10000 + p_size * 100 as string)",
        "modified_date": "lpad(cast(1 + p_partkey % 12 as string), 2, '0') || '/15/2021'",
    },
}


def _account_raw(spark, sf_dir, source: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(*[F.expr(e).alias(c) for c, e in _ACCOUNT_RAW[source].items()])


def accounts(spark, sf_dir) -> DataFrame:
    return union_all(
        [
            standardize(with_provenance(_account_raw(spark, sf_dir, s.name), s, AS_OF, F.lit(s.name)), ACCOUNT, s)
            for s in ACCOUNT.sources
        ]
    )


def _accounts_sql() -> str:
    from workloads.party import initcap_sql

    selects = []
    for s in ACCOUNT.sources:
        fields = ", ".join(f"{e} AS {c}" for c, e in _ACCOUNT_RAW[s.name].items())
        c = s.columns
        plain = ", ".join(
            f"{c[x]} AS {x}"
            for x in ("account_id", "account_type", "industry", "annual_revenue", "owner_customer_id", "postal_code", "updated_at")
        )
        selects.append(
            f"SELECT {plain}, {initcap_sql(c['account_name'])} AS account_name, upper({c['country_code']}) AS country_code, "
            f"'{s.name}' AS src FROM (SELECT {fields} FROM part)"
        )
    return f"""std AS ({' UNION ALL '.join(selects)}),
    scored AS (SELECT *, src || ':' || account_id AS record_key,
        (2.0::DOUBLE + CASE WHEN account_type IN ('Prospect','Customer','Partner','Reseller') THEN 0.5::DOUBLE ELSE 0.0 END
         + CASE WHEN industry IS NOT NULL THEN 0.5::DOUBLE ELSE 0.0 END) / 3.0::DOUBLE AS dq_score FROM std),
    passed AS (SELECT * FROM scored WHERE dq_score >= 0.85)"""


_ACCOUNT_EDGES = """edges AS (SELECT * FROM (
        SELECT a.record_key AS a, b.record_key AS b,
               (jaro_winkler_similarity(a.account_name, b.account_name) * 0.5::DOUBLE
                + coalesce((a.owner_customer_id = b.owner_customer_id)::INT::DOUBLE, 0.0::DOUBLE) * 0.3::DOUBLE
                + (a.account_type = b.account_type)::INT::DOUBLE * 0.2::DOUBLE)
               / (0.5::DOUBLE + 0.3::DOUBLE + 0.2::DOUBLE) AS confidence
        FROM passed a JOIN passed b ON a.country_code = b.country_code
             AND substr(a.postal_code, 1, 3) = substr(b.postal_code, 1, 3) AND a.record_key < b.record_key)
        WHERE confidence >= 0.7::DOUBLE)"""


@query(
    "account_groups",
    f"WITH RECURSIVE {_accounts_sql()}, {_ACCOUNT_EDGES}, {_GROUPS.replace('FROM parts', 'FROM passed')} "
    "SELECT golden_id, member_customer_id, round(match_confidence, 6) AS match_confidence FROM groups",
)
def account_groups(spark, sf_dir):
    keyed = with_record_key(quality.score(accounts(spark, sf_dir), ACCOUNT.rules), ACCOUNT.id_column)
    passed = quality.passed(keyed, ACCOUNT.min_score)
    groups = match_records(passed, ACCOUNT.match).groups()
    return groups.withColumn("match_confidence", r("match_confidence"))


@query(
    "account_golden",
    f"""WITH RECURSIVE {_accounts_sql()}, {_ACCOUNT_EDGES}, {_GROUPS.replace('FROM parts', 'FROM passed')},
    rolled AS (SELECT golden_id, count(*) AS source_record_count, avg(match_confidence) AS conf,
                      array_to_string(list_sort(list(member_customer_id)), ',') AS source_customer_ids FROM groups GROUP BY 1),
    best AS (SELECT g.golden_id, p.*, row_number() OVER (PARTITION BY g.golden_id ORDER BY
                CASE src WHEN 'erp' THEN 0 ELSE 1 END,
                coalesce(try_strptime(updated_at, '%Y-%m-%d'), try_strptime(updated_at, '%m/%d/%Y')) DESC NULLS LAST,
                record_key) AS rn
             FROM passed p JOIN groups g ON g.member_customer_id = p.record_key)
    SELECT golden_id, account_name, account_type, industry, annual_revenue, owner_customer_id, country_code, postal_code,
           round(dq_score, 6) AS dq_score, '' AS dq_issues, round(conf, 6) AS match_confidence, source_record_count,
           source_customer_ids, src AS surviving_source_system,
           CASE WHEN source_record_count = 1 THEN 'single_source' WHEN conf >= 0.9 THEN 'auto_merged'
                ELSE 'needs_review' END AS review_status
    FROM best JOIN rolled USING (golden_id) WHERE rn = 1""",
)
def account_golden(spark, sf_dir):
    out = master(accounts(spark, sf_dir), ACCOUNT, AS_OF).published(ACCOUNT).drop("merged_at")
    return out.withColumns(
        {
            "source_customer_ids": F.array_join("source_customer_ids", ","),
            "dq_score": r("dq_score"),
            "match_confidence": r("match_confidence"),
        }
    )
