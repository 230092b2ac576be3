"""Steward queue over all entities and the registration of configured glossary terms."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from assay.operators import review
from assay.plans.mastering import master
from assay.specs import load_entity
from workloads import parts, party
from workloads.registry import AS_OF, query, table

_ACCOUNT_QUEUE_SQL = f"""WITH RECURSIVE {parts._accounts_sql()}, {parts._ACCOUNT_EDGES},
    {parts._GROUPS.replace('FROM parts', 'FROM passed')}, {party._DECISIONS_SQL},
    rolled AS (SELECT golden_id, count(*) AS n, avg(match_confidence) AS conf FROM groups GROUP BY 1)
    SELECT * FROM (
        SELECT 'account' AS entity, 'dq_quarantine' AS record_type, record_key AS business_key,
               concat_ws(',', CASE WHEN account_type IN ('Prospect','Customer','Partner','Reseller') THEN NULL ELSE 'account_type_valid' END,
                         CASE WHEN industry IS NULL THEN 'industry_not_null' END) AS reason
        FROM scored WHERE dq_score < 0.85
        UNION ALL
        SELECT 'account', 'low_confidence_match', golden_id, 'match_confidence=' || round(conf, 3)::VARCHAR
        FROM rolled WHERE n > 1 AND conf < 0.9) q
    WHERE NOT EXISTS (SELECT 1 FROM decisions d WHERE d.entity = q.entity AND d.record_type = q.record_type
                      AND d.business_key = q.business_key)"""


@query(
    "review_queue_all",
    f"""SELECT * FROM (WITH RECURSIVE {party._GOLDEN_SQL}, {party._QUEUE_SQL} SELECT * FROM queue)
    UNION ALL SELECT * FROM ({_ACCOUNT_QUEUE_SQL})""",
)
def review_queue_all(spark, sf_dir):
    """What waits for a steward in every entity, in one table."""
    account = load_entity("account")
    runs = [
        ("customer", party.mastered(spark, sf_dir)),
        ("account", master(parts.accounts(spark, sf_dir), account, AS_OF, review.approved_overrides(party.decisions(spark, sf_dir), "account"))),
    ]
    items = []
    for entity, m in runs:
        items.append(review.quarantine_items(entity, m.quarantine, "record_key", AS_OF))
        items.append(review.low_confidence_items(entity, m.golden, AS_OF))
    return review.review_queue(items, party.decisions(spark, sf_dir)).drop("detected_at", "queued_at")


_ENTITIES = (load_entity("customer"), load_entity("account"))
_TERMS = ", ".join(
    f"('{e.entity}', '{column}', '{term}', 'steward', TIMESTAMP '2024-01-31')" for e in _ENTITIES for column, term in e.glossary.items()
)


@query(
    "glossary_registration",
    f"""WITH known AS (
        SELECT CASE WHEN user_id % 2 = 0 THEN 'customer' ELSE user_id::VARCHAR END AS entity,
               CASE WHEN event_type = 'click' THEN 'email' ELSE event_type END AS column_name, max(ts) AS seen_at
        FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2),
    terms(entity, column_name, glossary_term, steward, registered) AS (VALUES {_TERMS})
    SELECT entity, column_name, glossary_term, steward FROM terms
    UNION ALL SELECT entity, column_name, 'seen', 'team' FROM known ANTI JOIN terms USING (entity, column_name)""",
)
def glossary_registration(spark, sf_dir):
    """Terms of the entity settings registered into a glossary that knows some of the columns already."""
    early = table(spark, sf_dir, "events").filter(F.col("ts") < F.lit(date(2024, 1, 20)).cast("timestamp"))
    entity = F.when(F.col("user_id") % 2 == 0, "customer").otherwise(F.col("user_id").cast("string"))
    column = F.when(F.col("event_type") == "click", "email").otherwise(F.col("event_type"))
    known = early.groupBy(entity.alias("entity"), column.alias("column_name")).agg(
        F.lit("seen").alias("glossary_term"), F.lit("team").alias("steward"), F.max("ts").cast("timestamp").alias("registered_at")
    )
    terms = review.configured_terms(spark, _ENTITIES, "steward", AS_OF)
    return review.register_terms(known, terms).drop("registered_at")
