from datetime import datetime

from assay.operators import review
from assay.operators.upsert import changes, upsert
from assay.specs import load_entity

T1, T2, T3 = datetime(2026, 1, 1), datetime(2026, 1, 2), datetime(2026, 1, 3)
DECISION = "entity string, record_type string, business_key string, decision string"


def items(spark):
    quarantined = spark.createDataFrame([("erp:1", "a,b", T1), ("erp:2", "a", T1)], "record_key string, dq_issues string, _ingested_at timestamp")
    golden = spark.createDataFrame(
        [("g1", "needs_review", 0.87654, T2), ("g2", "auto_merged", 0.99, T2)],
        "golden_id string, review_status string, match_confidence double, merged_at timestamp",
    )
    return [
        review.quarantine_items("customer", quarantined, "record_key", T3),
        review.low_confidence_items("customer", golden, T3),
    ]


def test_queue_holds_quarantine_and_low_confidence(spark):
    rows = {tuple(r) for r in review.review_queue(items(spark)).collect()}
    assert rows == {
        ("customer", "dq_quarantine", "erp:1", "a,b", T1, T3),
        ("customer", "dq_quarantine", "erp:2", "a", T1, T3),
        ("customer", "low_confidence_match", "g1", "match_confidence=0.877", T2, T3),
    }


def test_decided_items_leave_the_queue(spark):
    decisions = spark.createDataFrame(
        [("customer", "dq_quarantine", "erp:1", "rejected"), ("account", "dq_quarantine", "erp:2", "approved")], DECISION
    )
    left = review.review_queue(items(spark), decisions)
    assert {r.business_key for r in left.collect()} == {"erp:2", "g1"}
    assert review.review_queue(items(spark), decisions, include_decided=True).count() == 3


def test_approved_overrides(spark):
    decisions = spark.createDataFrame(
        [
            ("customer", "dq_quarantine", "a", "approved"),
            ("customer", "dq_quarantine", "a", "approved"),
            ("customer", "dq_quarantine", "b", "rejected"),
            ("account", "dq_quarantine", "c", "approved"),
            ("customer", "low_confidence_match", "d", "approved"),
        ],
        DECISION,
    )
    assert [r[0] for r in review.approved_overrides(decisions, "customer").collect()] == ["a"]
    empty = spark.createDataFrame([], review.STEWARD_DECISIONS)
    assert review.approved_overrides(empty, "customer").count() == 0


def test_glossary_registration_and_submissions(spark):
    glossary = spark.createDataFrame([("customer", "email", "old", "s", T1)], review.BUSINESS_GLOSSARY)
    terms = review.configured_terms(spark, [load_entity("customer"), load_entity("account")], "team", T2)
    assert terms.count() == 9
    glossary = review.register_terms(glossary, terms)
    assert glossary.count() == 9
    row = ("customer", "email", "p", None, "me", T1, "approved", "boss")
    submissions = spark.createDataFrame(
        [
            ("1", "customer", "email", "first", None, "me", T1, "approved", "boss", T1, None),
            ("2", "customer", "email", "second", None, "you", T1, "approved", "boss", T3, None),
            ("3", "customer", "industry", "new", None, "you", T1, "approved", "boss", T3, None),
            ("4", "customer", "tax_id", "no", None, "you", T1, "pending", None, None, None),
        ],
        review.GLOSSARY_SUBMISSIONS,
    )
    once = review.apply_submissions(glossary, submissions)
    twice = review.apply_submissions(once, submissions)
    got = {(r.entity, r.column_name): r.glossary_term for r in twice.collect()}
    assert len(got) == 10 == once.count() == twice.count()
    assert got[("customer", "email")] == "second" and got[("customer", "industry")] == "new"
    assert got[("customer", "tax_id")] == "Tax Identification Number"


def test_upsert_changes_only_matching_keys(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, ts int")
    source = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 1)], "k int, v string, ts int")
    assert sorted(map(tuple, upsert(target, source, ["k"], "ts").collect())) == [(1, "a", 1), (2, "d", 3), (3, "e", 1)]


def test_change_feed(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1), (5, None, None)], "k int, v string, w int")
    new = spark.createDataFrame([(1, "a", None), (2, "B", 1), (4, "d", 1), (5, None, 7)], "k int, v string, w int")
    assert sorted(map(str, map(tuple, changes(old, new, "k").collect()))) == sorted(
        map(str, [
            (2, "update_preimage", "b", 1), (2, "update_postimage", "B", 1), (3, "delete", "c", 1),
            (4, "insert", "d", 1), (5, "update_preimage", None, None), (5, "update_postimage", None, 7),
        ])
    )
    assert changes(old, old, "k").count() == 0
