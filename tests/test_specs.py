import pytest

from assay.specs import (
    MatchAttribute,
    MatchSpec,
    RuleSpec,
    SourceSpec,
    load_cost,
    load_entity,
    load_match,
    load_rules,
    load_sources,
)


def test_shipped_entities_load():
    customer, account = load_entity("customer"), load_entity("account")
    assert [s.name for s in customer.sources] == ["erp", "crm", "flatfile", "partner_api"]
    assert customer.source("partner_api").columns["customer_id"] == "partnerCustomerId"
    assert sum(r.weight for r in customer.rules) == 3.5
    assert sum(r.weight for r in account.rules) == 3.0
    assert customer.match.threshold == 0.65 and account.match.threshold == 0.7
    assert customer.source("erp").raw_table == "bronze_erp_customer"


def test_unknown_rule_type_raises():
    with pytest.raises(ValueError):
        RuleSpec("x", "c", "range", "warn")


def test_unknown_severity_raises():
    with pytest.raises(ValueError):
        RuleSpec("x", "c", "not_null", "fatal")


def test_unknown_match_method_raises():
    with pytest.raises(ValueError):
        MatchAttribute("c", "levenshtein", 1.0)


def test_unknown_policies_and_formats_raise():
    attributes = (MatchAttribute("c", "exact", 1.0),)
    with pytest.raises(ValueError):
        MatchSpec((("b",),), attributes, 0.5, null_policy="maybe")
    with pytest.raises(ValueError):
        MatchSpec((("b",),), attributes, 0.5, null_block="maybe")
    with pytest.raises(ValueError):
        SourceSpec("s", "xml", "customer", "p", 1, 1.0)


def test_cost_settings():
    with pytest.raises(ValueError, match="project tag"):
        load_cost()
    cost = load_cost(project_tag="p")
    assert (cost.daily_budget_usd, cost.hard_limit_usd, cost.unit_price_usd["default"]) == (25.0, 100.0, 0.25)


def test_separate_yaml_files(tmp_path):
    (tmp_path / "rules.yml").write_text(
        "rules:\n  - {name: a, column: c, type: regex, pattern: '^x', severity: warn}\n"
        "gate: {min_dq_score_for_gold: 0.8}\n"
    )
    rules, minimum = load_rules(tmp_path / "rules.yml")
    assert rules[0].pattern == "^x" and minimum == 0.8
    (tmp_path / "match.yml").write_text(
        "id_column: id\nmatch_threshold: 0.6\nauto_merge_threshold: 0.9\n"
        "blocking_keys: [[a, b], {columns: [c], active: false}, {columns: [d]}]\n"
        "match_attributes: [{column: n, method: exact, weight: 1}]\n"
        "survivorship: {source_priority: [x, y]}\n"
    )
    match, survivorship = load_match(tmp_path / "match.yml")
    assert match.threshold == 0.6 and survivorship.source_priority == ("x", "y")
    (tmp_path / "sources.yml").write_text(
        "sources: [{name: x, format: csv, landing_path: p, entity: e, priority: 1, freshness_sla_hours: 2}]\n"
    )
    (tmp_path / "maps.yml").write_text("source_column_maps: {x: {id: raw_id}}\n")
    (source,) = load_sources(tmp_path / "sources.yml", tmp_path / "maps.yml")
    assert source.columns == {"id": "raw_id"}
