"""Declarative settings of an entity, checked once when they are loaded."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from pathlib import Path

# Weight of a failed rule by severity.
SEVERITY_WEIGHT = {"critical": 1.0, "warn": 0.5}

RULE_TYPES = ("not_null", "regex", "allowed_values")
MATCH_METHODS = ("jaro_winkler", "exact")
FILE_FORMATS = ("parquet", "json", "csv")

CONF_DIR = Path(__file__).parent / "conf"


@dataclass(frozen=True)
class SourceSpec:
    """One source system of one entity; ``columns`` maps canonical to raw names."""

    name: str
    format: str
    entity: str
    landing_path: str
    priority: int
    freshness_sla_hours: float
    columns: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.format not in FILE_FORMATS:
            raise ValueError(f"source {self.name}: unsupported format {self.format!r}")

    @property
    def raw_table(self) -> str:
        return f"bronze_{self.name}_{self.entity}"


@dataclass(frozen=True)
class RuleSpec:
    name: str
    column: str
    type: str
    severity: str
    pattern: str | None = None
    values: tuple = ()

    def __post_init__(self):
        if self.type not in RULE_TYPES:
            raise ValueError(f"rule {self.name}: unknown type {self.type!r}")
        if self.severity not in SEVERITY_WEIGHT:
            raise ValueError(f"rule {self.name}: unknown severity {self.severity!r}")
        if self.type == "regex" and not self.pattern:
            raise ValueError(f"rule {self.name}: regex without a pattern")

    @property
    def weight(self) -> float:
        return SEVERITY_WEIGHT[self.severity]


@dataclass(frozen=True)
class MatchAttribute:
    column: str
    method: str
    weight: float

    def __post_init__(self):
        if self.method not in MATCH_METHODS:
            raise ValueError(f"attribute {self.column}: unknown method {self.method!r}")


@dataclass(frozen=True)
class MatchSpec:
    """Blocking passes, weighted attributes and the threshold of a pair.

    ``null_policy``: 'zero' lets a null exact attribute count as no agreement;
    'reject' drops any pair with a null exact attribute.
    ``null_block``: 'exclude' leaves a row with a null block column out of that pass;
    'skip_null' drops the null part from the key, so such rows share what remains.
    ``match_invalid``: 'keep' compares every value; 'null' blanks values that failed
    one of their own quality rules.
    """

    blocking: tuple[tuple[str, ...], ...]
    attributes: tuple[MatchAttribute, ...]
    threshold: float
    null_policy: str = "zero"
    null_block: str = "exclude"
    match_invalid: str = "keep"

    def __post_init__(self):
        if self.null_policy not in ("zero", "reject"):
            raise ValueError(f"unknown null_policy {self.null_policy!r}")
        if self.null_block not in ("exclude", "skip_null"):
            raise ValueError(f"unknown null_block {self.null_block!r}")
        if self.match_invalid not in ("keep", "null"):
            raise ValueError(f"unknown match_invalid {self.match_invalid!r}")
        if not self.attributes or not self.blocking:
            raise ValueError("matching needs at least one attribute and one blocking pass")

    @property
    def total_weight(self) -> float:
        return sum(a.weight for a in self.attributes)

    def with_options(self, **changes) -> "MatchSpec":
        return replace(self, **changes)


@dataclass(frozen=True)
class SurvivorshipSpec:
    id_column: str
    source_priority: tuple[str, ...]
    auto_merge_threshold: float


@dataclass(frozen=True)
class EntitySpec:
    entity: str
    id_column: str
    name_column: str
    canonical: tuple[str, ...]
    sources: tuple[SourceSpec, ...]
    rules: tuple[RuleSpec, ...]
    min_score: float
    match: MatchSpec
    survivorship: SurvivorshipSpec
    gold_columns: tuple[tuple[str, str], ...]
    title_case: tuple[str, ...] = ()
    lower_case: tuple[str, ...] = ()
    upper_case: tuple[str, ...] = ()
    email_domain_from: str | None = None
    masked_columns: tuple[str, ...] = ()
    glossary: dict[str, str] = field(default_factory=dict)
    extra_blocking: tuple[tuple[str, ...], ...] = ()

    def source(self, name: str) -> SourceSpec:
        return next(s for s in self.sources if s.name == name)

    def with_match(self, **changes) -> "EntitySpec":
        return replace(self, match=self.match.with_options(**changes))


@dataclass(frozen=True)
class CostSpec:
    project_tag: str
    lookback_days: int
    daily_budget_usd: float
    hard_limit_usd: float
    unit_price_usd: dict[str, float]


def _read_yaml(path) -> dict:
    import yaml

    with open(path) as f:
        return yaml.safe_load(f)


def _rules(items) -> tuple[RuleSpec, ...]:
    return tuple(
        RuleSpec(r["name"], r["column"], r["type"], r["severity"], r.get("pattern"), tuple(r.get("values", ())))
        for r in items
    )


def _attributes(items) -> tuple[MatchAttribute, ...]:
    return tuple(MatchAttribute(a["column"], a["method"], float(a["weight"])) for a in items)


def _passes(items) -> tuple[tuple[str, ...], ...]:
    return tuple(tuple(p) for p in items)


def load_entity(name_or_path: str) -> EntitySpec:
    """Load a shipped entity by name ('customer', 'account') or a YAML file by path."""
    path = CONF_DIR / f"{name_or_path}.yml"
    raw = _read_yaml(path if path.exists() else name_or_path)
    sources = tuple(
        SourceSpec(
            name=name,
            format=s["format"],
            entity=raw["entity"],
            landing_path=s["landing_path"],
            priority=s["priority"],
            freshness_sla_hours=float(s["freshness_sla_hours"]),
            columns={c: by[name] for c, by in raw["columns"].items() if name in by},
        )
        for name, s in raw["sources"].items()
    )
    m = raw["match"]
    return EntitySpec(
        entity=raw["entity"],
        id_column=raw["id_column"],
        name_column=raw["name_column"],
        canonical=tuple(raw["canonical"]),
        sources=sources,
        rules=_rules(raw["rules"]),
        min_score=float(raw["min_score"]),
        match=MatchSpec(_passes(m["blocking"]), _attributes(m["attributes"]), float(m["threshold"])),
        survivorship=SurvivorshipSpec(
            raw["id_column"], tuple(raw["source_priority"]), float(m["auto_merge_threshold"])
        ),
        gold_columns=tuple((g["column"], g.get("as", g["column"])) for g in raw["gold_columns"]),
        title_case=tuple(raw.get("title_case", ())),
        lower_case=tuple(raw.get("lower_case", ())),
        upper_case=tuple(raw.get("upper_case", ())),
        email_domain_from=raw.get("email_domain_from"),
        masked_columns=tuple(raw.get("masked_columns", ())),
        glossary=dict(raw.get("glossary", {})),
        extra_blocking=_passes(raw.get("extra_blocking", ())),
    )


def load_cost(path=None, project_tag: str | None = None) -> CostSpec:
    """Spend limits and prices; the project whose usage counts must be named by the file or the caller."""
    raw = _read_yaml(path or CONF_DIR / "cost.yml")
    project = project_tag or raw.get("project_tag")
    if not project:
        raise ValueError("a cost check needs a project tag: without one it would count every job")
    return CostSpec(
        project,
        int(raw["lookback_days"]),
        float(raw["daily_budget_usd"]),
        float(raw["hard_limit_usd"]),
        {k: float(v) for k, v in (raw.get("unit_price_usd") or raw["dbu_price_usd"]).items()},
    )


def load_rules(path) -> tuple[tuple[RuleSpec, ...], float | None]:
    """Rules of a rules-only YAML file and the minimum score found in any of its sections."""
    raw = _read_yaml(path)
    sections = [raw, *(v for v in raw.values() if isinstance(v, dict))]
    minimum = next((float(s["min_dq_score_for_gold"]) for s in sections if "min_dq_score_for_gold" in s), None)
    return _rules(raw["rules"]), minimum


def load_match(path) -> tuple[MatchSpec, SurvivorshipSpec]:
    """Matching and survivorship of a match-rules-only YAML file.

    Every blocking pass the file declares is active, but for those written as a mapping with ``active: false``.
    """
    raw = _read_yaml(path)
    passes = [p for p in raw["blocking_keys"] if not isinstance(p, dict) or p.get("active", True)]
    spec = MatchSpec(
        _passes([p["columns"] if isinstance(p, dict) else p for p in passes]),
        _attributes(raw["match_attributes"]),
        float(raw["match_threshold"]),
    )
    survivorship = SurvivorshipSpec(
        raw["id_column"],
        tuple(raw["survivorship"]["source_priority"]),
        float(raw["auto_merge_threshold"]),
    )
    return spec, survivorship


def load_sources(sources_path, column_maps_path) -> tuple[SourceSpec, ...]:
    """Source list plus per-source column maps kept in two YAML files."""
    maps = _read_yaml(column_maps_path)["source_column_maps"]
    return tuple(
        SourceSpec(
            s["name"], s["format"], s["entity"], s["landing_path"], int(s["priority"]),
            float(s["freshness_sla_hours"]), dict(maps.get(s["name"], {})),
        )
        for s in _read_yaml(sources_path)["sources"]
    )
