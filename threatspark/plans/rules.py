"""Rule registry (U1, U2, D7): threat attributes and score factors.

A rule names its source, field(s) and how to read them; ``threat_value`` and ``score_expr`` turn the
registry into native Column expressions over a joined frame where each source
is a struct column named after its alias (null when the CVE has no record in
that source). No rule ever runs Python per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatspark.functions.casts import EPSS_DECIMAL, SCORE_DECIMAL, falsy_to_null
from threatspark.functions.nested import cvss_base, cwe_list, url_list

# Fixed values that must equal the reference's for right results:
# source alias -> gold table name.
COLLECTIONS = {
    "CISA": "gold_cisa",
    "NVD": "gold_nvd",
    "EPSS": "gold_epss",
    "ExploitDB": "gold_exploit",
    "Metasploit": "gold_metasploit",
}


@dataclass(frozen=True)
class ThreatRule:
    category: str
    name: str
    source: str
    field: str
    read: str = "identity"  # identity | cwe | url

    @property
    def key(self) -> str:
        return f"{self.category}_{self.name}"


@dataclass(frozen=True)
class ScoreRule:
    category: str
    name: str
    weight: Decimal
    source: str
    fields: tuple[str, ...]
    kind: str  # present | value | cvss


# Fixed values that must equal the reference's for right results:
# (category, name, source, field, reader) of the 15 threat attributes, in order.
THREAT_RULES: list[ThreatRule] = [
    ThreatRule("CISA", "required_action", "CISA", "required_action"),
    ThreatRule("CISA", "known_ransomware_campaign_use", "CISA", "known_ransomware_campaign_use"),
    ThreatRule("CISA", "product", "CISA", "product"),
    ThreatRule("CISA", "vendor_project", "CISA", "vendor_project"),
    ThreatRule("CISA", "cwe", "CISA", "cwes"),
    ThreatRule("EPSS", "epss_value", "EPSS", "epss"),
    ThreatRule("EPSS", "percentile", "EPSS", "percentile"),
    ThreatRule("ExploitDB", "exploit_id", "ExploitDB", "source_url"),
    ThreatRule("ExploitDB", "type", "ExploitDB", "type"),
    ThreatRule("ExploitDB", "platform", "ExploitDB", "platform"),
    ThreatRule("NVD", "weaknesses", "NVD", "weaknesses", "cwe"),
    ThreatRule("NVD", "references", "NVD", "references", "url"),
    ThreatRule("Metasploit", "module_name", "Metasploit", "name"),
    ThreatRule("Metasploit", "type", "Metasploit", "type"),
    ThreatRule("Metasploit", "platform", "Metasploit", "platform"),
]

# Fixed values that must equal the reference's for right results:
# (category, name, weight, source, fields, kind) of the 5 score factors.
SCORE_RULES: list[ScoreRule] = [
    ScoreRule("CISA", "CISA_KEY", Decimal("30.0"), "CISA", ("cve_id",), "present"),
    ScoreRule("EPSS", "EPSS", Decimal("10.0"), "EPSS", ("epss",), "value"),
    ScoreRule("ExploitDB", "EXPLOIT_DB", Decimal("10.0"), "ExploitDB", ("source_url",), "present"),
    ScoreRule("Metasploit", "METASPLOIT", Decimal("10.0"), "Metasploit", ("references",), "present"),
    ScoreRule("NVD", "NVD_CVSS_3", Decimal("0.5"), "NVD",
              ("metrics_cvssMetricV31", "metrics_cvssMetricV40", "metrics_cvssMetricV2"), "cvss"),
]

_registry_threats: list[ThreatRule] = list(THREAT_RULES)
_registry_scores: list[ScoreRule] = list(SCORE_RULES)


def threat_rule(rule: ThreatRule) -> ThreatRule:
    """Register an extra threat attribute (extension point U1)."""
    _registry_threats.append(rule)
    return rule


def score_rule(rule: ScoreRule) -> ScoreRule:
    """Register an extra score factor (extension point U2)."""
    _registry_scores.append(rule)
    return rule


def threat_rules() -> list[ThreatRule]:
    return list(_registry_threats)


def score_rules() -> list[ScoreRule]:
    return list(_registry_scores)


@dataclass
class SourceShape:
    """Struct schema of each source column in the joined frame."""
    schemas: dict[str, T.StructType] = field(default_factory=dict)

    def field_type(self, source: str, name: str) -> T.DataType | None:
        s = self.schemas.get(source)
        if s is None or name not in s.fieldNames():
            return None
        return s[name].dataType


def _sub(source: str, name: str) -> Column:
    return F.col(source)[name]


def threat_value(rule: ThreatRule, shape: SourceShape) -> Column:
    """One threat attribute as a Column, with Python truthiness."""
    dt = shape.field_type(rule.source, rule.field)
    if dt is None:
        return F.lit(None)
    schema = shape.schemas[rule.source]
    if rule.read == "cwe":
        val = cwe_list(schema, rule.field, root=F.col(rule.source))
        dt = T.ArrayType(T.StringType())
    elif rule.read == "url":
        val = url_list(schema, rule.field, root=F.col(rule.source))
        dt = T.ArrayType(T.StringType())
    else:
        val = _sub(rule.source, rule.field)
    return falsy_to_null(val, dt)


def score_addend(rule: ScoreRule, shape: SourceShape) -> Column:
    """Contribution of one factor (G2/G3) as decimal(12,5); 0 when absent."""
    w = F.lit(rule.weight)
    zero = F.lit(0).cast(SCORE_DECIMAL)
    if rule.kind == "present":
        return F.when(F.col(rule.source).isNotNull(), w).otherwise(zero).cast(SCORE_DECIMAL)
    if rule.kind == "value":
        f = rule.fields[0]
        if shape.field_type(rule.source, f) is None:
            return zero
        v = F.coalesce(_sub(rule.source, f).try_cast(EPSS_DECIMAL), F.lit(0).cast(EPSS_DECIMAL))
        return (v * w).cast(SCORE_DECIMAL)
    if rule.kind == "cvss":
        schema = shape.schemas.get(rule.source, T.StructType())
        return (cvss_on(rule.source, schema) * w).cast(SCORE_DECIMAL)
    raise ValueError(f"unknown rule kind {rule.kind}")


def cvss_on(source: str, schema: T.StructType) -> Column:
    """H7 evaluated on the struct column ``source``."""
    root = F.col(source)
    return cvss_base(schema, root=root)


def score_expr(shape: SourceShape, rules: list[ScoreRule] | None = None) -> Column:
    """Rounded weighted sum of all factors, as double."""
    rules = rules if rules is not None else score_rules()
    total = F.lit(0).cast(SCORE_DECIMAL)
    for r in rules:
        total = total + score_addend(r, shape)
    return F.round(total.cast(SCORE_DECIMAL), 2).cast("double")
