"""Findings: scoring, metadata, detail text, ids and deadlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantscope import catalogue as cat
from grantscope.functions import sqltext as sql
from grantscope.functions import text
from grantscope.functions.scoring import band_sql, score_sql
from grantscope.operators import rules as R


def _rule_case(rules, field: str) -> str:
    """rule_id → one catalogue field, as a CASE over the (small, fixed) catalogue."""
    whens = []
    for r in rules:
        v = r.get(field)
        if field == "frameworks":
            v_sql = "array(" + ", ".join(sql.lit(x) for x in (v or [])) + ")"
            v_sql = f"CAST({v_sql} AS ARRAY<STRING>)"
        else:
            v_sql = sql.lit(v)
        whens.append(f"WHEN {sql.lit(r['id'])} THEN {v_sql}")
    return f"(CASE rule_id {' '.join(whens)} END)"


def finding_id_sql() -> str:
    """Deterministic id: ``FND-`` + the 32 upper hex digits of md5(rule|access|employee|role_a|role_b).

    All 128 bits are kept: with ~1e11 findings a 64-bit id would already
    expect collisions (birthday bound), a 128-bit one does not.
    """
    key = ", ".join(f"coalesce({c}, '')" for c in ("rule_id", "access_id", "employee_id", "role_a", "role_b"))
    return f"concat({sql.lit(cat.FINDING_ID_PREFIX)}, upper(md5(concat_ws('|', {key}))))"



DETAIL_FIELDS = {
    "term_days": "coalesce(cast(term_days AS STRING), '?')",
    "days_unused": "days_unused",
    "last_used_date": "last_used_date",
    "system_name": "system_name",
    "full_name": "full_name",
    "department": "department",
    "level_upper": "upper(access_level)",
    "role_a": "role_a",
    "role_b": "role_b",
    "access_id": "access_id",
}


def _detail_sql(rules) -> str:
    whens = []
    for r in rules:
        text_ = r.get("detail") or cat.DETAIL_TEMPLATES.get(r["id"])
        if text_ is not None:
            whens.append(f"WHEN {sql.lit(r['id'])} THEN {sql.template(text_, DETAIL_FIELDS)}")
    return f"(CASE rule_id {' '.join(whens)} END)"


def to_findings(hits: DataFrame, as_of: str, params: cat.RuleParams = cat.RuleParams()) -> DataFrame:
    """Hits (``rules.HIT_COLUMNS``) → findings with the full ``schemas.FINDINGS`` layout."""
    rules = params.rules
    detected = f"CAST({sql.lit(as_of)} AS TIMESTAMP_NTZ)"
    meta = hits.selectExpr(
        "*",
        f"{_rule_case(rules, 'name')} AS rule_name",
        f"{_rule_case(rules, 'type')} AS finding_type",
        f"{_rule_case(rules, 'severity')} AS severity",
        f"{_rule_case(rules, 'sla_hours')} AS sla_hours",
        f"{_rule_case(rules, 'frameworks')} AS frameworks",
    )
    scored = meta.selectExpr("*", f"{score_sql('severity', 'system_criticality', 'access_level')} AS risk_score")
    return scored.selectExpr(
        f"{finding_id_sql()} AS finding_id", "rule_id", "rule_name", "finding_type", "severity", "risk_score",
        f"{band_sql('risk_score')} AS risk_band", "employee_id", "full_name AS employee_name", "department",
        "system_id", "system_name", "system_criticality", "access_level", "access_id",
        f"{_detail_sql(rules)} AS detail", f"{sql.lit(cat.FINDING_STATUS_OPEN)} AS status",
        f"{detected} AS detected_at",
        f"timestampadd(HOUR, sla_hours, {detected}) AS sla_deadline", "frameworks",
    )


def build_findings(employees: DataFrame, access: DataFrame, as_of: str,
                   params: cat.RuleParams = cat.RuleParams(), rules=R.ALL_RULES) -> DataFrame:
    """All findings of the selected rules, unsorted (the building block of every output)."""
    return to_findings(R.detect(employees, access, as_of, rules, params), as_of, params)


# Total order of the risk sort: score desc, severity ascending (alphabetical), then ids.
def risk_order() -> list[Column]:
    return [
        F.col("risk_score").desc(), F.col("severity").asc(), F.col("rule_id").asc(),
        F.col("access_id").asc(), F.col("employee_id").asc(), F.col("finding_id").asc(),
    ]


def sort_by_risk(findings: DataFrame) -> DataFrame:
    """Risk order. Use directly under a limit/offset (planned as a top-k, no full sort)."""
    return findings.orderBy(*risk_order())


def sorted_findings(findings: DataFrame) -> DataFrame:
    """The whole table in risk order.

    A global sort samples its input to choose range boundaries; without a
    shuffle in between, the sampling job recomputes every upstream join. A
    hash exchange on the (unique) finding id is materialised first, so the
    sampler and the sort read shuffle files instead, and partitions stay even.
    """
    return sort_by_risk(findings.repartition("finding_id"))


def run_all_rules(employees: DataFrame, access: DataFrame, as_of: str,
                  params: cat.RuleParams = cat.RuleParams()) -> DataFrame:
    """Union of all seven rules, sorted by risk. Empty input gives an empty, fully typed frame."""
    return sorted_findings(build_findings(employees, access, as_of, params))


def export_view(findings: DataFrame) -> DataFrame:
    """Findings in their record format: timestamps as ``yyyy-MM-dd HH:mm:ss``, frameworks comma-joined."""
    cols = []
    for c in findings.columns:
        if c in ("detected_at", "sla_deadline"):
            cols.append(text.second_stamp(F.col(c)).alias(c))
        elif c == "frameworks":
            cols.append(F.array_join(F.col(c), ", ").alias(c))
        else:
            cols.append(F.col(c))
    return findings.select(*cols)
