"""Extensions declared by the control catalogue but not executed by the original tool.

Each is labelled an extension; parity of the core rules does not depend on them.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantscope import catalogue as cat
from grantscope.functions.dates import as_of_ts, plus_hours
from grantscope.functions.scoring import literal_map
from grantscope.operators import rules as R
from grantscope.operators.findings import to_findings
from grantscope.operators.joins import split_hot_keys_join


def custom_rule_findings(employees: DataFrame, access: DataFrame, rule: dict, predicate: str,
                         as_of: str, params: cat.RuleParams = cat.RuleParams()) -> DataFrame:
    """X1 (extension): an extra per-grant rule given as a Spark SQL predicate.

    The predicate sees every column of an active grant joined with its owner
    (``status``, ``department``, ``title``, ``mfa_enabled``, ``access_level``, …)
    and ``days_unused``. ``rule`` carries id, name, type, severity, sla_hours,
    frameworks and an optional ``detail`` template over the hit columns.
    """
    emp = employees.select("employee_id", "full_name", "department", "status", "title", "termination_date",
                           "is_manager", "mfa_enabled")
    active = access.where(F.col("is_active") == F.lit(True))
    m = split_hot_keys_join(active, emp, "employee_id") if params.split_hot_owners else active.join(emp, "employee_id")
    m = m.withColumn("days_unused", F.datediff(F.to_date(as_of_ts(as_of)), F.col("last_used_date")))
    hits = m.where(F.expr(predicate)).select(
        F.lit(rule["id"]).alias("rule_id"), "employee_id", "full_name", "department", *R.GRANT_FIELDS,
        F.datediff(F.to_date(as_of_ts(as_of)), F.col("termination_date")).alias("term_days"),
        "days_unused", "last_used_date",
        F.lit(None).cast("string").alias("role_a"), F.lit(None).cast("string").alias("role_b"))
    return to_findings(hits, as_of, replace(params, rules=tuple(params.rules) + (rule,)))


def _owned_grants(employees: DataFrame, access: DataFrame, as_of: str, params: cat.RuleParams) -> DataFrame:
    """Active grants joined with their owners once, with ``days_unused`` and ``term_days``: what custom predicates see."""
    emp = employees.select("employee_id", "full_name", "department", "status", "title", "termination_date", "is_manager", "mfa_enabled")
    active = access.where(F.col("is_active") == F.lit(True))
    m = split_hot_keys_join(active, emp, "employee_id") if params.split_hot_owners else active.join(emp, "employee_id")
    day = F.to_date(as_of_ts(as_of))
    return m.withColumns({"days_unused": F.datediff(day, F.col("last_used_date")), "term_days": F.datediff(day, F.col("termination_date"))})


def check_predicate(grants: DataFrame, rule_id: str, predicate: str) -> None:
    """A rule's predicate must be a condition on one row: Boolean, on known columns, without subquery, aggregate or chance."""
    if re.search(r"\bselect\b", re.sub(r"'(?:[^'\\]|\\.)*'", "''", predicate), re.IGNORECASE):
        raise ValueError(f"{rule_id}: a predicate can't have a subquery")
    try:
        tested = grants.select(F.expr(predicate).alias("hit"))
        kept = grants.where(F.expr(predicate))  # refuses aggregates and windows
    except AnalysisException as e:
        raise ValueError(f"{rule_id}: {str(e).splitlines()[0]}") from None
    if tested.schema["hit"].dataType != T.BooleanType():
        raise ValueError(f"{rule_id}: the predicate is {tested.schema['hit'].dataType.simpleString()}, not boolean")
    if not kept._jdf.queryExecution().analyzed().deterministic():
        raise ValueError(f"{rule_id}: the predicate isn't deterministic")


def custom_rule_set_findings(employees: DataFrame, access: DataFrame, rules: list[tuple[dict, str]], as_of: str,
                             params: cat.RuleParams = cat.RuleParams()) -> DataFrame:
    """X1 (extension): any number of custom rules, pairs (rule, predicate), on one join of grants and owners.

    Each predicate is checked first (``check_predicate``). All are evaluated on the joined row, one finding per (grant, rule)
    that holds; NULL doesn't hold.
    """
    ids = [rule["id"] for rule, _ in rules]
    if len(set(ids)) < len(ids):
        raise ValueError(f"rule ids repeat: {sorted({i for i in ids if ids.count(i) > 1})}")
    grants = _owned_grants(employees, access, as_of, params)
    for rule, predicate in rules:
        check_predicate(grants, rule["id"], predicate)
    held = F.array_compact(F.array(*[F.when(F.expr(f"({p})"), F.lit(rule["id"])) for rule, p in rules]))
    none = F.lit(None).cast("string")
    hits = grants.withColumn("_held", held if rules else F.array().cast("array<string>")).where(F.size("_held") > 0).select(
        F.explode("_held").alias("rule_id"), "employee_id", "full_name", "department", *R.GRANT_FIELDS, "term_days", "days_unused",
        "last_used_date", none.alias("role_a"), none.alias("role_b"))
    return to_findings(hits, as_of, replace(params, rules=tuple(params.rules) + tuple(rule for rule, _ in rules)))


def framework_coverage(findings: DataFrame) -> DataFrame:
    """X2 (extension): findings and rules per framework reference."""
    x = findings.select(F.explode("frameworks").alias("framework"), "rule_id")
    return x.groupBy("framework").agg(F.count(F.lit(1)).alias("findings"),
                                      F.count_distinct("rule_id").alias("rules"))


def sla_status(findings: DataFrame, eval_time: str) -> DataFrame:
    """X3 (extension): is each finding past its deadline at ``eval_time``, and hours left."""
    ev = F.lit(eval_time).cast("timestamp_ntz")
    return findings.select(
        "finding_id", "severity", "sla_deadline",
        F.when(ev > F.col("sla_deadline"), F.lit("BREACHED")).otherwise(F.lit("WITHIN_SLA")).alias("sla_state"),
        F.timestamp_diff("HOUR", ev, F.col("sla_deadline")).alias("hours_left"))


def notification_queue(findings: DataFrame) -> DataFrame:
    """X4 (extension): one row per (finding, recipient) with the notify-by time."""
    sev = F.lower(F.col("severity"))
    hours = F.try_element_at(literal_map({k: v["notify_within_hours"] for k, v in cat.NOTIFICATIONS.items()}), sev)
    recipients = F.try_element_at(
        F.create_map(*[x for k, v in cat.NOTIFICATIONS.items()
                       for x in (F.lit(k), F.array(*[F.lit(r) for r in v["recipients"]]))]), sev)
    return findings.where(hours.isNotNull()).select(
        "finding_id", "severity", F.explode(recipients).alias("recipient"),
        plus_hours(F.col("detected_at"), hours).alias("notify_by"))


def evidence_retention(findings: DataFrame, years: int = cat.EVIDENCE_RETENTION_YEARS) -> DataFrame:
    """X5 (extension): the date until which each finding's evidence must be kept."""
    return findings.select("finding_id", F.to_date("detected_at").alias("evidence_date"),
                           F.add_months(F.to_date("detected_at"), 12 * years).alias("retain_until"))


def last_used_from_log(access: DataFrame, access_log: DataFrame) -> DataFrame:
    """X8 (extension): refresh each grant's last use from access logs.

    Logs are reduced to one row per (employee, system) before the join, so the
    join sees one row per key on the log side however many events a hot
    account produces.
    """
    seen = access_log.groupBy("employee_id", "system_id").agg(
        F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("log_events"))
    j = access.join(seen, ["employee_id", "system_id"], "left")
    return j.select(
        "access_id", "employee_id", "system_id", "last_used_date",
        F.to_date("last_seen").alias("last_log_date"),
        F.coalesce(F.col("log_events"), F.lit(0)).alias("log_events"),
        F.greatest(F.col("last_used_date"), F.to_date("last_seen")).alias("effective_last_used"))



def with_log_last_use(access: DataFrame, access_log: DataFrame) -> DataFrame:
    """X8 (extension): grants whose ``last_used_date`` is refreshed from the access logs.

    Same columns as the grant table, so every rule (dormancy in particular)
    runs unchanged on the refreshed table. One join, of the grants with the
    logs reduced per (employee, system); no second pass over the grants.
    """
    seen = access_log.groupBy("employee_id", "system_id").agg(F.max("ts").alias("_last_seen"))
    j = access.join(seen, ["employee_id", "system_id"], "left")
    fresh = F.greatest(F.col("last_used_date"), F.to_date("_last_seen"))
    return j.select(*[fresh.alias(c) if c == "last_used_date" else F.col(c) for c in access.columns])
