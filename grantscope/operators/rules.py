"""The seven detection rules as one Spark plan (operators R1–R7, F1–F6, J1, U3, W1, W2).

Two branches replace seven separate passes:

* per grant (R1, R2, R3, R6, R7): active grants ⋈ employees once, every rule
  predicate evaluated on the joined row, one output row per (grant, rule) via
  ``explode`` of the matching rule ids;
* per employee (R4, R5): active grants are aggregated per employee *before*
  the join — the first privileged grant, the first grant with any SoD role
  and the set of conflict-pair roles held — so map-side partial aggregation
  collapses even an employee that owns a third of all grants, and only one
  row per employee reaches the join.

"First" means the smallest ``access_id``. NULL ``is_active`` is not active,
NULL ``mfa_enabled`` is not a hit, NULL keys never join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantscope import catalogue as cat
from grantscope.functions import sqltext as sql
from grantscope.operators.joins import split_hot_keys_join

PER_GRANT_RULES = ("RULE-001", "RULE-002", "RULE-003", "RULE-006", "RULE-007")
PER_EMPLOYEE_RULES = ("RULE-004", "RULE-005")
ALL_RULES = tuple(r["id"] for r in cat.RULES)

GRANT_FIELDS = ["system_id", "system_name", "system_criticality", "access_level", "access_id"]

# Columns every hit carries; the finding builder turns them into findings.
HIT_COLUMNS = [
    "rule_id", "employee_id", "full_name", "department", *GRANT_FIELDS,
    "term_days", "days_unused", "last_used_date", "role_a", "role_b",
]


ACTIVE = "is_active = true"


def _days_since(as_of: str, d: str) -> str:
    return f"datediff(to_date(CAST({sql.lit(as_of)} AS TIMESTAMP_NTZ)), {d})"


def grant_predicates(as_of: str, params: cat.RuleParams) -> dict[str, str]:
    """Per-grant rule predicates over an active grant joined with its owner (SQL text)."""
    priv = f"access_level IN {sql.in_list(params.privileged_levels)}"
    return {
        "RULE-001": "status = 'terminated'",
        "RULE-002": f"status = 'active' AND {_days_since(as_of, 'last_used_date')} >= {int(params.dormancy_days)}",
        "RULE-003": f"status = 'active' AND department IN {sql.in_list(params.standard_departments)} AND {priv}",
        "RULE-006": "status = 'terminated' AND no_justification",
        "RULE-007": "status = 'active' AND system_criticality = 'critical' AND no_justification",
    }


def per_grant_hits(employees: DataFrame, access: DataFrame, as_of: str, rules=PER_GRANT_RULES,
                   params: cat.RuleParams = cat.RuleParams()) -> DataFrame:
    rules = [r for r in PER_GRANT_RULES if r in rules]
    needs_term = any(r in rules for r in ("RULE-001", "RULE-006"))
    needs_act = any(r in rules for r in ("RULE-002", "RULE-003", "RULE-007"))
    statuses = (["terminated"] if needs_term else []) + (["active"] if needs_act else [])

    emp = employees.where(f"status IN {sql.in_list(statuses)}").select(
        "employee_id", "full_name", "department", "status", "termination_date")
    # Only whether a justification exists matters: ship a flag, not the text, through the join.
    grants = access.where(ACTIVE).selectExpr("employee_id", *GRANT_FIELDS, "last_used_date",
                                             "business_justification IS NULL AS no_justification")
    if params.split_hot_owners:
        m = split_hot_keys_join(grants, emp, "employee_id")
    else:
        m = grants.join(emp, "employee_id")

    pred = grant_predicates(as_of, params)
    hit_any = " OR ".join(f"({pred[r]})" for r in rules)
    rule_ids = "array_compact(array(" + ", ".join(f"CASE WHEN {pred[r]} THEN '{r}' END" for r in rules) + "))"
    return m.where(hit_any).selectExpr(
        f"explode({rule_ids}) AS rule_id", "employee_id", "full_name", "department", *GRANT_FIELDS,
        f"{_days_since(as_of, 'termination_date')} AS term_days",
        f"{_days_since(as_of, 'last_used_date')} AS days_unused",
        "last_used_date", "CAST(NULL AS STRING) AS role_a", "CAST(NULL AS STRING) AS role_b",
    )


def _pairs_sql(pairs) -> str:
    items = [f"named_struct('a', {sql.lit(a)}, 'b', {sql.lit(b)})" for a, b in pairs]
    return "array(" + ", ".join(items) + ")"


ITEM_TYPE = ("array<struct<rule_id:string,system_id:string,system_name:string,system_criticality:string,"
             "access_level:string,access_id:string,role_a:string,role_b:string>>")


def _item_sql(rule_id: str, g: str, a: str, b: str) -> str:
    fields = ", ".join(f"'{f}', {g}.{f}" for f in GRANT_FIELDS)
    return (f"named_struct('rule_id', '{rule_id}', {fields}, 'role_a', CAST({a} AS STRING), "
            f"'role_b', CAST({b} AS STRING))")


def per_employee_hits(employees: DataFrame, access: DataFrame, as_of: str, rules=PER_EMPLOYEE_RULES,
                      params: cat.RuleParams = cat.RuleParams()) -> DataFrame:
    rules = [r for r in PER_EMPLOYEE_RULES if r in rules]
    want_sod = "RULE-004" in rules
    want_mfa = "RULE-005" in rules
    pairs = [tuple(p) for p in params.sod_pairs]

    priv = f"access_level IN {sql.in_list(params.privileged_levels)}"
    has_sod = "sod_role IS NOT NULL"
    relevant = " OR ".join(([priv] if want_mfa else []) + ([has_sod] if want_sod else []))
    grant = "struct(" + ", ".join(GRANT_FIELDS) + ")"

    aggs = []
    if want_mfa:
        aggs.append(F.expr(f"min_by({grant}, CASE WHEN {priv} THEN access_id END)").alias("first_priv"))
    if want_sod:
        aggs.append(F.expr(f"min_by({grant}, CASE WHEN {has_sod} THEN access_id END)").alias("first_sod"))
    # Only roles that occur in a conflict pair are kept, so the set has at most that many
    # entries per employee whatever the number of grants; being a typed aggregate it also
    # lets the planner use a hash-based (ObjectHashAggregate) node instead of sorting, so
    # it is kept (and read, below) where only RULE-005 is asked for.
    known = sorted({r for p in pairs for r in p}) or [""]
    aggs.append(F.expr(f"collect_set(CASE WHEN sod_role IN {sql.in_list(known)} THEN sod_role END)").alias("roles"))
    # Partial aggregation on the map side: a hot employee is reduced per task before the shuffle.
    per_emp = access.where(f"{ACTIVE} AND ({relevant})").groupBy("employee_id").agg(*aggs)

    emp = employees.where("status = 'active'").select("employee_id", "full_name", "department", "mfa_enabled")
    j = per_emp.join(emp, "employee_id")

    parts = []
    if want_mfa:
        parts.append(f"CASE WHEN mfa_enabled = false AND first_priv IS NOT NULL AND size(roles) >= 0 "
                     f"THEN array({_item_sql('RULE-005', 'first_priv', 'NULL', 'NULL')}) "
                     f"ELSE CAST(array() AS {ITEM_TYPE}) END")
    if want_sod and pairs:
        parts.append(f"transform(filter({_pairs_sql(pairs)}, "
                     f"p -> array_contains(roles, p.a) AND array_contains(roles, p.b)), "
                     f"p -> {_item_sql('RULE-004', 'first_sod', 'p.a', 'p.b')})")
    items = parts[0] if len(parts) == 1 else "concat(" + ", ".join(parts) + ")"

    x = j.selectExpr("employee_id", "full_name", "department", f"explode({items}) AS h")
    return x.selectExpr(
        "h.rule_id AS rule_id", "employee_id", "full_name", "department", *[f"h.{f} AS {f}" for f in GRANT_FIELDS],
        "CAST(NULL AS INT) AS term_days", "CAST(NULL AS INT) AS days_unused", "CAST(NULL AS DATE) AS last_used_date",
        "h.role_a AS role_a", "h.role_b AS role_b",
    )


def pair_table_hits(employees: DataFrame, access: DataFrame, pairs: DataFrame) -> DataFrame:
    """R4 with a conflict matrix of any size, given as a table of ``role_a``, ``role_b``.

    The distinct (employee, role) of active grants meet the pairs on ``role_a``, then each other on (employee, ``role_b``). Roles
    that many employees hold are split off the shuffle (``split_hot_keys_join``); the second join's key is one row. The grant
    shown is the employee's first one with any role, as in ``per_employee_hits``. Repeated pairs count once.
    """
    held = access.where(f"{ACTIVE} AND sod_role IS NOT NULL")
    people = employees.where("status = 'active'").select("employee_id", "full_name", "department")
    roles = held.select("employee_id", F.col("sod_role").alias("role_a")).distinct()
    listed = pairs.where("role_a IS NOT NULL AND role_b IS NOT NULL").select("role_a", "role_b").distinct()
    wanted = split_hot_keys_join(roles, listed, "role_a")
    second = roles.select(F.col("employee_id").alias("_owner"), F.col("role_a").alias("_role"))
    conflicts = wanted.join(second, (F.col("employee_id") == F.col("_owner")) & (F.col("role_b") == F.col("_role")))
    grant = "struct(" + ", ".join(GRANT_FIELDS) + ")"
    first = held.groupBy("employee_id").agg(F.expr(f"min_by({grant}, access_id)").alias("g"))
    hits = conflicts.select("employee_id", "role_a", "role_b").join(first.join(people, "employee_id"), "employee_id")
    return hits.selectExpr("'RULE-004' AS rule_id", "employee_id", "full_name", "department", *[f"g.{f} AS {f}" for f in GRANT_FIELDS],
                           "CAST(NULL AS INT) AS term_days", "CAST(NULL AS INT) AS days_unused", "CAST(NULL AS DATE) AS last_used_date",
                           "role_a", "role_b")


def detect(employees: DataFrame, access: DataFrame, as_of: str, rules=ALL_RULES,
           params: cat.RuleParams = cat.RuleParams()) -> DataFrame:
    """Raw hits of the selected rules (one row per finding, columns ``HIT_COLUMNS``)."""
    parts = []
    if any(r in PER_GRANT_RULES for r in rules):
        parts.append(per_grant_hits(employees, access, as_of, rules, params))
    if any(r in PER_EMPLOYEE_RULES for r in rules):
        parts.append(per_employee_hits(employees, access, as_of, rules, params))
    if not parts:
        raise ValueError(f"no known rule in {rules}")
    return reduce(lambda a, b: a.unionByName(b), [p.select(*HIT_COLUMNS) for p in parts])
