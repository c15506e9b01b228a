"""Independent SQL (DuckDB dialect) for every registered query.

Written per rule, the way an analyst would check each one by hand — one
join per rule, window functions for "first grant", EXISTS for role pairs —
rather than by transcribing the single-pass Spark plan. Inputs are rebuilt
from the test tables with the same derivations as ``sources.derived``.
"""

from __future__ import annotations

import re

from grantscope import catalogue as cat
from grantscope.plans import registry as reg
from grantscope.sources import derived

AS_OF_DATE = "DATE '2001-09-01'"
AS_OF_TS = "TIMESTAMP '2001-09-01 12:00:00'"
TS_FMT = "'%Y-%m-%d %H:%M:%S'"
D_FMT = "'%Y-%m-%d'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def with_(ctes: list[str], select: str, log: bool = False) -> str:
    return "WITH " + ",\n".join(derived.sql_ctes(log) + ctes) + "\n" + select


def _case(col: str, mapping: dict, default) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN CAST({v} AS DOUBLE)" for k, v in mapping.items())
    return f"(CASE {col} {whens} ELSE CAST({default} AS DOUBLE) END)"


def rules_values(extra: list[dict] | None = None) -> str:
    rows = ", ".join(
        f"({q(r['id'])}, {q(r['name'])}, {q(r['type'])}, {q(r['severity'])}, {int(r['sla_hours'])}, "
        f"{q(', '.join(r['frameworks']))})" for r in cat.RULES + (extra or []))
    return f"rules(rule_id, rule_name, finding_type, severity, sla_hours, frameworks) AS (VALUES {rows})"


HIT_COLS = ("a.employee_id, e.full_name, e.department, a.system_id, a.system_name, a.system_criticality, "
            "a.access_level, a.access_id")
NO_PAIR = "CAST(NULL AS VARCHAR) AS role_a, CAST(NULL AS VARCHAR) AS role_b"


def findings_ctes(access: str = "access_rights", dormancy: int = 90, rules=None) -> list[str]:
    """CTEs ending in ``findings`` (record format) for the selected rules."""
    rules = rules or [r["id"] for r in cat.RULES]
    pairs = ", ".join(f"({q(a)}, {q(b)})" for a, b in cat.SOD_CONFLICT_PAIRS)
    depts = ", ".join(q(d) for d in cat.STANDARD_ROLE_DEPARTMENTS)
    join = "FROM ag a JOIN employees e ON a.employee_id = e.employee_id"
    per_rule = {
        "RULE-001": f"""SELECT 'RULE-001' AS rule_id, {HIT_COLS},
            'Employee terminated ' || coalesce(CAST(date_diff('day', e.termination_date, {AS_OF_DATE}) AS VARCHAR), '?')
            || ' day(s) ago; access to ''' || a.system_name || ''' was never revoked.' AS detail, {NO_PAIR}
            {join} WHERE e.status = 'terminated'""",
        "RULE-002": f"""SELECT 'RULE-002' AS rule_id, {HIT_COLS},
            'Access to ''' || a.system_name || ''' has not been used in '
            || CAST(date_diff('day', a.last_used_date, {AS_OF_DATE}) AS VARCHAR)
            || ' days (last used ' || strftime(a.last_used_date, {D_FMT}) || ').' AS detail, {NO_PAIR}
            {join} WHERE e.status = 'active' AND date_diff('day', a.last_used_date, {AS_OF_DATE}) >= {dormancy}""",
        "RULE-003": f"""SELECT 'RULE-003' AS rule_id, {HIT_COLS},
            '''' || e.full_name || ''' (' || e.department || ') holds ' || upper(a.access_level)
            || ' access on ''' || a.system_name || '''. Role does not require elevated privilege.' AS detail, {NO_PAIR}
            {join} WHERE e.status = 'active' AND e.department IN ({depts}) AND a.access_level IN ('admin', 'elevated')""",
        "RULE-004": """SELECT 'RULE-004' AS rule_id, f.employee_id, f.full_name, f.department, f.system_id,
            f.system_name, f.system_criticality, f.access_level, f.access_id,
            'SoD violation: ''' || f.full_name || ''' holds both ''' || p.role_a || ''' and ''' || p.role_b
            || ''' roles on ''' || f.system_name || '''. Compensating control or role split required.' AS detail,
            p.role_a, p.role_b
            FROM sod_first f, pairs p
            WHERE EXISTS (SELECT 1 FROM sod s WHERE s.employee_id = f.employee_id AND s.sod_role = p.role_a)
              AND EXISTS (SELECT 1 FROM sod s WHERE s.employee_id = f.employee_id AND s.sod_role = p.role_b)""",
        "RULE-005": f"""SELECT 'RULE-005' AS rule_id, employee_id, full_name, department, system_id, system_name,
            system_criticality, access_level, access_id,
            '''' || full_name || ''' has ' || upper(access_level)
            || ' privileges but MFA is not enabled on their account. Mandatory for all privileged access.' AS detail,
            {NO_PAIR}
            FROM (SELECT {HIT_COLS}, row_number() OVER (PARTITION BY a.employee_id ORDER BY a.access_id) AS rn
                  {join} WHERE e.status = 'active' AND e.mfa_enabled = false
                  AND a.access_level IN ('admin', 'elevated')) t WHERE rn = 1""",
        "RULE-006": f"""SELECT 'RULE-006' AS rule_id, {HIT_COLS},
            'Account ACC:' || a.access_id || ' on ''' || a.system_name || ''' is active but owner '''
            || e.full_name || ''' is terminated with no recorded business justification.' AS detail, {NO_PAIR}
            {join} WHERE e.status = 'terminated' AND a.business_justification IS NULL""",
        "RULE-007": f"""SELECT 'RULE-007' AS rule_id, {HIT_COLS},
            '''' || e.full_name || ''' has access to ''' || a.system_name
            || ''' (CRITICAL tier) with no recorded business justification. Approval documentation is required.'
            AS detail, {NO_PAIR}
            {join} WHERE e.status = 'active' AND a.system_criticality = 'critical'
            AND a.business_justification IS NULL""",
    }
    ctes = [
        f"ag AS (SELECT * FROM {access} WHERE is_active)",
        f"pairs(role_a, role_b) AS (VALUES {pairs})",
        "sod AS (SELECT a.*, e.full_name, e.department FROM ag a JOIN employees e ON a.employee_id = e.employee_id "
        "WHERE e.status = 'active' AND a.sod_role IS NOT NULL)",
        "sod_first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY employee_id ORDER BY access_id) "
        "AS rn FROM sod) t WHERE rn = 1)",
        "hits AS (" + "\nUNION ALL\n".join(per_rule[r] for r in rules) + ")",
        rules_values(),
    ]
    return ctes + scored_ctes()


def scored_ctes() -> list[str]:
    score = (f"round_even(least({_case('r.severity', cat.SEVERITY_BASE, cat.DEFAULT_SEVERITY_BASE)} * "
             f"{_case('h.system_criticality', cat.CRITICALITY_MULTIPLIER, cat.DEFAULT_CRITICALITY_MULTIPLIER)} * "
             f"{_case('h.access_level', cat.ACCESS_LEVEL_MULTIPLIER, cat.DEFAULT_ACCESS_LEVEL_MULTIPLIER)}, "
             "CAST(100 AS DOUBLE)), 1)")
    return [
        f"scored AS (SELECT h.*, r.rule_name, r.finding_type, r.severity, r.sla_hours, r.frameworks, "
        f"{score} AS risk_score FROM hits h JOIN rules r ON h.rule_id = r.rule_id)",
        "findings AS (SELECT 'FND-' || upper(md5(concat_ws('|', rule_id, coalesce(access_id, ''), "
        "coalesce(employee_id, ''), coalesce(role_a, ''), coalesce(role_b, '')))) AS finding_id, "
        "rule_id, rule_name, finding_type, severity, risk_score, "
        "CASE WHEN risk_score >= 80 THEN 'CRITICAL' WHEN risk_score >= 55 THEN 'HIGH' "
        "WHEN risk_score >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band, "
        "employee_id, full_name AS employee_name, department, system_id, system_name, system_criticality, "
        "access_level, access_id, detail, 'OPEN' AS status, "
        f"strftime({AS_OF_TS}, {TS_FMT}) AS detected_at, "
        f"strftime({AS_OF_TS} + sla_hours * INTERVAL 1 HOUR, {TS_FMT}) AS sla_deadline, "
        "frameworks FROM scored)",
    ]


FINDINGS = findings_ctes()
ORDER = "risk_score DESC, severity, rule_id, access_id, employee_id, finding_id"

ACCESS_COLS_FMT = ("access_id, employee_id, system_id, system_name, system_criticality, access_level, "
                   f"strftime(granted_date, {D_FMT}) AS granted_date, strftime(last_used_date, {D_FMT}) AS last_used_date, "
                   "granted_by, business_justification, is_active, sod_role, review_status")
EMP_COLS_FMT = ("employee_id, full_name, email, department, title, status, "
                f"strftime(hire_date, {D_FMT}) AS hire_date, strftime(termination_date, {D_FMT}) AS termination_date, "
                "manager_id, is_manager, mfa_enabled")


def title_sql(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower(replace({x}, '_', ' ')), ' '), "
            "lambda w: upper(w[1]) || w[2:]), ' ')")


def mean_sql(col: str = "risk_score", digits: int = 1) -> str:
    return f"round_even(CAST(sum(CAST({col} AS DECIMAL(7,1))) AS DOUBLE) / CAST(count(*) AS DOUBLE), {digits})"


KPI_SQL = f"""SELECT
  (SELECT count(*) FROM findings) AS total_findings,
  (SELECT count(*) FROM findings WHERE severity = 'CRITICAL') AS critical_findings,
  (SELECT count(*) FROM findings WHERE severity = 'HIGH') AS high_findings,
  (SELECT count(*) FROM findings WHERE severity = 'MEDIUM') AS medium_findings,
  (SELECT count(*) FROM findings WHERE severity = 'LOW') AS low_findings,
  (SELECT {mean_sql()} FROM findings) AS avg_risk_score,
  (SELECT max(risk_score) FROM findings) AS max_risk_score,
  (SELECT count(*) FROM employees WHERE status = 'active') AS active_employees,
  (SELECT count(*) FROM access_rights WHERE is_active) AS total_access_records,
  (SELECT count(DISTINCT employee_id) FROM findings) AS affected_employees,
  (SELECT count(DISTINCT system_name) FROM findings) AS affected_systems,
  round_even((CAST(1 AS DOUBLE) - CAST((SELECT count(*) FROM findings) AS DOUBLE)
     / CAST(greatest((SELECT count(*) FROM access_rights WHERE is_active), 1) AS DOUBLE)) * CAST(100 AS DOUBLE), 1)
     AS compliance_rate"""

INVENTORY = ["inv AS (SELECT a.*, e.full_name, e.department, e.status, e.title FROM access_rights a "
             "LEFT JOIN employees e ON a.employee_id = e.employee_id WHERE a.is_active)"]
INV_COLS_FMT = ACCESS_COLS_FMT + ", full_name, department, status, title"


def _vc(col: str, name: str = "findings", src: str = "findings") -> str:
    return f"SELECT {col}, count(*) AS {name} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col}"


DETAIL_SQL = {"full_name": "m.full_name", "level_upper": "upper(m.access_level)", "system_name": "m.system_name",
              "days_unused": "CAST(m.days_unused AS VARCHAR)", "term_days": "CAST(m.term_days AS VARCHAR)", "access_id": "m.access_id"}


def _custom_rules_sql(rules: list[tuple[dict, str]]) -> str:
    """One scan of the joined grants per rule."""
    rule_rows = ", ".join(f"({q(r['id'])}, {q(r['name'])}, {q(r['type'])}, {q(r['severity'])}, {int(r['sla_hours'])}, "
                          f"{q(', '.join(r['frameworks']))})" for r, _ in rules)

    def detail(template):
        parts = re.split(r"{(\w+)}", template)
        return " || ".join(DETAIL_SQL[p] if i % 2 else q(p) for i, p in enumerate(parts) if p)

    hits = "\nUNION ALL\n".join(
        f"SELECT {q(r['id'])} AS rule_id, m.employee_id, m.full_name, m.department, m.system_id, m.system_name, m.system_criticality, "
        f"m.access_level, m.access_id, {detail(r['detail'])} AS detail, {NO_PAIR} FROM owned m WHERE {p}" for r, p in rules)
    owned = ("owned AS (SELECT a.*, e.full_name, e.department, e.status, e.title, e.mfa_enabled, e.is_manager, "
             f"date_diff('day', a.last_used_date, {AS_OF_DATE}) AS days_unused, date_diff('day', e.termination_date, {AS_OF_DATE}) AS term_days "
             "FROM access_rights a JOIN employees e ON a.employee_id = e.employee_id WHERE a.is_active)")
    table = f"rules(rule_id, rule_name, finding_type, severity, sla_hours, frameworks) AS (VALUES {rule_rows})"
    return with_([owned, f"hits AS ({hits})", table] + scored_ctes(), "SELECT * FROM findings")


def _pair_table_sql() -> str:
    names = "[" + ", ".join(q(r) for r in reg.ROLES) + "]"
    n = len(reg.ROLES)
    pairs = (f"pairs AS (SELECT DISTINCT role_a, role_b FROM (SELECT {names}[n_nationkey % {n} + 1] AS role_a, "
             f"{names}[(n_nationkey * 3 + 1) % {n} + 1] AS role_b FROM nation) WHERE role_a < role_b)")
    return with_([pairs if c.startswith("pairs(") else c for c in findings_ctes(rules=["RULE-004"])], "SELECT * FROM findings")


def _notification_values() -> str:
    rows = ", ".join(f"({q(sev)}, {v['notify_within_hours']}, {q(rcp)})"
                     for sev, v in cat.NOTIFICATIONS.items() for rcp in v["recipients"])
    return f"notif(sev, hours, recipient) AS (VALUES {rows})"


def _weights_values() -> str:
    rows = ([("severity", k, v) for k, v in cat.SEVERITY_BASE.items()]
            + [("criticality", k, v) for k, v in cat.CRITICALITY_MULTIPLIER.items()]
            + [("access_level", k, v) for k, v in cat.ACCESS_LEVEL_MULTIPLIER.items()])
    body = ", ".join(f"({q(d)}, {q(k)}, CAST({v} AS DOUBLE))" for d, k, v in rows)
    return f"w(dimension, key, weight) AS (VALUES {body})"


def _control_values() -> str:
    body = ", ".join(f"({q(cat.CONTROL['id'])}, {q(cat.CONTROL['name'])}, {q(x['ref'])}, {q(x['description'])})"
                     for x in cat.CONTROL["frameworks"])
    return f"fw(control_id, control_name, ref, description) AS (VALUES {body})"


def _appended() -> str:
    first_to_second = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in cat.SOD_CONFLICT_PAIRS)
    firsts = ", ".join(q(a) for a, _ in cat.SOD_CONFLICT_PAIRS)
    return ("appended AS (SELECT * FROM access_rights UNION ALL "
            "SELECT 'SOD' || substr(access_id, 4) AS access_id, employee_id, system_id, system_name, "
            "system_criticality, access_level, granted_date, last_used_date, granted_by, business_justification, "
            f"is_active, CASE sod_role {first_to_second} END AS sod_role, review_status FROM access_rights "
            f"WHERE is_active AND sod_role IN ({firsts}))")


def _search_sql() -> str:
    cols = ["finding_id", "rule_id", "rule_name", "finding_type", "severity", "risk_score", "risk_band",
            "employee_id", "employee_name", "department", "system_id", "system_name", "system_criticality",
            "access_level", "access_id", "detail", "status", "detected_at", "sla_deadline", "frameworks"]
    cond = " OR ".join(f"coalesce(regexp_matches(CAST({c} AS VARCHAR), {q(reg.SEARCH_PATTERN)}, 'i'), false)"
                       for c in cols)
    return with_(FINDINGS, f"SELECT * FROM findings WHERE {cond}")


def _search_owner_sql() -> str:
    """The id may stand in any column of a finding, not only in its owner's."""
    cols = ["finding_id", "rule_id", "rule_name", "finding_type", "severity", "risk_band", "employee_id", "employee_name", "department",
            "system_id", "system_name", "system_criticality", "access_level", "access_id", "detail", "status", "frameworks"]
    cond = " OR ".join(f"contains(lower(f.{c}), lower(o.id))" for c in cols)
    return with_(FINDINGS, f"SELECT f.* FROM findings f, (SELECT min(employee_id) AS id FROM findings) o WHERE {cond}")


def _domain_sql() -> str:
    def outside(table, col, allowed, nullable=False):
        vals = ", ".join(q(v) for v in allowed)
        cond = f"{col} NOT IN ({vals})" + ("" if nullable else f" OR {col} IS NULL")
        return (f"SELECT {q(table)} AS table_name, {q(col)} AS column_name, coalesce({col}, '<null>') AS value, "
                f"count(*) AS n FROM {table} WHERE {cond} GROUP BY {col}")

    def dupes(table, col):
        return (f"SELECT {q(table)} AS table_name, {q(col + ' (duplicate)')} AS column_name, "
                f"coalesce({col}, '<null>') AS value, count(*) AS n FROM {table} GROUP BY {col} HAVING count(*) > 1")

    parts = [
        outside("employees", "status", cat.EMPLOYEE_STATUSES),
        outside("access_rights", "access_level", cat.ACCESS_LEVELS),
        outside("access_rights", "system_criticality", cat.CRITICALITIES),
        outside("access_rights", "sod_role", cat.SOD_ROLES, nullable=True),
        dupes("employees", "employee_id"),
        dupes("access_rights", "access_id"),
        "SELECT 'access_rights' AS table_name, 'employee_id (no employee)' AS column_name, '<missing>' AS value, "
        "count(*) AS n FROM access_rights a WHERE NOT EXISTS (SELECT 1 FROM employees e "
        "WHERE e.employee_id = a.employee_id) HAVING count(*) > 0",
    ]
    return with_([], "\nUNION ALL\n".join(parts))


def _pivot_sql() -> str:
    cols = ", ".join(f"count(*) FILTER (WHERE finding_type = {q(t)}) AS \"{t.replace('_', ' ').title()}\""
                     for t in [r["type"] for r in cat.RULES])
    return with_(FINDINGS, f"SELECT department, {cols} FROM findings WHERE department IS NOT NULL GROUP BY department")


def _two_reviews(select: str) -> str:
    """``before`` and ``now``: the findings of the earlier review, on the tables as they were then, and of the present one."""
    day = f"DATE {q(reg.EARLIER[:10])}"
    then = ["employees_then AS (SELECT employee_id, full_name, email, department, title, "
            f"CASE WHEN termination_date > {day} THEN 'active' ELSE status END AS status, hire_date, "
            f"CASE WHEN termination_date > {day} THEN NULL ELSE termination_date END AS termination_date, manager_id, is_manager, mfa_enabled "
            "FROM employees)", f"access_then AS (SELECT * FROM access_rights WHERE granted_date <= {day})"]
    old = ", ".join(re.sub(r"\bemployees\b", "employees_then", c) for c in findings_ctes(access="access_then"))
    old = old.replace(AS_OF_DATE, day).replace(AS_OF_TS, f"TIMESTAMP {q(reg.EARLIER)}")
    reviews = [f"before AS (WITH {old} SELECT * FROM findings)", f"now AS (WITH {', '.join(FINDINGS)} SELECT * FROM findings)"]
    return with_(then + reviews, select)


def _findings_diff_sql() -> str:
    compared = [c for c in ("rule_id", "rule_name", "finding_type", "severity", "risk_score", "risk_band", "employee_id", "employee_name",
                            "department", "system_id", "system_name", "system_criticality", "access_level", "access_id", "status", "frameworks")]
    differs = " OR ".join(f"b.{c} IS DISTINCT FROM n.{c}" for c in compared)
    columns = "concat_ws(', ', " + ", ".join(f"CASE WHEN b.{c} IS DISTINCT FROM n.{c} THEN {q(c)} END" for c in compared) + ")"
    both = ", ".join(f"coalesce(n.{c}, b.{c}) AS {c}" for c in ("finding_id", "rule_id", "severity", "employee_id", "system_name", "access_id"))
    return _two_reviews(
        f"SELECT {both}, CASE WHEN b.finding_id IS NULL THEN 'opened' WHEN n.finding_id IS NULL THEN 'closed' ELSE 'changed' END AS change, "
        f"CASE WHEN b.finding_id IS NOT NULL AND n.finding_id IS NOT NULL THEN {columns} END AS columns, b.risk_score AS risk_before, "
        f"n.risk_score AS risk_after FROM before b FULL JOIN now n ON b.finding_id = n.finding_id WHERE {differs}")


def _deadline_events_sql() -> str:
    t1, t2, t3 = (f"TIMESTAMP {q(t)}" for t in reg.TICKS)
    timers = ("timers AS (SELECT finding_id, rule_id, severity, 'BREACH' AS kind, CAST(NULL AS VARCHAR) AS recipient, CAST(sla_deadline AS TIMESTAMP) "
              "AS due_at FROM findings UNION ALL SELECT f.finding_id, f.rule_id, f.severity, 'NOTIFY', n.recipient, "
              "CAST(f.detected_at AS TIMESTAMP) + n.hours * INTERVAL 1 HOUR FROM findings f JOIN notif n ON lower(f.severity) = n.sev)")
    passed = lambda t: f"(due_at < {t} OR kind = 'NOTIFY' AND due_at = {t})"
    told = (f"SELECT *, CASE WHEN {passed(t1)} AND substr(finding_id, 5, 1) < '8' THEN {t1} WHEN {passed(t2)} THEN {t2} "
            f"WHEN {passed(t3)} AND rule_id <> {q(reg.CLOSED_RULE)} THEN {t3} END AS told_at FROM timers")
    return with_(FINDINGS + [_notification_values(), timers],
                 f"SELECT finding_id, severity, kind, recipient, strftime(due_at, {TS_FMT}) AS due_at, strftime(told_at, {TS_FMT}) AS emitted_at "
                 f"FROM ({told}) WHERE told_at IS NOT NULL")


def _meta_cols() -> str:
    return (f"{q(cat.PACKAGE_ID_PREFIX + '20010901_120000')} AS package_id, '2001-09-01T12:00:00' AS generated_at, "
            f"{q(cat.GENERATED_BY)} AS generated_by, {q(cat.CONTROL['id'])} AS control_id, "
            f"{q(cat.CONTROL['name'])} AS control_name, "
            f"{q(cat.REVIEW_PERIOD_PREFIX + '2001-09-01')} AS review_period, "
            f"{q(', '.join(cat.COMPLIANCE_FRAMEWORKS))} AS frameworks")


ORACLE: dict[str, str] = {
    "src_employees": with_([], f"SELECT {EMP_COLS_FMT} FROM employees"),
    "src_access": with_([], f"SELECT {ACCESS_COLS_FMT} FROM access_rights"),
    "src_systems": with_([], "SELECT * FROM systems"),
    "access_enriched": with_([], "SELECT system_id, system_name, system_criticality, count(*) AS grants, "
                             "min(access_id) AS first_grant FROM access_rights GROUP BY ALL"),
    "findings_hot_owner": with_(["skewed AS (SELECT access_id, CASE WHEN CAST(right(access_id, 3) AS INTEGER) % 3 = 0 "
                                 f"THEN {q(reg.HOT_OWNER)} ELSE employee_id END AS employee_id, "
                                 "system_id, system_name, system_criticality, access_level, granted_date, last_used_date, "
                                 "granted_by, business_justification, is_active, sod_role, review_status FROM access_rights)"]
                                + findings_ctes(access="skewed"), "SELECT * FROM findings"),
    "evidence_findings_csv": with_(FINDINGS, "SELECT * FROM findings"),
    "evidence_findings_json": with_(FINDINGS, "SELECT * FROM findings"),
    "evidence_access_csv": with_([], f"SELECT {ACCESS_COLS_FMT} FROM access_rights WHERE is_active"),
    "evidence_employee_csv": with_([], "SELECT employee_id, full_name, department, title, status, "
                                   f"strftime(hire_date, {D_FMT}) AS hire_date, "
                                   f"strftime(termination_date, {D_FMT}) AS termination_date FROM employees"),
    "evidence_summary_maps": with_(FINDINGS, " UNION ALL ".join(
        f"SELECT * FROM (SELECT {q(m)} AS metric, {c} AS key, count(*) AS value FROM findings WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY value DESC, key LIMIT {n})" for m, c, n in (
            ("by_severity", "severity", 1000), ("by_type", "finding_type", 1000), ("by_department", "department", 1000),
            ("by_system", "system_name", cat.TOP_SYSTEMS)))),
    "export_findings_filtered": with_(FINDINGS, "SELECT * FROM findings WHERE severity = 'CRITICAL'"),
    "export_access_inventory": with_(INVENTORY, f"SELECT {INV_COLS_FMT} FROM inv"),
    "export_admin_grants": with_(INVENTORY, f"SELECT {INV_COLS_FMT} FROM inv WHERE access_level = 'admin'"),
    "top_departments_ascending": with_(FINDINGS, "SELECT department, findings, row_number() OVER (ORDER BY findings, department DESC) "
                                       "AS position FROM (" + _vc("department") + " ORDER BY findings DESC, department LIMIT 8)"),
    "findings_page_count": with_(FINDINGS, "SELECT count(*) AS findings, CAST(greatest(1, ceil(count(*) / 12.0)) AS BIGINT) "
                                 "AS n_pages FROM findings"),
    "findings_card_feed": with_(FINDINGS, f"SELECT finding_id, severity, {title_sql('finding_type')} AS type, employee_name, "
                                "department, system_name, CASE WHEN length(detail) > 150 THEN substr(detail, 1, 150) || '…' "
                                "ELSE detail END AS detail, CAST(round_even(risk_score, 0) AS BIGINT) AS risk "
                                f"FROM findings ORDER BY {ORDER} LIMIT 20"),
    "stream_recheck_terminations": with_(findings_ctes(rules=["RULE-001", "RULE-006"]), "SELECT * FROM findings"),
    "rule_catalogue": with_(FINDINGS, "SELECT r.rule_id, r.rule_name, r.finding_type, r.severity, "
                            "CAST(r.sla_hours AS BIGINT) AS sla_hours, r.frameworks, "
                            "coalesce(c.findings, 0) AS findings FROM rules r LEFT JOIN "
                            "(SELECT rule_id, count(*) AS findings FROM findings GROUP BY rule_id) c "
                            "ON r.rule_id = c.rule_id"),
    "scoring_weights": with_(FINDINGS + [_weights_values()],
                             "SELECT w.dimension, w.key, w.weight, coalesce(u.findings, 0) AS findings FROM w "
                             "LEFT JOIN (SELECT dimension, key, count(*) AS findings FROM ("
                             "SELECT 'severity' AS dimension, severity AS key FROM findings UNION ALL "
                             "SELECT 'criticality', system_criticality FROM findings UNION ALL "
                             "SELECT 'access_level', access_level FROM findings) GROUP BY dimension, key) u "
                             "ON w.dimension = u.dimension AND w.key = u.key"),
    "control_frameworks": with_(FINDINGS + [_control_values()],
                                "SELECT fw.*, coalesce(c.findings, 0) AS findings FROM fw LEFT JOIN "
                                "(SELECT ref, count(*) AS findings FROM (SELECT unnest(string_split(frameworks, ', ')) "
                                "AS ref FROM findings) GROUP BY ref) c ON fw.ref = c.ref"),
    "sink_csv_roundtrip": with_([], f"SELECT {ACCESS_COLS_FMT} FROM access_rights"),
    "sink_json_roundtrip": with_(FINDINGS, "SELECT * FROM findings"),
    "evidence_access_snapshot": with_([], f"SELECT {ACCESS_COLS_FMT} FROM access_rights WHERE is_active"),
    "evidence_employee_snapshot": with_([], "SELECT employee_id, full_name, department, title, status, "
                                        f"strftime(hire_date, {D_FMT}) AS hire_date, "
                                        f"strftime(termination_date, {D_FMT}) AS termination_date FROM employees"),
    "evidence_summary_meta": with_(FINDINGS, f"SELECT {_meta_cols()}, k.* FROM ({KPI_SQL}) k"),
    "evidence_package_index": with_(FINDINGS, """SELECT * FROM (VALUES
        ('findings.csv', (SELECT count(*) FROM findings)),
        ('findings.json', (SELECT count(*) FROM findings)),
        ('access_snapshot.csv', (SELECT count(*) FROM access_rights WHERE is_active)),
        ('employee_snapshot.csv', (SELECT count(*) FROM employees)),
        ('summary.json', CAST(1 AS BIGINT))) t(file, rows)"""),
    "rule_001_terminated": with_(FINDINGS, "SELECT * FROM findings WHERE rule_id = 'RULE-001'"),
    "rule_002_dormant": with_(FINDINGS, "SELECT * FROM findings WHERE rule_id = 'RULE-002'"),
    "rule_002_dormant_180": with_(findings_ctes(dormancy=180), "SELECT * FROM findings WHERE rule_id = 'RULE-002'"),
    "rule_003_excessive": with_(FINDINGS, "SELECT * FROM findings WHERE rule_id = 'RULE-003'"),
    "rule_004_sod": with_(FINDINGS, "SELECT * FROM findings WHERE rule_id = 'RULE-004'"),
    "rule_005_mfa": with_(FINDINGS, "SELECT * FROM findings WHERE rule_id = 'RULE-005'"),
    "rule_006_orphaned": with_(FINDINGS, "SELECT * FROM findings WHERE rule_id = 'RULE-006'"),
    "rule_007_unjustified": with_(FINDINGS, "SELECT * FROM findings WHERE rule_id = 'RULE-007'"),
    "findings_all": with_(FINDINGS, f"SELECT * FROM findings ORDER BY {ORDER}"),
    "findings_from_stored": with_(FINDINGS, "SELECT * FROM findings"),
    "findings_split_hot_owners": with_(FINDINGS, "SELECT * FROM findings"),
    "risk_score_matrix": with_(FINDINGS, "SELECT severity, system_criticality, access_level, count(*) AS findings, "
                               "max(risk_score) AS risk_score, max(risk_band) AS risk_band FROM findings "
                               "GROUP BY severity, system_criticality, access_level"),
    "finding_id_unique": with_(FINDINGS, "SELECT rule_id, count(*) AS findings, count(DISTINCT finding_id) "
                               "AS distinct_ids FROM findings GROUP BY rule_id"),
    "summary_kpis": with_(FINDINGS, KPI_SQL),
    "review_kpis": with_(FINDINGS, KPI_SQL),
    "kpis_from_states": with_(FINDINGS, KPI_SQL),
    "departments_from_states": with_(FINDINGS, f"SELECT department, count(*) AS n_rows, {mean_sql()} AS mean_score, max(risk_score) AS max_score, "
                                     "count(DISTINCT employee_id) AS distinct_employee_id, count(DISTINCT system_name) AS distinct_system_name "
                                     "FROM findings WHERE severity <> 'LOW' GROUP BY department"),
    "inventory_stats_from_states": with_(INVENTORY, "SELECT count(*) AS access_records, count(DISTINCT employee_id) AS unique_employees, "
                                         "count(DISTINCT system_id) AS systems, count(*) FILTER (WHERE access_level = 'admin') AS admin_grants "
                                         "FROM inv WHERE system_criticality = 'critical'"),
    "summary_by_severity": with_(FINDINGS, _vc("severity")),
    "summary_by_type": with_(FINDINGS, _vc("finding_type")),
    "summary_by_department": with_(FINDINGS, _vc("department")),
    "summary_top_systems": with_(FINDINGS, _vc("system_name") + " ORDER BY findings DESC, system_name LIMIT 10"),
    "top_departments": with_(FINDINGS, _vc("department") + " ORDER BY findings DESC, department LIMIT 8"),
    "finding_type_breakdown": with_(FINDINGS, f"SELECT {title_sql('finding_type')} AS type, severity, "
                                    f"count(*) AS count, {mean_sql()} AS avg_risk FROM findings "
                                    "GROUP BY finding_type, severity"),
    "dept_type_pivot": _pivot_sql(),
    "risk_histogram": with_(FINDINGS, "SELECT bin, CAST(bin * 4 AS DOUBLE) AS bin_start, "
                            "CAST((bin + 1) * 4 AS DOUBLE) AS bin_end, count(*) AS findings, "
                            f"(SELECT {mean_sql()} FROM findings) AS mean_risk FROM "
                            "(SELECT CAST(least(floor(risk_score / 4), 24) AS BIGINT) AS bin FROM findings "
                            "WHERE risk_score IS NOT NULL) GROUP BY bin"),
    "severity_share": with_(FINDINGS, "SELECT severity, findings, round_even(CAST(findings AS DOUBLE) * 100 / "
                            "CAST(sum(findings) OVER () AS DOUBLE), 1) AS pct, CAST(CASE severity "
                            "WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 3 "
                            f"ELSE 4 END AS BIGINT) AS band_order FROM ({_vc('severity')})"),
    "risk_scatter_feed": with_(FINDINGS, "SELECT finding_id, access_level, risk_score, severity, "
                               "risk_score * CAST(0.45 AS DOUBLE) + CAST(3 AS DOUBLE) AS bubble_size, "
                               "employee_name, system_name, finding_type FROM findings"),
    "findings_metrics": with_(FINDINGS, "SELECT count(*) AS findings, count(*) FILTER (WHERE severity = 'CRITICAL') "
                              f"AS critical, {mean_sql(digits=0)} AS avg_risk, count(DISTINCT system_name) "
                              "AS systems_affected FROM findings WHERE department = 'Finance'"),
    "exec_header": with_(FINDINGS, "SELECT (SELECT count(*) FROM employees) AS employees, "
                         "(SELECT count(*) FROM access_rights WHERE is_active) AS active_grants, "
                         "(SELECT count(DISTINCT system_name) FROM findings) AS systems_with_findings"),
    "active_ratio": with_([], "SELECT avg(CAST(status = 'active' AS DOUBLE)) AS active_ratio FROM employees"),
    "access_level_mix": with_(INVENTORY, "SELECT access_level, grants, round_even(CAST(grants AS DOUBLE) * 100 / "
                              "CAST(sum(grants) OVER () AS DOUBLE), 1) AS pct FROM ("
                              + _vc("access_level", "grants", "inv") + ")"),
    "dept_access_levels": with_(INVENTORY, "SELECT department, access_level, count(*) AS grants FROM inv "
                                "WHERE department IS NOT NULL GROUP BY department, access_level"),
    "inventory_stats": with_(INVENTORY, "SELECT count(*) AS access_records, count(DISTINCT employee_id) "
                             "AS unique_employees, count(DISTINCT system_id) AS systems, "
                             "count(*) FILTER (WHERE access_level = 'admin') AS admin_grants FROM inv"),
    "findings_filter": with_(FINDINGS, "SELECT * FROM findings WHERE severity = 'CRITICAL' AND department = 'Finance'"),
    "findings_search": _search_sql(),
    "findings_table_view": with_(FINDINGS, 'SELECT finding_id AS "ID", severity AS "Severity", risk_score AS "Risk", '
                                 'finding_type AS "Type", employee_name AS "Employee", department AS "Department", '
                                 'system_name AS "System", system_criticality AS "Criticality", '
                                 'access_level AS "Access", sla_deadline AS "SLA Deadline" FROM findings'),
    "findings_page": with_(FINDINGS, f"SELECT *, CAST({reg.PAGE} AS BIGINT) AS page FROM findings ORDER BY {ORDER} "
                           f"LIMIT 12 OFFSET {(reg.PAGE - 1) * 12}"),
    "findings_page_deep": with_(FINDINGS, f"SELECT *, CAST({reg.DEEP_PAGE} AS BIGINT) AS page FROM findings ORDER BY {ORDER} "
                                f"LIMIT 100 OFFSET {(reg.DEEP_PAGE - 1) * 100}"),
    "finding_detail": with_(FINDINGS, "SELECT finding_id, rule_id, rule_name, detail, frameworks, "
                            'employee_name AS "Employee", department AS "Department", system_name AS "System", '
                            'upper(access_level) AS "Access", upper(system_criticality) AS "Criticality", '
                            "CAST(risk_score AS VARCHAR) || ' / 100' AS \"Risk Score\", risk_band AS \"Risk Band\", "
                            'substr(sla_deadline, 1, 16) AS "SLA", status AS "Status" '
                            f"FROM findings ORDER BY {ORDER} LIMIT 1"),
    "finding_lookup": with_(FINDINGS, "SELECT finding_id, rule_id, rule_name, detail, frameworks, "
                            'employee_name AS "Employee", department AS "Department", system_name AS "System", '
                            'upper(access_level) AS "Access", upper(system_criticality) AS "Criticality", '
                            "CAST(risk_score AS VARCHAR) || ' / 100' AS \"Risk Score\", risk_band AS \"Risk Band\", "
                            'substr(sla_deadline, 1, 16) AS "SLA", status AS "Status" '
                            "FROM findings WHERE finding_id = (SELECT min(finding_id) FROM findings WHERE rule_id = 'RULE-007')"),
    "filter_options": with_(FINDINGS, """SELECT kind, value, row_number() OVER (PARTITION BY kind ORDER BY k, value) AS position
        FROM (SELECT DISTINCT 'severity' AS kind, severity AS value,
                CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 3 ELSE 4 END AS k
              FROM findings WHERE severity IS NOT NULL
              UNION ALL SELECT DISTINCT 'department', department, 0 FROM findings WHERE department IS NOT NULL
              UNION ALL SELECT DISTINCT 'finding_type', finding_type, 0 FROM findings WHERE finding_type IS NOT NULL)"""),
    "top_findings_20": with_(FINDINGS, f"SELECT * FROM findings ORDER BY {ORDER} LIMIT 20"),
    "top_findings_30": with_(FINDINGS, f"SELECT * FROM findings ORDER BY {ORDER} LIMIT 30"),
    "findings_report_rows": with_(FINDINGS, "SELECT finding_id, severity, replace(finding_type, '_', ' ') AS type, "
                                  "employee_name, department, system_name, risk_score, CASE WHEN length(detail) > 120 "
                                  "THEN substr(detail, 1, 120) || '…' ELSE detail END AS detail FROM findings"),
    "findings_display_rows": with_(FINDINGS, "SELECT finding_id, severity, CAST(round_even(risk_score, 0) AS BIGINT) "
                                   "AS risk, CASE WHEN risk_score >= 70 THEN 'bold red' WHEN risk_score >= 40 "
                                   f"THEN 'yellow' ELSE 'green' END AS risk_style, {title_sql('finding_type')} AS type, "
                                   "employee_name, department, system_name, substr(sla_deadline, 1, 16) AS sla "
                                   f"FROM findings ORDER BY {ORDER} LIMIT 30"),
    "access_inventory": with_(INVENTORY, f"SELECT {INV_COLS_FMT} FROM inv WHERE status = 'terminated'"),
    "access_table_view": with_(INVENTORY, 'SELECT access_id AS "ID", full_name AS "Employee", department AS "Dept", '
                               'status AS "Emp Status", system_name AS "System", system_criticality AS "Criticality", '
                               f'access_level AS "Level", strftime(granted_date, {D_FMT}) AS "Granted", '
                               f'strftime(last_used_date, {D_FMT}) AS "Last Used", is_active AS "Active", '
                               'business_justification AS "Justification" FROM inv WHERE access_level = \'admin\''),
    "critical_no_justification": with_(INVENTORY, f"SELECT {INV_COLS_FMT} FROM inv WHERE system_criticality = "
                                       "'critical' AND (business_justification IS NULL OR "
                                       "trim(business_justification) = '')"),
    "admin_grants": with_(INVENTORY, 'SELECT full_name AS "Employee", department AS "Dept", system_name AS "System", '
                          f'system_criticality AS "Criticality", strftime(granted_date, {D_FMT}) AS "Granted", '
                          f'strftime(last_used_date, {D_FMT}) AS "Last Used", business_justification AS '
                          '"Justification", access_id FROM inv WHERE access_level = \'admin\' '
                          'ORDER BY last_used_date NULLS FIRST, access_id'),
    "manager_flag": with_([], "SELECT employee_id, title, coalesce(regexp_matches(title, "
                          f"{q('|'.join(cat.MANAGER_TITLE_WORDS))}), false) AS is_manager_title FROM employees"),
    "manager_assignment": with_([], f"SELECT e.employee_id, e.full_name, e.email, e.department, e.title, e.status, "
                                f"strftime(e.hire_date, {D_FMT}) AS hire_date, "
                                f"strftime(e.termination_date, {D_FMT}) AS termination_date, "
                                "CASE WHEN m.mgr <> e.employee_id THEN m.mgr END AS manager_id, e.is_manager, "
                                "e.mfa_enabled FROM employees e LEFT JOIN (SELECT department, min(employee_id) AS mgr "
                                "FROM employees WHERE is_manager AND department IS NOT NULL GROUP BY department) m "
                                "ON e.department = m.department"),
    "access_of_terminated": with_([], f"SELECT {ACCESS_COLS_FMT} FROM access_rights WHERE employee_id IN "
                                  "(SELECT employee_id FROM employees WHERE status = 'terminated')"),
    "access_append": with_([_appended()], f"SELECT {ACCESS_COLS_FMT} FROM appended"),
    "access_append_sod": with_([_appended()] + findings_ctes(access="appended", rules=["RULE-004"]),
                               "SELECT * FROM findings"),
    "domain_violations": _domain_sql(),
    "custom_predicate_rule": _custom_rules_sql([(reg.CUSTOM_RULE, reg.CUSTOM_PREDICATE)]),
    "custom_rule_set": _custom_rules_sql(reg.RULE_SET),
    "rule_004_pair_table": _pair_table_sql(),
    "framework_coverage": with_(FINDINGS, "SELECT framework, count(*) AS findings, count(DISTINCT rule_id) AS rules "
                                "FROM (SELECT unnest(string_split(frameworks, ', ')) AS framework, rule_id "
                                "FROM findings) GROUP BY framework"),
    "sla_status": with_(FINDINGS, "SELECT finding_id, severity, sla_deadline, CASE WHEN "
                        f"TIMESTAMP {q(reg.SLA_EVAL_TIME)} > CAST(sla_deadline AS TIMESTAMP) THEN 'BREACHED' "
                        "ELSE 'WITHIN_SLA' END AS sla_state, "
                        f"date_diff('hour', TIMESTAMP {q(reg.SLA_EVAL_TIME)}, CAST(sla_deadline AS TIMESTAMP)) "
                        "AS hours_left FROM findings"),
    "notification_queue": with_(FINDINGS + [_notification_values()],
                                "SELECT f.finding_id, f.severity, n.recipient, strftime(CAST(f.detected_at AS TIMESTAMP) "
                                f"+ n.hours * INTERVAL 1 HOUR, {TS_FMT}) AS notify_by FROM findings f "
                                "JOIN notif n ON lower(f.severity) = n.sev"),
    "evidence_retention": with_(FINDINGS, f"SELECT finding_id, strftime(CAST(detected_at AS DATE), {D_FMT}) AS "
                                f"evidence_date, strftime(CAST(detected_at AS DATE) + INTERVAL "
                                f"{12 * cat.EVIDENCE_RETENTION_YEARS} MONTH, {D_FMT}) AS retain_until FROM findings"),
    "unowned_grants": with_([], f"SELECT {ACCESS_COLS_FMT} FROM access_rights a WHERE NOT EXISTS "
                            "(SELECT 1 FROM employees e WHERE e.employee_id = a.employee_id)"),
    "last_used_from_log": with_([], "SELECT a.access_id, a.employee_id, a.system_id, "
                                f"strftime(a.last_used_date, {D_FMT}) AS last_used_date, "
                                f"strftime(CAST(l.last_seen AS DATE), {D_FMT}) AS last_log_date, "
                                "coalesce(l.log_events, 0) AS log_events, "
                                f"strftime(greatest(a.last_used_date, CAST(l.last_seen AS DATE)), {D_FMT}) "
                                "AS effective_last_used FROM access_rights a LEFT JOIN (SELECT employee_id, system_id, "
                                "max(ts) AS last_seen, count(*) AS log_events FROM access_log "
                                "GROUP BY employee_id, system_id) l ON a.employee_id = l.employee_id "
                                "AND a.system_id = l.system_id", log=True),
    "quick_export_findings": with_(FINDINGS, "SELECT * FROM findings"),
    "quick_export_employees": with_([], f"SELECT {EMP_COLS_FMT} FROM employees"),
    "quick_export_access": with_([], f"SELECT {ACCESS_COLS_FMT} FROM access_rights WHERE is_active"),
    "quick_exports_index": with_(FINDINGS, """SELECT * FROM (VALUES
        ('all_findings.csv', (SELECT count(*) FROM findings)),
        ('employees.csv', (SELECT count(*) FROM employees)),
        ('active_access.csv', (SELECT count(*) FROM access_rights WHERE is_active))) t(file, rows)"""),
    "view_exports_index": with_(FINDINGS, """SELECT * FROM (VALUES
        ('findings_filtered.csv', (SELECT count(*) FROM findings WHERE severity = 'CRITICAL')),
        ('access_inventory.csv', (SELECT count(*) FROM access_rights WHERE is_active)),
        ('admin_grants.csv', (SELECT count(*) FROM access_rights WHERE is_active AND access_level = 'admin'))
        ) t(file, rows)"""),
    "risk_gauge": with_(FINDINGS, f"SELECT avg_risk_score, CASE WHEN avg_risk_score >= 70 THEN 'red' "
                        "WHEN avg_risk_score >= 45 THEN 'orange' WHEN avg_risk_score >= 25 THEN 'amber' "
                        f"ELSE 'green' END AS gauge_tier FROM (SELECT {mean_sql()} AS avg_risk_score FROM findings)"),
    "rule_002_dormant_with_logs": with_(
        ["seen AS (SELECT employee_id, system_id, CAST(max(ts) AS DATE) AS last_seen FROM access_log "
         "GROUP BY employee_id, system_id)",
         "refreshed AS (SELECT a.access_id, a.employee_id, a.system_id, a.system_name, a.system_criticality, "
         "a.access_level, a.granted_date, greatest(a.last_used_date, s.last_seen) AS last_used_date, a.granted_by, "
         "a.business_justification, a.is_active, a.sod_role, a.review_status FROM access_rights a "
         "LEFT JOIN seen s ON a.employee_id = s.employee_id AND a.system_id = s.system_id)"]
        + findings_ctes(access="refreshed", rules=["RULE-002"]), "SELECT * FROM findings", log=True),
    "stream_last_used_from_log": with_([], f"SELECT employee_id, system_id, strftime(max(ts), {TS_FMT}) AS last_seen, "
                                       "count(*) AS log_events FROM access_log GROUP BY employee_id, system_id",
                                       log=True),
    "stream_daily_usage": with_([], f"SELECT employee_id, system_id, strftime(date_trunc('day', ts), {TS_FMT}) AS window_start, "
                                f"strftime(date_trunc('day', ts) + INTERVAL 1 DAY, {TS_FMT}) AS window_end, strftime(max(ts), {TS_FMT}) AS last_seen, "
                                "count(*) AS events FROM access_log GROUP BY employee_id, system_id, date_trunc('day', ts)", log=True),
    "stream_deadline_events": _deadline_events_sql(),
    "findings_search_indexed": _search_owner_sql(),
    "snapshot_findings_diff": _findings_diff_sql(),
    "snapshot_hr_changes": _two_reviews(
        "SELECT e.employee_id, 'changed' AS change, concat_ws(', ', CASE WHEN t.status IS DISTINCT FROM e.status THEN 'status' END, "
        "'termination_date') AS columns, t.status AS status_before, e.status AS status_after FROM employees e JOIN employees_then t "
        "ON e.employee_id = t.employee_id WHERE t.termination_date IS DISTINCT FROM e.termination_date"),
    "snapshot_trend": _two_reviews(" UNION ALL ".join(
        f"SELECT {q(at[:10])} AS snapshot_date, {q(at)} AS as_of, severity, count(*) AS findings, max(risk_score) AS max_risk "
        f"FROM {t} GROUP BY severity" for t, at in (("before", reg.EARLIER), ("now", reg.AS_OF)))),
    **{name: with_(findings_ctes(rules=["RULE-001", "RULE-003", "RULE-006", "RULE-007"]), "SELECT * FROM findings")
       for name in ("stream_terminated_access", "stream_revocations", "stream_hr_changes")},
}
