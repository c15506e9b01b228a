"""Every implemented operator as a named query ``(spark, sf_dir) -> DataFrame``.

Inputs are the access-review tables derived from the test tables (see
``grantscope.sources.derived``); the review time is fixed so results are
reproducible. Outputs are in record format (``plans.present``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantscope import catalogue as cat
from grantscope.operators import evidence as E
from grantscope.operators import extensions as X
from grantscope.operators import joins as J
from grantscope.operators import rules as R
from grantscope.operators import states as ST
from grantscope.operators import summary as S
from grantscope.operators import views as V
from grantscope.operators.findings import build_findings, run_all_rules, to_findings
from grantscope.operators.search_index import SearchIndex
from grantscope.plans.present import record_format
from grantscope.session import shared_dir
from grantscope.sources import derived, sinks
from grantscope.sources.snapshots import SnapshotStore
from grantscope import schemas
from grantscope.streaming import continuous, usage
from grantscope.streaming.deadlines import DeadlineEvents
from grantscope.streaming.state import GRANT_EVENTS

# The review time of the test tables.
AS_OF = "2001-09-01 12:00:00"
SLA_EVAL_TIME = "2001-09-04 12:00:00"
# Ticks of the clock; before the last one, the findings of the closed rule are remediated.
TICKS = ("2001-09-01 16:00:00", "2001-09-04 12:00:00", "2001-09-20 00:00:00")
CLOSED_RULE = "RULE-006"
# An earlier review of the same tables, as they were then.
EARLIER = "2001-06-01 12:00:00"
SEARCH_PATTERN = "finance"
PAGE = 3
DEEP_PAGE = 9
HOT_OWNER = "EMP" + "1".rjust(19, "0")

CUSTOM_RULE = {
    "id": "RULE-X01", "name": "Admin Access on Critical System Without MFA", "type": "ADMIN_NO_MFA_CRITICAL",
    "severity": "HIGH", "sla_hours": 48, "frameworks": ["SOC 2 CC6.1"],
    "detail": "'{full_name}' holds {level_upper} access on critical system '{system_name}' without MFA.",
}
CUSTOM_PREDICATE = "status = 'active' AND access_level = 'admin' AND system_criticality = 'critical' AND NOT mfa_enabled"

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark, sf):
    return derived.load(spark, sf)


def _findings(spark, sf, rules=None, params=cat.RuleParams()):
    d = _tables(spark, sf)
    if rules is None:
        return build_findings(d["employees"], d["access_rights"], AS_OF, params)
    return build_findings(d["employees"], d["access_rights"], AS_OF, params, rules)


def _rules_of(**fields):
    """Ids of the catalogue's rules with these field values: a filter on them needs no other rule."""
    return tuple(r["id"] for r in cat.RULES if all(r[k] == v for k, v in fields.items()))


def _rule(rule_id, params=cat.RuleParams()):
    return lambda spark, sf: _findings(spark, sf, (rule_id,), params)


def _inventory(spark, sf, **kw):
    d = _tables(spark, sf)
    return V.access_inventory(d["access_rights"], d["employees"], **kw)


def findings_all(spark, sf):
    d = _tables(spark, sf)
    return run_all_rules(d["employees"], d["access_rights"], AS_OF)


def summary_kpis(spark, sf):
    d = _tables(spark, sf)
    f = build_findings(d["employees"], d["access_rights"], AS_OF)
    return S.kpis(f, d["employees"], d["access_rights"])


def _in_batches(states, df, key, batches=3):
    """``df`` added batch by batch, as tables that grow would be."""
    src, spark = shared_dir(states.spark, "batches"), states.spark
    df.withColumn("_batch", F.pmod(F.xxhash64(key), F.lit(batches))).write.partitionBy("_batch").parquet(src)
    for n in range(batches):
        states.add(spark.read.schema(df.schema).parquet(f"{src}/_batch={n}"), n)
    return states


def kpis_from_states(spark, sf):
    """The KPI row from the states of three batches of findings."""
    d = _tables(spark, sf)
    states = ST.finding_states(spark, shared_dir(spark, "finding-states"))
    return ST.kpis(_in_batches(states, _findings(spark, sf), "finding_id"), d["employees"], d["access_rights"])


def departments_from_states(spark, sf):
    """Findings, scores, owners and systems per department, without LOW findings, from the same states."""
    states = _in_batches(ST.finding_states(spark, shared_dir(spark, "finding-states")), _findings(spark, sf), "finding_id")
    return states.summary(("department",), F.col("severity") != "LOW")


def inventory_stats_from_states(spark, sf):
    """A14 of the critical systems' grants, from the states of three batches of the inventory."""
    states = _in_batches(ST.inventory_states(spark, shared_dir(spark, "inventory-states")), _inventory(spark, sf), "access_id")
    return ST.inventory_stats(states, F.col("system_criticality") == "critical")


def exec_header(spark, sf):
    d = _tables(spark, sf)
    f = build_findings(d["employees"], d["access_rights"], AS_OF)
    return S.exec_header(f, d["employees"], d["access_rights"])


def evidence_summary_meta(spark, sf):
    d = _tables(spark, sf)
    f = build_findings(d["employees"], d["access_rights"], AS_OF)
    return E.summary_meta(f, d["employees"], d["access_rights"], AS_OF)


def evidence_package_index(spark, sf):
    d = _tables(spark, sf)
    f = build_findings(d["employees"], d["access_rights"], AS_OF)
    idx = E.write_evidence_package(spark, f, d["employees"], d["access_rights"], shared_dir(spark, "evidence"), AS_OF)
    return idx.select("file", "rows")


def sink_csv_roundtrip(spark, sf):
    """Write the grants as CSV and read them back with the declared schema."""
    d = _tables(spark, sf)
    path = sinks.write_csv(d["access_rights"], shared_dir(spark, "csv") + "/access_rights")
    return sinks.read_csv(spark, path, schemas.ACCESS_RIGHTS)


def sink_json_roundtrip(spark, sf):
    """Write findings as JSON lines and read them back."""
    from grantscope.operators.findings import export_view
    from pyspark.sql import types as T
    f = export_view(_findings(spark, sf))
    path = sinks.write_json(f, shared_dir(spark, "json") + "/findings")
    schema = T.StructType([T.StructField(x.name, x.dataType) for x in f.schema.fields])
    return sinks.read_json(spark, path, schema)


def findings_from_stored(spark, sf):
    """The tables stored as Parquet, read back with their schema, then all rules."""
    from grantscope.sources import tables as TB
    base = TB.write_tables(_tables(spark, sf), shared_dir(spark, "tables"))
    t = TB.read_tables(spark, base)
    return run_all_rules(t["employees"], t["access_rights"], AS_OF)


def _reviews(spark, sf):
    """Snapshots of two reviews: the tables as they were at the earlier one (later grants gone, later leavers still there), and now."""
    d, store = _tables(spark, sf), SnapshotStore(spark, shared_dir(spark, "snapshots"))
    then = F.lit(EARLIER[:10]).cast("date")
    gone = F.coalesce(F.col("termination_date") > then, F.lit(False))
    emp = d["employees"].withColumns({"status": F.when(gone, F.lit("active")).otherwise(F.col("status")),
                                      "termination_date": F.when(~gone, F.col("termination_date"))})
    acc = d["access_rights"].where(F.col("granted_date") <= then)
    dates = [store.put(at, e, a, build_findings(e, a, at)) for at, e, a in ((EARLIER, emp, acc), (AS_OF, d["employees"], d["access_rights"]))]
    return store, *dates


def snapshot_findings_diff(spark, sf):
    """Findings opened, closed and changed between two stored reviews."""
    store, before, after = _reviews(spark, sf)
    return store.findings_diff(before, after)


def snapshot_hr_changes(spark, sf):
    """Employees that two stored reviews differ in, and in which columns."""
    store, before, after = _reviews(spark, sf)
    d = store.diff("employees", before, after)
    return d.select("employee_id", "change", "columns", F.col("was.status").alias("status_before"), F.col("now.status").alias("status_after"))


def snapshot_trend(spark, sf):
    """Findings per stored review and severity."""
    return _reviews(spark, sf)[0].trend(EARLIER, AS_OF)


def quick_exports_index(spark, sf):
    d = _tables(spark, sf)
    f = build_findings(d["employees"], d["access_rights"], AS_OF)
    idx = E.quick_exports(spark, f, d["employees"], d["access_rights"], shared_dir(spark, "exports"))
    return idx.select("file", "rows")


def view_exports_index(spark, sf):
    """S9–S11 with the dashboard defaults: CRITICAL findings, active inventory, its admin grants."""
    d = _tables(spark, sf)
    f = _findings(spark, sf, _rules_of(severity="CRITICAL"))
    inv = V.access_inventory(d["access_rights"], d["employees"])
    idx = E.view_exports(spark, f, inv, inv.where(F.col("access_level") == "admin"), shared_dir(spark, "views"))
    return idx.select("file", "rows")


def review_kpis(spark, sf):
    """A review run: findings written once to the shared folder, KPIs read from them."""
    from grantscope.review import Review
    d = _tables(spark, sf)
    return Review(spark, d["employees"], d["access_rights"], AS_OF).kpis()


def stream_last_used_from_log(spark, sf):
    return usage.run_available_now(usage.derived_stream(spark, sf), shared_dir(spark, "usage-stream"))


def stream_daily_usage(spark, sf):
    """Daily use of every (employee, system): logs in files that arrive out of order, folders folded on the way."""
    src = shared_dir(spark, "usage-files")
    log = derived.access_log(spark, sf)
    parts = log.withColumn("_file", F.pmod(F.xxhash64("ts"), F.lit(4)))
    for i in range(4):
        parts.where(F.col("_file") == i).drop("_file").coalesce(1).write.mode("append").parquet(src)
    stream = usage.log_stream(spark, src, log.schema, max_files=1)
    return usage.WindowedUsage(stream, shared_dir(spark, "daily-usage"), fold_every=2).run_available_now()


def stream_deadline_events(spark, sf):
    """Breaches and notifications as the clock moves: half of the findings arrive late, the first half a second time with them."""
    src, events = shared_dir(spark, "finding-files"), DeadlineEvents(spark, shared_dir(spark, "deadlines"))
    findings = _findings(spark, sf)
    early = F.col("finding_id").substr(5, 1) < "8"
    findings.where(early).write.parquet(src)
    stream = usage.log_stream(spark, src, findings.schema)
    events.follow(stream)
    events.advance(TICKS[0])
    findings.write.mode("append").parquet(src)
    events.follow(stream)
    events.advance(TICKS[1])
    events.advance(TICKS[1])  # a repeated tick
    events.advance(TICKS[2], spark.read.schema(findings.schema).parquet(src).where(F.col("rule_id") != CLOSED_RULE))
    return events.emitted().drop("event_id")


def stream_terminated_access(spark, sf):
    return continuous.run_available_now(continuous.derived_stream(spark, sf), derived.employees(spark, sf),
                                        derived.systems(spark, sf), shared_dir(spark, "stream"), AS_OF)


def stream_recheck_terminations(spark, sf):
    """Grants streamed while nobody had left; the re-check finds the owners who have left since."""
    emp, systems, out = derived.employees(spark, sf), derived.systems(spark, sf), shared_dir(spark, "recheck")
    before = emp.withColumns({"status": F.lit("active"), "termination_date": F.lit(None).cast("date")})
    continuous.run_available_now(continuous.derived_stream(spark, sf), before, systems, out, AS_OF, ("RULE-001", "RULE-006"))
    return continuous.recheck(emp, systems, out, AS_OF, ("RULE-001", "RULE-006"))


def _event_files(rows, src, files, order=lambda n: range(n)):
    """Rows as event files that arrive one after another, dealt by key and event time, so versions of a key arrive in any order."""
    dealt = rows.withColumn("_file", F.pmod(F.xxhash64(rows.columns[0], "event_time"), F.lit(files)))
    for i in order(files):
        dealt.where(F.col("_file") == i).drop("_file").coalesce(1).write.mode("append").parquet(src)


def _at(time):
    return F.lit(time).cast("timestamp_ntz").alias("event_time")


def stream_revocations(spark, sf):
    """Grants that were active and unjustified first, then as they are now (a fourth revoked); both versions arrive in any order."""
    src, base = shared_dir(spark, "grant-events"), derived.access_base(spark, sf)
    before = base.withColumns({"is_active": F.lit(True), "business_justification": F.lit(None).cast("string")})
    events = before.select("*", _at("2001-01-01 00:00:00")).unionByName(base.select("*", _at("2001-08-31 00:00:00")))
    _event_files(events, src, 3)
    stream = continuous.grant_stream(spark, src, GRANT_EVENTS, max_files=1)
    return continuous.run_available_now(stream, derived.employees(spark, sf), derived.systems(spark, sf), shared_dir(spark, "revocations"), AS_OF)


def stream_hr_changes(spark, sf):
    """Grants streamed while all owners were active; then only HR changes arrive, and wake the grants of those owners."""
    g_src, e_src, out = (shared_dir(spark, n) for n in ("grant-files", "hr-events", "hr-changes"))
    emp = derived.employees(spark, sf)
    before = emp.withColumns({"status": F.lit("active"), "termination_date": F.lit(None).cast("date")})
    derived.access_base(spark, sf).coalesce(1).write.parquet(g_src)
    before.select("*", _at("2001-01-01 00:00:00")).coalesce(1).write.parquet(e_src)
    stream = continuous.changes(continuous.grant_stream(spark, g_src), continuous.employee_stream(spark, e_src))
    systems = derived.systems(spark, sf)
    continuous.run_changes(stream, systems, out, AS_OF)
    _event_files(emp.where("status <> 'active'").select("*", _at("2001-08-31 00:00:00")), e_src, 2)
    return continuous.run_changes(stream, systems, out, AS_OF)


def _package_file(name):
    """The content of a file of the evidence package, read back."""
    def read(spark, sf):
        d = _tables(spark, sf)
        out = shared_dir(spark, "evidence")
        E.write_evidence_package(spark, build_findings(d["employees"], d["access_rights"], AS_OF), d["employees"],
                                 d["access_rights"], out, AS_OF, "run")
        return E.read_package_file(spark, E.package_dir(out, AS_OF, "run"), name)
    return read


def evidence_summary_maps(spark, sf):
    """The count dictionaries of the summary file, as rows."""
    row = _package_file("summary.json")(spark, sf)
    each = [row.select(F.lit(m).alias("metric"), F.posexplode(F.array(*[
        F.struct(F.lit(f.name).alias("key"), F.col(m)[f.name].alias("value")) for f in row.schema[m].dataType.fields])).alias("i", "e"))
        .select("metric", "e.key", "e.value") for m in ("by_severity", "by_type", "by_department", "by_system")]
    return reduce(lambda a, b: a.unionByName(b), each)


def _view_export(name):
    """The content of an export of the dashboard's views, read back."""
    def read(spark, sf):
        d = _tables(spark, sf)
        f = _findings(spark, sf, _rules_of(severity="CRITICAL"))
        inv = V.access_inventory(d["access_rights"], d["employees"])
        out = shared_dir(spark, "views")
        E.view_exports(spark, f, inv, inv.where(F.col("access_level") == "admin"), out)
        schema = E.EXPORT_SCHEMA if name == "findings_filtered.csv" else inv.schema
        return sinks.read_csv(spark, f"{out}/{name}", schema)
    return read


def _quick_export(name, schema):
    """The content of a quick export, read back as plain CSV."""
    def read(spark, sf):
        d, out = _tables(spark, sf), shared_dir(spark, "exports")
        E.quick_exports(spark, build_findings(d["employees"], d["access_rights"], AS_OF), d["employees"], d["access_rights"], out)
        return sinks.read_csv(spark, f"{out}/{name}", schema, "standard")
    return read


def findings_hot_owner(spark, sf):
    """Grants of which one employee holds a third: the hot-key split takes them out of the shuffle."""
    d = _tables(spark, sf)
    third = F.col("access_id").substr(-3, 3).cast("int") % 3 == 0
    acc = d["access_rights"].withColumn("employee_id", F.when(third, F.lit(HOT_OWNER)).otherwise(F.col("employee_id")))
    return build_findings(d["employees"], acc, AS_OF, cat.RuleParams(split_hot_owners=True))


def finding_lookup(spark, sf):
    """the detail card of a given id (here that of the first unjustified critical grant, computed as a user would)."""
    f = _findings(spark, sf)
    row = f.where("rule_id = 'RULE-007'").agg(F.min("finding_id")).first()
    return V.finding_detail(f, row[0])


def access_enriched(spark, sf):
    """What the lookup gave each system id: name and criticality, by default where no system row exists."""
    t = _tables(spark, sf)["access_rights"]
    return t.groupBy("system_id", "system_name", "system_criticality").agg(
        F.count(F.lit(1)).alias("grants"), F.min("access_id").alias("first_grant"))


def rule_catalogue(spark, sf):
    """The rule catalogue with the number of findings of each rule (0 when none)."""
    rules = spark.createDataFrame(
        [(r["id"], r["name"], r["type"], r["severity"], int(r["sla_hours"]), ", ".join(r["frameworks"]))
         for r in cat.RULES],
        "rule_id string, rule_name string, finding_type string, severity string, sla_hours bigint, frameworks string")
    # one row per rule id of the catalogue at most: a proven bound, safe to broadcast
    counts = S.value_counts(_findings(spark, sf), "rule_id")
    return rules.join(F.broadcast(counts), "rule_id", "left").na.fill(0, ["findings"])


def scoring_weights(spark, sf):
    """The three weight tables (long form) with how many findings use each weight."""
    rows = ([("severity", k, float(v)) for k, v in cat.SEVERITY_BASE.items()]
            + [("criticality", k, float(v)) for k, v in cat.CRITICALITY_MULTIPLIER.items()]
            + [("access_level", k, float(v)) for k, v in cat.ACCESS_LEVEL_MULTIPLIER.items()])
    w = spark.createDataFrame(rows, "dimension string, key string, weight double")
    f = _findings(spark, sf)
    used = (f.select(F.explode(F.array(
        F.struct(F.lit("severity").alias("dimension"), F.col("severity").alias("key")),
        F.struct(F.lit("criticality").alias("dimension"), F.col("system_criticality").alias("key")),
        F.struct(F.lit("access_level").alias("dimension"), F.col("access_level").alias("key")))).alias("u"))
        .groupBy("u.dimension", "u.key").agg(F.count(F.lit(1)).alias("findings")))
    return w.join(used, ["dimension", "key"], "left").na.fill(0, ["findings"])


def control_frameworks(spark, sf):
    """The control's framework references with the findings that cite each."""
    fw = spark.createDataFrame([(cat.CONTROL["id"], cat.CONTROL["name"], x["ref"], x["description"])
                                for x in cat.CONTROL["frameworks"]],
                               "control_id string, control_name string, ref string, description string")
    cov = X.framework_coverage(_findings(spark, sf)).select(F.col("framework").alias("ref"), "findings")
    return fw.join(cov, "ref", "left").na.fill(0, ["findings"])


def risk_score_matrix(spark, sf):
    """Score and band of every (severity, criticality, level) seen in findings."""
    f = _findings(spark, sf)
    # score and band are functions of the three keys, so they join the grouping keys
    return (f.groupBy("severity", "system_criticality", "access_level", "risk_score", "risk_band")
            .agg(F.count(F.lit(1)).alias("findings")))


def finding_id_unique(spark, sf):
    """C4: every finding id occurs once — count of ids and of distinct ids, per rule."""
    f = _findings(spark, sf)
    return f.groupBy("rule_id").agg(F.count(F.lit(1)).alias("findings"),
                                    F.count_distinct("finding_id").alias("distinct_ids"))


def findings_search_indexed(spark, sf):
    """F9 through the trigram index: the findings that name one owner (the one of the first finding), the others' blocks unread."""
    f = _findings(spark, sf)
    index = SearchIndex(spark, shared_dir(spark, "search-index"), f.schema)
    index.build(f)
    return index.search(index.rows().agg(F.min("employee_id")).first()[0], literal=True)


def finding_detail(spark, sf):
    """F11 + F16: the detail card of the highest-risk finding (one top-1 pass, no second scan)."""
    return V.detail_card(V.top_findings(_findings(spark, sf), 1))


def access_append(spark, sf):
    d = _tables(spark, sf)
    return V.append_grants(d["access_rights"], V.sod_complement_grants(d["access_rights"]))


def access_sod_findings_after_append(spark, sf):
    d = _tables(spark, sf)
    acc = V.append_grants(d["access_rights"], V.sod_complement_grants(d["access_rights"]))
    return build_findings(d["employees"], acc, AS_OF, rules=("RULE-004",))


def last_used_from_log(spark, sf):
    d = _tables(spark, sf)
    return X.last_used_from_log(d["access_rights"], derived.access_log(spark, sf))


def rule_002_dormant_with_logs(spark, sf):
    """R2 on grants whose last use is refreshed from the access logs."""
    d = _tables(spark, sf)
    acc = X.with_log_last_use(d["access_rights"], derived.access_log(spark, sf))
    return build_findings(d["employees"], acc, AS_OF, rules=("RULE-002",))


def custom_predicate_rule(spark, sf):
    d = _tables(spark, sf)
    return X.custom_rule_findings(d["employees"], d["access_rights"], CUSTOM_RULE, CUSTOM_PREDICATE, AS_OF)


# A custom rule set: catalogue fields and Spark SQL predicates (which DuckDB reads the same way).
RULE_SET = [
    (CUSTOM_RULE, CUSTOM_PREDICATE),
    ({"id": "RULE-X02", "name": "Stale Elevated Access", "type": "STALE_ELEVATED", "severity": "MEDIUM", "sla_hours": 168,
      "frameworks": ["NIST AC-2"], "detail": "'{full_name}' has not used elevated access on '{system_name}' for {days_unused} days."},
     "status = 'active' AND access_level = 'elevated' AND days_unused > 365"),
    ({"id": "RULE-X03", "name": "Manager With Role Conflict Potential", "type": "MANAGER_ROLE", "severity": "LOW", "sla_hours": 720,
      "frameworks": ["SOX ITGC", "COBIT"], "detail": "Manager '{full_name}' holds {level_upper} access on '{system_name}'."},
     "is_manager AND sod_role IN ('financial_approver', 'code_deployer')"),
    ({"id": "RULE-X04", "name": "Long Gone Owner", "type": "LONG_GONE", "severity": "CRITICAL", "sla_hours": 4,
      "frameworks": ["SOC 2 CC6.2"], "detail": "Owner of {access_id} left {term_days} days ago."},
     "status = 'terminated' AND term_days >= 90"),
]
# Roles as the grants have them, by number.
ROLES = ("financial_initiator", "financial_approver", "code_developer", "code_deployer", "user_admin", "user_auditor", "data_entry", "data_approver")


def custom_rule_set(spark, sf):
    d = _tables(spark, sf)
    return X.custom_rule_set_findings(d["employees"], d["access_rights"], RULE_SET, AS_OF)


def rule_004_pair_table(spark, sf):
    """R4 against a table of conflicts, here one for every nation (pairs repeat)."""
    d = _tables(spark, sf)
    role = lambda n: F.element_at(F.array(*map(F.lit, ROLES)), (n % len(ROLES) + 1).cast("int"))
    n = F.col("n_nationkey")
    pairs = derived.read_table(spark, sf, "nation").select(role(n).alias("role_a"), role(n * 3 + 1).alias("role_b")).where("role_a < role_b")
    return to_findings(R.pair_table_hits(d["employees"], d["access_rights"], pairs), AS_OF)


def _on_findings(fn):
    return lambda spark, sf: fn(_findings(spark, sf))


def _on_inventory(fn, **kw):
    return lambda spark, sf: fn(_inventory(spark, sf, **kw))


RAW: dict[str, Query] = {
    # sources
    "src_employees": lambda spark, sf: _tables(spark, sf)["employees"],
    "src_access": lambda spark, sf: _tables(spark, sf)["access_rights"],
    "src_systems": lambda spark, sf: _tables(spark, sf)["systems"],
    "access_enriched": access_enriched,
    "findings_from_stored": findings_from_stored,
    "rule_catalogue": rule_catalogue,
    "scoring_weights": scoring_weights,
    "control_frameworks": control_frameworks,
    # sinks
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "sink_json_roundtrip": sink_json_roundtrip,
    "evidence_access_snapshot": lambda spark, sf: E.access_snapshot(_tables(spark, sf)["access_rights"]),
    "evidence_employee_snapshot": lambda spark, sf: E.employee_snapshot(_tables(spark, sf)["employees"]),
    "evidence_summary_meta": evidence_summary_meta,
    "evidence_package_index": evidence_package_index,
    "evidence_findings_csv": _package_file("findings.csv"),
    "evidence_findings_json": _package_file("findings.json"),
    "evidence_access_csv": _package_file("access_snapshot.csv"),
    "evidence_employee_csv": _package_file("employee_snapshot.csv"),
    "evidence_summary_maps": evidence_summary_maps,
    "export_findings_filtered": _view_export("findings_filtered.csv"),
    "export_access_inventory": _view_export("access_inventory.csv"),
    "export_admin_grants": _view_export("admin_grants.csv"),
    "snapshot_findings_diff": snapshot_findings_diff,
    "snapshot_hr_changes": snapshot_hr_changes,
    "snapshot_trend": snapshot_trend,
    "quick_exports_index": quick_exports_index,
    "quick_export_findings": _quick_export("all_findings.csv", E.EXPORT_SCHEMA),
    "quick_export_employees": _quick_export("employees.csv", schemas.EMPLOYEES),
    "quick_export_access": _quick_export("active_access.csv", schemas.ACCESS_RIGHTS),
    "view_exports_index": view_exports_index,
    # rules
    "rule_001_terminated": _rule("RULE-001"),
    "rule_002_dormant": _rule("RULE-002"),
    "rule_002_dormant_180": _rule("RULE-002", cat.RuleParams(dormancy_days=180)),
    "rule_003_excessive": _rule("RULE-003"),
    "rule_004_sod": _rule("RULE-004"),
    "rule_004_pair_table": rule_004_pair_table,
    "rule_005_mfa": _rule("RULE-005"),
    "rule_006_orphaned": _rule("RULE-006"),
    "rule_007_unjustified": _rule("RULE-007"),
    "findings_all": findings_all,
    "findings_split_hot_owners": lambda spark, sf: _findings(spark, sf, params=cat.RuleParams(split_hot_owners=True)),
    "findings_hot_owner": findings_hot_owner,
    "risk_score_matrix": risk_score_matrix,
    "finding_id_unique": finding_id_unique,
    # summaries
    "summary_kpis": summary_kpis,
    "review_kpis": review_kpis,
    "kpis_from_states": kpis_from_states,
    "departments_from_states": departments_from_states,
    "inventory_stats_from_states": inventory_stats_from_states,
    "summary_by_severity": _on_findings(lambda f: S.value_counts(f, "severity")),
    "summary_by_type": _on_findings(lambda f: S.value_counts(f, "finding_type")),
    "summary_by_department": _on_findings(lambda f: S.value_counts(f, "department")),
    "summary_top_systems": _on_findings(lambda f: S.top_counts(f, "system_name", cat.TOP_SYSTEMS)),
    "top_departments": _on_findings(lambda f: S.top_counts(f, "department", cat.TOP_DEPARTMENTS)),
    "top_departments_ascending": _on_findings(lambda f: S.top_counts_ascending(f, "department", cat.TOP_DEPARTMENTS)),
    "finding_type_breakdown": _on_findings(S.type_breakdown),
    "dept_type_pivot": _on_findings(S.dept_type_pivot),
    "risk_histogram": _on_findings(S.risk_histogram),
    "severity_share": _on_findings(S.severity_share),
    "risk_scatter_feed": _on_findings(S.scatter_feed),
    "findings_metrics": _on_findings(lambda f: S.findings_metrics(V.filter_findings(f, department="Finance"))),
    "exec_header": exec_header,
    "active_ratio": lambda spark, sf: S.active_ratio(_tables(spark, sf)["employees"]),
    "access_level_mix": _on_inventory(lambda inv: S.with_share(S.value_counts(inv, "access_level", "grants"), "grants")),
    "dept_access_levels": _on_inventory(
        lambda inv: inv.where(F.col("department").isNotNull()).groupBy("department", "access_level")
        .agg(F.count(F.lit(1)).alias("grants"))),
    "inventory_stats": _on_inventory(S.inventory_stats),
    # views
    "findings_filter": lambda spark, sf: V.filter_findings(
        _findings(spark, sf, _rules_of(severity="CRITICAL")), severity="CRITICAL", department="Finance"),
    "findings_search": lambda spark, sf: V.search_findings(
        record_format(_findings(spark, sf)), SEARCH_PATTERN),
    "findings_search_indexed": findings_search_indexed,
    "findings_table_view": _on_findings(V.findings_table_view),
    "findings_page": lambda spark, sf: V.ranked_page(V.store_ranked(_findings(spark, sf), shared_dir(spark, "ranked")), PAGE),
    "findings_page_deep": lambda spark, sf: V.ranked_page(V.store_ranked(_findings(spark, sf), shared_dir(spark, "ranked")), DEEP_PAGE, 100),
    "findings_page_count": _on_findings(V.page_count),
    "findings_card_feed": _on_findings(lambda f: V.card_feed(f, 20)),
    "finding_detail": finding_detail,
    "finding_lookup": finding_lookup,
    "filter_options": _on_findings(V.filter_options),
    "top_findings_20": _on_findings(lambda f: V.top_findings(f, 20)),
    "top_findings_30": _on_findings(lambda f: V.top_findings(f, 30)),
    "findings_report_rows": _on_findings(V.report_rows),
    "findings_display_rows": _on_findings(lambda f: V.display_rows(f, 30)),
    "access_inventory": lambda spark, sf: _inventory(spark, sf, status="terminated"),
    "access_table_view": _on_inventory(V.access_table_view, level="admin"),
    "critical_no_justification": _on_inventory(V.critical_without_justification),
    "admin_grants": _on_inventory(V.admin_grants),
    "manager_flag": lambda spark, sf: V.manager_flag(_tables(spark, sf)["employees"]),
    "manager_assignment": lambda spark, sf: J.assign_managers(_tables(spark, sf)["employees"]),
    "access_of_terminated": lambda spark, sf: J.access_of_employees_with_status(
        _tables(spark, sf)["access_rights"], _tables(spark, sf)["employees"], "terminated"),
    "access_append": access_append,
    "access_append_sod": access_sod_findings_after_append,
    "domain_violations": lambda spark, sf: V.domain_violations(_tables(spark, sf)["employees"],
                                                               _tables(spark, sf)["access_rights"]),
    # extensions
    "custom_predicate_rule": custom_predicate_rule,
    "custom_rule_set": custom_rule_set,
    "framework_coverage": _on_findings(X.framework_coverage),
    "sla_status": _on_findings(lambda f: X.sla_status(f, SLA_EVAL_TIME)),
    "notification_queue": _on_findings(X.notification_queue),
    "evidence_retention": _on_findings(X.evidence_retention),
    "unowned_grants": lambda spark, sf: J.unowned_grants(_tables(spark, sf)["access_rights"],
                                                         _tables(spark, sf)["employees"]),
    "last_used_from_log": last_used_from_log,
    "rule_002_dormant_with_logs": rule_002_dormant_with_logs,
    "stream_terminated_access": stream_terminated_access,
    "stream_recheck_terminations": stream_recheck_terminations,
    "stream_revocations": stream_revocations,
    "stream_hr_changes": stream_hr_changes,
    "stream_last_used_from_log": stream_last_used_from_log,
    "stream_daily_usage": stream_daily_usage,
    "stream_deadline_events": stream_deadline_events,
    "risk_gauge": _on_findings(S.risk_gauge),
}


def _wrap(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return record_format(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {name: _wrap(fn) for name, fn in RAW.items()}
