"""Interactive views over findings and the access inventory (F7–F16, T2, T5, W4, U2, U4, X-s).

Filters are plain ``where`` chains that Catalyst pushes toward the scans;
search is an OR of per-column regex tests; pages and top-N use a total order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantscope import catalogue as cat
from grantscope.functions import sqltext as sql
from grantscope.functions import text
from grantscope.functions.scoring import band_rank, literal_map
from grantscope.operators.findings import risk_order, sort_by_risk
from grantscope.operators.joins import inventory
from grantscope.operators.ranking import ranked
from grantscope.operators.summary import tiers


def filter_findings(findings: DataFrame, severity: str | None = None, department: str | None = None,
                    finding_type: str | None = None) -> DataFrame:
    """F8: optional equality filters, ANDed; ``None`` or ``"All"`` means no filter."""
    for col, value in (("severity", severity), ("department", department), ("finding_type", finding_type)):
        if value is not None and value != "All":
            findings = findings.where(F.col(col) == value)
    return findings


def search_findings(findings: DataFrame, pattern: str, literal: bool = False) -> DataFrame:
    """keep rows where any column, as text, contains ``pattern`` (case-insensitive regex, any script).

    Each column is tested on its own (no concatenation, so no cross-column
    hits); NULL never matches. ``literal=True`` escapes the pattern.
    """
    if not pattern:
        return findings
    if literal:
        pattern = "\\Q" + pattern.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    rx = sql.lit("(?iu)" + pattern)
    hit = " OR ".join(f"coalesce(CAST(`{c.replace('`', '``')}` AS STRING) RLIKE {rx}, false)"
                      for c in findings.columns)
    return findings.where(hit)


def access_inventory(access: DataFrame, employees: DataFrame, active_only: bool = True, status: str | None = None,
                     level: str | None = None, criticality: str | None = None,
                     split_hot_owners: bool = False) -> DataFrame:
    """F10 + J2: grants left-joined with their owners, then optional filters."""
    df = inventory(access, employees, split_hot_owners)
    if active_only:
        df = df.where(F.col("is_active") == F.lit(True))
    for col, value in (("status", status), ("access_level", level), ("system_criticality", criticality)):
        if value is not None and value != "All":
            df = df.where(F.col(col) == value)
    return df


def critical_without_justification(inv: DataFrame) -> DataFrame:
    """critical-system grants whose justification is NULL or blank."""
    return inv.where((F.col("system_criticality") == "critical") & text.is_blank(F.col("business_justification")))


def admin_grants(inv: DataFrame) -> DataFrame:
    """T5: admin grants, stalest first (NULL last-use first).

    The hash exchange on the grant id lets the range sort sample shuffle
    output instead of recomputing the inventory join.
    """
    return (inv.where(F.col("access_level") == "admin").repartition("access_id")
            .select(F.col("full_name").alias("Employee"), F.col("department").alias("Dept"),
                    F.col("system_name").alias("System"), F.col("system_criticality").alias("Criticality"),
                    F.col("granted_date").alias("Granted"), F.col("last_used_date").alias("Last Used"),
                    F.col("business_justification").alias("Justification"), "access_id")
            .orderBy(F.col("Last Used").asc_nulls_first(), F.col("access_id")))


def findings_table_view(findings: DataFrame) -> DataFrame:
    """the ten display columns of the findings table."""
    return findings.select(
        F.col("finding_id").alias("ID"), F.col("severity").alias("Severity"), F.col("risk_score").alias("Risk"),
        F.col("finding_type").alias("Type"), F.col("employee_name").alias("Employee"),
        F.col("department").alias("Department"), F.col("system_name").alias("System"),
        F.col("system_criticality").alias("Criticality"), F.col("access_level").alias("Access"),
        F.col("sla_deadline").alias("SLA Deadline"))


def access_table_view(inv: DataFrame) -> DataFrame:
    """the eleven display columns of the inventory table."""
    return inv.select(
        F.col("access_id").alias("ID"), F.col("full_name").alias("Employee"), F.col("department").alias("Dept"),
        F.col("status").alias("Emp Status"), F.col("system_name").alias("System"),
        F.col("system_criticality").alias("Criticality"), F.col("access_level").alias("Level"),
        F.col("granted_date").alias("Granted"), F.col("last_used_date").alias("Last Used"),
        F.col("is_active").alias("Active"), F.col("business_justification").alias("Justification"))


def filter_options(findings: DataFrame) -> DataFrame:
    """option lists — severities in band order, departments and types sorted.

    Long form (kind, value, position). One pass over the findings emits the
    three (kind, value) pairs of each row; ``distinct`` (map-side combined)
    leaves one row per value, so the ranking window only sees those.
    """
    pairs = F.expr(
        "explode(array(named_struct('kind', 'severity', 'value', severity), "
        "named_struct('kind', 'department', 'value', department), "
        "named_struct('kind', 'finding_type', 'value', finding_type)))")
    u = findings.select(pairs.alias("o")).select("o.kind", "o.value").where(F.col("value").isNotNull()).distinct()
    k = F.when(F.col("kind") == "severity", band_rank("value")).otherwise(F.lit(0))
    w = Window.partitionBy("kind").orderBy(k, F.col("value"))
    return u.select("kind", "value", F.row_number().over(w).cast("bigint").alias("position"))


def manager_flag(employees: DataFrame) -> DataFrame:
    """is the title a manager title (contains one of the fixed words, case-sensitive)."""
    rx = "|".join(cat.MANAGER_TITLE_WORDS)
    return employees.select("employee_id", "title",
                            F.coalesce(F.col("title").rlike(rx), F.lit(False)).alias("is_manager_title"))


def detail_card(findings: DataFrame) -> DataFrame:
    """F16: detail-card fields of each given finding."""
    return findings.select(
        "finding_id", "rule_id", "rule_name", "detail", F.array_join("frameworks", ", ").alias("frameworks"),
        F.col("employee_name").alias("Employee"), F.col("department").alias("Department"),
        F.col("system_name").alias("System"), F.upper("access_level").alias("Access"),
        F.upper("system_criticality").alias("Criticality"),
        F.concat(F.col("risk_score").cast("string"), F.lit(" / 100")).alias("Risk Score"),
        F.col("risk_band").alias("Risk Band"), text.minute_stamp(F.col("sla_deadline")).alias("SLA"),
        F.coalesce(F.col("status"), F.lit(cat.FINDING_STATUS_OPEN)).alias("Status"))


def finding_detail(findings: DataFrame, finding_id: str) -> DataFrame:
    """F11 + F16: the detail card of one finding by id (first match)."""
    return detail_card(findings.where(F.col("finding_id") == F.lit(finding_id)).orderBy(*risk_order()).limit(1))



def findings_page(findings: DataFrame, page: int, per_page: int = cat.FINDINGS_PER_PAGE) -> DataFrame:
    """Page ``page`` (1-based) of the risk-sorted findings."""
    if page < 1:
        raise ValueError("page starts at 1")
    return (sort_by_risk(findings).offset((page - 1) * per_page).limit(per_page)
            .withColumn("page", F.lit(page).cast("bigint")))


#: Ranks that one folder of a stored ranking holds.
RANK_BLOCK = 1_000_000


def store_ranked(findings: DataFrame, path: str) -> DataFrame:
    """Findings with their ``rank`` in risk order, stored under ``path`` in folders of ``RANK_BLOCK`` ranks.

    Ranks are counted in two levels (``ranking.ranked``), so no task and no driver passes the rows before a page.
    """
    table = ranked(findings, risk_order(), f"{path}/dealt").withColumn("block", F.floor((F.col("rank") - 1) / RANK_BLOCK))
    table.write.partitionBy("block").mode("overwrite").parquet(f"{path}/ranked")
    return findings.sparkSession.read.schema(table.schema).parquet(f"{path}/ranked")


def ranked_page(table: DataFrame, page: int, per_page: int = cat.FINDINGS_PER_PAGE) -> DataFrame:
    """Page ``page`` (1-based) of a stored ranking: a range of ranks, read from the folders that hold it."""
    if page < 1:
        raise ValueError("page starts at 1")
    first, last = (page - 1) * per_page + 1, page * per_page
    rows = table.where(F.col("block").between((first - 1) // RANK_BLOCK, (last - 1) // RANK_BLOCK) & F.col("rank").between(first, last))
    return rows.orderBy("rank").drop("rank", "block").withColumn("page", F.lit(page).cast("bigint"))


# The sort key of the risk order: score falling, the rest rising.
PAGE_KEY = ["risk_score", "severity", "rule_id", "access_id", "employee_id", "finding_id"]


def page_count(findings: DataFrame, per_page: int = cat.FINDINGS_PER_PAGE) -> DataFrame:
    """(findings, n_pages); an empty result is one page."""
    n = F.count(F.lit(1))
    return findings.agg(n.alias("findings"), F.greatest(F.ceil(n / per_page), F.lit(1)).cast("bigint").alias("n_pages"))


def findings_after(findings: DataFrame, last: dict | None, n: int = cat.FINDINGS_PER_PAGE) -> DataFrame:
    """Keyset page: the ``n`` findings that follow ``last`` in risk order (``None`` = first page).

    ``last`` holds the sort key of the previous page's last row (risk_score,
    severity, rule_id, access_id, employee_id, finding_id). Each task keeps
    only ``n`` rows however deep the page, unlike an offset.
    """
    if last is None:
        return top_findings(findings, n)
    after = None
    for col in reversed(PAGE_KEY):
        v = F.lit(last[col])
        strictly = F.col(col) < v if col == "risk_score" else F.col(col) > v
        after = strictly if after is None else (strictly | ((F.col(col) == v) & after))
    return top_findings(findings.where(after), n)


def top_findings(findings: DataFrame, n: int) -> DataFrame:
    """The ``n`` highest-risk findings (a top-k, planned as TakeOrderedAndProject)."""
    return sort_by_risk(findings).limit(n)


def report_rows(findings: DataFrame, width: int = cat.REPORT_DETAIL_WIDTH) -> DataFrame:
    """X-s2, X-s5: rows of the executive report table."""
    return findings.select(
        "finding_id", "severity", text.spaced(F.col("finding_type")).alias("type"), "employee_name",
        "department", "system_name", "risk_score", text.truncate(F.col("detail"), width).alias("detail"))


def card_feed(findings: DataFrame, n: int = 10, width: int = cat.CARD_DETAIL_WIDTH) -> DataFrame:
    """X-s5: the finding cards: top-``n`` rows with the detail cut at the card's width."""
    return top_findings(findings, n).select(
        "finding_id", "severity", text.title_words(F.col("finding_type")).alias("type"), "employee_name", "department",
        "system_name", text.truncate(F.col("detail"), width).alias("detail"),
        F.bround(F.col("risk_score"), 0).cast("bigint").alias("risk"))


def display_rows(findings: DataFrame, n: int = 30) -> DataFrame:
    """X-s1, X-s6, X-m2, X-m3: the top-``n`` console table rows."""
    score = F.col("risk_score")
    return top_findings(findings, n).select(
        "finding_id", "severity", F.bround(score, 0).cast("bigint").alias("risk"),
        tiers(score, cat.CONSOLE_RISK_STYLES, cat.CONSOLE_RISK_STYLE_DEFAULT).alias("risk_style"),
        text.title_words(F.col("finding_type")).alias("type"), "employee_name", "department", "system_name",
        text.minute_stamp(F.col("sla_deadline")).alias("sla"))


def append_grants(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Append grant rows; both sides must have exactly the same columns."""
    if sorted(base.columns) != sorted(extra.columns):
        raise ValueError(f"column mismatch: {sorted(set(base.columns) ^ set(extra.columns))}")
    return base.unionByName(extra, allowMissingColumns=False)


def sod_complement_grants(access: DataFrame) -> DataFrame:
    """Grants completing a conflicting pair: for each active grant of a pair's first role,
    the same owner is given the second role on the same system (ids ``SOD…``)."""
    first_to_second = {a: b for a, b in cat.SOD_CONFLICT_PAIRS}
    other = F.try_element_at(literal_map(first_to_second), F.col("sod_role"))
    src = access.where((F.col("is_active") == F.lit(True)) & other.isNotNull())
    return src.select(*[
        F.concat(F.lit("SOD"), F.substring(F.col("access_id"), 4, 1 << 20)).alias("access_id") if c == "access_id"
        else other.alias("sod_role") if c == "sod_role"
        else F.col(c)
        for c in access.columns])


def domain_violations(employees: DataFrame, access: DataFrame) -> DataFrame:
    """U4: values outside their allowed set, duplicate keys and grants without an owner.

    Long form (table_name, column_name, value, n). All value checks of a
    table run in one pass (each row emits its out-of-domain values, which
    are then counted); duplicate keys and missing owners are one aggregate
    and one anti join each.
    """
    def outside(df, table, checks):
        items = []
        for col, allowed, nullable in checks:
            bad = ~F.col(col).isin(allowed)
            if not nullable:
                bad = bad | F.col(col).isNull()
            items.append(F.when(bad, F.struct(F.lit(col).alias("column_name"),
                                              F.coalesce(F.col(col), F.lit("<null>")).alias("value"))))
        x = df.select(F.explode(F.array_compact(F.array(*items))).alias("v"))
        return (x.groupBy("v.column_name", "v.value").agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit(table).alias("table_name"), "column_name", "value", "n"))

    def dupes(df, table, col):
        return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                .select(F.lit(table).alias("table_name"), F.lit(col + " (duplicate)").alias("column_name"),
                        F.coalesce(F.col("value"), F.lit("<null>")).alias("value"), "n"))

    missing_owner = (access.join(employees.select("employee_id"), "employee_id", "left_anti")
                     .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0)
                     .select(F.lit("access_rights").alias("table_name"),
                             F.lit("employee_id (no employee)").alias("column_name"),
                             F.lit("<missing>").alias("value"), "n"))
    parts = [
        outside(employees, "employees", [("status", cat.EMPLOYEE_STATUSES, False)]),
        outside(access, "access_rights", [("access_level", cat.ACCESS_LEVELS, False),
                                          ("system_criticality", cat.CRITICALITIES, False),
                                          ("sod_role", cat.SOD_ROLES, True)]),
        dupes(employees, "employees", "employee_id"),
        dupes(access, "access_rights", "access_id"),
        missing_owner,
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
