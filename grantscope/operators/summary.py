"""Summary metrics, breakdowns and chart feeds over findings.

Every metric is one distributed aggregate (partial per task, merged once);
share-of-total columns are computed over the already aggregated rows, whose
number is bounded by the number of groups, never over raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantscope import catalogue as cat
from grantscope.functions import text
from grantscope.functions.scoring import band_rank


def mean_1dp(score: Column, n: Column | None = None) -> Column:
    """Average score rounded half-even to 1 decimal, summed exactly as decimal (order independent)."""
    total = F.sum(score.cast("decimal(7,1)")).cast("double")
    return F.bround(F.try_divide(total, (n if n is not None else F.count(score)).cast("double")), 1)


def fold_rows(*parts: DataFrame) -> DataFrame:
    """Put several one-row aggregates side by side without a join.

    Each part is a one-row frame with its own columns; they are unioned (the
    other parts' columns NULL) and folded with ``max`` into one row. Only the
    already aggregated rows travel, never the inputs.
    """
    cols = [(c, t) for p in parts for c, t in p.dtypes]
    u = None
    for p in parts:
        have = set(p.columns)
        a = p.selectExpr(*[f"`{c}`" if c in have else f"CAST(NULL AS {t}) AS `{c}`" for c, t in cols])
        u = a if u is None else u.unionByName(a)
    return u.selectExpr(*[f"max(`{c}`) AS `{c}`" for c, _ in cols])


MEAN_1DP_SQL = ("bround(try_divide(CAST(sum(CAST(risk_score AS DECIMAL(7,1))) AS DOUBLE), "
                "CAST(count(risk_score) AS DOUBLE)), 1)")


def kpis(findings: DataFrame, employees: DataFrame, access: DataFrame) -> DataFrame:
    """A1 + A6: the one-row KPI table.

    Each input is reduced by its own global aggregate (partial per task,
    merged once). Only the employees are counted by a distinct aggregate; the
    systems, a bounded dimension, are counted as a set, so no row is expanded.
    The three one-row results are folded together without a join.
    """
    sev = [f"count_if(severity = '{s}') AS {s.lower()}_findings" for s in cat.BAND_ORDER]
    f = findings.selectExpr(
        "count(1) AS total_findings", *sev, f"{MEAN_1DP_SQL} AS avg_risk_score",
        "max(risk_score) AS max_risk_score", "count(DISTINCT employee_id) AS affected_employees",
        "CAST(size(collect_set(system_name)) AS BIGINT) AS affected_systems")
    e = employees.selectExpr("count_if(status = 'active') AS active_employees")
    a = access.selectExpr("count_if(is_active = true) AS total_access_records")
    return fold_rows(f, e, a).selectExpr(
        "total_findings", *[f"{s.lower()}_findings" for s in cat.BAND_ORDER], "avg_risk_score",
        "max_risk_score", "active_employees", "total_access_records", "affected_employees", "affected_systems",
        "bround((1.0D - CAST(total_findings AS DOUBLE) / CAST(greatest(total_access_records, 1) AS DOUBLE)) "
        "* 100.0D, 1) AS compliance_rate")


def value_counts(df: DataFrame, key: str, name: str = "findings") -> DataFrame:
    """``value_counts`` of one column; NULL keys are dropped as pandas does."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def with_share(counts: DataFrame, n: str, name: str = "pct") -> DataFrame:
    """Add ``n`` as a percent of the total, 1 dp. Runs over aggregated rows only."""
    total = F.sum(n).over(Window.partitionBy())
    return counts.withColumn(name, F.bround(F.col(n).cast("double") * 100.0 / total.cast("double"), 1))


def top_counts(df: DataFrame, key: str, k: int, name: str = "findings") -> DataFrame:
    return value_counts(df, key, name).orderBy(F.col(name).desc(), F.col(key).asc()).limit(k)


def top_counts_ascending(df: DataFrame, key: str, k: int, name: str = "findings") -> DataFrame:
    """T4: the ``k`` largest counts, smallest first (``position`` from 1), as a bar chart draws them."""
    top = top_counts(df, key, k, name)
    place = F.row_number().over(Window.partitionBy().orderBy(F.col(name).asc(), F.col(key).desc()))  # k rows
    return top.withColumn("position", place.cast("bigint"))


def severity_share(findings: DataFrame) -> DataFrame:
    """Counts per severity in band order, with percent of all findings."""
    c = with_share(value_counts(findings, "severity"), "findings")
    return c.withColumn("band_order", band_rank("severity").cast("bigint"))


def type_breakdown(findings: DataFrame) -> DataFrame:
    """A7 + T6: count and average score per (type, severity); type title-cased; by average desc."""
    g = findings.groupBy("finding_type", "severity").agg(
        F.count(F.lit(1)).alias("count"), mean_1dp(F.col("risk_score")).alias("avg_risk"))
    return g.select(text.title_words(F.col("finding_type")).alias("type"), "severity", "count", "avg_risk") \
        .orderBy(F.col("avg_risk").desc(), "type", "severity")


TYPES = [r["type"] for r in cat.RULES]


def dept_type_pivot(findings: DataFrame) -> DataFrame:
    """Department × finding type counts, zero-filled, title-cased headers.

    The seven types are given explicitly so every column exists and no extra
    job is run to discover the pivot values.
    """
    p = (findings.where(F.col("department").isNotNull())
         .groupBy("department").pivot("finding_type", TYPES).agg(F.count(F.lit(1))).na.fill(0, subset=TYPES))
    return p.select("department", *[F.col(t).alias(t.replace("_", " ").title()) for t in TYPES])


def risk_histogram(findings: DataFrame, bins: int = 25, width: float = 4.0) -> DataFrame:
    """Fixed-width bins over 0–100 (top bin closed), each with the mean of all scores (1 dp), where the chart draws its line."""
    b = F.least(F.floor(F.col("risk_score") / F.lit(width)), F.lit(bins - 1)).cast("bigint")
    g = findings.where(F.col("risk_score").isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("findings"), F.sum(F.col("risk_score").cast("decimal(7,1)")).alias("_total"))
    every = Window.partitionBy()  # over the bins
    mean = F.bround(F.sum("_total").over(every).cast("double") / F.sum("findings").over(every).cast("double"), 1)
    g = g.withColumn("mean_risk", mean)
    return g.select("bin", (F.col("bin") * F.lit(width)).alias("bin_start"),
                    ((F.col("bin") + 1) * F.lit(width)).alias("bin_end"), "findings", "mean_risk")


def scatter_feed(findings: DataFrame) -> DataFrame:
    """Points for the level × score bubble chart."""
    return findings.select("finding_id", "access_level", "risk_score", "severity",
                           (F.col("risk_score") * F.lit(0.45) + F.lit(3.0)).alias("bubble_size"),
                           "employee_name", "system_name", "finding_type")


def findings_metrics(findings: DataFrame) -> DataFrame:
    """Count, critical count, average score (0 dp), distinct systems of a (filtered) result."""
    return findings.agg(
        F.count(F.lit(1)).alias("findings"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical"),
        F.bround(F.try_divide(F.sum(F.col("risk_score").cast("decimal(7,1)")).cast("double"),
                              F.count(F.lit(1)).cast("double")), 0).alias("avg_risk"),
        F.count_distinct("system_name").alias("systems_affected"),
    )


def inventory_stats(inv: DataFrame) -> DataFrame:
    """Rows, distinct employees, distinct systems, admin grants of the filtered inventory."""
    return inv.agg(
        F.count(F.lit(1)).alias("access_records"),
        F.count_distinct("employee_id").alias("unique_employees"),
        F.size(F.collect_set("system_id")).cast("bigint").alias("systems"),  # a bounded dimension: no row is expanded
        F.count_if(F.col("access_level") == "admin").alias("admin_grants"),
    )


def exec_header(findings: DataFrame, employees: DataFrame, access: DataFrame) -> DataFrame:
    """Employees, active grants, systems with findings (one row)."""
    return fold_rows(
        employees.selectExpr("count(1) AS employees"),
        access.selectExpr("count_if(is_active = true) AS active_grants"),
        findings.selectExpr("count(DISTINCT system_name) AS systems_with_findings"),
    )


def active_ratio(employees: DataFrame) -> DataFrame:
    """Share of employees whose status is active."""
    return employees.agg(F.avg((F.col("status") == "active").cast("double")).alias("active_ratio"))


def tiers(value: Column, thresholds, default: str) -> Column:
    """First tier whose threshold ``value`` reaches (thresholds in descending order)."""
    expr = None
    for t, name in thresholds:
        c = value >= t
        expr = F.when(c, F.lit(name)) if expr is None else expr.when(c, F.lit(name))
    return expr.otherwise(F.lit(default))


def risk_gauge(findings: DataFrame) -> DataFrame:
    """X-m3: average risk (1 dp) and its gauge tier (tiers differ from the risk bands)."""
    avg = findings.agg(mean_1dp(F.col("risk_score")).alias("avg_risk_score"))
    return avg.withColumn("gauge_tier", tiers(F.col("avg_risk_score"), cat.GAUGE_TIERS, cat.GAUGE_TIER_DEFAULT))
