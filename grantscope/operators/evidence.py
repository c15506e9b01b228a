"""Audit evidence: snapshots, summary metadata and the evidence package.

The package is written under a shared folder: findings are first written as
Parquet (the lineage cut every later file is derived from), then CSV/JSON
exports, snapshots and the metadata row. Both exports of findings are written
from one sort. The returned index reads every file back and counts its rows,
so it checks what was actually written.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantscope import catalogue as cat
from grantscope import schemas
from grantscope.functions import sqltext as sql
from grantscope.operators import summary as S
from grantscope.operators.findings import export_view, sort_by_risk, sorted_findings
from grantscope.session import exists, sql_setting
from grantscope.sources import sinks

EMPLOYEE_SNAPSHOT_COLUMNS = cat.EMPLOYEE_SNAPSHOT_COLUMNS


def access_snapshot(access: DataFrame) -> DataFrame:
    """Active grants, every column."""
    return access.where(F.col("is_active") == F.lit(True))


def employee_snapshot(employees: DataFrame) -> DataFrame:
    """Status fields of every employee."""
    return employees.select(*EMPLOYEE_SNAPSHOT_COLUMNS)


def summary_long(findings: DataFrame) -> DataFrame:
    """The summary's count dictionaries as long-form rows (metric, key, value).

    One pass counts the findings by all four keys; the dictionaries are sums of those few rows.
    """
    keys = {"by_severity": "severity", "by_type": "finding_type", "by_department": "department", "by_system": "system_name"}
    counts = findings.groupBy(*keys.values()).agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).alias("key")) for m, c in keys.items()]))
    sums = (counts.select(each.alias("e"), "n").select("e.metric", "e.key", "n").where(F.col("key").isNotNull())
            .groupBy("metric", "key").agg(F.sum("n").alias("value")))
    place = F.row_number().over(Window.partitionBy("metric").orderBy(F.desc("value"), "key"))
    return sums.withColumn("place", place).where((F.col("metric") != "by_system") | (F.col("place") <= cat.TOP_SYSTEMS)).drop("place")


def package_stamp(as_of: str) -> str:
    return datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S").strftime("%Y%m%d_%H%M%S")


def summary_meta(findings: DataFrame, employees: DataFrame, access: DataFrame, as_of: str,
                 with_maps: bool = False) -> DataFrame:
    """One row — package metadata and the KPI summary (and, optionally, the count maps).

    KPIs and count maps are combined by unioning their (already aggregated)
    long-form rows and folding them in one small aggregate — no join.
    """
    k = S.kpis(findings, employees, access)
    kpi_cols = [c for c in k.columns]
    ts = datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S")
    meta_values = {
        "package_id": f"{cat.PACKAGE_ID_PREFIX}{package_stamp(as_of)}",
        "generated_at": ts.isoformat(),
        "generated_by": cat.GENERATED_BY,
        "control_id": cat.CONTROL["id"],
        "control_name": cat.CONTROL["name"],
        "review_period": cat.REVIEW_PERIOD_PREFIX + ts.strftime("%Y-%m-%d"),
        "frameworks": ", ".join(cat.COMPLIANCE_FRAMEWORKS),
    }
    if not with_maps:
        return k.selectExpr(*[f"{sql.lit(v)} AS {n}" for n, v in meta_values.items()], *kpi_cols)
    meta = [F.lit(v).alias(n) for n, v in meta_values.items()]
    long_k = k.select(F.struct(*kpi_cols).alias("kpi"), F.lit(None).cast("string").alias("metric"),
                      F.lit(None).cast("string").alias("key"), F.lit(None).cast("bigint").alias("value"))
    long_c = summary_long(findings).select(F.lit(None).cast(long_k.schema["kpi"].dataType).alias("kpi"),
                                           "metric", "key", "value")
    u = long_k.unionByName(long_c)
    maps = [F.map_from_entries(F.collect_list(F.when(F.col("metric") == m, F.struct("key", "value")))).alias(m)
            for m in ("by_severity", "by_type", "by_department", "by_system")]
    folded = u.agg(F.max("kpi").alias("kpi"), *maps)
    return folded.select(*meta, *[F.col(f"kpi.{c}").alias(c) for c in kpi_cols],
                         "by_severity", "by_type", "by_department", "by_system")


EXPORT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType() if f.name in (
    "detected_at", "sla_deadline", "frameworks") else f.dataType) for f in schemas.FINDINGS.fields])


def package_dir(out_dir: str, as_of: str, run_id: str) -> str:
    return f"{out_dir.rstrip('/')}/{cat.PACKAGE_DIR_PREFIX}{package_stamp(as_of)}_{run_id}"


def write_evidence_package(spark: SparkSession, findings: DataFrame, employees: DataFrame, access: DataFrame,
                           out_dir: str, as_of: str, run_id: str | None = None) -> DataFrame:
    """Write the package under ``out_dir`` and return its index (file, rows, path).

    The package folder is named after the review time and the run. An interrupted run is redone in place when its
    ``run_id`` is given again; a finished package, marked by its index in ``_COMPLETE``, is never written again.
    """
    pkg = package_dir(out_dir, as_of, run_id or uuid.uuid4().hex[:12])
    if exists(spark, f"{pkg}/_COMPLETE/_SUCCESS"):
        raise FileExistsError(f"{pkg} is complete")
    ow = "overwrite"
    stored = sinks.write_parquet(findings, f"{pkg}/_findings.parquet", ow, "zstd")
    # the stored table is cheap to sample: no further exchange. Both exports read one sort's shuffle files; partitions
    # that memory doesn't hold are sorted again from them, so nothing cached goes to disk. Small partitions are joined
    # as in a plan that isn't cached, so that few rows make one file
    with sql_setting(spark, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true"):
        ranked = export_view(sort_by_risk(stored)).persist(StorageLevel.MEMORY_ONLY)
    try:
        files = {
            cat.PACKAGE_FILES[0]: sinks.write_csv(ranked, f"{pkg}/{cat.PACKAGE_FILES[0]}", ow),
            cat.PACKAGE_FILES[1]: sinks.write_json(ranked, f"{pkg}/{cat.PACKAGE_FILES[1]}", ow),
        }
    finally:
        ranked.unpersist()
    files |= {
        cat.PACKAGE_FILES[2]: sinks.write_csv(access_snapshot(access), f"{pkg}/{cat.PACKAGE_FILES[2]}", ow),
        cat.PACKAGE_FILES[3]: sinks.write_csv(employee_snapshot(employees), f"{pkg}/{cat.PACKAGE_FILES[3]}", ow),
        cat.PACKAGE_FILES[4]: sinks.write_json(summary_meta(stored, employees, access, as_of, with_maps=True),
                                               f"{pkg}/{cat.PACKAGE_FILES[4]}", ow),
    }
    parts = [read_package_file(spark, pkg, name).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("file"), "rows", F.lit(path).alias("path"))
             for name, path in files.items()]
    index = reduce(lambda a, b: a.unionByName(b), parts)
    return sinks.write_parquet(index, f"{pkg}/_COMPLETE", ow)


def read_package_file(spark: SparkSession, pkg: str, name: str) -> DataFrame:
    """A file of the package as it was written."""
    path = f"{pkg}/{name}"
    if name == cat.PACKAGE_FILES[1]:
        return sinks.read_json(spark, path, EXPORT_SCHEMA)
    if name == cat.PACKAGE_FILES[4]:
        return spark.read.json(path)
    columns = {cat.PACKAGE_FILES[0]: EXPORT_SCHEMA, cat.PACKAGE_FILES[2]: schemas.ACCESS_RIGHTS,
               cat.PACKAGE_FILES[3]: T.StructType([schemas.EMPLOYEES[c] for c in EMPLOYEE_SNAPSHOT_COLUMNS])}
    return sinks.read_csv(spark, path, columns[name])


def quick_exports(spark: SparkSession, findings: DataFrame, employees: DataFrame, access: DataFrame,
                  out_dir: str, dialect: str = "standard") -> DataFrame:
    """All findings, the full employee table and active grants as CSV (plain CSV by default); index (file, rows, path)."""
    base = out_dir.rstrip("/")
    files = {
        "all_findings.csv": (sinks.write_csv(export_view(sorted_findings(findings)), f"{base}/all_findings.csv", dialect=dialect),
                             EXPORT_SCHEMA),
        "employees.csv": (sinks.write_csv(employees, f"{base}/employees.csv", dialect=dialect), schemas.EMPLOYEES),
        "active_access.csv": (sinks.write_csv(access_snapshot(access), f"{base}/active_access.csv", dialect=dialect),
                              schemas.ACCESS_RIGHTS),
    }
    parts = [sinks.read_csv(spark, path, schema, dialect).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("file"), "rows", F.lit(path).alias("path"))
             for name, (path, schema) in files.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def view_exports(spark: SparkSession, filtered_findings: DataFrame, inventory: DataFrame, admin: DataFrame,
                 out_dir: str) -> DataFrame:
    """CSV of the current findings filter, of the filtered inventory and of its admin grants.

    Returns an index (file, rows, path) read back from what was written.
    """
    base = out_dir.rstrip("/")
    written = {
        "findings_filtered.csv": sinks.write_csv(export_view(sorted_findings(filtered_findings)),
                                                 f"{base}/findings_filtered.csv"),
        "access_inventory.csv": sinks.write_csv(inventory, f"{base}/access_inventory.csv"),
        "admin_grants.csv": sinks.write_csv(admin, f"{base}/admin_grants.csv"),
    }
    parts = [spark.read.options(**sinks.CSV_OPTIONS).csv(path).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("file"), "rows", F.lit(path).alias("path"))
             for name, path in written.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
