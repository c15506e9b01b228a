"""Lookup, membership and assignment joins (operators J2, J3, J6, J7, X6).

Broadcast is used only behind an explicit row-count bound on the small side;
above the bound the join is left to Catalyst and AQE (shuffle join with
runtime skew splitting), so a grown dimension never blows up executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension we are willing to ship to every executor, in rows and in
# bytes: small enough to copy to a thousand executors.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 32 << 20


def bounded_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``small`` for broadcast only if it provably has at most ``max_rows`` rows and ``max_bytes`` bytes.

    The check reads at most ``max_rows + 1`` rows of the (small) side; bytes are those of its JSON form.
    """
    width = F.octet_length(F.to_json(F.struct(*small.columns)))
    n, size = small.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(small) if n <= max_rows and size <= max_bytes else small


def small_rows(small: DataFrame, max_rows: int) -> DataFrame:
    """An aggregate of at most ``max_rows`` rows as a local table to broadcast, computed once; a larger one unchanged."""
    rows = small.limit(max_rows + 1).collect()
    return F.broadcast(small.sparkSession.createDataFrame(rows, small.schema)) if len(rows) <= max_rows else small


def enrich_with_systems(access_base: DataFrame, systems: DataFrame) -> DataFrame:
    """Add ``system_name`` (default: the id) and ``system_criticality`` (default ``medium``).

    Grant tables are huge and have few distinct systems, so a shuffle join on
    ``system_id`` would put whole systems in one task; the systems table is
    broadcast when its size is bounded.
    """
    sys_ = bounded_broadcast(systems.select(
        F.col("system_id").alias("_sid"), F.col("name").alias("_sname"), F.col("criticality").alias("_scrit")))
    j = access_base.join(sys_, access_base["system_id"] == sys_["_sid"], "left")
    return j.select(
        "access_id", "employee_id", "system_id",
        F.coalesce(F.col("_sname"), F.col("system_id")).alias("system_name"),
        F.coalesce(F.col("_scrit"), F.lit("medium")).alias("system_criticality"),
        "access_level", "granted_date", "last_used_date", "granted_by", "business_justification",
        "is_active", "sod_role", "review_status",
    )


MAX_DEPARTMENTS = 10_000


def access_of_employees_with_status(access: DataFrame, employees: DataFrame, status: str) -> DataFrame:
    """Grants whose owner has ``status`` (``employee_id.isin(...)`` as a semi join)."""
    ids = employees.where(F.col("status") == status).select("employee_id")
    return access.join(ids, "employee_id", "left_semi")


def unowned_grants(access: DataFrame, employees: DataFrame) -> DataFrame:
    """X6 (extension): grants whose employee does not exist (anti join). NULL owners count as unowned."""
    return access.join(employees.select("employee_id"), "employee_id", "left_anti")


def assign_managers(employees: DataFrame) -> DataFrame:
    """Every employee reports to the first manager of their department.

    "First" is the smallest ``employee_id`` among ``is_manager`` rows of the
    department (any status); that manager gets NULL, as does a department with
    no manager. The per-department table (one row per department, partial-
    aggregated on the map side) is computed once; up to ``MAX_DEPARTMENTS`` rows it
    is broadcast, so employees are never shuffled by their few departments.
    """
    firsts = small_rows(
        employees.where(F.col("is_manager") & F.col("department").isNotNull())
        .groupBy("department")
        .agg(F.min("employee_id").alias("_dept_manager")),
        MAX_DEPARTMENTS)
    j = employees.join(firsts, "department", "left")
    mgr = F.when(F.col("_dept_manager") != F.col("employee_id"), F.col("_dept_manager"))
    return j.select(*[mgr.alias("manager_id") if c == "manager_id" else F.col(c) for c in employees.columns])


def inventory(access: DataFrame, employees: DataFrame, split_hot_owners: bool = False) -> DataFrame:
    """Every grant with owner name, department, status and title (NULL when no owner)."""
    emp = employees.select("employee_id", "full_name", "department", "status", "title")
    if split_hot_owners:
        return split_hot_keys_join(access, emp, "employee_id", "left")
    return access.join(emp, "employee_id", "left")


def hot_keys(big: DataFrame, key: str, fraction: float = 0.01, min_share: float = 0.001, seed: int = 17) -> list:
    """Keys of ``big`` that hold at least ``min_share`` of its rows, estimated on a seeded sample, heaviest first.

    The sample only picks which keys to route differently; no row is dropped, and no hot key is left
    out: at most ``1 / min_share`` keys can hold that share of the sample, which bounds the list.
    """
    s = big.select(key).where(F.col(key).isNotNull()).sample(fraction=fraction, seed=seed)
    counts = s.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    sampled = counts.agg(F.sum("n")).first()[0] or 0
    # at least a few sampled rows, so small inputs do not promote noise to "hot"
    heavy = counts.where(F.col("n") >= F.lit(max(10.0, sampled * min_share)))
    return [r[0] for r in heavy.orderBy(F.col("n").desc(), F.col(key)).collect()]


def split_hot_keys_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
                        keys: list | None = None, max_small_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Equi join that keeps hot keys of ``big`` off the shuffle.

    Rows of ``big`` whose key is hot are joined with a broadcast of the
    matching ``small`` rows (when their number is within ``max_small_rows``),
    so a key holding a third of all rows never lands in one task; all other
    rows take the ordinary shuffle join. The union is the exact join result.
    """
    keys = hot_keys(big, key) if keys is None else keys
    if not keys:
        return big.join(small, key, how)
    is_hot = F.col(key).isin(keys)
    hot_small = bounded_broadcast(small.where(is_hot), max_small_rows)
    hot_part = big.where(is_hot).join(hot_small, key, how)
    cold_part = big.where(~is_hot | F.col(key).isNull()).join(small.where(~is_hot), key, how)
    return hot_part.unionByName(cold_part)
