"""Access-review tables derived from the TPC-H-like test tables.

Employees come from ``customer``, systems from ``nation``, grants from
``orders`` and access logs from ``events``. Every column is one SQL
expression with the same meaning in Spark SQL and in DuckDB, so the oracle
queries can rebuild exactly the same inputs. All derivations are narrow
projections (no shuffle); the only join is the system lookup. Ids keep all 19
digits that a long key can have, and the ids of owners that do not exist have a
prefix of their own, so no two keys ever share an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantscope import schemas
from grantscope.operators.joins import enrich_with_systems

EMPLOYEE_EXPRS = [
    ("employee_id", "concat('EMP',lpad(cast(c_custkey as string),19,'0'))"),
    ("full_name", "c_name"),
    ("email", "concat('user',cast(c_custkey as string),'@example.com')"),
    ("department", "case c_custkey%9 when 0 then 'Engineering' when 1 then 'Security' when 2 then 'Finance' "
                   "when 3 then 'HR' when 4 then 'Sales' when 5 then 'Marketing' when 6 then 'Legal' "
                   "when 7 then 'Operations' else 'Executive' end"),
    ("title", "case when c_custkey%23=0 then 'Team Manager' when c_custkey%41=0 then 'VP Department' else 'Analyst' end"),
    ("status", "case when (c_custkey*7)%100<8 then 'terminated' when (c_custkey*7)%100<11 then 'on_leave' else 'active' end"),
    ("hire_date", "date '1993-01-01' + cast(c_custkey%700 as int)"),
    ("termination_date", "case when (c_custkey*7)%100<8 and c_custkey%11<>0 then date '2001-08-31' - cast(c_custkey%180 as int) end"),
    ("manager_id", "cast(null as string)"),
    ("is_manager", "c_custkey%23=0 or c_custkey%41=0"),
    ("mfa_enabled", "c_custkey%13<>0"),
]

SYSTEM_EXPRS = [
    ("system_id", "concat('SYS',lpad(cast(n_nationkey as string),19,'0'))"),
    ("name", "n_name"),
    ("type", "'Application'"),
    ("criticality", "case n_regionkey%4 when 0 then 'critical' when 1 then 'high' when 2 then 'medium' else 'low' end"),
    ("data_classification", "case n_regionkey%4 when 0 then 'Restricted' when 1 then 'Confidential' else 'Internal' end"),
    ("owner_dept", "case n_nationkey%3 when 0 then 'Engineering' when 1 then 'Security' else 'Operations' end"),
]

ACCESS_BASE_EXPRS = [
    ("access_id", "concat('ACC',lpad(cast(o_orderkey as string),19,'0'))"),
    ("employee_id", "concat(case when o_orderkey%101=0 then 'GONE' else 'EMP' end,lpad(cast(o_custkey as string),19,'0'))"),
    ("system_id", "concat('SYS',lpad(cast(o_orderkey%27 as string),19,'0'))"),
    ("access_level", "case when (o_orderkey*13)%20<3 then 'admin' when (o_orderkey*13)%20<9 then 'elevated' else 'standard' end"),
    ("granted_date", "cast(o_orderdate as date)"),
    ("last_used_date", "least(cast(o_orderdate as date)+cast((o_orderkey*31)%1500 as int), date '2001-08-31')"),
    ("granted_by", "'EMP0000000000000000000'"),
    ("business_justification", "case when o_orderkey%9=0 then null when o_orderkey%9=4 then '  ' "
                               "else concat('ticket ',cast(o_orderkey as string)) end"),
    ("is_active", "o_orderkey%4<>0"),
    ("sod_role", "case o_orderkey%15 when 0 then 'financial_initiator' when 1 then 'financial_approver' "
                 "when 2 then 'code_developer' when 3 then 'code_deployer' when 4 then 'user_admin' "
                 "when 5 then 'user_auditor' when 6 then 'data_entry' when 7 then 'data_approver' end"),
    ("review_status", "'pending'"),
]

ACCESS_LOG_EXPRS = [
    ("employee_id", "concat('EMP',lpad(cast(user_id as string),19,'0'))"),
    ("system_id", "concat('SYS',lpad(cast(event_id%27 as string),19,'0'))"),
    ("ts", "ts"),
]


def _select(df: DataFrame, exprs: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.expr(e).alias(name) for name, e in exprs])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.validate(_select(read_table(spark, sf_dir, "customer"), EMPLOYEE_EXPRS), schemas.EMPLOYEES, "employees")


def systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.validate(_select(read_table(spark, sf_dir, "nation"), SYSTEM_EXPRS), schemas.SYSTEMS, "systems")


def access_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.validate(_select(read_table(spark, sf_dir, "orders"), ACCESS_BASE_EXPRS), schemas.ACCESS_BASE, "access_base")


def access_rights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grants with system name and criticality looked up (operator J3)."""
    return enrich_with_systems(access_base(spark, sf_dir), systems(spark, sf_dir))


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(read_table(spark, sf_dir, "events"), ACCESS_LOG_EXPRS)


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "employees": employees(spark, sf_dir),
        "access_rights": access_rights(spark, sf_dir),
        "systems": systems(spark, sf_dir),
    }


def sql_ctes(with_log: bool = False) -> list[str]:
    """The same derivations as DuckDB/ANSI SQL common table expressions."""

    def body(exprs, src):
        return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in exprs) + f" FROM {src}"

    parts = [
        f"employees AS ({body(EMPLOYEE_EXPRS, 'customer')})",
        f"systems AS ({body(SYSTEM_EXPRS, 'nation')})",
        f"access_base AS ({body(ACCESS_BASE_EXPRS, 'orders')})",
        "access_rights AS (SELECT b.access_id, b.employee_id, b.system_id, "
        "coalesce(s.name, b.system_id) AS system_name, coalesce(s.criticality, 'medium') AS system_criticality, "
        "b.access_level, b.granted_date, b.last_used_date, b.granted_by, b.business_justification, "
        "b.is_active, b.sod_role, b.review_status FROM access_base b LEFT JOIN systems s ON b.system_id = s.system_id)",
    ]
    if with_log:
        parts.append(f"access_log AS ({body(ACCESS_LOG_EXPRS, 'events')})")
    return parts
