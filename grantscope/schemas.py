"""Explicit schemas of the access-review tables and a validator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

EMPLOYEES = T.StructType([
    T.StructField("employee_id", T.StringType(), False),
    T.StructField("full_name", T.StringType(), True),
    T.StructField("email", T.StringType(), True),
    T.StructField("department", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("hire_date", T.DateType(), True),
    T.StructField("termination_date", T.DateType(), True),
    T.StructField("manager_id", T.StringType(), True),
    T.StructField("is_manager", T.BooleanType(), True),
    T.StructField("mfa_enabled", T.BooleanType(), True),
])

ACCESS_RIGHTS = T.StructType([
    T.StructField("access_id", T.StringType(), False),
    T.StructField("employee_id", T.StringType(), True),
    T.StructField("system_id", T.StringType(), True),
    T.StructField("system_name", T.StringType(), True),
    T.StructField("system_criticality", T.StringType(), True),
    T.StructField("access_level", T.StringType(), True),
    T.StructField("granted_date", T.DateType(), True),
    T.StructField("last_used_date", T.DateType(), True),
    T.StructField("granted_by", T.StringType(), True),
    T.StructField("business_justification", T.StringType(), True),
    T.StructField("is_active", T.BooleanType(), True),
    T.StructField("sod_role", T.StringType(), True),
    T.StructField("review_status", T.StringType(), True),
])

# Grants before the system lookup (no system_name / system_criticality yet).
ACCESS_BASE = T.StructType([f for f in ACCESS_RIGHTS.fields if f.name not in ("system_name", "system_criticality")])

SYSTEMS = T.StructType([
    T.StructField("system_id", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("criticality", T.StringType(), True),
    T.StructField("data_classification", T.StringType(), True),
    T.StructField("owner_dept", T.StringType(), True),
])

FINDINGS = T.StructType([
    T.StructField("finding_id", T.StringType(), False),
    T.StructField("rule_id", T.StringType(), False),
    T.StructField("rule_name", T.StringType(), True),
    T.StructField("finding_type", T.StringType(), True),
    T.StructField("severity", T.StringType(), True),
    T.StructField("risk_score", T.DoubleType(), True),
    T.StructField("risk_band", T.StringType(), True),
    T.StructField("employee_id", T.StringType(), True),
    T.StructField("employee_name", T.StringType(), True),
    T.StructField("department", T.StringType(), True),
    T.StructField("system_id", T.StringType(), True),
    T.StructField("system_name", T.StringType(), True),
    T.StructField("system_criticality", T.StringType(), True),
    T.StructField("access_level", T.StringType(), True),
    T.StructField("access_id", T.StringType(), True),
    T.StructField("detail", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("detected_at", T.TimestampNTZType(), True),
    T.StructField("sla_deadline", T.TimestampNTZType(), True),
    T.StructField("frameworks", T.ArrayType(T.StringType()), True),
])

FINDING_COLUMNS = [f.name for f in FINDINGS.fields]


class SchemaMismatch(ValueError):
    pass


def validate(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """Check that ``df`` carries every column of ``schema`` with a compatible type.

    Returns the frame projected to the schema's column order. Only the plan's
    schema is inspected; no job runs.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise SchemaMismatch(f"{name}: missing columns {missing}")
    wrong = [
        (f.name, have[f.name].simpleString(), f.dataType.simpleString())
        for f in schema.fields
        if have[f.name] != f.dataType and not isinstance(have[f.name], T.NullType)
    ]
    if wrong:
        raise SchemaMismatch(f"{name}: wrong types {wrong}")
    return df.select(*[f.name for f in schema.fields])
