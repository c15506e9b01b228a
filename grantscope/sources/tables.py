"""Readers and writers of stored access-review tables (operator S1).

Stored tables are read with their declared schema (never inferred) in any
file format Spark reads, then validated. Unlike the derived test tables,
filters on stored columns such as ``status`` or ``is_active`` reach the
Parquet scan (``PushedFilters``) and only the referenced columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grantscope import schemas
from grantscope.sources import sinks

TABLE_SCHEMAS = {
    "employees": schemas.EMPLOYEES,
    "access_rights": schemas.ACCESS_RIGHTS,
    "systems": schemas.SYSTEMS,
}

FORMATS = ("parquet", "orc", "json", "csv", "pandas_csv")

# Datasets exported by the original tool: one ``<table>.csv`` per table, written
# by pandas (header, no index, ``True``/``False`` booleans, NULL as an empty field,
# dates as yyyy-MM-dd). Whitespace is kept so blank justifications stay blank. Texts may
# hold line breaks inside quotes, so a file is read whole by one task (pandas wrote it so).
# Every column is parsed, whichever are asked for, so that a broken record fails the read.
PANDAS_CSV_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
    "mode": "FAILFAST",
    "multiLine": "true",
    "escape": '"',
    "columnPruning": "false",
}


def read_tables(spark: SparkSession, base: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """``{employees, access_rights, systems}`` stored as ``base/<name>`` in ``fmt``."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; one of {FORMATS}")
    out = {}
    for name, schema in TABLE_SCHEMAS.items():
        if fmt == "pandas_csv":
            df = spark.read.schema(schema).options(**PANDAS_CSV_OPTIONS).csv(f"{base.rstrip('/')}/{name}.csv")
        elif fmt == "csv":
            df = sinks.read_csv(spark, f"{base.rstrip('/')}/{name}", schema)
        else:
            df = spark.read.schema(schema).format(fmt).load(f"{base.rstrip('/')}/{name}")
        out[name] = schemas.validate(df, schema, name)
    return out


def write_tables(tables: dict[str, DataFrame], base: str, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """Store the three tables under ``base`` (one folder each, any Spark format)."""
    if fmt not in FORMATS or fmt == "pandas_csv":
        raise ValueError(f"cannot write {fmt!r}")
    for name, schema in TABLE_SCHEMAS.items():
        df = schemas.validate(tables[name], schema, name)
        path = f"{base.rstrip('/')}/{name}"
        if fmt == "csv":
            sinks.write_csv(df, path, mode)
        else:
            df.write.mode(mode).format(fmt).save(path)
    return base
