"""Record format of query outputs: the original tool keeps dates and times as text.

Dates become ``yyyy-MM-dd``, timestamps ``yyyy-MM-dd HH:mm:ss``, arrays a
comma-joined string and small integers ``bigint`` — a stable, engine-neutral
schema for exports and for comparison with SQL oracles. Built as one
``selectExpr`` (one call, one analysis), and skipped when nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def record_format(df: DataFrame) -> DataFrame:
    exprs, changed = [], False
    for f in df.schema.fields:
        c, t = _quote(f.name), f.dataType
        if isinstance(t, T.DateType):
            e = f"date_format({c}, 'yyyy-MM-dd')"
        elif isinstance(t, (T.TimestampNTZType, T.TimestampType)):
            e = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"
        elif isinstance(t, T.ArrayType):
            e = f"array_join({c}, ', ')"
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            e = f"CAST({c} AS BIGINT)"
        elif isinstance(t, T.DecimalType):
            e = f"CAST({c} AS DOUBLE)"
        else:
            exprs.append(c)
            continue
        changed = True
        exprs.append(f"{e} AS {c}")
    return df.selectExpr(*exprs) if changed else df
