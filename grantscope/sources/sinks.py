"""CSV / JSON sinks and readers that lose nothing.

A CSV field may hold anything: NULL, empty and blank strings, quotes, line breaks, the
NULL marker itself. Backslashes and line breaks are written as ``\\\\``, ``\\n`` and ``\\r``
and read back the same way, so every record is one line (files stay splittable) and the
NULL marker ``\\N`` can't be a value. Quotes are doubled as in RFC 4180. Arrays are
comma-joined first (CSV has no array type).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {
    "header": "true",
    "nullValue": "\\N",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}


#: What other tools read (RFC 4180): line breaks inside quotes, NULL an empty field, an empty text a quoted one.
STANDARD_OPTIONS = {**CSV_OPTIONS, "nullValue": "", "multiLine": "true"}

#: Rows of a file in that dialect: one task reads a file whole, so a table's files must not grow with the table.
STANDARD_FILE_ROWS = 100_000

#: What the reader of that dialect puts for a quoted empty text.
EMPTY = "\u0000empty\u0000"


def _escaped(c: Column) -> Column:
    for char, code in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(char), F.lit(code))
    return c


def _unescaped(c: Column) -> Column:
    """Between doubled backslashes, a backslash can only start a line break's code."""
    def part(x: Column) -> Column:
        return F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    return F.array_join(F.transform(F.split(c, r"\\\\", -1), part), "\\")


def _flat(df: DataFrame, escaped: bool = True) -> list[Column]:
    out = []
    for f in df.schema.fields:
        c = F.array_join(F.col(f.name), ", ") if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        out.append((_escaped(c) if escaped and isinstance(f.dataType, (T.ArrayType, T.StringType)) else c).alias(f.name))
    return out


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", dialect: str = "own") -> str:
    """``dialect="standard"`` writes plain CSV for other tools; only the own dialect stays splittable, so its files are kept small."""
    if dialect == "standard":
        df.select(*_flat(df, False)).write.mode(mode).options(**STANDARD_OPTIONS, emptyValue='""', maxRecordsPerFile=STANDARD_FILE_ROWS).csv(path)
    else:
        df.select(*_flat(df)).write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType, dialect: str = "own") -> DataFrame:
    if dialect == "standard":
        # the reader takes an empty text for NULL unless a quoted one stands for something else
        df = spark.read.options(**STANDARD_OPTIONS, emptyValue=EMPTY).schema(schema).csv(path)
        return df.select(*[F.when(F.col(f.name) != EMPTY, F.col(f.name)).when(F.col(f.name).isNotNull(), "").alias(f.name)
                           if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema.fields])
    df = spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
    return df.select(*[_unescaped(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in schema.fields])


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """JSON lines, NULL fields written explicitly (``ignoreNullFields=false``)."""
    df.write.mode(mode).option("ignoreNullFields", "false") \
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None) -> DataFrame:
    """Write and read back: a lineage cut that survives executor loss (no local checkpoint). The session's codec by default."""
    df.write.mode(mode).parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)
