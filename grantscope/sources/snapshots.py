"""Dated snapshots of a review's tables, kept side by side, and what changed between two of them.

A snapshot is named by its date. Its tables lie under ``<table>/snapshot_date=<date>/state=<state>``, where the state is the column
that reviews filter by (an employee's or a finding's status, whether a grant is active), so a reader of one date, or of one
date's active rows, lists no other files. ``snapshots`` has one row per finished snapshot; readers see finished ones only. An
interrupted snapshot is written anew by the next ``put``; a finished one is evidence and is never replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantscope import schemas
from grantscope.session import exists

#: Per table: schema, key, the column that its files are parted by, and columns that no change is told of (they move with the review).
TABLES = {
    "employees": (schemas.EMPLOYEES, "employee_id", "status", ()),
    "access_rights": (schemas.ACCESS_RIGHTS, "access_id", "is_active", ()),
    "findings": (schemas.FINDINGS, "finding_id", "status", ("detected_at", "sla_deadline", "detail")),
}
SNAPSHOTS = "snapshot_date date, as_of timestamp_ntz"
NO_STATE = "none"


class SnapshotExists(ValueError):
    pass


def _state(table: str):
    """The folder of a row. NULL and blank states share one; the column itself stays in the files, so the two stay apart."""
    value = F.col(TABLES[table][2]).cast("string")
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit(NO_STATE)).otherwise(value)


class SnapshotStore:
    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    def snapshots(self) -> DataFrame:
        """(snapshot_date, as_of) of every finished snapshot."""
        path = f"{self.location}/snapshots"
        return self.spark.read.schema(SNAPSHOTS).parquet(f"{path}/*") if exists(self.spark, path) else self.spark.createDataFrame([], SNAPSHOTS)

    def put(self, as_of: str, employees: DataFrame, access: DataFrame, findings: DataFrame) -> str:
        """Store the three tables as the snapshot of the day of ``as_of``; its date."""
        date = as_of[:10]
        mark = f"{self.location}/snapshots/{date}"
        if exists(self.spark, f"{mark}/_SUCCESS"):
            raise SnapshotExists(f"the snapshot of {date} is finished")
        for table, df in (("employees", employees), ("access_rights", access), ("findings", findings)):
            rows = schemas.validate(df, TABLES[table][0], table).withColumn("state", _state(table))
            # few states: every task writes its own rows of each, so no shuffle moves the whole table and one state can't fill one task
            rows.write.mode("overwrite").partitionBy("state").parquet(f"{self.location}/{table}/snapshot_date={date}")
        row = self.spark.range(1).select(F.lit(date).cast("date").alias("snapshot_date"), F.lit(as_of).cast("timestamp_ntz").alias("as_of"))
        row.coalesce(1).write.mode("overwrite").parquet(mark)
        return date

    def _stored(self, table: str) -> DataFrame:
        schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in TABLES[table][0].fields],
                               T.StructField("snapshot_date", T.DateType(), True), T.StructField("state", T.StringType(), True)])
        path = f"{self.location}/{table}"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def read(self, table: str, date: str, state: str | None = None) -> DataFrame:
        """A table as it was at ``date``, or only its rows of one state ('active', 'true', …), from their folders alone."""
        if not exists(self.spark, f"{self.location}/snapshots/{date}/_SUCCESS"):
            raise ValueError(f"no finished snapshot of {date}")
        df = self._stored(table).where(F.col("snapshot_date") == F.lit(date).cast("date"))
        return (df if state is None else df.where(F.col("state") == state)).drop("snapshot_date", "state")

    def between(self, table: str, first: str, last: str) -> DataFrame:
        """A table's rows in all snapshots reviewed from ``first`` to ``last``, with ``snapshot_date`` and ``as_of``.

        The period is a condition on the list of snapshots, so the join's dates prune the table's folders when it runs.
        """
        period = self.snapshots().where(F.col("as_of").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))
        return self._stored(table).drop("state").join(period, "snapshot_date")

    def diff(self, table: str, before: str, after: str, whole: bool = True) -> DataFrame:
        """Per key that differs: ``change`` (opened, closed, changed), the columns that changed, and the row (``was``, ``now``).

        One shuffle by the key, reduced before it. Repeated rows of a key (NULL included, a key like any other) are compared as
        a multiset, and the row shown is one of them; ``columns`` compares the rows shown. With ``whole=False`` the rows are without
        the columns that no change is told of, which then needn't be read or shuffled.
        """
        schema, key, _, moving = TABLES[table]
        compared = [c for c in schema.names if c not in moving]
        content = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in compared])
        side = lambda date, late: self.read(table, date).select(
            F.col(key).alias("key"), F.lit(late).alias("late"), content.alias("content"), F.struct(*(schema.names if whole else compared)).alias("row"))
        both = side(before, False).unionByName(side(after, True))
        of = lambda late, x: F.when(F.col("late") == late, x)
        total = lambda late: F.sum(of(late, F.col("content").cast("decimal(20,0)")))  # noqa: E731  order of rows doesn't matter
        g = both.groupBy("key").agg(
            F.max_by("row", of(False, F.col("content"))).alias("was"), F.max_by("row", of(True, F.col("content"))).alias("now"),
            total(False).alias("sum_was"), total(True).alias("sum_now"),
            F.count(of(False, F.lit(1))).alias("rows_was"), F.count(of(True, F.lit(1))).alias("rows_now"))
        change = (F.when(F.col("rows_was") == 0, "opened").when(F.col("rows_now") == 0, "closed")
                  .when((F.col("rows_was") != F.col("rows_now")) | (F.col("sum_was") != F.col("sum_now")), "changed"))
        columns = F.array_compact(F.array(*[F.when(~F.col(f"was.{c}").eqNullSafe(F.col(f"now.{c}")), F.lit(c)) for c in compared]))
        return g.withColumn("change", change).where("change is not null").select(
            F.col("key").alias(key), "change", F.when(F.col("change") == "changed", columns).alias("columns"),
            F.when(F.col("rows_was") > 0, F.col("was")).alias("was"), F.when(F.col("rows_now") > 0, F.col("now")).alias("now"))

    def findings_diff(self, before: str, after: str) -> DataFrame:
        """Findings opened, closed and changed between two reviews, with both scores."""
        d = self.diff("findings", before, after, whole=False)
        at = lambda c: F.coalesce(F.col(f"now.{c}"), F.col(f"was.{c}")).alias(c)
        return d.select("finding_id", "change", "columns", at("rule_id"), at("severity"), at("employee_id"), at("system_name"), at("access_id"),
                        F.col("was.risk_score").alias("risk_before"), F.col("now.risk_score").alias("risk_after"))

    def trend(self, first: str, last: str) -> DataFrame:
        """Findings and their highest score per snapshot of a period and severity."""
        f = self.between("findings", first, last)
        return f.groupBy("snapshot_date", "as_of", "severity").agg(F.count(F.lit(1)).alias("findings"), F.max("risk_score").alias("max_risk"))
