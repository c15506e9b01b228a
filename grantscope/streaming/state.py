"""The state of continuous detection (extension X7): versioned events, and findings kept per grant.

Grants and HR rows are events: the last one of an ``access_id`` (or ``employee_id``) by ``event_time``, then by micro-batch, is
its state, in whatever order events arrive. Four tables lie under the state's folder, each in ``BUCKETS`` partitions:

* ``grants`` and ``employees``: the events, by the hash of their key;
* ``owners``: which grants name an owner, by the hash of the owner;
* ``findings``: what the evaluations of each grant found, by the hash of the grant, with a marker row per evaluation.

A micro-batch appends its events, then evaluates the grants it names and those whose owner it names, and no others: it reads only
the buckets these lie in. The current findings of a grant are those of its last evaluation, so a revoked grant or a returned
owner closes findings, and a new evaluation replaces the old one without a search for known ids. Every batch writes folders of its
own in overwrite mode, so a retried batch replaces itself. ``compact`` folds the events and evaluations into a new generation of the
tables; readers take the newest generation that has its ``_COMPLETE`` marker.

One state belongs to one set of rules, and one writer at a time (a stream over both sources; a re-check between its runs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantscope import catalogue as cat
from grantscope import schemas
from grantscope.operators.findings import to_findings
from grantscope.operators.joins import enrich_with_systems
from grantscope.operators.rules import per_grant_hits
from grantscope.session import exists

BUCKETS = 64
#: Versions between two micro-batches, for re-checks.
RECHECKS = 1 << 20

EVENT_TIME = T.StructField("event_time", T.TimestampNTZType(), True)
VERSION = T.StructField("version", T.LongType(), True)
GRANT_EVENTS = T.StructType([*schemas.ACCESS_BASE.fields, EVENT_TIME])
EMPLOYEE_EVENTS = T.StructType([*schemas.EMPLOYEES.fields, EVENT_TIME])


def _bucketed(*fields: T.StructField) -> T.StructType:
    """Columns of a stored table, all nullable, with the folder's columns last."""
    return T.StructType([*[T.StructField(f.name, f.dataType, True) for f in fields], T.StructField("part", T.StringType(), True),
                         T.StructField("bucket", T.IntegerType(), True)])


TABLES = {
    "grants": _bucketed(*GRANT_EVENTS.fields, VERSION),
    "employees": _bucketed(*EMPLOYEE_EVENTS.fields, VERSION),
    "owners": _bucketed(T.StructField("employee_id", T.StringType()), T.StructField("access_id", T.StringType())),
    "findings": _bucketed(*schemas.FINDINGS.fields, T.StructField("grant_id", T.StringType()), VERSION),
}


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def last_states(events: DataFrame, key: str) -> DataFrame:
    """The last event of each key by event time (NULL first), then version; equal ones by their content. Partial per task."""
    columns = [c for c in events.columns if c not in ("part", "bucket", "event_time", "version")]
    order = F.struct("event_time", "version", F.xxhash64(*columns))
    last = events.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("row"))
    return last.select("row.*")


class DetectionState:
    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    # ── tables ──────────────────────────────────────────────────────────
    def generation(self) -> int:
        """The newest complete generation of the tables."""
        n = 0
        while exists(self.spark, f"{self.location}/gen-{n + 1}/_COMPLETE"):
            n += 1
        return n

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        """A stored table, or only the ``buckets`` of it (the others' files are not listed for the scan)."""
        path = f"{self.location}/gen-{self.generation()}/{table}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], TABLES[table])
        df = self.spark.read.schema(TABLES[table]).parquet(path)
        return df if buckets is None else df.where(F.col("bucket").isin(buckets))

    def _write(self, df: DataFrame, table: str, part: str, key: str, generation: int | None = None) -> None:
        """Rows of one batch, a file or more per bucket (AQE splits a bucket that one key fills)."""
        path = f"{self.location}/gen-{self.generation() if generation is None else generation}/{table}/part={part}"
        columns = [f.name for f in TABLES[table].fields if f.name not in ("part", "bucket")]
        rows = df.select(*columns, bucket_of(key).alias("bucket")).hint("rebalance", "bucket").sortWithinPartitions("bucket", key)
        rows.write.mode("overwrite").partitionBy("bucket").parquet(path)

    def _buckets(self, keys: DataFrame) -> list[int]:
        return sorted(r[0] for r in keys.select("bucket").distinct().collect())  # at most BUCKETS

    # ── events and evaluations ──────────────────────────────────────────
    def grants(self) -> DataFrame:
        """Every grant's state."""
        return last_states(self.read("grants"), "access_id")

    def employees(self) -> DataFrame:
        """Every employee's state."""
        return last_states(self.read("employees"), "employee_id")

    def grants_named(self, ids: DataFrame) -> DataFrame:
        """The states of the grants ``ids`` (access_id, bucket), read from their buckets only."""
        events = self.read("grants", self._buckets(ids))
        return last_states(events.join(ids.select("access_id"), "access_id", "left_semi"), "access_id")

    def _owners_named(self, grants: DataFrame) -> DataFrame:
        ids = grants.select("employee_id").where("employee_id is not null").distinct().withColumn("bucket", bucket_of("employee_id"))
        events = self.read("employees", self._buckets(ids))
        return last_states(events.join(ids.select("employee_id"), "employee_id", "left_semi"), "employee_id")

    def _grants_of(self, employees: DataFrame) -> DataFrame:
        """Grants (access_id, bucket) of which some event named one of the ``employees`` (employee_id, bucket)."""
        index = self.read("owners", self._buckets(employees)).join(employees.select("employee_id"), "employee_id", "left_semi")
        return index.select("access_id", bucket_of("access_id").alias("bucket"))

    def apply(self, batch: str, version: int, systems: DataFrame, as_of: str, rules, params: cat.RuleParams,
              grants: DataFrame | None = None, employees: DataFrame | None = None, hr: DataFrame | None = None) -> None:
        """Store a batch of grant and employee events, and evaluate the grants that they concern.

        ``hr``: a fixed HR table to evaluate with, in place of the stored employees.
        """
        ids = []
        if grants is not None:
            self._write(grants.withColumn("version", F.lit(version).cast("long")), "grants", batch, "access_id")
            own = self.read("grants").where(F.col("part") == batch)
            self._write(own.where("employee_id is not null").select("employee_id", "access_id").distinct(), "owners", batch, "employee_id")
            ids.append(own.where("access_id is not null").select("access_id", "bucket"))
        if employees is not None:
            self._write(employees.withColumn("version", F.lit(version).cast("long")), "employees", batch, "employee_id")
            ids.append(self._grants_of(self.read("employees").where(F.col("part") == batch).select("employee_id", "bucket").distinct()))
        named = (ids[0] if len(ids) == 1 else ids[0].unionByName(ids[1])).distinct()
        states = self.grants_named(named)
        self._evaluate(states, self._owners_named(states) if hr is None else hr, batch, version, systems, as_of, rules, params)

    def evaluate_all(self, batch: str, version: int, systems: DataFrame, as_of: str, rules, params: cat.RuleParams,
                     hr: DataFrame | None = None) -> None:
        """Evaluate every stored grant (a batch review's cost), for a change of systems or a table of employees from outside."""
        self._evaluate(self.grants(), self.employees() if hr is None else hr, batch, version, systems, as_of, rules, params)

    def _evaluate(self, states, employees, batch, version, systems, as_of, rules, params) -> None:
        found = to_findings(per_grant_hits(employees, enrich_with_systems(states, systems), as_of, rules, params), as_of, params)
        # rows may repeat in the HR table: a finding is one
        found = found.dropDuplicates(["finding_id"]).withColumn("grant_id", F.col("access_id"))
        marker = states.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.FINDINGS.fields], F.col("access_id").alias("grant_id"))
        rows = found.select(*marker.columns).unionByName(marker).withColumn("version", F.lit(version).cast("long"))
        self._write(rows, "findings", batch, "grant_id")

    # ── results ─────────────────────────────────────────────────────────
    def _last_evaluations(self, findings: DataFrame) -> DataFrame:
        last = F.max("version").over(Window.partitionBy("grant_id"))
        return findings.withColumn("_last", last).where("version = _last").drop("_last")

    def current_findings(self, buckets: list[int] | None = None) -> DataFrame:
        """Findings of each grant's last evaluation."""
        return self._last_evaluations(self.read("findings", buckets)).where("finding_id is not null").select(*schemas.FINDINGS.names)

    def closed_findings(self) -> DataFrame:
        """Findings of earlier evaluations that the last one no longer has, as last seen. ``compact`` forgets them."""
        stored = self.read("findings").withColumn("_last", F.max("version").over(Window.partitionBy("grant_id")))
        newest = Window.partitionBy("finding_id").orderBy(F.col("version").desc())
        rows = stored.where("finding_id is not null").withColumn("_n", F.row_number().over(newest)).where("_n = 1")
        return rows.where("version < _last").select(*schemas.FINDINGS.names)

    def next_version(self, batch: str) -> int:
        """A version after all that are stored, but for those of ``batch`` itself."""
        return 1 + (self.read("findings").where(F.col("part") != batch).agg(F.max("version")).first()[0] or 0)

    def compact(self) -> int:
        """Fold events into one row per key, and evaluations into the last one, as a new generation; its number.

        Folded rows keep their event time and version, so events that arrive later, and a retry of a folded batch, meet the
        same order as before. An interrupted run leaves no marker and is written anew.
        """
        new = self.generation() + 1

        def folded(table, key):
            events = self.read(table)
            columns = [c for c in events.columns if c not in ("part", "bucket")]
            order = F.struct("event_time", "version", F.xxhash64(*[c for c in columns if c not in ("event_time", "version")]))
            return events.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("row")).select("row.*")

        self._write(folded("grants", "access_id"), "grants", "folded", "access_id", new)
        self._write(folded("employees", "employee_id"), "employees", "folded", "employee_id", new)
        self._write(self.read("owners").select("employee_id", "access_id").distinct(), "owners", "folded", "employee_id", new)
        self._write(self._last_evaluations(self.read("findings")), "findings", "folded", "grant_id", new)
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.location}/gen-{new}/_COMPLETE")
        return new
