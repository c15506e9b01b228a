"""Breaches and notifications as events, each emitted once when the clock passes its time (extensions X3 and X4, event-time form).

A finding's deadlines are known when it is detected: the end of its remediation time, and for each recipient the time to notify
by. ``schedule`` stores them as timers, in folders by micro-batch and due day. ``advance`` moves the clock: it emits the timers that
have come due since the last tick, and due ones of findings that arrived late. It reads the days that the tick covers, and earlier
days only of batches that no tick has seen, so its cost follows what is due, not what is stored. Events are told apart by finding,
kind, recipient and time, and are checked against those emitted for the same days: findings that arrive twice, retried batches
and repeated ticks emit nothing twice. A finding detected anew at another time has new deadlines.

A batch is seen once it and all before it are written whole; a tick counts once its row in ``ticks`` is written, and is made
anew otherwise. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantscope.operators.extensions import notification_queue
from grantscope.session import exists

BREACH, NOTIFY = "BREACH", "NOTIFY"
#: An event is told by these; its id is derived from them, so no file and no shuffle carries it.
KEY = ("finding_id", "kind", "recipient", "due_at")
TIMERS = "finding_id string, severity string, kind string, recipient string, due_at timestamp_ntz"
DUE = f"{TIMERS}, part long, due_day date"
EMITTED = f"{TIMERS}, emitted_at timestamp_ntz, tick long, due_day date"
TICKS = "tick long, at timestamp_ntz, upto long"


def _event_id() -> Column:
    return F.md5(F.to_json(F.struct("finding_id", "kind", "recipient", F.col("due_at").cast("string").alias("due_at")))).alias("event_id")


def timers(findings: DataFrame) -> DataFrame:
    """The timers of findings: a breach (no recipient) at the deadline, a notification per recipient. NULL ids and times have none."""
    breach = findings.select("finding_id", "severity", F.lit(BREACH).alias("kind"), F.lit(None).cast("string").alias("recipient"),
                             F.col("sla_deadline").alias("due_at"))
    notify = notification_queue(findings).select("finding_id", "severity", F.lit(NOTIFY).alias("kind"), "recipient", F.col("notify_by").alias("due_at"))
    both = breach.unionByName(notify).where("finding_id is not null and due_at is not null")
    return both.select(_event_id(), *both.columns)


class DeadlineEvents:
    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    def _read(self, table: str, schema: str) -> DataFrame:
        path = f"{self.location}/{table}"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def schedule(self, findings: DataFrame, batch: int) -> None:
        """Store the timers of a micro-batch of findings; batches are numbered from 0, and a retried one replaces itself."""
        rows = timers(findings).drop("event_id").withColumn("due_day", F.to_date("due_at"))
        rows.hint("rebalance", "due_day").write.mode("overwrite").partitionBy("due_day").parquet(f"{self.location}/due/part={batch}")

    def follow(self, findings: DataFrame) -> None:
        """Schedule what the stream ``findings`` has now."""
        q = (findings.writeStream.foreachBatch(self.schedule).option("checkpointLocation", f"{self.location}/_checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()

    def last_tick(self) -> tuple[int, str | None, int]:
        """Number and time of the last tick, and the last batch it saw; (-1, None, -1) before the first."""
        n = -1
        while exists(self.spark, f"{self.location}/ticks/{n + 1}/_SUCCESS"):
            n += 1
        if n < 0:
            return -1, None, -1
        row = self.spark.read.schema(TICKS).parquet(f"{self.location}/ticks/{n}").select(F.col("at").cast("string"), "upto").first()
        return n, row[0], row[1]

    def _whole_batches(self, after: int) -> int:
        """The last batch that is written whole with all before it; looks only at those after ``after``."""
        while exists(self.spark, f"{self.location}/due/part={after + 1}/_SUCCESS"):
            after += 1
        return after

    def advance(self, to: str, open_findings: DataFrame | None = None) -> DataFrame:
        """Move the clock to ``to`` and return the events of this tick: breaches strictly past their deadline, notifications due.

        With ``open_findings`` (finding_id), timers of other findings that this tick covers stay silent for good: they were closed
        in time. A repeated tick (the clock stands there already, and no batch has come) emits nothing.
        """
        last, at, seen = self.last_tick()
        tick, upto, now = last + 1, self._whole_batches(seen), F.lit(to).cast("timestamp_ntz")
        if at is not None and self.spark.range(1).select(now < F.lit(at).cast("timestamp_ntz")).first()[0]:
            raise ValueError(f"the clock stands at {at}, after {to}")
        fresh = F.col("part") > seen
        due = self._read("due", DUE).where((F.col("part") <= upto) & (F.col("due_day") <= F.to_date(now)))
        passed = lambda clock: (F.col("due_at") < clock) | ((F.col("kind") == NOTIFY) & (F.col("due_at") == clock))
        due = due.where(passed(now))
        if at is not None:
            before = F.lit(at).cast("timestamp_ntz")
            due = due.where(fresh | (F.col("due_day") >= F.to_date(before))).where(fresh | ~passed(before))
        if open_findings is not None:
            due = due.join(open_findings.select("finding_id"), "finding_id", "left_semi")
        columns = [c.split()[0] for c in TIMERS.split(", ")]
        due = due.select(*columns, "due_day", F.lit(False).alias("told"))
        if tick:
            covered = [r[0] for r in due.select("due_day").distinct().collect()]  # a row a day
            told = self._read("emitted", EMITTED).where((F.col("tick") < tick) & F.col("due_day").isin(covered))
            due = due.unionByName(told.select(*columns, "due_day", F.lit(True).alias("told")))
        # one shuffle leaves out both what came twice and what is told already
        events = due.groupBy(*KEY, "due_day").agg(F.max("severity").alias("severity"), F.max("told").alias("told")).where("not told")
        events = events.select(*columns, now.alias("emitted_at"), "due_day")
        events.write.mode("overwrite").partitionBy("due_day").parquet(f"{self.location}/emitted/tick={tick}")
        mark = self.spark.range(1).select(F.lit(tick).cast("long").alias("tick"), now.alias("at"), F.lit(upto).cast("long").alias("upto"))
        mark.write.mode("overwrite").parquet(f"{self.location}/ticks/{tick}")
        return self._events(F.col("tick") == tick)

    def _events(self, ticks: Column) -> DataFrame:
        told = self._read("emitted", EMITTED).where(ticks).drop("tick", "due_day")
        return told.select(_event_id(), *told.columns)

    def emitted(self) -> DataFrame:
        """Every event of the finished ticks."""
        return self._events(F.col("tick") <= self.last_tick()[0])
