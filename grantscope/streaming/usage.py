"""Last use of each (employee, system) from a stream of access-log files (extension X8, streaming form).

Each micro-batch is reduced to one row per key (last event, number of events)
and written to a folder of its own, named after the batch id, in overwrite
mode; the batch view folds all folders. Maxima and counts add up in any order,
so an event is counted however late it arrives, there is no state that grows
in the stream, and a retried micro-batch replaces its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantscope.session import exists, file_stream
from grantscope.sources import derived

USAGE = "employee_id string, system_id string, last_seen {ts}, events bigint, batch bigint"


def log_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str = "parquet",
               max_files: int | None = None, file_glob: str | None = None) -> DataFrame:
    """Access logs (``employee_id, system_id, ts``) landing as files in ``source_dir``."""
    return file_stream(spark, source_dir, schema, fmt, max_files, file_glob)


def batch_usage(log: DataFrame) -> DataFrame:
    return log.groupBy("employee_id", "system_id").agg(
        F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("events"))


def fold_usage(updates: DataFrame) -> DataFrame:
    """Totals per key over all micro-batches."""
    return updates.groupBy("employee_id", "system_id").agg(
        F.max("last_seen").alias("last_seen"), F.sum("events").alias("log_events"))


def run_available_now(log: DataFrame, out_dir: str) -> DataFrame:
    """Process every log file of the stream ``log`` that is there now, then stop; return the usage so far."""
    spark, table = log.sparkSession, f"{out_dir}/usage"
    ts = log.schema["ts"].dataType.simpleString()

    def put(batch: DataFrame, batch_id: int) -> None:
        batch_usage(batch).write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    q = (log.writeStream.foreachBatch(put).option("checkpointLocation", f"{out_dir}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return fold_usage(spark.read.schema(USAGE.format(ts=ts)).parquet(table))


WINDOWS = "employee_id string, system_id string, window_start {ts}, window_end {ts}, last_seen {ts}, events bigint, batch bigint"


class WindowedUsage:
    """Use of each (employee, system) per event-time window, from a stream of logs.

    Each micro-batch adds a folder of its own windows' counts; a window is the fold of its counts over all folders, so an event
    belongs to its window however late it arrives, and no state has to wait for it. ``compact`` folds the folders into one of a new
    generation, named after the last batch in it; batches up to that one are not written again when they are retried, so nothing is
    counted twice. Readers take the newest generation that has its ``_COMPLETE`` marker.
    """

    def __init__(self, log: DataFrame, out_dir: str, width: str = "1 day", fold_every: int = 20):
        self.log, self.spark, self.out_dir = log, log.sparkSession, out_dir.rstrip("/")
        self.width, self.fold_every = width, fold_every
        self.schema = T.StructType.fromDDL(WINDOWS.format(ts=log.schema["ts"].dataType.simpleString()))

    def generation(self) -> int:
        n = 0
        while exists(self.spark, f"{self.out_dir}/gen-{n + 1}/_COMPLETE"):
            n += 1
        return n

    def folded_upto(self) -> int:
        """The last batch that the present generation began with; -1 for none."""
        n = self.generation()
        return self.spark.read.parquet(f"{self.out_dir}/gen-{n}/_COMPLETE").first()["upto"] if n else -1

    def stored(self) -> DataFrame:
        path = f"{self.out_dir}/gen-{self.generation()}/windows"
        return self.spark.read.schema(self.schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], self.schema)

    def put(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self.folded_upto():
            return
        window = F.window("ts", self.width)
        counts = batch.where("ts is not null").groupBy("employee_id", "system_id", window.alias("w")).agg(
            F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("events"))
        counts = counts.select("employee_id", "system_id", *[F.col(f"w.{x}").cast(self.schema["last_seen"].dataType).alias(f"window_{x}")
                                                             for x in ("start", "end")], "last_seen", "events")
        counts.write.mode("overwrite").parquet(f"{self.out_dir}/gen-{self.generation()}/windows/batch={batch_id}")

    def usage(self) -> DataFrame:
        """(employee_id, system_id, window_start, window_end, last_seen, events) of all events so far."""
        return self.stored().groupBy("employee_id", "system_id", "window_start", "window_end").agg(
            F.max("last_seen").alias("last_seen"), F.sum("events").alias("events"))

    def folders(self) -> int:
        """Folders that a read opens."""
        return self.stored().select("batch").distinct().count()

    def compact(self) -> int:
        """Fold all folders into one; the new generation. An interrupted run leaves no marker and is written anew."""
        new, upto = self.generation() + 1, self.stored().agg(F.max("batch")).first()[0]
        if upto is None:
            return new - 1
        folded = self.usage().withColumn("batch", F.lit(upto).cast("long"))
        folded.write.mode("overwrite").partitionBy("batch").parquet(f"{self.out_dir}/gen-{new}/windows")
        self.spark.range(1).select(F.lit(upto).cast("long").alias("upto")).write.mode("overwrite").parquet(f"{self.out_dir}/gen-{new}/_COMPLETE")
        return new

    def run_available_now(self) -> DataFrame:
        """Process every log file that is there now, folding after every ``fold_every`` folders; the usage so far."""
        def put(batch: DataFrame, batch_id: int) -> None:
            self.put(batch, batch_id)
            if batch_id - max(self.folded_upto(), 0) >= self.fold_every:
                self.compact()

        q = (self.log.writeStream.foreachBatch(put).option("checkpointLocation", f"{self.out_dir}/_checkpoint")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return self.usage()


def derived_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs derived from the ``events`` test table, as a stream of its files."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    raw = file_stream(spark, sf_dir, schema, file_glob="events*.parquet")
    return raw.select(*[F.expr(e).alias(n) for n, e in derived.ACCESS_LOG_EXPRS])
