"""Mergeable summaries: counts and exact distinct counts per batch of rows, added up without reading old rows.

Distinct keys are numbered once, in a dictionary that grows with the keys, and every batch stores for each combination of the
dimensions its row count, its scores' total and maximum, and bitmaps of the numbers of its keys (32,768 numbers a bitmap). Bitmaps are
merged by OR, so a distinct count over any batches and any filter or grouping by dimensions is exact. A batch reads itself and the
dictionary; a summary reads the states.

Batches are numbered from 0 and hold disjoint rows. A batch is part of the summaries once its row in ``batches`` is written: an
interrupted one is written anew, a finished one is left as it is when it is added again. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantscope import catalogue as cat
from grantscope.operators.ranking import ranked
from grantscope.operators.summary import fold_rows
from grantscope.session import exists, shared_dir

DICTIONARY = "key_column string, key string, number long, part long"
BATCHES = "batch long, last_number long"


class SummaryStates:
    def __init__(self, spark: SparkSession, location: str, dims: tuple[str, ...], keys: tuple[str, ...], score: str | None = None):
        self.spark, self.location = spark, location.rstrip("/")
        self.dims, self.keys, self.score = dims, keys, score
        named = "".join(f"`{d}` string, " for d in dims)
        self.counts_schema = f"{named}n_rows long, scored long, score_total decimal(38,1), score_max double, part long"
        self.bitmaps_schema = f"{named}key_column string, bucket long, bitmap binary, part long"

    def _read(self, table: str, schema: str, upto: int) -> DataFrame:
        path = f"{self.location}/{table}"
        df = self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)
        return df.where(F.col("part") <= upto)

    def last_batch(self) -> tuple[int, int]:
        """The last finished batch and the last number given to a key; (-1, 0) before the first."""
        n = -1
        while exists(self.spark, f"{self.location}/batches/{n + 1}/_SUCCESS"):
            n += 1
        return (n, self.spark.read.schema(BATCHES).parquet(f"{self.location}/batches/{n}").first()["last_number"]) if n >= 0 else (-1, 0)

    def _number_new_keys(self, held: DataFrame, batch: int, last: int) -> int:
        """Add the keys that the dictionary lacks, numbered after ``last``; the last number then."""
        known = self._read("dictionary", DICTIONARY, batch - 1).select("key_column", "key")
        new = held.select("key_column", "key").distinct().join(known, ["key_column", "key"], "left_anti")
        new = ranked(new, [F.col("key_column"), F.col("key")], shared_dir(self.spark, "new-keys"), "rank")
        path = f"{self.location}/dictionary/part={batch}"
        new.select("key_column", "key", (F.col("rank") + last).cast("long").alias("number")).write.mode("overwrite").parquet(path)
        return self._read("dictionary", DICTIONARY, batch).where(F.col("part") == batch).agg(F.max("number")).first()[0] or last

    def add(self, df: DataFrame, batch: int) -> None:
        """Add the rows of a batch. NULL keys aren't counted; NULL is a value of a dimension like any other."""
        done, last = self.last_batch()
        if batch <= done:
            return
        if batch != done + 1:
            raise ValueError(f"batch {batch} does not follow batch {done}")
        dims = [F.col(d).cast("string").alias(d) for d in self.dims]
        score = F.col(self.score).cast("double") if self.score else F.lit(None).cast("double")
        counts = df.select(*dims, score.alias("s")).groupBy(*self.dims).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count("s").alias("scored"),
            F.sum(F.col("s").cast("decimal(7,1)")).cast("decimal(38,1)").alias("score_total"), F.max("s").alias("score_max"))
        counts.write.mode("overwrite").parquet(f"{self.location}/counts/part={batch}")
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("key_column"), F.col(k).cast("string").alias("key")) for k in self.keys]))
        # reduced before the join: a key with a third of all rows is one row per combination and task
        held = df.select(*dims, each.alias("k")).select(*self.dims, "k.*").where("key is not null").distinct()
        last = self._number_new_keys(held, batch, last)
        numbers = self._read("dictionary", DICTIONARY, batch).select("key_column", "key", "number")
        bits = held.join(numbers, ["key_column", "key"]).groupBy(*self.dims, "key_column", F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
        bits.write.mode("overwrite").parquet(f"{self.location}/bitmaps/part={batch}")
        row = self.spark.range(1).select(F.lit(batch).cast("long").alias("batch"), F.lit(last).cast("long").alias("last_number"))
        row.write.mode("overwrite").parquet(f"{self.location}/batches/{batch}")

    def counts(self) -> DataFrame:
        """Row counts and score totals of the finished batches, per batch and combination of the dimensions."""
        return self._read("counts", self.counts_schema, self.last_batch()[0])

    def distinct(self, by: tuple[str, ...] = (), where: Column | None = None) -> DataFrame:
        """Exact distinct counts ``distinct_<key>`` of the finished batches, per ``by`` (one row without), of the rows where the
        dimensions satisfy ``where``. Groups without any key have no row."""
        bits = self._read("bitmaps", self.bitmaps_schema, self.last_batch()[0])
        bits = bits if where is None else bits.where(where)
        merged = bits.groupBy(*by, "key_column", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
        return merged.groupBy(*by).agg(*[F.coalesce(F.sum(F.when(F.col("key_column") == k, F.col("n"))), F.lit(0)).alias(f"distinct_{k}")
                                         for k in self.keys])

    def summary(self, by: tuple[str, ...], where: Column | None = None) -> DataFrame:
        """Per ``by``: rows, mean score (1 dp), highest score and the distinct counts."""
        counts = self.counts() if where is None else self.counts().where(where)
        totals = counts.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), _mean().alias("mean_score"), F.max("score_max").alias("max_score"))
        found = self.distinct(by, where)
        found = found.select(*[F.col(c).alias(f"_{c}") if c in by else F.col(c) for c in found.columns])
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        return totals.join(found, same, "left").drop(*[f"_{c}" for c in by]).na.fill(0, [f"distinct_{k}" for k in self.keys])


def _mean() -> Column:
    return F.bround(F.try_divide(F.sum("score_total").cast("double"), F.sum("scored").cast("double")), 1)


FINDING_DIMS, FINDING_KEYS = ("severity", "department"), ("employee_id", "system_name")
INVENTORY_DIMS, INVENTORY_KEYS = ("status", "access_level", "system_criticality"), ("employee_id", "system_id")


def finding_states(spark: SparkSession, location: str) -> SummaryStates:
    return SummaryStates(spark, location, FINDING_DIMS, FINDING_KEYS, "risk_score")


def inventory_states(spark: SparkSession, location: str) -> SummaryStates:
    return SummaryStates(spark, location, INVENTORY_DIMS, INVENTORY_KEYS)


def kpis(states: SummaryStates, employees: DataFrame, access: DataFrame) -> DataFrame:
    """A1 + A6 from the states of findings: the row of ``summary.kpis`` over all batches."""
    of = lambda s: F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("n_rows"))), F.lit(0))
    f = states.counts().agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_findings"),
                            *[of(s).alias(f"{s.lower()}_findings") for s in cat.BAND_ORDER], _mean().alias("avg_risk_score"),
                            F.max("score_max").alias("max_risk_score"))
    d = states.distinct().select(F.col("distinct_employee_id").alias("affected_employees"), F.col("distinct_system_name").alias("affected_systems"))
    e = employees.selectExpr("count_if(status = 'active') AS active_employees")
    a = access.selectExpr("count_if(is_active = true) AS total_access_records")
    rate = F.bround((F.lit(1.0) - F.col("total_findings").cast("double") / F.greatest("total_access_records", F.lit(1)).cast("double")) * 100.0, 1)
    return fold_rows(f, d, e, a).withColumn("compliance_rate", rate)


def inventory_stats(states: SummaryStates, where: Column | None = None) -> DataFrame:
    """A14 from the states of the inventory, under a filter on its dimensions."""
    c = states.counts() if where is None else states.counts().where(where)
    admin = F.coalesce(F.sum(F.when(F.col("access_level") == "admin", F.col("n_rows"))), F.lit(0))
    c = c.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("access_records"), admin.alias("admin_grants"))
    d = states.distinct(where=where).select(F.col("distinct_employee_id").alias("unique_employees"), F.col("distinct_system_id").alias("systems"))
    return fold_rows(c, d)
