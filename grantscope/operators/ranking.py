"""Global ranks and running sums in two levels, for tables of any size.

A window without partitions would put the whole table in one task. Here the table is dealt to ranges of the order, each
range is numbered on its own, and the ranges' totals (one row a range) give every range its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantscope.operators.joins import bounded_broadcast


def ranked(df: DataFrame, order: list[Column], path: str, rank: str = "rank", sums: dict[str, str] | None = None) -> DataFrame:
    """``df`` with ``rank`` (from 1) and, for each ``{new: column}`` of ``sums``, the running sum of ``column`` up to the row.

    The dealt rows are written to ``path`` and read back: the sampled bounds of the ranges differ from one evaluation to the next,
    so ranks and totals must be taken from one evaluation. Rows equal in ``order`` are numbered in any order. Running sums are of
    the column's own sum type; the sum of no row is never asked for, so an empty table gives an empty one.
    """
    sums = sums or {}
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = df.sparkSession.read.schema(dealt.schema).parquet(path)
    totals = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()])
    # one row a range
    before = Window.partitionBy().orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"),
                            *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_sum_{n}") for n in sums])
    within = Window.partitionBy("_range").orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = dealt.select("*", F.row_number().over(within).alias("_row"), *[F.sum(c).over(upto).alias(f"_local_{n}") for n, c in sums.items()])
    joined = local.join(bounded_broadcast(offsets), F.col("_range") == F.col("_of"))
    return joined.select(*df.columns, (F.col("_rows") + F.col("_row")).cast("long").alias(rank),
                         *[(F.col(f"_sum_{n}") + F.col(f"_local_{n}")).alias(n) for n in sums])
