"""A trigram index over stored findings for the any-column search.

Findings are stored in blocks of neighbouring rows (by employee and grant, so that one person's findings share a block), and the index
holds which blocks have a trigram in any column. A search for a text reads the postings of its trigrams, and then only the blocks that
have all of them, where the search itself runs; so its rows are those of ``views.search_findings``. Texts are folded for the index
coarser than the search compares them (any letters that the search takes as equal are equal here), so no hit is left out.
A regular expression with operators, and a text of fewer than three characters, have no trigrams that must occur: they scan all blocks.

Trigrams are taken per column, of the distinct values that a block has there, so a value that all its rows share is taken once. No step
puts a whole zone in one task: the ranked rows are written where they lie, and any number of tasks share a zone or a block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantscope.operators.ranking import ranked
from grantscope.operators.views import search_findings
from grantscope.session import exists, shared_dir

BLOCK_ROWS = 4_096
ZONE_BLOCKS = 256
PARTS = 64
#: Blocks (or zones) that a search names to the scan; beyond, it prunes by zone only, or scans all, and finds the same rows.
NAMED = 10_000


def folded(text: Column) -> Column:
    """Upper, then lower case, with the dotted capital I as the plain one and the two small sigmas as one.

    The step between the two keeps them apart: lower case of upper case alone is planned as lower case.
    """
    return F.replace(F.lower(F.replace(F.upper(text), F.lit("\u0130"), F.lit("I"))), F.lit("\u03c2"), F.lit("\u03c3"))


def trigrams(text: Column) -> Column:
    """Distinct trigrams of a column ``text``; none of a shorter one."""
    n = F.length(text)
    return F.when(n >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.substring(text, i, 3)))).otherwise(
        F.array().cast("array<string>"))


def grams_in(values: pa.Array) -> np.ndarray:
    """Distinct trigrams of the distinct values, each as one number: 21 bits a code point."""
    values = pc.unique(values).drop_null()
    points = np.frombuffer("".join(values.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.cumsum(pc.utf8_length(values).to_numpy(zero_copy_only=False))
    whole = np.ones(max(len(points) - 2, 0), bool)
    for back in (1, 2):  # those that go on into the next value
        over = ends - back
        whole[over[(over >= 0) & (over < len(whole))]] = False
    return np.unique((points[:-2] << 42 | points[1:-1] << 21 | points[2:])[whole])


def _block_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_block, gram) of rows whose columns but ``_block`` are folded texts; a block's trigrams once a batch."""
    for batch in batches:
        blocks = batch.column("_block").to_numpy()
        texts = [c for name, c in zip(batch.schema.names, batch.columns) if name != "_block"]
        for block in np.unique(blocks).tolist():
            mine = pa.array(blocks == block)
            grams = np.unique(np.concatenate([grams_in(t.filter(mine)) for t in texts]))
            points = np.stack([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF], axis=1).astype(np.uint32)
            text = points.tobytes().decode("utf-32-le", "surrogatepass")
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(grams), pa.int64()),
                                              pa.array([text[i:i + 3] for i in range(0, len(text), 3)], pa.string())], ["_block", "gram"])


def _part(gram: str) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(PARTS)).cast("int")


class SearchIndex:
    def __init__(self, spark: SparkSession, location: str, schema: T.StructType, block_rows: int = BLOCK_ROWS, zone_blocks: int = ZONE_BLOCKS):
        self.spark, self.location, self.columns = spark, location.rstrip("/"), schema.names
        self.block_rows, self.zone_blocks = block_rows, zone_blocks
        nullable = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
        self.schema = T.StructType([*nullable, T.StructField("_block", T.LongType()), T.StructField("_zone", T.LongType())])

    def build(self, findings: DataFrame) -> None:
        """Store the findings in blocks, then their postings. An interrupted build is written anew; a finished one stays."""
        if exists(self.spark, f"{self.location}/postings/_SUCCESS"):
            return
        order = [F.col(c) for c in ("employee_id", "access_id", "finding_id")]
        rows = ranked(findings.select(*self.columns), order, shared_dir(self.spark, "blocks"), "_rank")
        block = F.floor((F.col("_rank") - 1) / self.block_rows).cast("long")
        rows = rows.withColumn("_block", block).withColumn("_zone", F.floor(F.col("_block") / self.zone_blocks).cast("long")).drop("_rank")
        # a task of the ranked rows holds whole ranges of the order, so a block is in one or two files without another exchange
        rows.sortWithinPartitions("_zone", "_block").write.mode("overwrite").partitionBy("_zone").parquet(f"{self.location}/rows")
        texts = self.rows().select("_block", *[folded(F.col(f"`{c}`").cast("string")).alias(f"_{i}") for i, c in enumerate(self.columns)])
        grams = texts.mapInArrow(_block_grams, "_block long, gram string").distinct().withColumn("part", _part("gram"))
        grams.hint("rebalance", "part").sortWithinPartitions("part", "gram").write.mode("overwrite").partitionBy("part").parquet(
            f"{self.location}/postings")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.location}/rows")

    def grams_of(self, pattern: str, literal: bool) -> list[str] | None:
        """The trigrams that a hit must have; None where nothing is known of them."""
        if not literal and re.search(r"[\\^$.|?*+()\[\]{}]", pattern):
            return None
        found = self.spark.range(1).select(folded(F.lit(pattern)).alias("t")).select(trigrams(F.col("t"))).first()[0]
        return found or None

    def candidates(self, grams: list[str]) -> DataFrame:
        """Blocks that have all ``grams``, from the postings' folders of those trigrams."""
        wanted = self.spark.range(1).select(F.explode(F.array(*map(F.lit, grams))).alias("gram")).select(_part("gram")).distinct()
        parts = [r[0] for r in wanted.collect()]  # at most PARTS
        postings = self.spark.read.schema("_block long, gram string, part int").parquet(f"{self.location}/postings")
        held = postings.where(F.col("part").isin(parts) & F.col("gram").isin(grams))
        return held.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams)).select("_block")

    def search(self, pattern: str, literal: bool = False) -> DataFrame:
        """The rows of ``views.search_findings(findings, pattern, literal)``."""
        rows, grams = self.rows(), self.grams_of(pattern, literal)
        if grams:
            blocks = self.candidates(grams)
            named = [r[0] for r in blocks.limit(NAMED + 1).collect()]
            if len(named) <= NAMED:
                zones = sorted({b // self.zone_blocks for b in named})
                rows = rows.where(F.col("_zone").isin(zones) & F.col("_block").isin(named))
            else:
                zones = [r[0] for r in blocks.select(F.floor(F.col("_block") / self.zone_blocks)).distinct().limit(NAMED + 1).collect()]
                rows = rows.where(F.col("_zone").isin(zones)) if len(zones) <= NAMED else rows
        return search_findings(rows.select(*self.columns), pattern, literal)
