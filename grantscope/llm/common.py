"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantscope.session import shared_dir

#: Text handled at a time inside a task. Whole documents only: a longer document is a slice of its own.
SLICE_BYTES = 8 << 20


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    A lineage cut that survives lost executors: later stages read files that every executor sees.
    """
    path = shared_dir(df.sparkSession, "llm", name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches to at most ``max_bytes`` of text each (one row at least), whatever the rows' lengths."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if batch.num_rows > start:
            yield batch.slice(start)


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equality of the column pairs under which NULL equals NULL (planned as an ordinary equi-join)."""
    on = None
    for a, b in pairs:
        one = left[a].eqNullSafe(right[b])
        on = one if on is None else on & one
    return on


def other_columns(docs: DataFrame) -> Column:
    """All columns but the text as one struct ``row``, so that no name of theirs can clash with a working column."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_chars")]).alias("row")


def with_text(docs: DataFrame, changed: str) -> list[Column]:
    """The columns of ``docs``, with ``text`` (and ``n_chars``, where there is one) taken from the column ``changed``."""
    swap = {"text": F.col(changed), "n_chars": F.length(changed).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return [swap.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
