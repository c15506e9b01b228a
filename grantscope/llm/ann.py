"""Approximate nearest neighbours by largest inner product, with an adaptive dimension scan inside probed lists.

Index. Vectors get one more coordinate, so that the nearest by Euclidean distance has the largest inner product, and
one random rotation. Centroids are fitted on a bounded sample (``SAMPLE_ROWS``); every vector goes to the list of its
nearest centroid, and each list is cut into blocks of about ``BLOCK_ROWS`` by a hash of id and vector, so a list that a
third of all vectors fall into (copies of one, or rows of one id) is many blocks. Rows equal in id and vector are one.

Search. A query goes to the blocks of its ``probe_share`` nearest lists. There its rotated coordinates are compared block of
columns by block of columns: after each, the partial distance, scaled to all dimensions, is tested against the query's
threshold (a bound on the distance of its k-th id, from a small sample), and candidates that are beyond it by the test's
margin are abandoned. Those that remain are scored exactly on the original vectors, in double precision.

Defined cases. Vectors that are NULL, zero, of another length than most, or hold NULL or non-finite components take no
part, nor do rows without an id. Rows of one id are one candidate (its best score) and one query (its least
vector). With fewer candidates than k all that were found are returned. Ties go to the smaller id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantscope.llm.common import stored

SAMPLE_ROWS = 16_384
THRESHOLD_ROWS = 4_096
LIST_ROWS = 4_096
MAX_LISTS = 1_024
BLOCK_ROWS = 4_096
COLUMNS = 16
#: Share of pairs alive above which a block of columns is added for all pairs of a block at once.
DENSE = 0.1
#: Queries of a block compared at a time (bounds memory).
QUERIES_AT_A_TIME = 256
#: Significance of the test: margin over the threshold is ``MARGIN / sqrt(dimensions seen)``.
MARGIN = 1.2


@dataclass
class Index:
    """What every task needs: bounded by ``SAMPLE_ROWS`` vectors."""

    rotation: np.ndarray
    centroids: np.ndarray
    top_square: float
    sample: np.ndarray
    sample_ids: np.ndarray
    sample_lists: np.ndarray

    def rotated(self, x: np.ndarray, query: bool) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top_square - (x ** 2).sum(axis=1), 0.0))
        return np.column_stack([x, more]) @ self.rotation

    def to_centroids(self, rotated: np.ndarray) -> np.ndarray:
        return (self.centroids ** 2).sum(axis=1)[None, :] - 2 * rotated @ self.centroids.T

    def thresholds(self, ids: np.ndarray, rotated: np.ndarray, probed: np.ndarray, k: int) -> np.ndarray:
        """For each query, a square distance that some more than k other ids of its ``probed`` lists don't exceed.

        Some more: the scan's tests may abandon a vector or two of them. Rows of one id stand together in the sample.
        """
        out, enough = np.full(len(ids), np.inf), k + k // 2
        starts = np.flatnonzero(np.concatenate([[True], self.sample_ids[1:] != self.sample_ids[:-1]]))
        if len(starts) > enough:
            square = (rotated ** 2).sum(axis=1)[:, None] + (self.sample ** 2).sum(axis=1)[None, :] - 2 * rotated @ self.sample.T
            square[(ids[:, None] == self.sample_ids[None, :]) | ~probed[:, self.sample_lists]] = np.inf
            square = np.minimum.reduceat(square, starts, axis=1)
            out = np.partition(square, enough - 1, axis=1)[:, enough - 1] * (1 + 1e-9) + 1e-12
        return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (size["d"] if size else 0))


def fit(vectors: DataFrame, seed: int = 7, rounds: int = 8) -> tuple[Index | None, int]:
    """The index's parameters from the ``SAMPLE_ROWS`` vectors with the least hashes, and the number of vectors."""
    n, top = vectors.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    if not n:
        return None, 0
    rows = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(SAMPLE_ROWS).toArrow()
    x, ids = _matrix(rows["v"]), rows["vec_id"].to_numpy()
    rng = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(rng.normal(size=(x.shape[1] + 1, x.shape[1] + 1)))
    by_id = np.argsort(ids[:THRESHOLD_ROWS], kind="stable")
    index = Index(rotation, np.zeros((1, 1)), top, np.zeros((0, 0)), ids[by_id], np.zeros(0, np.int64))
    r = index.rotated(x, False)
    index.sample = r[by_id]
    lists = int(min(MAX_LISTS, max(1, n // LIST_ROWS), len(r)))
    index.centroids = r[rng.choice(len(r), lists, replace=False)]
    for _ in range(rounds):
        nearest = index.to_centroids(r).argmin(axis=1)
        size = np.bincount(nearest, minlength=lists)
        total = np.zeros_like(index.centroids)
        np.add.at(total, nearest, r)
        index.centroids = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], index.centroids)
    index.sample_lists = index.to_centroids(index.sample).argmin(axis=1)
    return index, n


def _assigned(index: Index):
    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                r = index.rotated(_matrix(batch.column("v")), False)
                nearest = index.to_centroids(r).argmin(axis=1).astype(np.int32)
                rotated = pa.FixedSizeListArray.from_arrays(pa.array(r.ravel()), r.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(nearest), batch.column("vec_id"), batch.column("v"), rotated],
                                                 ["list", "vec_id", "v", "r"])

    return assigned


def _probes(index: Index, blocks: np.ndarray, probes: int, k: int):
    """Queries, once for each block of the lists they probe. ``blocks``: how many each list has."""
    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES_AT_A_TIME):
                part = batch.slice(at, QUERIES_AT_A_TIME)
                x, ids = _matrix(part.column("v")), part.column("vec_id").to_numpy()
                r = index.rotated(x, True)
                near = np.argsort(index.to_centroids(r), axis=1, kind="stable")[:, :probes]
                each = blocks[near.ravel()]
                row = np.repeat(np.repeat(np.arange(len(ids)), probes), each)
                block = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
                probed = np.zeros((len(ids), len(blocks)), bool)
                probed[np.arange(len(ids))[:, None], near] = True
                limit = index.thresholds(ids, r, probed, k)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(near.ravel(), each).astype(np.int32)), pa.array(block.astype(np.int32)), pa.array(ids[row]),
                    part.column("v").take(pa.array(row)), pa.array(limit[row])], ["list", "block", "query_id", "q", "limit"])

    return probing


def dimension_scan(q: np.ndarray, limit: np.ndarray, x: np.ndarray, columns: int = COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of q, row of x) that no test abandons; rotated coordinates, ``limit``: square distances.

    While many pairs are alive a block of columns is added for all at once; then for each that is left.
    """
    d = q.shape[1]

    def bound(seen: int) -> np.ndarray:
        return (limit if seen == d else limit * (1 + MARGIN / np.sqrt(seen)) ** 2 * seen / d) + 1e-9

    partial, at = np.zeros((len(q), len(x))), 0
    alive = np.ones(partial.shape, bool)
    while at < d and alive.mean() > DENSE:
        a, b = q[:, at:at + columns], x[:, at:at + columns]
        partial += (a ** 2).sum(axis=1)[:, None] + (b ** 2).sum(axis=1)[None, :] - 2 * a @ b.T
        at = min(at + columns, d)
        alive &= partial <= bound(at)[:, None]
    i, j = np.nonzero(alive)
    partial = partial[i, j]
    while at < d:
        to = min(at + columns, d)
        partial = partial + ((q[i, at:to] - x[j, at:to]) ** 2).sum(axis=1)
        near = partial <= bound(to)[i]
        i, j, partial, at = i[near], j[near], partial[near], to
    return i, j


def _search(index: Index, k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(queries: pa.Table, block: pa.Table) -> pa.Table:
        out = [schema.empty_table()]
        if queries.num_rows and block.num_rows:
            x, ids, rotated = _matrix(block["v"]), block["vec_id"].to_numpy(), _matrix(block["r"])
            for at in range(0, queries.num_rows, QUERIES_AT_A_TIME):
                part = queries.slice(at, QUERIES_AT_A_TIME)
                q, names = _matrix(part["q"]), part["query_id"].to_numpy()
                i, j = dimension_scan(index.rotated(q, True), part["limit"].to_numpy(), rotated)
                own = names[i] != ids[j]
                i, j = i[own], j[own]
                score = (q[i] * x[j]).sum(axis=1)
                order = np.lexsort((-score, ids[j], i))
                i, j, score = i[order], j[order], score[order]
                pair = np.stack([i, ids[j]])
                new = np.ones(len(i), bool)  # rows of one id stand together, the best first
                new[1:] = (pair[:, 1:] != pair[:, :-1]).any(axis=0)
                i, j, score = i[new], j[new], score[new]
                order = np.lexsort((ids[j], -score, i))
                i, j, score = i[order], j[order], score[order]
                starts = np.searchsorted(i, i)
                best = np.arange(len(i)) - starts < k
                out.append(pa.Table.from_arrays([pa.array(names[i[best]]), pa.array(ids[j[best]]), pa.array(score[best])], schema=schema))
        return pa.concat_tables(out)

    return search


def nearest_neighbours(table: DataFrame, queries: DataFrame, k: int = 20, probe_share: float = 0.75, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k nearest rows of ``table`` found, but for its own id."""
    spark, empty = table.sparkSession, "query_id long, rank int, vec_id long, score double"
    vectors = stored(valid_vectors(table, id_col, vector_col).distinct(), "vectors")
    index, n = fit(vectors)
    if index is None:
        return spark.createDataFrame([], empty)
    assigned = stored(vectors.mapInArrow(_assigned(index), "list int, vec_id long, v array<double>, r array<double>"), "vector-lists")
    blocks = np.ones(len(index.centroids), np.int64)
    for row in assigned.groupBy("list").count().collect():  # MAX_LISTS rows at most
        blocks[row["list"]] = 1 + row["count"] // BLOCK_ROWS
    of_list = F.array(*[F.lit(int(b)) for b in blocks])
    placed = assigned.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.element_at(of_list, F.col("list") + 1)).cast("int"))
    d = len(index.rotation) - 1
    asked = valid_vectors(queries, id_col, vector_col).where(F.size("v") == d).groupBy("vec_id").agg(F.min("v").alias("v"))
    probes = max(1, int(np.ceil(probe_share * len(blocks))))
    probing = asked.mapInArrow(_probes(index, blocks, probes, k), "list int, block int, query_id long, q array<double>, limit double")
    found = probing.groupBy("list", "block").cogroup(placed.groupBy("list", "block")).applyInArrow(
        _search(index, k), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
