"""Packing documents into sequences by cutting stock.

A document's ids are cut into whole sequences of the capacity and one remainder. The histogram of remainder lengths
(fewer than the capacity, whatever the input) goes to the cutting-stock program; its rounded patterns say how
many sequences hold which lengths, and the documents of each length, ranked by id, take the patterns' places in turn.

Ranks are counted in two levels: documents of a length are dealt to salts by a hash, each salt numbers its own
rows, and the salts' sizes give the offsets; so a length that a third of all documents have is spread over tasks.

Defined cases. NULL text is empty and holds only the end id. Every row is a document and is packed, repeated rows
and NULL ids too. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from grantscope.llm.byte_bpe import UNSAFE
from grantscope.llm.common import stored, text_slices
from grantscope.llm.cutting import cut_stock
from grantscope.llm.units import UnitCache, distinct_units, gather

CAPACITY = 1024
#: Text encoded at a time (whole documents).
ENCODED_BYTES = 4 << 20
#: How byte-level tokenizers write the space (a fixed value).
SPACE_CHAR = "\u0120"
#: Rows that one salt of a length numbers, where all documents have that length.
SALT_ROWS = 200_000
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@functools.lru_cache(maxsize=2)
def _ids_of(path: str) -> UnitCache:
    """Ids of units by the library.

    Units that start with their only space are encoded many to a text, which is the same by their independence: a token
    that starts with a space is a unit's first one. The others (white space at the end, or no space first) go one by one.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores already
    tokenizer = Tokenizer.from_file(path)
    first = np.zeros(tokenizer.get_vocab_size(), bool)
    first[[i for piece, i in tokenizer.get_vocab().items() if piece[0] == SPACE_CHAR]] = True

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(units: list[str]) -> list[bytes]:
        alone = [i for i, u in enumerate(units) if u.rfind(" ") != 0 or u[-1].isspace()]
        apart = set(alone)
        joined = [u for i, u in enumerate(units) if i not in apart] if alone else units
        ids = np.concatenate([np.zeros(0, np.uint32), *ids_of(["".join(joined[a:a + 512]) for a in range(0, len(joined), 512)])])
        ends = (4 * np.append(np.flatnonzero(first[ids]), len(ids))).tolist()
        flat = ids.tobytes()
        parts = [flat[a:b] for a, b in zip(ends, ends[1:])]
        if len(parts) != len(joined):
            raise ValueError("a unit's first token isn't its only one with a space")
        for i, own in zip(alone, ids_of([units[i] for i in alone])):  # rising, so each stands where it will stay
            parts.insert(i, own.tobytes())
        return parts

    return UnitCache(encode)


def _cut(path: str, capacity: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _ids_of(path), np.array([end_id], np.uint32)
        for part in text_slices(batches, max_bytes=ENCODED_BYTES):
            offsets, index, words, others = distinct_units(part.column("text"), UNSAFE)
            ids, ends = gather(encode([" " + w for w in words] + others), index)
            at = ends[offsets].tolist()
            tokens, checks = [], []
            for a, b in zip(at, at[1:]):
                own = np.concatenate([ids[a:b], end])
                tokens.append(len(own))
                checks.append([zlib.crc32(own[i:i + capacity]) for i in range(0, len(own), capacity)])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(tokens, pa.int64()), pa.array(checks, pa.list_(pa.int64()))],
                                             ["doc_id", "doc_tokens", "checks"])

    return cut


def _placed(capacity: int, places: np.ndarray, whole_base: np.ndarray):
    """Pieces of each document, from its length's rank and its first whole sequence.

    ``places``: rows (length, first rank, times in a sequence, first sequence, first offset) by length and rank.
    """
    key = places[:, 0] << 48 | places[:, 1]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, rank, whole = (batch.column(c).to_numpy() for c in ("doc_tokens", "rank", "whole_rank"))
            rest, n_whole = tokens % capacity, tokens // capacity
            found = places[np.searchsorted(key, rest << 48 | rank, side="right") - 1] if len(places) else np.zeros((len(rest), 5), np.int64)
            copy, slot = np.divmod(rank - found[:, 1], np.maximum(found[:, 2], 1))
            each = n_whole + (rest > 0)
            row = np.repeat(np.arange(len(tokens)), each)
            k = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
            last = k == n_whole[row]
            sequence = np.where(last, (found[:, 3] + copy)[row], (whole_base[rest] + whole)[row] + k)
            offset = np.where(last, (found[:, 4] + slot * rest)[row], 0)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(row)), pa.array(k * capacity), pa.array(np.where(last, rest[row], capacity)),
                batch.column("checks").flatten(), pa.array(tokens[row]), pa.array(sequence), pa.array(offset)], schema=PIECES)

    return pieces


def _places(patterns: list, first_sequence: int) -> np.ndarray:
    """Where the ranks of each length go, for the pieces function; sequences are numbered pattern by pattern."""
    rank: dict[int, int] = {}
    rows = []
    for pattern, times in patterns:
        offset = 0
        for length, each in pattern:
            rows.append((length, rank.get(length, 0), each, first_sequence, offset))
            rank[length] = rank.get(length, 0) + each * times
            offset += length * each
        first_sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: where it stands in its document and in its sequence, and the checksum of its ids."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    cut = stored(rows.mapInArrow(_cut(path, capacity, end_id), "doc_id long, doc_tokens long, checks array<long>"), "packing-cut")
    salts = 1 + cut.count() // SALT_ROWS
    cut = cut.select("*", (F.col("doc_tokens") % capacity).cast("int").alias("rest"),
                     F.floor(F.col("doc_tokens") / capacity).cast("long").alias("n_whole"),
                     F.pmod(F.xxhash64("doc_id", "checks"), F.lit(salts)).cast("int").alias("salt"))
    sizes = cut.groupBy("rest", "salt").agg(F.count(F.lit(1)).alias("n"), F.sum("n_whole").alias("n_whole"))
    # At most `capacity` lengths come to the driver, with their counts.
    totals = sizes.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("n_whole").alias("n_whole")).collect()
    whole_base = np.zeros(capacity, np.int64)
    n_whole = 0
    for t in sorted(totals, key=lambda t: t["rest"]):
        whole_base[t["rest"]] = n_whole
        n_whole += t["n_whole"]
    places = _places(cut_stock({t["rest"]: t["n"] for t in totals if t["rest"]}, capacity), n_whole)
    before = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("rest").alias("s_rest"), F.col("salt").alias("s_salt"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
                          F.coalesce(F.sum("n_whole").over(before), F.lit(0)).alias("whole_before"))
    own = Window.partitionBy("rest", "salt").orderBy("doc_id", "doc_tokens", "checks")
    upto = own.rowsBetween(Window.unboundedPreceding, -1)
    ranked = cut.select("*", (F.row_number().over(own) - 1).alias("own_rank"),
                        F.coalesce(F.sum("n_whole").over(upto), F.lit(0)).alias("own_whole"))
    ranked = ranked.join(starts, (F.col("rest") == F.col("s_rest")) & (F.col("salt") == F.col("s_salt")))
    ranked = ranked.select("doc_id", "doc_tokens", "checks", (F.col("own_rank") + F.col("n_before")).cast("long").alias("rank"),
                           (F.col("own_whole") + F.col("whole_before")).cast("long").alias("whole_rank"))
    return ranked.mapInArrow(_placed(capacity, places, whole_base), PIECES_DDL)
