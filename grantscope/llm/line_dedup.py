"""Line de-duplication by a sharded minimal perfect hash.

The distinct line hashes are dealt to shards. Each shard builds a minimal perfect hash (cascaded bit arrays:
keys alone in their position at a level are placed there, the others go on to the next level; a key's index is the
rank of its bit) over compact arrays: a 32-bit fingerprint, a saturating 32-bit document count, the largest
document id. Documents send their line hashes to the shards and probe the arrays; only hits come back.

A line's key is the line without white space ([space, \\t..\\r]) at both ends, A-Z in lower case. Keys of at least
``min_chars`` code points that ``min_documents`` documents hold lose all their lines, except in the document with
the largest id. Every distinct key is in the index, so a probe is always a member: the fingerprint is a safety net.

Defined cases. NULL or empty text is one empty line. Documents are counted by their ids: rows that share an id count once (and
both keep the line, where it is the largest id); rows without one don't count, and lose what others lose. An empty table gives an empty result. Extra columns are carried by ``drop_lines`` unread.

Skew: a shard that many documents probe (a very common line) is split into salts, each with a copy of its arrays,
which are of bounded size; the number of salts follows the shard's own count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantscope.llm.common import null_safe, other_columns, stored, text_slices, with_text

SPACES = " \t\n\v\f\r"
#: Line occurrences for which a shard is made, and probes that one salt of a shard takes.
SHARD_LINES = 200_000
SALT_PROBES = 400_000
NO_ID = np.iinfo(np.int64).min
#: Odd multipliers of the SplitMix64 finaliser (fixed values).
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def line_key(line: str, min_chars: int) -> bytes | None:
    """128-bit hash of the line's key; None for keys under ``min_chars`` code points."""
    key = line.strip(SPACES)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Position of each key (two 64-bit words) at a level."""
    step = np.uint64((MIX[0] * (level + 1)) & (2**64 - 1))
    return (_mixed(keys[:, 0] ^ _mixed(keys[:, 1] + step)) % np.uint64(size)).astype(np.int64)


def build_hash(keys: np.ndarray) -> list[np.ndarray]:
    """Minimal perfect hash of distinct keys (n x 2 words): a bit array for each level."""
    levels = []
    while len(keys):
        size = 2 * len(keys) + 1
        at = _position(keys, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        keys = keys[~alone[at]]
        if len(levels) > 200:
            raise ValueError("keys are not distinct")
    return levels


def look_up(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Index of each key, from 0; -1 where no level has a bit for it (then it is no member)."""
    index, base = np.full(len(keys), -1, np.int64), 0
    for level, bits in enumerate(levels):
        rank = np.cumsum(bits) - 1 + base
        left = np.flatnonzero(index < 0)
        at = _position(keys[left], level, len(bits))
        hit = bits[at]
        index[left[hit]] = rank[at[hit]]
        base += int(bits.sum())
    return index


def _words(column: pa.ChunkedArray) -> np.ndarray:
    """16-byte keys as n x 2 unsigned words."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (keys[:, 1] >> np.uint64(32)).astype(np.uint32)


INDEX_DDL = "shard int, n long, sizes array<long>, bits binary, fingerprints binary, counts binary, holders binary, probes long"
INDEX = pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()),
                   ("fingerprints", pa.binary()), ("counts", pa.binary()), ("holders", pa.binary()), ("probes", pa.int64())])


def _build_shard(table: pa.Table) -> pa.Table:
    keys, count = _words(table["key"]), table["held_by"].to_numpy()
    holder = table["holder"].fill_null(NO_ID).to_numpy()
    levels = build_hash(keys)
    at = look_up(levels, keys)
    fingerprints, counts, holders = (np.empty(len(keys), t) for t in (np.uint32, np.uint32, np.int64))
    fingerprints[at], holders[at] = _fingerprint(keys), holder
    counts[at] = np.minimum(count, 2**32 - 1)
    row = [table["shard"][0].as_py(), len(keys), [len(x) for x in levels], b"".join(np.packbits(x).tobytes() for x in levels),
           fingerprints.tobytes(), counts.tobytes(), holders.tobytes(), int(table["rows"].to_numpy().sum())]
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, INDEX)], schema=INDEX)


def _levels(sizes: list[int], bits: bytes) -> list[np.ndarray]:
    out, at = [], 0
    for n in sizes:
        width = (n + 7) // 8
        out.append(np.unpackbits(np.frombuffer(bits, np.uint8, width, at), count=n).astype(bool))
        at += width
    return out


def _probe(min_documents: int):
    kept = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("key", pa.binary())])

    def probe(lines: pa.Table, index: pa.Table) -> pa.Table:
        if not lines.num_rows or not index.num_rows:
            return kept.empty_table()
        row = index.slice(0, 1).to_pylist()[0]
        keys = _words(lines["key"])
        at = look_up(_levels(row["sizes"], row["bits"]), keys)
        holder = np.frombuffer(row["holders"], np.int64)[at]
        ids = lines["doc_id"].fill_null(NO_ID).to_numpy()
        hit = (at >= 0) & (np.frombuffer(row["fingerprints"], np.uint32)[at] == _fingerprint(keys))
        hit &= (np.frombuffer(row["counts"], np.uint32)[at] >= min_documents) & (ids != holder)
        return lines.select(kept.names).filter(pa.array(hit)).cast(kept)

    return probe


def _line_keys(min_chars: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found = [list({k for x in t.split("\n") if (k := line_key(x, min_chars))}) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(found, pa.list_(pa.binary()))],
                                             ["doc_id", "text_hash", "keys"])

    return keys


def _keyed(docs: DataFrame) -> list:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")]


def build_index(lines: DataFrame, shards: int) -> DataFrame:
    """The stored index of ``lines`` (doc_id, key): one row of arrays per shard."""
    held = lines.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    counts = (held.groupBy("key").agg(F.count("doc_id").alias("held_by"), F.max("doc_id").alias("holder"), F.sum("rows").alias("rows"))
              .withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")))
    return stored(counts.groupBy("shard").applyInArrow(_build_shard, INDEX_DDL), "line-index")


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_documents: int = 5) -> DataFrame:
    """Per document (doc_id, text_hash) that loses lines: the set ``drop_keys`` of their keys."""
    held = stored(docs.select(*_keyed(docs)).mapInArrow(_line_keys(min_chars), "doc_id long, text_hash long, keys array<binary>"),
                  "line-keys")
    total = held.agg(F.sum(F.size("keys"))).first()[0] or 0
    shards = 1 + total // SHARD_LINES
    lines = held.select("doc_id", "text_hash", F.explode("keys").alias("key"))
    index = build_index(lines, shards)
    salts = index.select(F.col("shard").alias("s_shard"), F.ceil(F.col("probes") / SALT_PROBES).cast("int").alias("salts"))
    probes = lines.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    probes = probes.join(salts.where("salts > 1"), F.col("shard") == F.col("s_shard"), "left")
    probes = probes.select("doc_id", "text_hash", "key", "shard",
                           F.pmod(F.xxhash64("doc_id", "text_hash", "key"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    copies = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.ceil(F.col("probes") / SALT_PROBES).cast("int") - 1)))
    hits = (probes.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
            .applyInArrow(_probe(min_documents), "doc_id long, text_hash long, key binary"))
    return hits.groupBy("doc_id", "text_hash").agg(F.collect_set("key").alias("drop_keys"))


def _clean(min_chars: int):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "clean"):
            n_lines, n_dropped, out = [], [], []
            for text, keys in zip(part.column("clean").to_pylist(), part.column("drop_keys").to_pylist()):
                lines, drop = text.split("\n"), set(keys or ())
                kept = [x for x in lines if line_key(x, min_chars) not in drop] if drop else lines
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
                out.append("\n".join(kept) if drop else text)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(out, part.column("clean").type), pa.array(n_lines, pa.int64()),
                                              pa.array(n_dropped, pa.int64())], ["row", "clean", "n_lines", "n_dropped"])

    return clean


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_documents: int = 5) -> DataFrame:
    """``row`` (the other columns), the text without its repeated lines (``clean``), ``n_lines`` before, ``n_dropped``."""
    drops = repeated_lines(docs, min_chars, min_documents).withColumnsRenamed({"doc_id": "d_id", "text_hash": "d_hash"})
    rows = docs.select(*_keyed(docs), other_columns(docs)).withColumnRenamed("text", "clean")
    joined = rows.join(drops, null_safe(rows, drops, [("doc_id", "d_id"), ("text_hash", "d_hash")]), "left")
    joined = joined.select("row", "clean", "drop_keys")
    row = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_clean(min_chars), f"row {row}, clean string, n_lines long, n_dropped long")


def drop_lines(docs: DataFrame, min_chars: int = 40, min_documents: int = 5) -> DataFrame:
    """``docs`` without the repeated lines; every document stays."""
    return dedup_lines(docs, min_chars, min_documents).select(*with_text(docs, "clean"))
