"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint has 64 bits: a bit is set where over half of the document's shingle hashes have it. Two fingerprints
link at ``MAX_BITS`` (4) or fewer differing bits; the components of the links are the groups.

Finding the links. Equal fingerprints are one node. The 64 bits are three segments (22, 21, 21). By pigeonhole, two
linked fingerprints either agree in one segment, or differ by a single bit in each of two segments (1 + 1 + at most
2). The first case meets under the segment itself. For the second, each segment is a word of the perfect [23, 12]
Golay code: the nearest codeword's index is the key of the word, and a word on the rim of its ball (three errors) also
takes the indices of the codewords at distance four, six keys in all; words that differ by one bit always share one.
A pair of segments gives the product of their keys, 24 bits each. Candidates meet under a key, and the bit distance is
verified; within a key a search from node to node links each found node once, so a large group never makes all pairs.

Defined cases. NULL text has no words: fingerprint zero, linked like any other. Repeated rows have equal
fingerprints. A group's id is the smallest non-NULL doc_id in it. One row of every group survives, also of groups that
share an id or have none: rows are told apart by id and text, and of rows equal in both one is kept. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from grantscope.llm.common import null_safe, stored, text_slices
from grantscope.llm.components import components

SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
PAIRS = ((0, 1), (0, 2), (1, 2))
#: Generator polynomial of the [23, 12] Golay code (a fixed value).
GOLAY = 0xAE3
#: Groups of a key up to this size are compared by shifting the sorted rows; larger ones by the search.
SHIFTS = 8


def fingerprint(text: str, words_in_shingle: int) -> int:
    """SimHash of the text's word shingles (A-Z in lower case), repeats included."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(words_in_shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        upto = min(n, at + (1 << 16))
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:upto].tolist(), ends[at + k - 1:upto + k - 1].tolist())],
                          np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(words_in_shingle: int, carried: list[str]):
    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found = np.array([fingerprint(t, words_in_shingle) for t in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*map(part.column, carried), pa.array(found.view(np.int64))], [*carried, "fingerprint"])

    return fingerprints


def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Parity of each 12-bit message, and the error pattern (three bits at most) of each syndrome."""
    parity = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        parity ^= np.where(parity >> bit & 1, GOLAY << (bit - 11), 0)
    errors = np.zeros(1 << 11, np.int64)
    ones = 1 << np.arange(23)
    syndrome = lambda w: parity[w >> 11] ^ (w & 0x7FF)
    for a in range(23):
        errors[syndrome(ones[a])] = ones[a]
        for b in range(a):
            errors[syndrome(ones[a] | ones[b])] = ones[a] | ones[b]
            for c in range(b):
                errors[syndrome(ones[a] | ones[b] | ones[c])] = ones[a] | ones[b] | ones[c]
    return parity, errors


PARITY, ERRORS = _golay_tables()


def nearest_codeword(words: np.ndarray) -> np.ndarray:
    """12-bit index of the nearest codeword of 23-bit words."""
    return (words ^ ERRORS[PARITY[words >> 11] ^ (words & 0x7FF)]) >> 11


def fuzzy_keys(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each word (rows of six at most) and which are there: codewords nearest to it or to a word one bit away."""
    flips = np.concatenate([[0], 1 << np.arange(bits)])
    near = np.sort(nearest_codeword(words[:, None] ^ flips[None, :]), axis=1)
    new = np.concatenate([np.ones((len(near), 1), bool), near[:, 1:] != near[:, :-1]], axis=1)
    keys, there = np.zeros((len(near), 6), np.int64), np.zeros((len(near), 6), bool)
    row, col = np.nonzero(new)
    at = (np.cumsum(new, axis=1) - 1)[row, col]
    keys[row, at], there[row, at] = near[row, col], True
    return keys, there


def candidate_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and key for every key of the fingerprints (unsigned); the top byte of a key names its kind."""
    segments = [((prints >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.int64) for first, bits in SEGMENTS]
    rows, keys = [], []
    for kind, segment in enumerate(segments):
        rows.append(np.arange(len(prints)))
        keys.append(segment | kind << 56)
    fuzzy = [fuzzy_keys(s, bits) for s, (_, bits) in zip(segments, SEGMENTS)]
    for kind, (i, j) in enumerate(PAIRS, len(SEGMENTS)):
        both = fuzzy[i][0][:, :, None] << 12 | fuzzy[j][0][:, None, :] | kind << 56
        there = fuzzy[i][1][:, :, None] & fuzzy[j][1][:, None, :]
        rows.append(np.nonzero(there)[0])
        keys.append(both[there])
    return np.concatenate(rows), np.concatenate(keys)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fingerprint").to_numpy()
        rows, keys = candidate_keys(prints.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[rows])], ["key", "fingerprint"])


def search_links(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected among distinct ``prints``, each node reached once."""
    left, right, unseen = [], [], prints
    while len(unseen):
        todo, unseen = [unseen[:1]], unseen[1:]
        while todo and len(unseen):
            for one in todo.pop():
                near = np.bitwise_count(unseen ^ one) <= MAX_BITS
                if near.any():
                    found, unseen = unseen[near], unseen[~near]
                    left.append(np.full(len(found), one))
                    right.append(found)
                    todo.append(found)
    none = np.zeros(0, prints.dtype)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def key_links(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key (whole groups)."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    small = np.repeat(sizes <= SHIFTS, sizes)
    left, right = [prints[:0]], [prints[:0]]
    for shift in range(1, SHIFTS):
        near = (keys[shift:] == keys[:-shift]) & small[shift:] & (np.bitwise_count(prints[shift:] ^ prints[:-shift]) <= MAX_BITS)
        left.append(prints[:-shift][near])
        right.append(prints[shift:][near])
    for at in np.flatnonzero(sizes > SHIFTS).tolist():
        a, b = search_links(prints[starts[at]:starts[at] + sizes[at]])
        left.append(a)
        right.append(b)
    return np.concatenate(left), np.concatenate(right)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by key; the last, perhaps unfinished group is carried on to the next batch."""
    keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def out(upto: int) -> pa.RecordBatch:
        a, b = key_links(keys[:upto], prints[:upto])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        prints = np.concatenate([prints, batch.column("fingerprint").to_numpy().view(np.uint64)])
        if len(keys) and keys[0] != keys[-1]:
            upto = int(np.searchsorted(keys, keys[-1]))
            yield out(upto)
            keys, prints = keys[upto:], prints[upto:]
    yield out(len(keys))


def _rooted(rows: DataFrame, least: Column, words_in_shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with a fingerprint in place of the text, and (fingerprint, least, root) of every distinct fingerprint."""
    if max_bits != MAX_BITS:
        raise ValueError(f"the segments are laid out for {MAX_BITS} differing bits")
    carried = rows.drop("text")
    schema = StructType([*carried.schema.fields, StructField("fingerprint", LongType())])
    prints = stored(rows.mapInArrow(_fingerprints(words_in_shingle, carried.columns), schema), "simhash-fingerprints")
    nodes = stored(prints.groupBy("fingerprint").agg(least.alias("least")), "simhash-nodes")
    keys = nodes.select("fingerprint").mapInArrow(_keys, "key long, fingerprint long")
    links = keys.repartition("key").sortWithinPartitions("key").mapInArrow(_links, "a long, b long")
    roots = components(links)
    rooted = nodes.join(roots, F.col("fingerprint") == F.col("node"), "left")
    return prints, rooted.select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(docs: DataFrame, words_in_shingle: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint as a signed long, component_id) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    prints, rooted = _rooted(rows, F.min("doc_id"), words_in_shingle, max_bits)
    groups = rooted.groupBy(F.col("root").alias("g_root")).agg(F.min("least").alias("component_id"))
    named = rooted.join(groups, F.col("root") == F.col("g_root")).select(F.col("fingerprint").alias("n_print"), "component_id")
    return prints.join(named, F.col("fingerprint") == F.col("n_print")).select("doc_id", "fingerprint", "component_id")


def first_of_groups(docs: DataFrame, words_in_shingle: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id (NULL last), then the least hash of the text."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.coalesce(F.col("text"), F.lit(""))
    text_hash = F.unhex(F.md5(text))  # 128 bits: it alone tells rows without an id apart
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash.alias("text_hash"), text.alias("text"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    prints, rooted = _rooted(rows, least, words_in_shingle, max_bits)
    kept = rooted.groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.doc_id").alias("k_id"), F.col("least.text_hash").alias("k_hash"))
    repeated = prints.groupBy(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = kept.join(repeated, null_safe(kept, repeated, [("k_id", "m_id"), ("k_hash", "m_hash")]), "left")
    kept = kept.select("k_id", "k_hash", F.col("n").isNotNull().alias("many"))
    rows = docs.select(F.col("doc_id").cast("long").alias("r_id"), text_hash.alias("r_hash"), own)
    rows = rows.join(kept, null_safe(rows, kept, [("r_id", "k_id"), ("r_hash", "k_hash")]))
    once = rows.where("not many").select("row.*")
    again = rows.where("many").groupBy("r_id", "r_hash").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row.*")
    return once.unionByName(again)
