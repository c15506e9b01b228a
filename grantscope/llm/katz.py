"""Language-model scores by Katz backoff over n-gram tables that Spark counts, stores and looks up.

Model. Counts come from the training documents (the others are held out). Order 1: a word seen r times has
d(r) r / N, and all unseen words are one class with the mass that discounting leaves. Order k: a word seen r
times after the context h has d(r) r / c(h); the rest of the context's mass is spread over the words unseen after h in
proportion to order k - 1, so the backoff weight is (1 - sum of seen p_k) / (1 - sum of their p_(k-1)), exactly. A
context that was never seen leaves the word to order k - 1. d(r) is Katz's Good-Turing discount for r up to 5, and 1 above.
Where counts of counts are too few for that, d(r) = (r - D) / r with D = (n1 + 0.5) / (n1 + 2 n2 + 1). A context whose
followers are all above 5 gets one more count in its total, so that something is left for the unseen.

Jobs. Tokens are written once, in chunks: a chunk's documents as indexes into its own distinct words, in a table
bucketed by chunk. For each order, chunks send their distinct n-grams with training counts to shards; a shard adds
them up, writes its part of the n-gram table, and answers each chunk with the counts and the contexts' sums. Chunks
then evaluate the recursion for each of their tokens. A context is a shard's as a whole, but for those with over a
quarter of a shard's mean load: their n-grams are spread over all shards by word, and the sums of these few contexts (at most
four per shard) are added up apart. So one very common word or pair costs each chunk one row, wherever it stands.

Words are identified by 64-bit hashes, n-grams exactly by the numbers that the shards give.

Defined cases. NULL text has only the end token. Every row is a document, repeated rows too; a NULL doc_id is trained
on. An empty table gives an empty result; with nothing to train on, every token is the unseen class (log 0).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantscope.llm.common import stored, text_slices
from grantscope.llm.packed import (pack, raw, raw_repeating, raw_rising, seal, unpack, unraw, unraw_repeating, unraw_rising,
                                   unseal)
from grantscope.session import shared_dir

CHUNK_BYTES = 8 << 20
#: Tokens for which a shard is made.
SHARD_TOKENS = 4_000_000
#: Counts up to this are discounted.
CUTOFF = 5
#: A context with more counts than this share of a shard's mean load is spread over all shards.
HOT_SHARE = 0.25
#: The end of a text, as a word that no text can have; the number that stands for the start of a text.
END = xxhash.xxh3_64_intdigest(b" ")
START = np.uint64(2**64 - 1)

CHUNKS = pa.schema([("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                    ("sizes", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary()), ("n_tokens", pa.int64())])
CHUNKS_DDL = "chunk long, doc_ids array<long>, held array<boolean>, sizes binary, words binary, tokens binary, n_tokens long"
#: Words: hashes and counts. n-grams, sorted by word, then context: the distinct contexts, which of them each one has (its
#: slot), words, counts, and the lower-order p of those that are counted; pairs are sorted by their words' counts first, and
#: have these in place of p, which they determine.
REQUESTS = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("hot", pa.bool_()), ("body", pa.binary())])
REQUESTS_DDL = "shard int, chunk long, hot boolean, body binary"
#: kind: "table" (the stored n-grams: contexts, followers of each, words, counts), "answer" (to a chunk: counts, numbers, sums of
#: the contexts) or "sums" (contexts and sums of those that are spread).
ANSWERS = pa.schema([("kind", pa.string()), ("level", pa.int32()), ("shard", pa.int32()), ("chunk", pa.int64()), ("hot", pa.bool_()),
                     ("body", pa.binary()), ("of_counts", pa.list_(pa.int64()))])
ANSWERS_DDL = "kind string, level int, shard int, chunk long, hot boolean, body binary, of_counts array<long>"


# ---- the model ------------------------------------------------------------------------------------------------------

def discounts(of_counts: list[int]) -> np.ndarray:
    """d(0) to d(CUTOFF) from the numbers of n-grams seen 1 to CUTOFF + 1 times; d(0) is 1."""
    n = [0.0, *map(float, of_counts)]
    if all(x > 0 for x in n[1:CUTOFF + 2]):
        common = (CUTOFF + 1) * n[CUTOFF + 1] / n[1]
        d = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if common < 1 else 0.0 for r in range(1, CUTOFF + 1)]
        if all(0 < x < 1 for x in d):
            return np.array([1.0, *d])
    shift = (n[1] + 0.5) / (n[1] + 2 * n[2] + 1)
    return np.array([1.0, *((r - shift) / r for r in range(1, CUTOFF + 1))])


@dataclass
class Level:
    """What all tasks need of an order: sizes, discounts, and the sums of the contexts that are spread over shards."""

    shards: int
    total: int
    distinct: int
    d: np.ndarray
    n: list[int]
    hot_over: float = float("inf")
    hot_ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    hot_sums: np.ndarray = field(default_factory=lambda: np.zeros((0, CUTOFF + 2)))

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        return counts * np.where(counts <= CUTOFF, self.d[np.minimum(counts, CUTOFF)], 1.0)


def left_over(low: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Counts that discounting leaves: ``low`` has the number of n-grams seen 1 to CUTOFF times, in rows."""
    return low @ ((1 - d[1:]) * np.arange(1, CUTOFF + 1))


def unigram_probabilities(counts: np.ndarray, level: Level) -> np.ndarray:
    left = float(left_over(np.array([level.n[:CUTOFF]], float), level.d)[0])
    total = level.total + (left == 0)
    return np.where(counts > 0, level.discounted(counts) / total, (left or 1.0) / total)


def backoff_probabilities(counts: np.ndarray, lower: np.ndarray, sums: np.ndarray, level: Level) -> np.ndarray:
    """p of each n-gram from its count, its lower-order p, and its context's row of sums: total, seen 1 to CUTOFF times, lower p."""
    total, left = sums[:, 0], left_over(sums[:, 1:CUTOFF + 1], level.d)
    full = total + (left == 0)
    weight = np.where(left == 0, 1.0, left) / np.maximum(full, 1) / np.maximum(1 - sums[:, -1], 1e-300)
    p = np.where(counts > 0, level.discounted(counts) / np.maximum(full, 1), weight * lower)
    return np.where(total > 0, p, lower)


# ---- chunks ---------------------------------------------------------------------------------------------------------

def _chunk_batches(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.Table]:
    waiting, size = [], 0
    for part in text_slices(batches, max_bytes=max_bytes):
        n = part.column("text").nbytes
        if waiting and size + n > max_bytes:
            yield pa.Table.from_batches(waiting)
            waiting, size = [], 0
        waiting.append(part)
        size += n
    if waiting:
        yield pa.Table.from_batches(waiting)


def tokenised(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens per text (with the end), the distinct words' hashes, frequent ones first, and each token's word."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets, flat = lists.offsets.to_numpy().astype(np.int64), lists.flatten()
    there = pc.greater(pc.binary_length(flat), 0)
    words = flat.filter(there).dictionary_encode()
    upto = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])[offsets - offsets[0]]
    sizes = np.diff(upto) + 1
    names = words.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.array([*map(xxhash.xxh3_64_intdigest, names), END], np.uint64)
    tokens = np.full(int(sizes.sum()), len(names), np.int64)
    inside = np.ones(len(tokens), bool)
    inside[np.cumsum(sizes) - 1] = False
    tokens[inside] = words.indices.to_numpy()
    order = np.argsort(-np.bincount(tokens, minlength=len(hashes)), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return sizes, hashes[order], place[tokens]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId() << 32
    for i, part in enumerate(_chunk_batches(batches, CHUNK_BYTES)):
        part = part.combine_chunks()
        sizes, words, tokens = tokenised(part["text"].chunk(0))
        row = [task + i, part["doc_id"].to_pylist(), part["held_out"].to_pylist(), pack(sizes.astype(np.uint32)), words.tobytes(),
               pack(tokens.astype(np.uint32)), len(tokens)]
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, CHUNKS)], schema=CHUNKS)


class Chunk:
    """A chunk's tokens, with what the shards have answered so far."""

    def __init__(self, row: dict, levels: list[Level], answers: list[dict]):
        self.id, self.doc_ids, self.held = row["chunk"], row["doc_ids"], np.array(row["held"], bool)
        self.sizes, self.words = unpack(row["sizes"]).astype(np.int64), np.frombuffer(row["words"], np.uint64)
        self.tokens = unpack(row["tokens"]).astype(np.int32)
        self.train = np.repeat(~self.held, self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.grams, self.ids = self.tokens, self.words
        for k, level in enumerate(levels, 1):
            found = sorted((a for a in answers if a["level"] == k), key=lambda a: (a["hot"], a["shard"]))
            found = [a | dict(zip(("counts", "ids", "sums"), unseal(a["body"]))) for a in found]
            if k == 1:
                self._take_words(level, found)
            else:
                self._take_grams(k, level, found)

    def training_counts(self, grams: np.ndarray, n: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        return np.bincount(grams[self.train[at]], minlength=n)

    def word_order(self, shards: int) -> np.ndarray:
        return np.argsort(self.words % np.uint64(shards), kind="stable")

    def _take_words(self, level: Level, found: list[dict]) -> None:
        order = self.word_order(level.shards)
        self.ids, self.counts = np.empty(len(order), np.uint64), np.empty(len(order), np.int64)
        if len(order):
            self.ids[order] = np.concatenate([unraw(a["ids"]) for a in found])
            self.counts[order] = np.concatenate([unraw(a["counts"]) for a in found])
        self.word_ids, self.word_counts = self.ids, self.counts
        self.p = unigram_probabilities(self.counts, level)[self.tokens]

    def next_grams(self, k: int, level: Level) -> dict[str, np.ndarray]:
        """The distinct n-grams of order ``k``, one up, as requests have them: spread contexts last; by shard, word, context.

        ``slot`` numbers the distinct contexts of all requests in turn; ``heads`` and ``head_part`` are theirs.
        """
        place = (np.arange(len(self.tokens)) - np.repeat(self.first, self.sizes)).astype(np.int32)
        at = np.flatnonzero(place >= (0 if k == 2 else k - 2)).astype(np.int32)
        before = np.where(place[at] > 0, self.grams[at - 1], len(self.ids))  # one past the last: the start of a text
        pair = before.astype(np.int64) * len(self.words) + self.tokens[at]
        del place, before
        pair, first, index = np.unique(pair, return_index=True, return_inverse=True)
        context, word = np.divmod(pair, len(self.words))
        ids, counts = np.append(self.ids, START), np.append(self.counts, np.iinfo(np.int64).max)
        hot = counts[context] > level.hot_over
        weight = self.word_counts[word] if k == 2 else np.zeros(len(word), np.int64)
        context, word = ids[context], self.word_ids[word]
        shard = ((context ^ np.where(hot, _spread(word), np.uint64(0))) % np.uint64(level.shards)).astype(np.int64)
        part = shard + hot * level.shards
        by_context = np.lexsort((context, part))
        new = changes(part[by_context], context[by_context])
        slot = np.empty(len(part), np.int64)
        slot[by_context] = np.cumsum(new) - 1
        heads = by_context[new]
        order = np.lexsort((context, word, weight, part))
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        found = {"context": context, "word": word, "part": part, "slot": slot, "weight": weight, "lower": self.p[at][first],
                 "counts": self.training_counts(index, len(pair), at)}
        return {name: v[order] for name, v in found.items()} | {
            "at": at, "index": rank[index], "heads": context[heads], "head_part": part[heads]}

    def _take_grams(self, k: int, level: Level, found: list[dict]) -> None:
        g = self.next_grams(k, level)
        counts = np.concatenate([np.zeros(0, np.int64), *(unraw(a["counts"]) for a in found)])
        sums = np.empty((len(g["heads"]), CUTOFF + 2))
        cold = g["head_part"] < level.shards
        sums[cold] = np.concatenate([np.zeros((0, CUTOFF + 2)), *(_unraw_sums(a["sums"]) for a in found if not a["hot"])])
        sums[~cold] = level.hot_sums[np.searchsorted(level.hot_ids, g["heads"][~cold])]
        of_gram = sums[g["slot"]]
        p = backoff_probabilities(counts, g["lower"], of_gram, level)
        self.p[g["at"]] = p[g["index"]]
        if found and found[0]["ids"]:
            self.ids, self.counts = np.concatenate([unraw(a["ids"]) for a in found]), counts
            self.grams = np.full(len(self.tokens), len(self.ids), np.int32)
            self.grams[g["at"]] = g["index"]

    def per_document(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.first) if len(self.first) else np.zeros(0)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it in any of the columns; True at the first."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _spread(ids: np.ndarray) -> np.ndarray:
    return (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)


def _raw_sums(sums: np.ndarray) -> bytes:
    columns = [raw_repeating(sums[:, i]) for i in range(sums.shape[1])]
    return b"".join(len(c).to_bytes(8, "little") + c for c in columns)


def _unraw_sums(data: bytes) -> np.ndarray:
    columns, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 8], "little")
        columns.append(unraw_repeating(data[at + 8:at + 8 + n]))
        at += 8 + n
    return np.stack(columns, axis=1)


def _requests(rows: list[list]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), REQUESTS)], schema=REQUESTS) if rows else REQUESTS.empty_table()


def _word_requests(shards: int):
    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, [], [])
                order = chunk.word_order(shards)
                counts = chunk.training_counts(chunk.tokens, len(chunk.words))[order]
                words = chunk.words[order]
                shard = (words % np.uint64(shards)).astype(np.int64)
                starts = np.flatnonzero(changes(shard))
                rows = [[int(shard[a]), chunk.id, False, seal(words[a:b].tobytes(), raw(counts[a:b]))]
                        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(shard)])]
                yield from _requests(rows).to_batches()

    return requests


def _gram_requests(levels: list[Level], level: Level):
    def requests(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        rows, found = [], answers.to_pylist()
        for row in chunks.to_pylist():
            g = (chunk := Chunk(row, levels, found)).next_grams(len(levels) + 1, level)
            starts = np.flatnonzero(changes(g["part"]))
            head_starts = np.searchsorted(g["head_part"], g["part"][starts])
            for a, b, h, i in zip(starts.tolist(), [*starts[1:].tolist(), len(g["part"])], head_starts.tolist(),
                                  [*head_starts[1:].tolist(), len(g["heads"])]):
                counts, part = g["counts"][a:b], int(g["part"][a])
                body = seal(raw_rising(g["heads"][h:i]), raw((g["slot"][a:b] - h).astype(np.uint32)), raw_rising(g["word"][a:b]),
                            raw(counts), raw_rising(g["weight"][a:b][counts > 0]) if len(levels) == 1
                            else raw_repeating(g["lower"][a:b][counts > 0]))
                rows.append([part % level.shards, chunk.id, part >= level.shards, body])
        return _requests(rows)

    return requests


# ---- shards ---------------------------------------------------------------------------------------------------------

def _of_counts(counts: np.ndarray) -> list[int]:
    """All counts, how many are over 0, how many are 1 to CUTOFF + 1."""
    return [int(counts.sum()), int((counts > 0).sum()), *(int((counts == r).sum()) for r in range(1, CUTOFF + 2))]


def _answers(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist([dict.fromkeys(ANSWERS.names) | r for r in rows], schema=ANSWERS)


def _add_words(shards: int):
    def add(table: pa.Table) -> pa.Table:
        requests = table.to_pylist()
        bodies, shard = [unseal(r["body"]) for r in requests], requests[0]["shard"]
        words = [np.frombuffer(b[0], np.uint64) for b in bodies]
        distinct, index = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.bincount(index, np.concatenate([unraw(b[1]) for b in bodies]), len(distinct)).astype(np.int64)
        # Numbers rise with counts, so that requests sorted by count are nearly sorted by number.
        ids = np.empty(len(distinct), np.uint64)
        ids[np.argsort(counts, kind="stable")] = np.arange(len(distinct), dtype=np.uint64) * np.uint64(shards) + np.uint64(shard)
        head = {"level": 1, "shard": shard, "hot": False}
        out, at = [head | {"kind": "table", "body": seal(b"", b"", raw(distinct), raw(counts)), "of_counts": _of_counts(counts)}], 0
        for request, own in zip(requests, words):
            own = index[at:at + len(own)]
            at += len(own)
            out.append(head | {"kind": "answer", "chunk": request["chunk"], "body": seal(raw(counts[own]), raw(ids[own]))})
        return _answers(out)

    return add


def _add_grams(k: int, words: Level, shards: int, numbered: bool):
    def add(table: pa.Table) -> pa.Table:
        every, out = table.to_pylist(), []
        shard, seen = every[0]["shard"], 0
        for hot in (False, True):
            requests = [r for r in every if r["hot"] == hot]
            if not requests:
                continue
            bodies = [unseal(r["body"]) for r in requests]
            heads, slots = [unraw_rising(b[0]) for b in bodies], [unraw(b[1]) for b in bodies]
            of_head = np.unique(np.concatenate(heads), return_inverse=True)[1]
            context = np.concatenate([h[i] for h, i in zip(heads, slots)])
            word = np.concatenate([unraw_rising(b[2]) for b in bodies])
            times = np.concatenate([unraw(b[3]) for b in bodies])
            lower = np.zeros(len(times))
            lower[times > 0] = (unigram_probabilities(np.concatenate([unraw_rising(b[4]) for b in bodies]), words) if k == 2
                                else np.concatenate([unraw_repeating(b[4]) for b in bodies]))
            order = np.lexsort((word, context))
            context, word = context[order], word[order]
            new_context, new = changes(context), changes(context, word)
            starts = np.flatnonzero(new)
            counts, lower = np.add.reduceat(times[order], starts), np.maximum.reduceat(lower[order], starts)
            gram = np.empty(len(order), np.int64)
            gram[order] = np.cumsum(new) - 1
            context_starts = np.flatnonzero(new_context[starts])
            sums = np.stack([counts, *(counts == r for r in range(1, CUTOFF + 1)), np.where(counts > 0, lower, 0.0)], axis=1).astype(float)
            sums = np.add.reduceat(sums, context_starts, axis=0)
            ids = (np.arange(len(starts), dtype=np.uint64) + np.uint64(seen)) * np.uint64(shards) + np.uint64(shard)
            seen += len(starts)
            head, trained, at, head_at = {"level": k, "shard": shard, "hot": hot}, counts > 0, 0, 0
            if hot:
                out.append(head | {"kind": "sums", "body": seal(raw(context[starts][context_starts]), _raw_sums(sums))})
            kept_context = context[starts][trained]
            kept_heads = np.flatnonzero(changes(kept_context))
            out.append(head | {"kind": "table", "of_counts": _of_counts(counts), "body": seal(
                raw_rising(kept_context[kept_heads]), raw(np.diff([*kept_heads, len(kept_context)])), raw(word[starts][trained]),
                raw(counts[trained]))})
            for request, own_heads, own_slots in zip(requests, heads, slots):
                own, own_sums = slice(at, at + len(own_slots)), slice(head_at, head_at + len(own_heads))
                at, head_at = own.stop, own_sums.stop
                out.append(head | {"kind": "answer", "chunk": request["chunk"], "body": seal(
                    raw(counts[gram[own]]), raw(ids[gram[own]]) if numbered else b"", b"" if hot else _raw_sums(sums[of_head[own_sums]]))})
        return _answers(out)

    return add


def _hot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            contexts, sums = unseal(row["body"])
            sums = _unraw_sums(sums)
            yield pa.RecordBatch.from_arrays([pa.array(unraw(contexts).view(np.int64)), *(pa.array(c.copy()) for c in sums.T)],
                                             ["context", *(f"s{i}" for i in range(CUTOFF + 2))])


# ---- jobs -----------------------------------------------------------------------------------------------------------

def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed by ``key``, so that it is not dealt out again for each order.

    The catalogue knows the table only until its plan is made: the files are the folder's, and the plan keeps their buckets.
    """
    spark, name = df.sparkSession, f"katz_chunks_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", shared_dir(spark, "llm", name)).format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table `{name}`")
    return table


def _level(answers: DataFrame, shards: int) -> Level:
    n = answers.where("kind = 'table'").agg(*(F.coalesce(F.sum(F.col("of_counts")[i]), F.lit(0)) for i in range(CUTOFF + 3))).first()
    return Level(shards, n[0], n[1], discounts(list(n[2:])), list(n[2:]))


def _scored(levels: list[Level]):
    words = levels[0]
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def scored(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out, found = [schema.empty_table()], answers.to_pylist()
        for row in chunks.to_pylist():
            chunk = Chunk(row, levels, found)
            counts = chunk.word_counts[chunk.tokens]
            base = np.log10((counts + 1) / (words.total + words.distinct + 1))
            columns = [chunk.doc_ids, chunk.held, chunk.sizes, chunk.per_document((counts > 0).astype(np.int64)),
                       np.full(len(chunk.sizes), words.total), chunk.per_document(base), chunk.per_document(np.log10(chunk.p))]
            out.append(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema))
        return pa.concat_tables(out)

    return scored


def score_documents(docs: DataFrame, order: int = 2, held_out: str = "pmod(crc32(cast(cast(doc_id as string) as binary)), 7) = 2") -> DataFrame:
    """Per document: whether it is held out, its tokens and known tokens, the add-one unigram score and the model's score.

    ``held_out`` is an SQL condition on ``doc_id``; documents for which it is not true are trained on.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("held_out", F.coalesce(F.expr(held_out), F.lit(False)))
    chunks = _bucketed(rows.mapInArrow(_chunks, CHUNKS_DDL), "chunk")
    shards = 1 + (chunks.agg(F.sum("n_tokens")).first()[0] or 0) // SHARD_TOKENS
    requests = chunks.mapInArrow(_word_requests(shards), REQUESTS_DDL)
    answers = stored(requests.groupBy("shard").applyInArrow(_add_words(shards), ANSWERS_DDL), "katz-1", ("kind",))
    levels, every = [_level(answers, shards)], answers
    for k in range(2, order + 1):
        to_chunks = every.where("kind = 'answer'")
        level = Level(shards, 0, 0, np.ones(CUTOFF + 1), [], levels[0].total * HOT_SHARE / shards)
        requests = chunks.groupBy("chunk").cogroup(to_chunks.groupBy("chunk")).applyInArrow(_gram_requests(levels, level), REQUESTS_DDL)
        answers = stored(requests.groupBy("shard").applyInArrow(_add_grams(k, levels[0], shards, k < order), ANSWERS_DDL), f"katz-{k}", ("kind",))
        hot = answers.where("kind = 'sums'").mapInArrow(_hot_rows, "context long, " + ", ".join(f"s{i} double" for i in range(CUTOFF + 2)))
        hot = hot.groupBy("context").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(CUTOFF + 2))).toArrow()  # four a shard at most
        ids = hot["context"].to_numpy().view(np.uint64)
        by_id = np.argsort(ids)
        counted = _level(answers, shards)
        counted.hot_over, counted.hot_ids = level.hot_over, ids[by_id]
        counted.hot_sums = np.stack([hot[f"s{i}"].to_numpy() for i in range(CUTOFF + 2)], axis=1)[by_id]
        levels.append(counted)
        every = every.unionByName(answers)
    to_chunks = every.where("kind = 'answer'")
    return chunks.groupBy("chunk").cogroup(to_chunks.groupBy("chunk")).applyInArrow(
        _scored(levels), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
