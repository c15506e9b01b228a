"""Prefix trie of conversations, as tables of nodes in minimal perfect hashes.

A node is a distinct sequence of first turns. Its digest is the sum of 128-bit hashes of (position, turn), so digests of prefixes
are running sums, and the parts of a long conversation can be hashed apart.

1. *Turns.* Rows are dealt to ranges of (conversation, turn, role, text); texts become digests and word counts there, and turns are
   numbered in two levels (inside a range, then by the counts of the ranges before it).
2. *Rebuilt conversations.* First turns come from the conversation's base, the others are its own; arrays of at most ``BAND`` turns.
3. *Slots.* Bands are dealt to shards of bounded size. A shard enumerates its distinct prefix digests; a minimal perfect hash gives
   each a slot, the digest in the slot is compared on every look-up, and rows of one digest must agree in depth, parent and turn
   (an error else). Counts are scattered to flat arrays by slot; the shards' nodes are then merged by digest.
4. *Sums.* A node's saved tokens are its words for every member but the smallest, so each turn of a conversation that isn't the smallest
   member of its node adds its words there; a leaf counts once, for its smallest member. These are scattered by slot and go up through the
   array of parent slots, in depth order. What lies in later bands of a conversation is added to its earlier ones as one number each,
   as bands begin at the same depths everywhere. Sums of shards add up by digest.

Skew. A first turn that a third of all conversations share is one node a shard; a conversation with a third of all rows is
split by ranges, then by bands; conversations that end at one node are joined to texts by ranges of ids, and one task streams these
texts through the node's SHA-256 (which has to read them in order), holding none of them.

Defined cases. NULL roles and texts are empty; NULL turns come first; turns that are equal stand by role, then text; repeated rows are
turns of their own. Rows without ``conv_id`` are in no conversation. ``c % 20`` keeps the sign of c. An empty table has no node.
Long texts are read once. Extra columns of any name aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantscope.llm.common import stored, text_slices
from grantscope.llm.line_dedup import MIX, _mixed, build_hash, look_up
from grantscope.operators.joins import bounded_broadcast

#: Conversations of one base, own turns that come from it at most, turns of a band (over that number), and rows of a shard.
FAMILY = 20
SHARED = 3
BAND = 4096
SHARD_TURNS = 150_000
#: Conversation ids written as one text.
ID_RANGE = 1 << 16

TURNS = pa.schema([("range", pa.int32()), ("conv_id", pa.int64()), ("p", pa.int64()), ("t0", pa.int64()), ("t1", pa.int64()), ("words", pa.int64())])
TURNS_DDL = "range int, conv_id long, p long, t0 long, t1 long, words long"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of sorted rows as digests and word counts, numbered inside the range."""
    last, count = None, 0
    for part in text_slices(batches):
        ids = part.column("conv_id").to_numpy()
        new = np.concatenate([[ids[0] != last], ids[1:] != ids[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(ids)), -1))
        p = np.where(start >= 0, np.arange(len(ids)) - start, np.arange(len(ids)) + count) + 1
        last, count = ids[-1], int(p[-1])
        digests, words = [], []
        for role, text in zip(part.column("role").to_pylist(), part.column("text").to_pylist()):
            role, text = role.encode(), text.encode()
            digests.append(xxhash.xxh3_128_digest(len(role).to_bytes(8, "little") + role + text))
            words.append(len(text.split()))  # bytes are split at [\x20\x09-\x0D]
        pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([part.column("range"), part.column("conv_id"), pa.array(p, pa.int64()), pa.array(pair[:, 0].copy()),
                                          pa.array(pair[:, 1].copy()), pa.array(words, pa.int64())], schema=TURNS)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Every turn's place ``p`` (from 1) in its conversation, its digest and its words."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("range"), "conv_id", "role", "text")
    turns = stored(dealt.mapInArrow(_numbered, TURNS_DDL), "trie-turns")
    counts = turns.groupBy("range", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # at most one conversation goes on from a range to the next: at most one row a range
    later = counts.select(F.col("range").alias("r"), F.col("conv_id").alias("c"), F.sum("n").over(before).alias("earlier")).where("earlier > 0")
    joined = turns.join(bounded_broadcast(later), (F.col("range") == F.col("r")) & (F.col("conv_id") == F.col("c")), "left")
    return joined.select("conv_id", (F.col("p") + F.coalesce("earlier", F.lit(0))).alias("p"), "t0", "t1", "words")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Rebuilt conversations in bands of at most ``BAND`` turns (a turnless one has one empty band): arrays of digests and words."""
    own = numbered_turns(conversations).groupBy("conv_id", F.floor((F.col("p") - 1) / BAND).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("p", "t0", "t1", "words"))).alias("turns"))
    own = stored(own, "trie-own")
    heads = own.where(f"part = 0 and conv_id % {FAMILY} = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED).alias("head"))
    rows = own.join(heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("base"), "left")
    rows = rows.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % (SHARED + 1)).cast("int"))
    rows = rows.withColumn("head", F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h")))
    first_part = F.concat("head", F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0))))
    rows = rows.select("conv_id", F.when(F.col("part") == 0, first_part).otherwise(F.col("turns")).alias("turns"),
                       F.when(F.col("part") == 0, 0).otherwise(F.col("part") * BAND - F.col("h") + F.size("head")).cast("long").alias("before"))
    # a shorter head shifts the later parts: cut where bands begin, the same depths in all conversations
    last = F.greatest(F.col("before"), F.col("before") + F.size("turns") - 1)
    rows = rows.withColumn("band", F.explode(F.sequence(F.floor(F.col("before") / BAND), F.floor(last / BAND))))
    begin = F.greatest(F.col("band") * BAND - F.col("before"), F.lit(0).cast("long")).cast("int")
    end = F.least((F.col("band") + 1) * BAND - F.col("before"), F.size("turns")).cast("int")
    cut = rows.select("conv_id", "band", F.struct("before", F.slice("turns", begin + 1, end - begin).alias("turns")).alias("piece"))
    bands = cut.groupBy("conv_id", "band").agg(F.flatten(F.array_sort(F.collect_list("piece")).getField("turns")).alias("turns"))
    return bands.select("conv_id", "band", (F.col("band") * BAND).alias("before"), *[F.col(f"turns.{c}").alias(c) for c in ("t0", "t1", "words")])


def _hashes(t0: np.ndarray, t1: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """128-bit hashes of (depth, turn), as n x 2 words."""
    t0, t1, step = t0.view(np.uint64), t1.view(np.uint64), depth.astype(np.uint64) * np.uint64(MIX[0])
    return np.stack([_mixed(t0 ^ _mixed(t1 + step)), _mixed(t1 ^ _mixed(t0 ^ ~step))], axis=1)


class Bands:
    """The rows of a table of bands, one after another, each band after a row for the node where it begins."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.conv_ids, self.bands = (table[c].to_numpy() for c in ("conv_id", "band"))
        n = pc.list_value_length(table["t0"]).to_numpy().astype(np.int64)
        t0, t1, words = (pc.list_flatten(table[c]).to_numpy() for c in ("t0", "t1", "words"))
        self.band = np.repeat(np.arange(len(n)), n + 1)
        self.starts = np.cumsum(n + 1) - n - 1
        self.ends = self.starts + n
        real = np.ones(len(self.band), bool)
        real[self.starts] = False
        place = np.arange(len(self.band)) - self.starts[self.band]
        self.depth = table["before"].to_numpy()[self.band] + place
        #: nodes with which a later band begins.
        self.begins = (place == 1) & (self.bands[self.band] > 0)
        self.conv = self.conv_ids[self.band]
        self.words = np.zeros(len(self.band), np.int64)
        self.words[real] = words
        self.hash = np.zeros((len(self.band), 2), np.uint64)
        self.hash[real] = _hashes(t0, t1, self.depth[real])
        #: whether the row is a node of this band; the row before a later band is one of the band before.
        self.own = real | (self.depth == 0)
        if "o0_low" in table.column_names:
            for lane in (0, 1):
                low, high = (table[f"o{lane}_{x}"].to_numpy().astype(np.uint64) for x in ("low", "high"))
                self.hash[self.starts, lane] = low + (high << np.uint64(32))
            total = np.cumsum(self.hash, axis=0)
            base = np.concatenate([np.zeros((1, 2), np.uint64), total])[self.starts]
            self.digest = total - base[self.band]
            self.parent = np.where(place > 0, np.arange(len(self.band)) - 1, -1)


LANES = ("o0_low", "o0_high", "o1_low", "o1_high")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A band's sums of hashes, in halves of words (which can be added without overflow)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = Bands(pa.Table.from_batches([batch]))
        halves = [half.astype(np.int64) for lane in (0, 1) for half in (rows.hash[:, lane] & np.uint64(2**32 - 1), rows.hash[:, lane] >> np.uint64(32))]
        out = [pa.array(np.add.reduceat(x, rows.starts)) for x in halves]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("band"), *out], ["conv_id", "band", *LANES])


def sharded_bands(conversations: DataFrame) -> DataFrame:
    """Bands with the sums of hashes before them, and their shard, stored."""
    bands = stored(rebuilt(conversations), "trie-bands")
    sums = bands.mapInArrow(_sums, "conv_id long, band long, " + ", ".join(f"{x} long" for x in LANES))
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("conv_id", "band", *[F.sum(x).over(before).alias(x) for x in LANES]).where("band > 0")
    # additions wrap in the digests, so only the lowest 32 bits of a high half count
    offsets = offsets.select("conv_id", "band", *[(F.pmod(x, F.lit(1 << 32)) if x.endswith("high") else F.col(x)).alias(x) for x in LANES])
    rows = bands.agg(F.sum(F.size("t0") + 1)).first()[0] or 0
    shard = F.pmod(F.xxhash64(F.col("conv_id") - F.col("conv_id") % FAMILY, "band"), F.lit(1 + rows // SHARD_TURNS)).cast("int")
    return stored(bands.join(offsets, ["conv_id", "band"], "left").na.fill(0, list(LANES)).withColumn("shard", shard), "trie-shards")


def _slots(distinct: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Slots of ``digests`` in the hash of the ``distinct`` ones, verified."""
    levels = build_hash(distinct)
    table = np.empty_like(distinct)
    table[look_up(levels, distinct)] = distinct
    at = look_up(levels, digests)
    if len(at) and (at.min() < 0 or (table[at] != digests).any()):
        raise ValueError("a digest isn't in the table of nodes")
    return at


def _distinct(digests: np.ndarray) -> np.ndarray:
    order = np.lexsort((digests[:, 0], digests[:, 1]))
    rows = digests[order]
    return rows[np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])]


NODES = pa.schema([("shard", pa.int32()), ("d0", pa.int64()), ("d1", pa.int64()), ("p0", pa.int64()), ("p1", pa.int64()), ("depth", pa.int64()),
                   ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("words", pa.int64()), ("check", pa.int64())])
NODES_DDL = "shard int, d0 long, d1 long, p0 long, p1 long, depth long, n_convs long, conv_id long, words long, check long"


def _enumerated(table: pa.Table) -> pa.Table:
    """A shard's nodes: members here, the smallest one, parent; nodes before a later band have no members here."""
    rows = Bands(table)
    distinct = _distinct(rows.digest)
    slot, n = _slots(distinct, rows.digest), len(distinct)
    has_parent = rows.own & (rows.parent >= 0)
    check = np.zeros(len(slot), np.uint64)
    up = rows.digest[rows.parent]
    check[has_parent] = _mixed(rows.hash[has_parent, 0] ^ _mixed(up[has_parent, 0] ^ _mixed(rows.hash[has_parent, 1] ^ _mixed(
        up[has_parent, 1] + rows.depth[has_parent].astype(np.uint64)))))
    node = {"check": np.zeros(n, np.uint64), "parent": np.zeros((n, 2), np.uint64), "words": np.zeros(n, np.int64), "depth": np.zeros(n, np.int64)}
    node["depth"][slot] = rows.depth
    own, of = np.flatnonzero(has_parent), slot[has_parent]
    for name, values in (("check", check[own]), ("parent", up[own]), ("words", rows.words[own])):
        node[name][of] = values
    if (node["depth"][slot] != rows.depth).any() or (node["check"][of] != check[own]).any():
        raise ValueError("two sequences of turns have one digest")
    n_convs = np.bincount(slot[rows.own], minlength=n)
    smallest = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(smallest, slot, rows.conv)
    digest = np.empty((n, 2), np.uint64)
    digest[slot] = rows.digest
    none = ~np.isin(np.arange(n), of)  # the root, and nodes before a later band
    signed = lambda x: x.view(np.int64)
    columns = [np.full(n, table["shard"][0].as_py()), signed(digest[:, 0].copy()), signed(digest[:, 1].copy()),
               signed(node["parent"][:, 0].copy()), signed(node["parent"][:, 1].copy()), node["depth"], n_convs, smallest, node["words"],
               signed(node["check"])]
    masked = {"p0", "p1", "words", "check"}
    return pa.Table.from_arrays([pa.array(c, f.type, mask=none if f.name in masked else None) for c, f in zip(columns, NODES)], schema=NODES)


PARTS = pa.schema([("kind", pa.string()), ("conv_id", pa.int64()), ("band", pa.int64()), ("d0", pa.int64()), ("d1", pa.int64()),
                   ("saved", pa.int64()), ("leaves", pa.int64()), ("parent_conv_id", pa.int64())])
PARTS_DDL = "kind string, conv_id long, band long, d0 long, d1 long, saved long, leaves long, parent_conv_id long"


def _signed(digests: np.ndarray) -> list[pa.Array]:
    return [pa.array(digests[:, k].copy().view(np.int64)) for k in (0, 1)]


def _accumulated(table: pa.Table, nodes: pa.Table) -> pa.Table:
    """A shard's share of each node's sums (kind ``node``), and each band's own sums and last node (kind ``band``)."""
    if not table.num_rows:
        return PARTS.empty_table()
    rows = Bands(table)
    nodes = nodes.combine_chunks()
    distinct = np.stack([nodes[c].to_numpy().view(np.uint64) for c in ("d0", "d1")], axis=1)
    slot, at, n = _slots(distinct, rows.digest), _slots(distinct, distinct), len(distinct)
    owner, leaf, depth = np.empty(n, np.int64), np.empty(n, bool), np.empty(n, np.int64)
    owner[at], leaf[at], depth[at] = nodes["owner"].to_numpy(), nodes["n_children"].to_numpy() == 0, nodes["depth"].to_numpy()
    smallest = rows.conv == owner[slot]
    saved = np.where(rows.own & ~smallest, rows.words, 0)
    leaves = (rows.own & smallest & leaf[slot]).astype(np.int64)
    total = np.zeros((n, 2), np.int64)
    np.add.at(total, slot, np.stack([saved, leaves], axis=1))
    parent = np.full(n, -1)
    inner = rows.own & (rows.parent >= 0)
    parent[slot[inner]] = slot[rows.parent[inner]]
    begins = np.zeros(n, bool)
    begins[slot[rows.begins]] = True
    # deepest first; sums end where a later band begins, as its conversations add them to the bands before themselves
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    for level in reversed(levels):
        level = level[(parent[level] >= 0) & ~begins[level]]
        np.add.at(total, parent[level], total[level])
    here = np.zeros(n, bool)
    here[slot[rows.own]] = True
    digest = np.empty((n, 2), np.uint64)
    digest[at] = distinct
    k, m = int(here.sum()), len(rows.starts)
    top = np.where(parent >= 0, owner[parent], 0)
    own_nodes = [pa.array(["node"] * k), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), *_signed(digest[here]), pa.array(total[here, 0]),
                 pa.array(total[here, 1]), pa.array(top[here], mask=parent[here] < 0)]
    sums = [pa.array(np.add.reduceat(x, rows.starts)) for x in (saved, leaves)]
    bands = [pa.array(["band"] * m), pa.array(rows.conv_ids), pa.array(rows.bands), *_signed(rows.digest[rows.ends]), *sums, pa.nulls(m, pa.int64())]
    return pa.concat_tables([pa.Table.from_arrays(x, schema=PARTS) for x in (own_nodes, bands)])


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the later bands of a conversation add to each node of a band."""
    for batch in batches:
        if batch.num_rows:
            rows = Bands(pa.Table.from_batches([batch]))
            later = [batch.column(c).to_numpy()[rows.band][rows.own] for c in ("saved", "leaves")]
            yield pa.RecordBatch.from_arrays([*_signed(rows.digest[rows.own]), *map(pa.array, later)], ["d0", "d1", "saved", "leaves"])


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's id texts, which come in order."""
    names, key, digest = ["d0", "d1", "ends_sha256"], None, None
    for batch in batches:
        done = []
        for d0, d1, ids in zip(*(batch.column(c).to_pylist() for c in ("d0", "d1", "ids"))):
            if (d0, d1) == key:
                digest.update(b"," + ids.encode())
                continue
            if key:
                done.append((*key, digest.hexdigest()))
            key, digest = (d0, d1), hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names)
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, digest.hexdigest())], names)


def node_table(bands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The shards' nodes, and all nodes with members, smallest member (``owner``), words and children; both stored."""
    local = stored(bands.groupBy("shard").applyInArrow(_enumerated, NODES_DDL), "trie-local")
    merged = local.groupBy("d0", "d1").agg(*[F.max(c).alias(c) for c in ("p0", "p1", "depth", "words")], F.sum("n_convs").alias("n_convs"),
                                           F.min("conv_id").alias("owner"), F.min("check").alias("low"), F.max("check").alias("high"))
    clash = F.raise_error(F.lit("two sequences of turns have one digest")).cast("long")
    merged = merged.withColumn("depth", F.when(F.col("low").eqNullSafe(F.col("high")), F.col("depth")).otherwise(clash)).drop("low", "high")
    merged = stored(merged, "trie-merged")
    children = merged.where("p0 is not null").groupBy(F.col("p0").alias("d0"), F.col("p1").alias("d1")).agg(F.count(F.lit(1)).alias("n_children"))
    return local, stored(merged.join(children, ["d0", "d1"], "left").na.fill(0, ["n_children", "words"]), "trie-nodes")


def trie_nodes(conversations: DataFrame) -> DataFrame:
    """One row per node: smallest member, depth, parent's smallest member, members, children, leaves below, tokens that sharing saves
    below, and the hash of the conversations that end there."""
    bands = sharded_bands(conversations)
    local, nodes = node_table(bands)
    known = local.select("shard", "d0", "d1").join(nodes.select("d0", "d1", "owner", "n_children", "depth"), ["d0", "d1"])
    parts = stored(bands.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(_accumulated, PARTS_DDL), "trie-parts")
    own = parts.where("kind = 'band'")
    # sums of all bands after a band, for conversations with more than one
    from_here = Window.partitionBy("conv_id").orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, 0)
    later = own.where("band > 0").select("conv_id", (F.col("band") - 1).alias("band"), F.sum("saved").over(from_here).alias("saved"),
                                         F.sum("leaves").over(from_here).alias("leaves")).where("saved > 0 or leaves > 0")
    shares = bands.join(later, ["conv_id", "band"]).mapInArrow(_shares, "d0 long, d1 long, saved long, leaves long")
    sums = parts.where("kind = 'node'").select("d0", "d1", "saved", "leaves", "parent_conv_id").unionByName(
        shares.withColumn("parent_conv_id", F.lit(None).cast("long")))
    sums = sums.groupBy("d0", "d1").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"),
                                        F.max("parent_conv_id").alias("parent_conv_id"))
    last = own.groupBy("conv_id").agg(F.max_by(F.struct("d0", "d1"), "band").alias("end")).select("conv_id", "end.d0", "end.d1")
    texts = last.groupBy("d0", "d1", F.floor(F.col("conv_id") / ID_RANGE).alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    ends = texts.repartition("d0", "d1").sortWithinPartitions("d0", "d1", "part").mapInArrow(_streamed, "d0 long, d1 long, ends_sha256 string")
    out = nodes.join(sums, ["d0", "d1"]).join(ends, ["d0", "d1"], "left")
    return out.select(F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
