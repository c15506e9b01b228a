"""Mixing sources to target weights, in blocks of words, with DataFrame functions only.

1. *Targets.* A source's target is its weight's share of ``budget`` times all words, at most ``max_repeats`` times its own; what is
   above is shared again by weight among the others until none is above. That is a water level: sources in the order of
   limit by weight are full as long as the level of the rest reaches them.
2. *Blocks.* The documents of a source, by id, form one stream of words (running sums in two levels), cut into blocks of
   ``BLOCK_WORDS`` (the last one may be shorter).
3. *Draws.* The mix is ``SHARD_SLOTS`` slots to an output shard. Each slot draws a source by the sources' shares, so a shard's
   counts are multinomial; running sums of the counts number a source's slots over all shards. As draws scatter, slots beyond a
   source's number are handed to the sources left short, one for one, so every source takes its target to the word.
4. *Permutation.* Slot ``j`` of a source takes block ``p(j mod blocks)`` of pass ``j div blocks``, where p is a swap-or-not shuffle
   keyed by source and pass: a bijection computed for each slot alone. The last slot's block is cut short where the target ends.
5. *Join.* Blocks meet the parts of documents by (source, block).

Draws and permutations are hashes of a seed and positions, so reruns agree on any cluster and partitioning.

Skew. A source with a third of all rows is split by ranges of ids in the running sums, and by blocks in the join. Rows equal in
source, id and text are counted before they are dealt, and laid out in groups of ``COPIES``.

Defined cases. NULL text has size 0; documents of size 0 are in the result and take nothing. NULL sources are one source, the last.
NULL ids come first in their source. Every row is a document, repeated rows too. Sources whose documents have no words have target
0. A table without words, or an empty one, takes nothing. Long texts lie in many blocks. Columns beside ``doc_id``, ``source`` and
``text`` aren't read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantscope.llm.common import null_safe, stored
from grantscope.operators.joins import bounded_broadcast
from grantscope.operators.ranking import ranked
from grantscope.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 512
SHARD_SLOTS = 4096
#: Equal rows laid out together, rounds of the shuffle, and draws that a bin of the draws' look-up takes on average.
COPIES = 1000
ROUNDS = 40
BIN = 4096
SEED = 20_011


def _hash(*parts) -> Column:
    return F.xxhash64(F.lit(SEED), *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def permuted(index: Column, n: Column, *key: Column, inverse: bool = False) -> Column:
    """Where a keyed bijection of 0..n-1 (swap-or-not, ``ROUNDS`` rounds) puts ``index``; ``inverse``: what it puts there."""
    def swap(at: Column, turn: Column) -> Column:
        partner = F.pmod(F.pmod(_hash("pivot", turn, *key), n) - at, n)
        return F.when(F.pmod(_hash("swap", turn, F.greatest(at, partner), *key), F.lit(2)) == 0, partner).otherwise(at)

    turns = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(turns, index, swap)


def _ranked(df: DataFrame, order: list[Column], name: str, **kw) -> DataFrame:
    return ranked(df, order, shared_dir(df.sparkSession, "llm", f"mix-{name}"), **kw)


def lay_out(docs: DataFrame) -> DataFrame:
    """Groups of equal rows (``copies`` rows of ``size`` words) with the ``start`` of each in the stream of all words, by source."""
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    groups = rows.groupBy("source", "doc_id", "size", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    groups = groups.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / COPIES))))
    groups = groups.withColumn("copies", F.least(F.lit(COPIES).cast("long"), F.col("rows") - F.col("part") * COPIES)).drop("rows")
    groups = groups.withColumn("words", F.col("size") * F.col("copies"))
    order = [F.col("source").asc_nulls_last(), F.col("doc_id").asc_nulls_first(), *map(F.col, ("size", "text_hash", "part"))]
    return _ranked(groups, order, "rows", sums={"start": "words"}).withColumn("start", F.col("start") - F.col("words"))


def source_targets(layout: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per source (numbered by code point as ``sid``): size, start of its stream, weight, target, and the words to take."""
    sizes = layout.groupBy("source").agg(F.sum("words").alias("source_size"), F.min("start").alias("base"))
    sources = _ranked(sizes, [F.col("source").asc_nulls_last()], "sources", rank="sid")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeats)
    full_order = _ranked(sources, [(F.col("cap") / F.col("weight")).asc(), F.col("sid").asc()], "levels",
                         sums={"caps": "cap", "weights": "weight"})
    words, all_weights = full_order.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    rest = F.lit(budget * words) - (F.col("caps") - F.col("cap"))
    rest_weights = F.lit(all_weights) - (F.col("weights") - F.col("weight"))
    level = full_order.select("*", rest.alias("rest"), rest_weights.alias("rest_weights"))
    level = level.withColumn("full", F.col("cap") * F.col("rest_weights") <= F.col("rest") * F.col("weight"))
    # the rest and its weights at the first source that isn't full: one row
    found = level.where(~F.col("full")).agg(F.min_by(F.struct("rest", "rest_weights"), "rank")).first()[0]
    open_target = F.col("weight") * F.lit(found["rest"]) / F.lit(found["rest_weights"]) if found else F.col("cap").cast("double")
    targets = level.withColumn("target", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(open_target))
    quota = F.least(F.col("cap"), F.bround("target", 0).cast("long"))
    return stored(targets.select("source", "sid", "source_size", "base", "weight", "target", quota.alias("quota")), "mix-targets")


def with_slots(targets: DataFrame) -> DataFrame:
    """Sources that take words, with their ``blocks``, the length of the last one (``short``), ``slots``, the words by which the
    last slot is ``trim``-med, and the start ``drawn_from`` of their range among all slots."""
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS)
    t = targets.where("quota > 0").withColumn("blocks", blocks)
    t = t.withColumn("short", F.col("source_size") - (F.col("blocks") - 1) * BLOCK_WORDS)
    t = t.withColumn("passes", F.floor(F.col("quota") / F.col("source_size")))
    t = t.withColumn("rest", F.col("quota") - F.col("passes") * F.col("source_size"))
    # where the short block stands in the last pass decides how many of its slots hold the rest
    t = t.withColumn("short_at", permuted(F.col("blocks") - 1, F.col("blocks"), F.col("sid"), F.col("passes"), inverse=True))
    t = t.withColumn("last", F.ceil(F.col("rest") / BLOCK_WORDS))
    lacks = F.lit(BLOCK_WORDS) - F.col("short")
    has_short = F.col("short_at") < F.col("last")
    t = t.withColumn("trim", F.when(has_short, lacks).otherwise(F.lit(0).cast("long")))
    t = t.withColumn("last", F.when(has_short, F.ceil((F.col("rest") + lacks) / BLOCK_WORDS)).otherwise(F.col("last")))
    t = t.withColumn("trim", F.col("last") * BLOCK_WORDS - F.col("trim") - F.col("rest"))
    t = t.withColumn("slots", F.col("passes") * F.col("blocks") + F.col("last"))
    t = _ranked(t, [F.col("sid").asc()], "slots", rank="_order", sums={"drawn_from": "slots"})
    return stored(t.select("sid", "blocks", "short", "slots", "trim", (F.col("drawn_from") - F.col("slots")).alias("drawn_from")), "mix-sources")


def draw_counts(sources: DataFrame, slots: int) -> DataFrame:
    """Multinomial counts ``n`` per output shard and source. A draw is a position in the sources' ranges of slots, found by bins."""
    spark = sources.sparkSession
    ranges = sources.select("sid", "drawn_from", F.explode(F.sequence(
        F.floor(F.col("drawn_from") / BIN), F.floor((F.col("drawn_from") + F.col("slots") - 1) / BIN))).alias("bin"))
    ranges = ranges.select("bin", F.greatest(F.col("drawn_from"), F.col("bin") * BIN).alias("at"), "sid", F.lit(None).cast("long").alias("shard"))
    draws = spark.range(slots).select(F.pmod(_hash("draw", F.col("id")), F.lit(slots)).alias("at"),
                                      F.floor(F.col("id") / SHARD_SLOTS).alias("shard"))
    draws = draws.select(F.floor(F.col("at") / BIN).alias("bin"), "at", F.lit(None).cast("long").alias("sid"), "shard")
    upto = Window.partitionBy("bin").orderBy("at", F.col("shard").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    drawn = ranges.unionByName(draws).select("shard", F.last("sid", ignorenulls=True).over(upto).alias("sid")).where("shard is not null")
    return drawn.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n"))


def _each(n: Column) -> Column:
    """0..n-1, one row each; no row for 0."""
    return F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)))


def deal_slots(sources: DataFrame) -> DataFrame:
    """Every slot of the mix: output ``shard``, source, the block it takes, and the words of it (``take``)."""
    slots = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    counts = _ranked(draw_counts(sources, slots), [F.col("sid").asc(), F.col("shard").asc()], "draws", sums={"upto": "n"})
    drawn = counts.groupBy("sid").agg(F.sum("n").alias("drawn"), F.min(F.col("upto") - F.col("n")).alias("from"))
    sources = stored(sources.join(drawn, "sid", "left").na.fill(0, ["drawn", "from"]), "mix-drawn")
    own = bounded_broadcast(sources.select("sid", "slots", "from"))
    counts = counts.join(own, "sid").withColumn("first", F.col("upto") - F.col("n") - F.col("from"))
    counts = counts.withColumn("kept", F.greatest(F.lit(0).cast("long"), F.least(F.col("n"), F.col("slots") - F.col("first"))))
    kept = counts.select("shard", "sid", "first", _each(F.col("kept")).alias("k")).select("shard", "sid", (F.col("first") + F.col("k")).alias("j"))
    # slots beyond a source's number, and the numbers of the sources left short, one for one
    freed = counts.where("n > kept").select("shard", "sid", (F.col("n") - F.col("kept")).alias("freed"))
    freed = _ranked(freed, [F.col("shard").asc(), F.col("sid").asc()], "freed", sums={"q": "freed"})
    freed = freed.select("shard", "q", "freed", _each(F.col("freed")).alias("k")).select("shard", (F.col("q") - F.col("freed") + F.col("k")).alias("q"))
    lacking = sources.where("slots > drawn").select("sid", "drawn", (F.col("slots") - F.col("drawn")).alias("lacks"))
    lacking = _ranked(lacking, [F.col("sid").asc()], "lacking", sums={"q": "lacks"})
    lacking = lacking.select("sid", "drawn", "q", "lacks", _each(F.col("lacks")).alias("k"))
    lacking = lacking.select("sid", (F.col("drawn") + F.col("k")).alias("j"), (F.col("q") - F.col("lacks") + F.col("k")).alias("q"))
    dealt = kept.unionByName(freed.join(lacking, "q").select("shard", "sid", "j"))
    dealt = dealt.join(bounded_broadcast(sources.select("sid", "blocks", "short", "slots", "trim")), "sid")
    block = permuted(F.pmod("j", "blocks"), F.col("blocks"), F.col("sid"), F.floor(F.col("j") / F.col("blocks")))
    dealt = dealt.withColumn("block", block)
    length = F.when(F.col("block") == F.col("blocks") - 1, F.col("short")).otherwise(F.lit(BLOCK_WORDS).cast("long"))
    trim = F.when(F.col("j") == F.col("slots") - 1, F.col("trim")).otherwise(F.lit(0).cast("long"))
    return dealt.select("shard", "sid", "j", "block", (length - trim).alias("take"))


def _same_source(groups: DataFrame, targets: DataFrame, *columns: str) -> DataFrame:
    t = targets.select(F.col("source").alias("_source"), "sid", *columns)
    return groups.join(bounded_broadcast(t), null_safe(groups, t, [("source", "_source")])).drop("_source")


def document_parts(layout: DataFrame, targets: DataFrame) -> DataFrame:
    """The parts of documents in blocks: words ``lo`` (from 0) to ``hi`` of block ``block``; ``at`` is the document's place."""
    rows = _same_source(layout.where("size > 0"), targets, "base").select("*", _each(F.col("copies")).alias("copy"))
    rows = rows.withColumn("at", F.col("start") - F.col("base") + F.col("copy") * F.col("size"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / BLOCK_WORDS), F.floor((F.col("at") + F.col("size") - 1) / BLOCK_WORDS))))
    begin = F.col("block") * BLOCK_WORDS
    return rows.select("sid", "block", "at", "doc_id", "size", "text_hash", F.greatest(F.col("at") - begin, F.lit(0).cast("long")).alias("lo"),
                       F.least(F.col("at") + F.col("size") - begin, F.lit(BLOCK_WORDS).cast("long")).alias("hi"))


def plan(docs: DataFrame, **rule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The layout of the documents, the sources' targets, and the slots of the mix. ``rule``: see ``source_targets``."""
    layout = lay_out(docs)
    targets = source_targets(layout, **rule)
    return layout, targets, deal_slots(with_slots(targets))


def mix_documents(docs: DataFrame, **rule) -> DataFrame:
    """Per document: its size, its source's size and target, and the words of it that the mix takes (``taken``)."""
    layout, targets, slots = plan(docs, **rule)
    parts = document_parts(layout, targets)
    take = F.coalesce("take", F.lit(0).cast("long"))  # a block that no slot takes
    used = F.greatest(F.lit(0).cast("long"), F.least(F.col("hi"), take) - F.col("lo"))
    taken = parts.join(slots.select("sid", "block", "take"), ["sid", "block"], "left").groupBy("sid", "at", "doc_id", "size").agg(
        F.sum(used).alias("taken"))
    empty = _same_source(layout.where("size = 0").select("source", "doc_id", "size", "copies"), targets)
    empty = empty.select("sid", F.lit(0).cast("long").alias("at"), "doc_id", "size", F.lit(0).cast("long").alias("taken"), _each(F.col("copies")))
    both = taken.unionByName(empty.drop("col"))
    info = targets.select("sid", "source_size", "target")
    return both.join(bounded_broadcast(info), "sid").select("doc_id", "size", "source_size", "target", "taken")


def mixed_blocks(docs: DataFrame, **rule) -> DataFrame:
    """The mix itself: ``shard``, ``slot`` in it, the source, the documents whose words the block holds, and its ``text`` (words joined
    by spaces)."""
    layout, targets, slots = plan(docs, **rule)
    parts = document_parts(layout, targets).join(slots, ["sid", "block"]).where("take > lo")
    texts = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("t_id"),
                        F.xxhash64("text").alias("t_hash"), F.regexp_extract_all("text", F.lit(WORD), 0).alias("all_words"))
    texts = _same_source(texts.where("text is not null").dropDuplicates(["source", "t_id", "t_hash"]), targets).withColumnRenamed("sid", "t_sid")
    pairs = parts.join(texts, null_safe(parts, texts, [("sid", "t_sid"), ("doc_id", "t_id"), ("text_hash", "t_hash")]))
    first = F.col("block") * BLOCK_WORDS + F.col("lo") - F.col("at")
    words = F.slice("all_words", (first + 1).cast("int"), (F.least(F.col("hi"), F.col("take")) - F.col("lo")).cast("int"))
    part = F.struct("lo", "doc_id", F.array_join(words, " ").alias("text"))
    blocks = pairs.groupBy("shard", "sid", "j").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    place = F.row_number().over(Window.partitionBy("shard").orderBy(_hash("slot", F.col("sid"), F.col("j")), "sid", "j"))
    named = blocks.join(bounded_broadcast(targets.select("sid", "source")), "sid")
    return named.select("shard", place.cast("long").alias("slot"), "source", F.col("parts.doc_id").alias("doc_ids"),
                        F.array_join("parts.text", " ").alias("text"))
