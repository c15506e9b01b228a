"""Quality rules: per-document counts and cross-document line frequency per host.

Base rules look at one document: too few words, or too many words that stand in repeated 3-word windows. The
line rule looks across documents: normalised lines are hashed, the documents of a host that hold a line are
counted, lines held by more than the limit are taken out of all of them but the one with the smallest id (so
no content is lost altogether), and a document that loses more than half of its words is rejected as depleted.

Defined cases. A NULL text is empty; NULL hosts form one host. Every row is judged, repeated rows too, and rows that are equal in
id, host and text get the same verdict. Documents are counted by their ids: rows that share an id count once, rows without one don't
count and are never the holder that keeps a line, but lose it like others. An empty table gives an empty result. Extra columns are carried by ``apply_rules`` unread.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantscope.llm.common import null_safe, other_columns, stored, text_slices, with_text

#: Characters that count as white space, and as symbols (fixed by the contract of the counts).
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules. A line is boilerplate of a host in more than ``max_documents`` documents of it, whatever the host's
    size, or in ``min_documents`` that are more than ``max_share`` of a small host."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_documents: int = 20
    min_documents: int = 5
    max_share: float = 0.5
    max_removed_share: float = 0.5


STATS = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("text_hash", pa.int64()),
                   ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                   ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
                   ("line_keys", pa.list_(pa.binary())), ("line_words", pa.list_(pa.int64()))])
STATS_DDL = ("doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, "
             "n_dup_lines long, n_repeat_words long, line_keys array<binary>, line_words array<long>")


def line_key(words: list[bytes]) -> bytes:
    """128-bit hash of a normalised line: words in lower case (A-Z), one space between."""
    return xxhash.xxh3_128_digest(b" ".join(words).lower())


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more in the document."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, upto = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def document_stats(text: str) -> tuple[int, int, int, int, int, dict[bytes, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; words by line key."""
    raw, lines, seen, dups = text.encode(), Counter(), set(), 0
    words: list[bytes] = []
    for line in raw.split(b"\n"):
        if own := line.split():
            dups += line in seen
            seen.add(line)
            lines[line_key(own)] += len(own)
            words += own
    spaces = sum(text.count(c) for c in SPACES)
    return len(words), len(text) - spaces, sum(text.count(c) for c in SYMBOLS), dups, repeat_words(words), lines


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches):
        found = [document_stats(t or "") for t in part.column("text").to_pylist()]
        counts = list(zip(*(f[:5] for f in found)))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("host"), part.column("text_hash"),
             *(pa.array(c, pa.int64()) for c in counts),
             pa.array([list(f[5]) for f in found], STATS.field("line_keys").type),
             pa.array([list(f[5].values()) for f in found], STATS.field("line_words").type)], schema=STATS)


def _keyed(docs: DataFrame, host_col: str) -> list:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
            F.xxhash64(text).alias("text_hash"), text.alias("text")]


def line_verdicts(docs: DataFrame, host_col: str = "source", rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: the counts, the line keys to remove (``drop_keys``), ``base_failed`` and ``kept``.

    One pass over the texts writes the counts and the line hashes; the rest reads only those. Lines are counted
    with map-side combine; the frequent ones join back to the documents' lines (a skewed line is split by AQE).
    """
    stats = stored(docs.select(*_keyed(docs, host_col)).mapInArrow(_stats, STATS_DDL), "quality-stats")
    lines = stats.select("doc_id", "host", "text_hash", F.explode(F.arrays_zip("line_keys", "line_words")).alias("l"))
    lines = lines.select("doc_id", "host", "text_hash", F.col("l.line_keys").alias("key"), F.col("l.line_words").alias("words"))
    hosts = stats.groupBy(F.col("host").alias("h_host")).agg(F.count_distinct("doc_id").alias("host_docs"))
    heavy = (lines.groupBy(F.col("host").alias("k_host"), F.col("key").alias("k_key"))
             .agg(F.count_distinct("doc_id").alias("held_by"), F.min("doc_id").alias("holder"))
             .where(F.col("held_by") >= min(rules.min_documents, rules.max_documents + 1)))
    heavy = heavy.join(hosts, null_safe(heavy, hosts, [("k_host", "h_host")]))
    common = (F.col("held_by") >= rules.min_documents) & (F.col("held_by") > F.col("host_docs") * rules.max_share)
    heavy = heavy.where((F.col("held_by") > rules.max_documents) | common).select("k_host", "k_key", "holder")
    hits = lines.join(heavy, null_safe(lines, heavy, [("host", "k_host"), ("key", "k_key")]))
    hits = hits.where(~F.col("doc_id").eqNullSafe(F.col("holder")))
    drops = (hits.groupBy(F.col("doc_id").alias("d_id"), F.col("host").alias("d_host"), F.col("text_hash").alias("d_hash"))
             .agg(F.collect_set(F.struct("key", "words")).alias("drops")))
    out = stats.join(drops, null_safe(stats, drops, [("doc_id", "d_id"), ("host", "d_host"), ("text_hash", "d_hash")]), "left")
    removed = F.coalesce(F.aggregate("drops", F.lit(0).cast("long"), lambda a, d: a + d["words"]), F.lit(0).cast("long"))
    base = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    return out.select(
        "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), removed.alias("n_removed_words"),
        (~base & (removed <= F.col("n_words") * rules.max_removed_share)).alias("kept"),
        F.coalesce(F.col("drops")["key"], F.array().cast("array<binary>")).alias("drop_keys"))


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches, "clean"):
        texts, keys = part.column("clean").to_pylist(), part.column("drop_keys").to_pylist()
        out = [t if not k else strip_lines(t, set(k)) for t, k in zip(texts, keys)]
        at = part.schema.get_field_index("clean")
        yield part.set_column(at, part.schema.field(at), pa.array(out, part.schema.field(at).type))


def strip_lines(text: str, drop: set[bytes]) -> str:
    """``text`` without its lines whose key is in ``drop``; blank lines stay."""
    return "\n".join(x for x in text.split("\n") if not ((own := x.encode().split()) and line_key(own) in drop))


def apply_rules(docs: DataFrame, host_col: str = "source", rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, with all their columns, their host's boilerplate lines removed."""
    verdicts = line_verdicts(docs, host_col, rules).where("kept")
    verdicts = verdicts.select(F.col("doc_id").alias("v_id"), F.col("host").alias("v_host"),
                               F.col("text_hash").alias("v_hash"), "drop_keys").dropDuplicates(["v_id", "v_host", "v_hash"])
    rows = docs.select(*_keyed(docs, host_col), other_columns(docs))
    rows = rows.withColumnRenamed("text", "clean")
    joined = rows.join(verdicts, null_safe(rows, verdicts, [("doc_id", "v_id"), ("host", "v_host"), ("text_hash", "v_hash")]))
    joined = joined.select("row", "clean", "drop_keys")
    done = joined.mapInArrow(_without_lines, joined.schema)
    # A text that was NULL has no words and is rejected above, so "clean" stands for every kept text.
    return done.select(*with_text(docs, "clean"))
