"""One query for each training-data operator, on its whole table with production parameters, and its SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantscope.llm import alignment, ann, byte_bpe, katz, licenses, line_dedup, mixing, packing, prefix_trie, quality, secrets, simhash, token_counts

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["rank"] == secrets.KINDS.index(kind))).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in secrets.KINDS[:secrets.BASE]),
                        F.sha2(secrets.described("base"), 256).alias("base_sha256"), secrets.described("spans").alias("spans"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.line_verdicts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                        "n_removed_words")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("clean", 256).alias("kept_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_RANKS)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(table(spark, sf_dir, "conversations"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_MODEL)


QUERIES = {f.__name__: f for f in (
    op1_katz_backoff, op2_secret_scans, op3_nearest_neighbours, op4_simhash_near_dedup, op5_license_scans, op6_quality_rules,
    op7_packing, op8_line_dedup, op9_byte_bpe, op10_token_counts, op11_prefix_trie, op12_mixing, op13_alignment)}

# White space and A-Z as the contracts have them, in DuckDB's terms.
_SPACES = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"


def _lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# every row is judged on its own (r), while documents are counted by id
_LINES = """docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs)"""

_RULES = quality.LineRules()

ORACLE: dict[str, str] = {
    "op6_quality_rules": f"""WITH {_LINES},
words AS (SELECT r, unnest(regexp_extract_all(text, '{_WORD}')) AS w,
  generate_subscripts(regexp_extract_all(text, '{_WORD}'), 1) AS i FROM docs),
windows AS (SELECT r, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS n FROM windows WHERE w3 IS NOT NULL),
repeats AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n > 1) GROUP BY r),
keyed AS (SELECT r, doc_id, source, line, len(regexp_extract_all(line, '{_WORD}')) AS n,
  {_lower(f"array_to_string(regexp_extract_all(line, '{_WORD}'), ' ')")} AS key FROM lines),
hosts AS (SELECT source, count(DISTINCT doc_id) AS docs FROM docs GROUP BY source),
heavy AS (SELECT k.source, k.key, min(k.doc_id) AS holder FROM keyed k JOIN hosts h ON k.source IS NOT DISTINCT FROM h.source WHERE k.n > 0
  GROUP BY k.source, k.key HAVING count(DISTINCT k.doc_id) > {_RULES.max_documents}
  OR (count(DISTINCT k.doc_id) >= {_RULES.min_documents} AND count(DISTINCT k.doc_id) > {_RULES.max_share} * any_value(h.docs))),
removed AS (SELECT k.r, sum(k.n) AS n FROM keyed k JOIN heavy h ON k.key = h.key AND k.source IS NOT DISTINCT FROM h.source
  WHERE k.doc_id IS DISTINCT FROM h.holder GROUP BY k.r),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM keyed WHERE n > 0 GROUP BY r),
base AS (SELECT d.doc_id, CAST(len(regexp_extract_all(text, '{_WORD}')) AS BIGINT) AS n_words,
  length(regexp_replace(text, '{_SPACES}', '', 'g')) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(u.n, 0) AS n_dup_lines,
  coalesce(p.n, 0) AS n_repeat_words, CAST(coalesce(x.n, 0) AS BIGINT) AS n_removed_words
  FROM docs d LEFT JOIN dups u ON d.r = u.r LEFT JOIN repeats p ON d.r = p.r LEFT JOIN removed x ON d.r = x.r),
judged AS (SELECT *, n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND n_removed_words <= n_words * {_RULES.max_removed_share} AS kept FROM judged""",
    "op8_line_dedup": f"""WITH {_LINES},
keyed AS (SELECT *, {_lower(f"regexp_replace(line, '^{_SPACES}+|{_SPACES}+$', '', 'g')")} AS key FROM lines),
held AS (SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT k.*, h.key IS NOT NULL AND k.doc_id IS DISTINCT FROM h.holder AS gone FROM keyed k LEFT JOIN held h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM judged GROUP BY r, doc_id""",
}
