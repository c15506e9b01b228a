"""Token counts with a whole-token shortcut, for a sentencepiece BPE model.

No piece of such a model crosses from another character to a space mark, so merges never do: each word, with the mark
before it, is encoded on its own. Before any text is read, every piece that starts with a single mark is encoded
alone; those that come back as that one piece are proven, and a word among them counts one token without any merge.
Only the distinct other words are merged, by the library, and the counts are summed per document.

Defined cases. NULL text is empty and has no token. Texts with a space beside a space or at an end are encoded
whole by the library. Every row is counted, repeated rows too; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantscope.llm.common import text_slices
from grantscope.llm.units import UnitCache, distinct_units

#: The library's space mark; in a text it means the same as a space.
MARK = "▁"
UNSAFE = "  |▁ |^ | $"


class TokenCounter:
    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size()) if not self.model.is_control(i)]
        crossing = [p for p in pieces if MARK in p.lstrip(MARK)]
        if crossing or self.model.encode("a", out_type=str)[0][0] != MARK:
            raise ValueError("words aren't independent in this model: a piece goes on past a space, or no mark is put first")
        words = [p[1:] for p in pieces if p[0] == MARK and len(p) > 1 and p[1] != MARK]
        self.whole = {w for w, ids in zip(words, self.model.encode(words, out_type=str, num_threads=1)) if ids == [MARK + w]}
        self.counts = UnitCache(self._merge)

    def _merge(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, out_type=int, num_threads=1)] if texts else []

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        offsets, index, words, others = distinct_units(texts, UNSAFE)
        words += others  # the library puts a mark before a text, so a word alone stands for the word after a space
        rest = [w for w in words if w not in self.whole]
        merged = dict(zip(rest, self.counts(rest)))
        each = np.fromiter((merged.get(w, 1) for w in words), np.int64, len(words))
        return np.add.reduceat(each[index], offsets[:-1]) if len(offsets) > 1 else np.zeros(0, np.int64)


@functools.lru_cache(maxsize=2)
def token_counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def _counted(path: str):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(path)
        for part in text_slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(counter.count(part.column("text")))],
                                             ["doc_id", "n_bytes", "n_tokens"])

    return counted


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """Per document: bytes (UTF-8), tokens, and whether the tokens are over ``limit``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counts = rows.mapInArrow(_counted(path), "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
