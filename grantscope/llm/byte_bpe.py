"""Byte-level BPE by a sentencepiece model that is serialised straight from a rank file.

Every byte maps to one character, every token of the rank file to the piece of its bytes' characters, scored by
its negative rank, with identity normalisation: sentencepiece then merges as rank BPE does (best rank first, then
leftmost). Pre-tokens are matches of the pattern; one whose bytes are a token is that token, as the rank
library has it. Decoding is the inverse mapping of ids to bytes.

Defined cases. NULL text is empty: no token, the hash of nothing. Any text round-trips. Every row is encoded,
repeated rows too; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantscope.llm.common import text_slices
from grantscope.llm.units import UnitCache, distinct_units, gather

#: Unicode white space. The pattern gives all of a run of it but the last character to one match, so a cut before a
#: space is proven only where no other white space stands beside that space.
WHITE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNSAFE = f" {WHITE}|{WHITE} "
#: Characters for the bytes 0 to 255: letters, which no normalisation or white-space rule touches.
FIRST_CHAR = 0x100
BYTE_CHARS = {b: FIRST_CHAR + b for b in range(256)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def byte_chars(raw: bytes) -> str:
    return raw.decode("latin-1").translate(BYTE_CHARS)


def _field(number: int, kind: int, value: bytes) -> bytes:
    """A protocol-buffer field; kind 0: varint, 2: with its length, 5: 32 bits."""
    return _varint(number << 3 | kind) + (_varint(len(value)) if kind == 2 else b"") + value


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model: piece 0 is the unknown one, piece r + 1 the token of rank r.

    Field numbers are those of the public sentencepiece model format: pieces 1 (piece 1, score 2, type 3: normal 1,
    unknown 2), trainer 2 (model type 3: BPE 2), normaliser 3 (name 1, dummy prefix 3, extra spaces 4, escaping 5).
    """
    def piece(text: str, score: float, kind: int) -> bytes:
        return _field(1, 2, _field(1, 2, text.encode()) + _field(2, 5, struct.pack("<f", score)) + _field(3, 0, _varint(kind)))

    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must count up from 0")
    pieces = [piece("<unk>", 0.0, 2), *(piece(byte_chars(t), -float(r), 1) for r, t in enumerate(tokens))]
    normaliser = _field(1, 2, b"identity") + b"".join(_field(n, 0, _varint(0)) for n in (3, 4, 5))
    return b"".join(pieces) + _field(2, 2, _field(3, 0, _varint(2))) + _field(3, 2, normaliser)


class ByteBpe:
    """Encoder and decoder over the model serialised from a rank file."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        # \s by Unicode's property: the regex module's own also takes the separators 1C to 1F.
        self.matches = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.pieces = pa.array(sorted(self.ranks, key=self.ranks.get), pa.large_binary())
        self.units, self.pretokens = UnitCache(self._encode_units), UnitCache(self._encode_pretokens)

    def _encode_pretokens(self, pretokens: list[str]) -> list[bytes]:
        raw = [p.encode() for p in pretokens]
        out = [struct.pack("<I", r) if (r := self.ranks.get(t)) is not None else None for t in raw]
        rest = [i for i, ids in enumerate(out) if ids is None]
        merged = self.model.encode([byte_chars(raw[i]) for i in rest], out_type=int, num_threads=1) if rest else []
        for i, ids in zip(rest, merged):
            out[i] = (np.array(ids, np.uint32) - 1).tobytes()
        return out

    def _encode_units(self, units: list[str]) -> list[bytes]:
        lists = [self.matches(u) for u in units]
        distinct = list({p for pretokens in lists for p in pretokens})
        ids = dict(zip(distinct, self.pretokens(distinct)))
        return [b"".join([ids[p] for p in pretokens]) for pretokens in lists]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and the offset of each text in them (one more at the end)."""
        offsets, index, words, others = distinct_units(texts, UNSAFE)
        ids, ends = gather(self.units([" " + w for w in words] + others), index)
        return ids, ends[offsets]

    def decode(self, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The bytes of all ids, and the offset of each id in them (one more at the end)."""
        out = self.pieces.take(pa.array(ids))
        _, offsets, data = out.buffers()
        return memoryview(data or b""), np.frombuffer(offsets, np.int64, len(ids) + 1, out.offset * 8)


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _coded(path: str, pattern: str):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for part in text_slices(batches):
            ids, at = bpe.encode(part.column("text"))
            data, byte_at = bpe.decode(ids)
            spans = list(zip(at[:-1].tolist(), at[1:].tolist()))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(np.diff(at)),
                pa.array([hashlib.sha256(ids[a:b]).hexdigest() for a, b in spans], pa.string()),
                pa.array([hashlib.sha256(data[byte_at[a]:byte_at[b]]).hexdigest() for a, b in spans], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return coded


def _encoded(path: str, pattern: str):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for part in text_slices(batches):
            ids, at = bpe.encode(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    return encoded


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def encode_documents(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id`` and the array ``ids`` of each document."""
    return _documents(docs).mapInArrow(_encoded(path, pattern), "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per document: the number of ids, the hash of the ids, and the hash of the bytes they decode to."""
    return _documents(docs).mapInArrow(_coded(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
