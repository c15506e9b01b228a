"""Texts as lists of units that a byte-pair encoder treats independently, encoded once per distinct unit.

A text is cut before single spaces, so a unit is a word with the space before it. Arrow finds the distinct
units of a slice of texts; each is encoded once (and kept in a bounded cache of the Python worker), and the
texts' results are gathered from the units' by index. Where a cut before a space isn't proven independent (a
space beside other white space, for instance), the caller's pattern says so, and the whole text is one unit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units in each of the two generations of a worker's cache (this bounds memory only), and units encoded at a time.
GENERATION = 150_000
ENCODED_AT_A_TIME = 16_384


class UnitCache:
    """Encodes distinct units once. ``encode`` takes a list of strings and gives one value (not None) for each.

    Two generations: when the young one is full it becomes the old one, and what is used again moves up.
    """

    def __init__(self, encode: Callable[[list[str]], Sequence], generation: int | None = None):
        self.encode, self.young, self.old, self.generation = encode, {}, {}, generation

    def __call__(self, units: list[str]) -> list:
        values = list(map(self.young.get, units))
        missing = [i for i, v in enumerate(values) if v is None]
        names = [units[i] for i in missing]
        found = list(map(self.old.get, names))
        new = [j for j, v in enumerate(found) if v is None]
        for at in range(0, len(new), ENCODED_AT_A_TIME):
            part = new[at:at + ENCODED_AT_A_TIME]
            for j, v in zip(part, self.encode([names[j] for j in part])):
                found[j] = v
        generation = self.generation or GENERATION
        if len(self.young) + len(names) > generation:
            self.old, self.young = self.young, {}
        self.young.update(zip(names[:generation], found))
        for i, v in zip(missing, found):
            values[i] = v
        return values


def distinct_units(texts: pa.Array, unsafe: str) -> tuple[np.ndarray, np.ndarray, list[str], list[str]]:
    """Offsets of each text in the units, the index of each unit, and the distinct units: words that a space goes
    before (without that space), then the others: first words of texts, and whole texts that match ``unsafe``.
    """
    whole = pc.match_substring_regex(texts, unsafe)
    parts = pc.split_pattern(pc.if_else(whole, "", texts), " ")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    flat = parts.flatten().dictionary_encode()
    index = flat.indices.to_numpy().astype(np.int64)
    plain = flat.dictionary.to_pylist()
    heads, at = np.unique(index[offsets[:-1]], return_inverse=True)
    index[offsets[:-1]] = len(plain) + at
    others = [plain[i] for i in heads.tolist()]
    for row in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
        index[offsets[row]] = len(plain) + len(others)
        others.append(texts[row].as_py())
    return offsets, index, plain, others


def gather(values: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the units ``index``, one after another, and the offset of each unit in them (one more at the end).

    ``values``: each distinct unit's ids as little-endian unsigned 32-bit integers.
    """
    flat = np.frombuffer(b"".join(values), np.uint32)
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    starts = np.cumsum(sizes) - sizes
    ends = np.cumsum(sizes[index])
    ids = flat[np.repeat(starts[index] - ends + sizes[index], sizes[index]) + np.arange(ends[-1] if len(ends) else 0)]
    return ids, np.concatenate([[0], ends])
