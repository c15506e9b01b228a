"""Number arrays as compressed bytes, for tables of arrays that travel between Spark stages.

The byte planes of an array (its lowest bytes, its next bytes, ...) are compressed apart, each by its own statistics: most numbers
are small, so high planes are empty, and random low ones are stored as they are. ``seal`` puts several arrays in one piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def raw(values: np.ndarray) -> bytes:
    """An array of any number type: type, length, and each plane after its own length (0: all zero; negative: not compressed)."""
    out = [values.dtype.str[1:].encode(), len(values).to_bytes(8, "little")]
    for plane in np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T if len(values) else ():
        if not plane.any():
            out.append(bytes(8))
            continue
        plain = plane.tobytes()
        small = pa.compress(plain, codec="zstd", asbytes=True)
        size, body = (len(small), small) if len(small) < len(plain) else (-len(plain), plain)
        out += [size.to_bytes(8, "little", signed=True), body]
    return b"".join(out)


def unraw(data: bytes) -> np.ndarray:
    kind, n, at = np.dtype("<" + data[:2].decode()), int.from_bytes(data[2:10], "little"), 10
    planes = np.zeros((kind.itemsize, n), np.uint8)
    for i in range(kind.itemsize if n else 0):
        size = int.from_bytes(data[at:at + 8], "little", signed=True)
        body, at = data[at + 8:at + 8 + abs(size)], at + 8 + abs(size)
        if size:
            plain = pa.decompress(body, decompressed_size=n, codec="zstd", asbytes=True) if size > 0 else body
            planes[i] = np.frombuffer(plain, np.uint8)
    return planes.T.copy().view(kind).reshape(n)


def raw_rising(values: np.ndarray) -> bytes:
    """An array of whole numbers that seldom fall, by its differences (in the type's own wrapping arithmetic)."""
    return raw(np.diff(values, prepend=values.dtype.type(0)))


def unraw_rising(data: bytes) -> np.ndarray:
    steps = unraw(data)
    return np.cumsum(steps, dtype=steps.dtype)


def raw_repeating(values: np.ndarray) -> bytes:
    """An array of numbers many of which are equal: the distinct ones, frequent first, and which one stands where.

    Where most are different, the numbers as they are.
    """
    distinct, index, times = np.unique(values, return_inverse=True, return_counts=True)
    if 2 * len(distinct) > len(values):
        return bytes(8) + raw(values)
    order = np.argsort(-times, kind="stable")
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order))
    first = raw(distinct[order])
    return len(first).to_bytes(8, "little") + first + raw(place[index])


def unraw_repeating(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    return unraw(data[8:8 + n])[unraw(data[8 + n:])] if n else unraw(data[8:])


def seal(*parts: bytes) -> bytes:
    """Several packed arrays as one piece."""
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def unseal(data: bytes) -> list[bytes]:
    parts, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 8], "little")
        parts.append(data[at + 8:at + 8 + n])
        at += 8 + n
    return parts


pack, unpack = raw, unraw
