"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow string column.

A word is a run of bytes outside 0x20 and 0x09-0x0D. Words and word sequences are compared by 64-bit polynomial hashes
(mod 2**64, odd base, random byte values, bits mixed afterwards); where equality decides a result, hashes of two bases are used
together. Such hashes tell apart sequences of up to some hundred values; from 1,024 on there are pairs that no base tells apart,
so longer words are hashed otherwise, and longer sequences must be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text that are hashed at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: Longer words have a hash of their own.
LONG_WORD = 256
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUE = np.random.Generator(np.random.PCG64(20)).integers(0, 2**64, 256, dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i below n at least."""
    if base not in _powers or len(_powers[base][0]) < n:
        n = max(n, BLOCK_BYTES + 1)
        tables = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(n, b, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        if n > 4 * BLOCK_BYTES:  # one very long text must not leave its tables behind
            return tables[0], tables[1]
        _powers[base] = (tables[0], tables[1])
    return _powers[base]


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for each pair."""
    up, down = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start])


class Block:
    """Words of some texts: word w of text d is the bytes[start[k]:end[k]] with k = first[d] + w."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, row: int, lower: bool = False):
        self.row, self.n = row, len(bounds) - 1
        if lower:
            data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
        self.data, self.bounds = data, bounds
        inside = ~_SPACE[data]
        fresh = np.ones(len(data) + 1, dtype=bool)
        np.logical_not(inside, out=fresh[1:])
        fresh[bounds] = True  # before a byte: a word can only begin here
        self.start = np.flatnonzero(inside & fresh[:-1])
        self.end = np.flatnonzero(inside & fresh_after(inside, bounds)) + 1
        self.first = np.searchsorted(self.start, bounds)

    @property
    def words(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64 bits of each word."""
        found = spans_hash(_BYTE_VALUE[self.data], self.start, self.end, BASES[0])
        for k in np.flatnonzero(self.end - self.start > LONG_WORD).tolist():
            found[k] = xxhash.xxh3_64_intdigest(np.ascontiguousarray(self.data[self.start[k] : self.end[k]]))
        return found

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Text of the block and first word of every window of so many words."""
        per_text = np.maximum(self.words - size + 1, 0)
        text = np.repeat(np.arange(self.n), per_text)
        before = np.cumsum(per_text) - per_text
        return text, np.arange(len(text)) - np.repeat(before - self.first[:-1], per_text)


def fresh_after(inside: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the byte behind is no part of the same word."""
    last = np.ones(len(inside) + 1, dtype=bool)
    np.logical_not(inside[1:], out=last[: max(len(inside) - 1, 0)])
    last[bounds[1:] - 1] = True  # -1, for empty texts in front, is the spare entry
    return last[: len(inside)]


def blocks(column: pa.Array, lower: bool = False) -> Iterator[Block]:
    """The texts of an Arrow string column, in blocks of about BLOCK_BYTES; null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK_BYTES, side="right")) - 1)
        yield Block(data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at], at, lower)
        at = to
