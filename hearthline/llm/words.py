"""Words of a batch of texts as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D, the pattern
``[^\\x20\\x09-\\x0D]+``.  All functions work on one Arrow batch; a null text has
no words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# An odd multiplier with mixed bits (2^64 divided by the golden ratio).
STEP = np.uint64(0x9E3779B97F4A7C15)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each text begins (one entry more than texts)."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary()).fill_null(b"")
    else:
        column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    begin = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    content = np.frombuffer(data, np.uint8)[begin[0] : begin[-1]] if data is not None and begin[-1] > begin[0] else np.zeros(0, np.uint8)
    return content, begin - begin[0]


def slices(content: np.ndarray, lengths: np.ndarray) -> pa.LargeBinaryArray:
    """Consecutive slices of the given lengths as an Arrow array, without copying."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(content))]
    )


@dataclass
class Words:
    """Words of a batch: their byte ranges, and the first word of each text."""

    content: np.ndarray
    begin: np.ndarray  # of each text in content
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text in starts; one entry more than texts

    @classmethod
    def of(cls, column: pa.Array) -> Words:
        return cls.parted(*text_bytes(column), SPACE)

    @classmethod
    def parted(cls, content: np.ndarray, begin: np.ndarray, apart: np.ndarray) -> Words:
        """The words of texts that ``apart`` marks the bytes between them of."""
        solid = ~apart[content]
        opening, closing = solid.copy(), solid.copy()
        opening[1:] &= ~solid[:-1]
        closing[:-1] &= ~solid[1:]
        borders = begin[1:-1]
        inner = borders[(borders > 0) & (borders < len(content))]
        opening[inner] = solid[inner]
        closing[inner - 1] = solid[inner - 1]
        starts = np.flatnonzero(opening)
        return cls(content, begin, starts, np.flatnonzero(closing) + 1, np.searchsorted(starts, begin))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def coded(self, apart: np.ndarray = SPACE) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, equal for equal words, and the distinct words."""
        solid = self.content[~apart[self.content]]
        found = slices(solid, self.ends - self.starts).dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False), found.dictionary

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        codes, distinct = self.coded()
        one = xxhash.xxh64_intdigest
        table = np.fromiter((one(w, seed) for w in distinct.to_pylist()), np.uint64, len(distinct))
        return table[codes] if len(codes) else np.zeros(0, np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """The values with their bits spread, so that low and high bits depend on all of them."""
    out = values ^ (values >> np.uint64(32))
    out *= STEP
    out ^= out >> np.uint64(29)
    out *= STEP
    return out ^ (out >> np.uint64(32))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each word on; shorter than the input by size - 1."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, size):
        total *= STEP
        total += hashes[k : k + n]
    return mixed(total)


def fits(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """For each of the first n words, whether ``size`` words from it on are in its text."""
    ends = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + size <= ends


def lowest_of(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, where its smallest is; the leftmost of equal ones."""
    at, have = np.arange(len(values)), 1
    while have < width and len(at):
        step = min(have, width - have)
        left, right = at[:-step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        have += step
    return at
