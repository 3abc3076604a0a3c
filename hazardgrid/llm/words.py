"""Words and their 64-bit hashes from Arrow text columns, vectorised per batch.

A word is a maximal run of bytes other than space and 0x09-0x0D. Texts are read
from Arrow's UTF-8 buffer without building Python strings; work arrays are made
for a bounded number of bytes at a time, however long a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once (a longer text makes a chunk alone).
CHUNK_BYTES = 1 << 20
#: Longer words are digested one by one.
LONG = 256

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_FACTORS = _RNG.integers(1, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FULL = np.uint64(2**64 - 1)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, factor in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, factor, np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers))
        return self.up, self.down


_POWERS = _Powers(_BASE)


def mix(h: np.ndarray) -> np.ndarray:
    """Murmur-style finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets of a string column; a null has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and n+1 word offsets of the rows."""
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    word = ~WHITE[data]
    before = np.empty_like(word)
    before[:1] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty_like(word)
    after[-1:] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _blocks_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded.tobytes(), strides=(1,))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each byte range: eight bytes at a time, each multiplied in and mixed.

    Hashes of two seeds are independent. A range over ``LONG`` bytes is digested by
    BLAKE2, keyed by the seed.
    """
    size = (ends - starts).astype(np.uint64)
    out = mix(size * np.uint64(_BASE) + np.uint64(seed))
    long = size > LONG
    raw = _blocks_of(data)
    rest = np.flatnonzero(~long)
    at = 0
    while len(rest):
        left = np.minimum(size[rest] - np.uint64(at), np.uint64(8))
        part = raw[starts[rest] + at] & (_FULL >> (np.uint64(64) - np.uint64(8) * left))
        out[rest] = mix((out[rest] ^ part) * _FACTORS[seed] + np.uint64(at))
        at += 8
        rest = rest[size[rest] > at]
    for k in np.flatnonzero(long).tolist():
        digest = hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8, key=b"%d" % seed).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


def digests(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit BLAKE2 digest of the words of each row, one space apart, as two longs."""
    word = ~WHITE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty_like(word)
    before[:1] = False
    before[1:] = word[:-1]
    keep = word | (before & ~edge[:-1])
    joined = np.where(word, data, np.uint8(0x20))[keep]
    bounds = np.concatenate([[0], np.cumsum(keep)])[offsets].tolist()
    raw = [joined[a:b].tobytes().rstrip(b" ") for a, b in zip(bounds[:-1], bounds[1:])]
    both = b"".join(hashlib.blake2b(r, digest_size=16).digest() for r in raw)
    pairs = np.frombuffer(both, "<i8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def rolling(h: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive values, at its first one."""
    if len(h) < width:
        return np.empty(0, np.uint64)
    up, down = _POWERS.upto(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum((h + np.uint64(seed)) * up[: len(h)], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[: len(h) + 1 - width])


def doc_windows(word_offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rolling windows over joined rows: which lie in one row, and n+1 offsets of these."""
    counts = np.diff(word_offsets)
    inside = np.maximum(counts - width + 1, 0)
    total = int(word_offsets[-1] - word_offsets[0])
    keep = np.zeros(max(total - width + 1, 0) + 1, dtype=np.int32)
    full = inside > 0
    np.add.at(keep, word_offsets[:-1][full], 1)
    np.add.at(keep, np.minimum(word_offsets[:-1][full] + inside[full], len(keep) - 1), -1)
    return np.flatnonzero(np.cumsum(keep)[:-1] > 0), np.concatenate([[0], np.cumsum(inside)])
