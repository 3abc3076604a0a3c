"""Per-word results computed once and looked up for all later uses of the word."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from hazardgrid.llm import words

#: Words held by one task; beyond it only those of the current chunk stay.
WORDS_HELD = 1 << 20

#: Encodes distinct words: list of UTF-8 words -> (flat values, values per word).
Encoder = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def _equal(a, a_starts, a_sizes, b, b_starts, b_sizes) -> np.ndarray:
    """Which byte ranges of ``a`` are equal to their partners of ``b``."""
    same = a_sizes == b_sizes
    rows = np.flatnonzero(same)
    if not len(rows):
        return same
    sizes = a_sizes[rows]
    ends = np.cumsum(sizes)
    step = np.arange(int(ends[-1])) - np.repeat(ends - sizes, sizes)
    differs = a[np.repeat(a_starts[rows], sizes) + step] != b[np.repeat(b_starts[rows], sizes) + step]
    same[rows] = np.bincount(np.repeat(np.arange(len(rows)), sizes)[differs], minlength=len(rows)) == 0
    return same


class WordMemo:
    """Word -> sequence of small integers, kept in flat sorted arrays.

    Words are found by a 64-bit hash; their bytes are kept and every hit is compared.
    """

    def __init__(self, encode: Encoder, dtype=np.uint32):
        self.encode, self.dtype = encode, dtype
        self._clear()

    def _clear(self):
        self.keys = np.empty(0, np.uint64)
        self.slot = np.empty(0, np.int64)
        self.raw = np.empty(0, np.uint8)
        self.raw_starts = np.empty(0, np.int64)
        self.raw_sizes = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)
        self.values = np.empty(0, self.dtype)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slot[at], -1)

    def _add(self, keys, found, values, sizes):
        base = len(self.sizes)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1] + len(self.values)
        self.values = np.concatenate([self.values, values.astype(self.dtype)])
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes])
        lengths = np.array([len(w) for w in found], np.int64)
        self.raw_starts = np.concatenate([self.raw_starts, len(self.raw) + np.cumsum(lengths) - lengths])
        self.raw_sizes = np.concatenate([self.raw_sizes, lengths])
        self.raw = np.concatenate([self.raw, np.frombuffer(b"".join(found), np.uint8)])
        merged = np.concatenate([self.keys, keys])
        slots = np.concatenate([self.slot, base + np.arange(len(keys))])  # words without a key are not found again
        order = np.argsort(merged, kind="stable")
        self.keys, self.slot = merged[order], slots[order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slot of every word; unknown words are encoded and remembered."""
        if not len(starts):
            return np.empty(0, np.int64)
        h = words.hashes(data, starts, ends)
        order = np.argsort(h)
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[order[1:]] != h[order[:-1]]
        inverse = np.empty(len(h), np.int64)
        inverse[order] = np.cumsum(new) - 1
        one = order[new]
        s, e = starts[one], ends[one]
        slots = self._slots(h[one])
        known = slots >= 0
        at = slots[known]
        known[known] = _equal(self.raw, self.raw_starts[at], self.raw_sizes[at], data, s[known], (e - s)[known])
        if not known.all():
            if len(self.sizes) + int((~known).sum()) > WORDS_HELD:
                self._clear()
                known[:] = False
            lost = np.flatnonzero(~known)
            slots[lost] = self._encoded(data, s[lost], e[lost], h[one][lost])
        out = slots[inverse]
        size = ends - starts
        other = np.flatnonzero(~_equal(data, starts, size, data, s[inverse], size[one][inverse]))
        if len(other):  # two words of one hash in this part
            out[other] = self._encoded(data, starts[other], ends[other], None)
        return out

    def _encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray | None) -> np.ndarray:
        """New slots of words, to be found by ``keys`` that are not taken yet."""
        raw = data.tobytes()
        found = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        values, sizes = self.encode(found)
        slots = len(self.sizes) + np.arange(len(found))
        if keys is None:
            keys = np.empty(0, np.uint64)
        self._add(keys, found, values, np.asarray(sizes, np.int64))
        return slots

    def spread(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the words in order, and n+1 offsets of the words."""
        sizes = self.sizes[slots]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.starts[slots] - bounds[:-1], sizes) + np.arange(bounds[-1])
        return self.values[at], bounds
