"""Simple-8b coding of unsigned integers, vectorised over blocks.

A 64-bit word holds a selector in its upper 4 bits and as many values of one
width as fit in the other 60. Selector 0 is an escape: its payload is the
position of a 64-bit literal, for values of 2^60 and more. Values are coded in
blocks of ``BLOCK``; each block starts a new word, and the word offset of every
block is kept, so that all blocks can be decoded side by side.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256

# Fixed values: (values per word, bits per value) of selectors 2 to 15; 1 is unused.
LAYOUT = [
    (60, 1),
    (30, 2),
    (20, 3),
    (15, 4),
    (12, 5),
    (10, 6),
    (8, 7),
    (7, 8),
    (6, 10),
    (5, 12),
    (4, 15),
    (3, 20),
    (2, 30),
    (1, 60),
]
COUNT = np.array([1, 0] + [n for n, _ in LAYOUT], np.int64)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value, 1 at least."""
    if len(values) and values.max() < len(_NARROW):
        return _NARROW[values]
    bits = np.ones(values.shape, np.uint8)
    for shift in (32, 16, 8, 4, 2, 1):
        big = values >= (np.uint64(1) << np.uint64(shift))
        values = np.where(big, values >> np.uint64(shift), values)
        bits += big.astype(np.uint8) * np.uint8(shift)
    return bits


_NARROW = np.ones(1 << 16, np.uint8)
for _bit in range(1, 16):
    _NARROW[1 << _bit :] += np.uint8(1)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of every block and the end, literals)."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    room = BLOCK + LAYOUT[0][0]
    grid = np.zeros((blocks, room), np.uint64)
    bits = np.ones((blocks, room), np.uint8)
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[:n] = values
    grid[:, :BLOCK] = padded.reshape(blocks, BLOCK)
    bits[:, :BLOCK] = _widths(padded).reshape(blocks, BLOCK)
    choice = np.zeros((blocks, BLOCK), np.uint8)  # 0: escape
    widest = {1: bits}
    for count in sorted({c for c, _ in LAYOUT} - {1}):
        half = max(k for k in widest if k * 2 >= count or k == max(widest))
        part = widest[half]
        rest = count - half
        top = part.copy()
        top[:, : room - rest] = np.maximum(part[:, : room - rest], part[:, rest:]) if rest <= half else 0
        widest[count] = top
    for selector in range(15, 1, -1):
        count, width = LAYOUT[selector - 2]
        choice[widest[count][:, :BLOCK] <= width] = selector
    limit = np.full(blocks, BLOCK, np.int64)
    if n % BLOCK:
        limit[-1] = n % BLOCK
    at, live = np.zeros(blocks, np.int64), np.arange(blocks)
    found_block, found_at, found_sel = [], [], []
    while len(live):
        sel = choice[live, at[live]]
        found_block.append(live)
        found_at.append(at[live])
        found_sel.append(sel)
        at[live] += COUNT[sel]
        live = live[at[live] < limit[live]]
    if not found_block:
        return np.empty(0, np.uint64), np.zeros(1, np.int64), np.empty(0, np.uint64)
    block, at, sel = map(np.concatenate, (found_block, found_at, found_sel))
    order = np.argsort(block, kind="stable")
    block, at, sel = block[order], at[order], sel[order]
    words = sel.astype(np.uint64) << np.uint64(60)
    for selector in range(2, 16):
        own = np.flatnonzero(sel == selector)
        if len(own):
            count, width = LAYOUT[selector - 2]
            b, a, packed = block[own], at[own], words[own]
            for k in range(count):
                packed |= grid[b, a + k] << np.uint64(k * width)
            words[own] = packed
    own = np.flatnonzero(sel == 0)
    words[own] = np.arange(len(own), dtype=np.uint64)
    return words, np.concatenate([[0], np.cumsum(np.bincount(block, minlength=blocks))]), grid[block[own], at[own]]


def decode(words: np.ndarray, offsets: np.ndarray, literals: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values that ``encode`` was given."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    count = COUNT[sel]
    block = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    before = np.cumsum(count) - count
    at = before - (before[offsets[:-1]][block] if len(words) else 0) + block * BLOCK
    end = np.minimum((block + 1) * BLOCK, n)
    out = np.zeros(n, np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for selector in range(2, 16):
        own = np.flatnonzero(sel == selector)
        if len(own):
            size, width = LAYOUT[selector - 2]
            a, e, p = at[own], end[own], payload[own]
            mask = np.uint64((1 << width) - 1)
            for k in range(size):
                inside = a + k < e
                out[(a + k)[inside]] = ((p >> np.uint64(k * width)) & mask)[inside]
    own = np.flatnonzero(sel == 0)
    out[at[own]] = literals[payload[own].astype(np.int64)] if len(own) else 0
    return out
