"""SentencePiece encoding and decoding as shortest paths of a transducer.

The transducer is the composition of a normalizer (spaces become marks, a mark
is put in front), the pieces, and byte fallback for characters without one.

Unigram models weigh an arc by minus its score. In a BPE model merges, not
weights, decide: the segmentation is the one path on which every two
neighbouring pieces keep apart, that is, on which merging their joined text
gives the same two pieces again. That makes the last piece the state: an arc
for piece b leaves state a only if (a, b) keep apart, with weight 0. Each
prefix has exactly one accepted state, so its shortest path is followed for all
words of a batch side by side.
"""

from __future__ import annotations

import codecs
import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardgrid.llm import pieces, words
from hazardgrid.llm.batches import lists
from hazardgrid.llm.memo import WordMemo
from hazardgrid.llm.tokencount import UNKNOWN_PENALTY

#: Longer units are merged one by one instead of side by side.
_LONG = 48
_CACHE = 1 << 20


codecs.register_error("each-byte", lambda error: ("\ufffd" * (error.end - error.start), error.end))


def merge(text: str, rank: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Symbols left when the best-ranked neighbours are merged, leftmost first; and the last merge."""
    symbols: list[str | None] = list(text)
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[float, int, int, str]] = []

    def propose(i: int, j: int):
        joined = symbols[i] + symbols[j]
        if joined in rank:
            heapq.heappush(heap, (rank[joined], i, j, joined))

    for i in range(n - 1):
        propose(i, i + 1)
    last = None
    while heap:
        _, i, j, joined = heapq.heappop(heap)
        if symbols[i] is None or symbols[j] is None or after[i] != j or symbols[i] + symbols[j] != joined:
            continue
        last = (symbols[i], symbols[j])
        symbols[i], symbols[j] = joined, None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
            propose(i, after[j])
        if before[i] >= 0:
            propose(before[i], i)
    return [s for s in symbols if s is not None], last


class _Table:
    """Sorted 64-bit keys with values; -1 for an absent key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def get(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], -1)


class Transducer:
    def __init__(self, model: pieces.Model):
        self.model = model
        self.normal = model.normal()
        self.sizes = np.array([len(t) for t in model.texts] + [1], np.int64)
        self.other = len(model.texts)  # state of a character without a piece
        self.table = [self._bytes(i) for i in range(len(model.texts))]
        if model.kind == pieces.BPE:
            if not pieces.splits_before_space(model):
                raise ValueError("pieces that cross into a new word are not supported")
            self._compile()
            self.memo = WordMemo(self._encode_units)
        elif model.kind == pieces.UNIGRAM:
            self.longest = max(map(len, self.normal), default=1)
            self.worst = min(model.scores) - UNKNOWN_PENALTY
        else:
            raise ValueError("only BPE and unigram models are supported")

    def _bytes(self, i: int) -> bytes:
        kind, text = self.model.kinds[i], self.model.texts[i]
        if kind == pieces.BYTE:
            return bytes([int(text[3:5], 16)])
        if kind == pieces.CONTROL:
            return b""
        return (" ⁇ " if kind == pieces.UNKNOWN else text.replace(pieces.SPACE, " ")).encode()

    def _compile(self):
        rank = {t: -self.model.scores[i] for t, i in self.normal.items()}
        self.rank_of = rank
        size = len(self.model.texts) + 1
        self.rank = np.full(size, -1.0)
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        hashes, ids, pair_keys, pair_ranks = [], [], [], []
        for text, i in self.normal.items():
            if len(text) > 1:
                result, last = merge(text, rank)
                if result == [text]:
                    self.rank[i] = rank[text]
                    self.left[i], self.right[i] = (self.normal.get(x, self.other) for x in last)
                    hashes.append(text)
                    ids.append(i)
                for cut in range(1, len(text)):
                    a, b = self.normal.get(text[:cut]), self.normal.get(text[cut:])
                    if a is not None and b is not None:
                        pair_keys.append(a * size + b)
                        pair_ranks.append(rank[text])
            else:
                hashes.append(text)
                ids.append(i)
        self.size = size
        self.pair_keys = np.array(pair_keys, np.int64)
        order = np.argsort(self.pair_keys)
        self.pair_keys, self.pair_ranks = self.pair_keys[order], np.array(pair_ranks)[order]
        self.longest = max(map(len, hashes), default=1)
        joined = np.array([ord(c) for t in hashes for c in t], np.uint64)
        ends = np.cumsum([len(t) for t in hashes])
        self.by_hash = _Table(self._ranges(joined, ends - [len(t) for t in hashes], ends), np.array(ids, np.int64))
        self.seen_key = np.full(_CACHE, -1, np.int64)
        self.seen = np.zeros(_CACHE, dtype=bool)

    @staticmethod
    def _sums(points: np.ndarray) -> np.ndarray:
        up, _ = words._POWERS.upto(len(points) + 1)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(words.mix(points + np.uint64(1)) * up[: len(points)], out=sums[1:])
        return sums

    def _ranges(self, points, starts, ends):
        sums = self._sums(points)
        _, down = words._POWERS.upto(len(points) + 1)
        return (sums[ends] - sums[starts]) * down[starts]

    def _pair_rank(self, a, b):
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], np.inf)

    def keep_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the joined text of each pair gives the pair again.

        Merges are undone from the last one back. While x ends the left text
        and y begins the right one, merging them would have cost the pair its
        edge if its rank comes before the merge that ended that state (or ties
        with a merge further right).
        """
        key = a * self.size + b
        slot = (words.mix(key.astype(np.uint64)) & np.uint64(_CACHE - 1)).astype(np.int64)
        known = self.seen_key[slot] == key
        result = self.seen[slot]
        new = np.flatnonzero(~known)
        if len(new):
            result[new] = self._derive(a[new], b[new])
            self.seen_key[slot[new]] = key[new]
            self.seen[slot[new]] = result[new]
        return result

    def _derive(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        if not len(self.pair_keys):
            return np.ones(len(x), dtype=bool)
        apart = np.ones(len(x), dtype=bool)
        live = np.arange(len(x))
        limit, or_equal = np.full(len(x), np.inf), np.zeros(len(x), dtype=bool)
        while len(live):
            r = self._pair_rank(x, y)
            crossed = (r < limit) | (or_equal & (r == limit) & np.isfinite(r))
            apart[live[crossed]] = False
            undo_left = self.rank[x] > self.rank[y]
            more = ~crossed & ((self.rank[x] >= 0) | (self.rank[y] >= 0))
            limit = np.where(undo_left, self.rank[x], self.rank[y])
            x, y = np.where(undo_left, self.right[x], x), np.where(undo_left, y, self.left[y])
            live, x, y, limit, or_equal = live[more], x[more], y[more], limit[more], ~undo_left[more]
        return apart

    def _paths(self, found: list[str]) -> list[np.ndarray]:
        """Piece ids of every unit, all units side by side, one character at a time."""
        sizes = np.array([len(u) for u in found], np.int64)
        points = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32).astype(np.uint64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        sums, (_, down) = self._sums(points), words._POWERS.upto(len(points) + 1)
        state = np.full(len(points) + 1, -1, np.int64)  # at the end of each character, shifted by one
        order = np.argsort(-sizes, kind="stable")
        falling = -sizes[order]
        for i in range(1, int(sizes.max(initial=0)) + 1):
            live = order[: np.searchsorted(falling, -i, "right")]
            at = starts[live] + i
            open_ = np.arange(len(live))
            for size in range(min(i, self.longest), 0, -1):
                to = at[open_]
                piece = self.by_hash.get((sums[to] - sums[to - size]) * down[to - size])
                if size == 1:
                    piece = np.where(piece < 0, self.other, piece)
                hit = np.flatnonzero(piece >= 0)
                if size < i and len(hit):
                    hit = hit[self.keep_apart(state[to[hit] - size], piece[hit])]
                state[to[hit]] = piece[hit]
                rest = np.ones(len(open_), dtype=bool)
                rest[hit] = False
                open_ = open_[rest]
                if not len(open_):
                    break
            if len(open_):
                raise AssertionError("no path: the model's merges are inconsistent")
        # state[p] is only read inside its own unit, so units may share the array.
        at, live, steps = ends.copy(), np.flatnonzero(sizes), []
        while len(live):
            piece = state[at[live]]
            steps.append((live, piece, at[live]))
            at[live] -= self.sizes[piece]
            live = live[at[live] > starts[live]]
        if not steps:
            return [np.empty(0, np.int64) for _ in found]
        unit, piece, place = map(np.concatenate, zip(*steps))
        order = np.lexsort((place, unit))
        unit, piece, place = unit[order], piece[order], place[order]
        paths = np.split(piece, np.cumsum(np.bincount(unit, minlength=len(found)))[:-1])
        for k in np.unique(unit[piece == self.other]).tolist():
            paths[k] = self._fallback(found[k], paths[k])
        return paths

    def _fallback(self, text: str, path) -> np.ndarray:
        """Replace characters without a piece by their bytes, or runs of them by the unknown piece."""
        out, at = [], 0
        for piece in path:
            piece = int(piece)
            size = int(self.sizes[piece])
            if piece != self.other:
                out.append(piece)
            elif self.model.bytes_from:
                out += [self.model.bytes_from[b] for b in text[at].encode()]
            elif not out or out[-1] != self.model.unknown:
                out.append(self.model.unknown)
            at += size
        return np.array(out, np.int64)

    def _merged(self, text: str) -> np.ndarray:
        symbols, _ = merge(text, self.rank_of)
        return self._fallback(text, [self.normal.get(s, self.other) for s in symbols])

    def _encode_units(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # Marks in front of the last one merge after everything else, as their
        # pieces rank last; runs of them are therefore set apart first.
        texts = [u.decode().replace(" ", pieces.SPACE) for u in found]
        extra = [max(len(t) - len(t.lstrip(pieces.SPACE)) - 1, 0) for t in texts]
        short = [k for k, t in enumerate(texts) if not extra[k] and len(t) <= _LONG]
        paths: list[np.ndarray] = [None] * len(texts)
        for k, path in zip(short, self._paths([texts[k] for k in short])):
            paths[k] = path
        for k, t in enumerate(texts):
            if paths[k] is None:
                paths[k] = self._merged(t)
        return np.concatenate([np.empty(0, np.int64), *paths]), np.array([len(p) for p in paths], np.int64)

    def _unigram(self, text: str) -> np.ndarray:
        n = len(text)
        best = [0.0] + [-np.inf] * n
        back = [0] * (n + 1)
        for at in range(n):
            for size in range(1, min(self.longest, n - at) + 1):
                i = self.normal.get(text[at : at + size])
                if i is not None and best[at] + self.model.scores[i] > best[at + size]:
                    best[at + size], back[at + size] = best[at] + self.model.scores[i], size
                elif i is None and size == 1 and best[at] + self.worst > best[at + 1]:
                    best[at + 1], back[at + 1] = best[at] + self.worst, 1
        path, at = [], n
        while at:
            path.append(self.normal.get(text[at - back[at] : at], self.other))
            at -= back[at]
        return self._fallback(text, path[::-1])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat piece ids and n+1 offsets."""
        if self.model.kind == pieces.UNIGRAM:
            lead = pieces.SPACE if self.model.dummy_prefix else ""
            each = [self._unigram(lead + t.replace(" ", pieces.SPACE)) if t else np.empty(0, np.int64) for t in texts]
            return np.concatenate([np.empty(0, np.int64), *each]), np.cumsum([0, *map(len, each)])
        data, starts, ends, first = pieces.units(texts, self.model)
        ids, bounds = self.memo.spread(self.memo.find(data, starts, ends))
        return ids, bounds[first]

    def decode(self, ids: list[int]) -> str:
        """Text of piece ids; the mark put in front is taken off, each broken byte becomes U+FFFD."""
        raw = b"".join(map(self.table.__getitem__, ids))
        if self.model.dummy_prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "each-byte")


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(pieces.load(path))


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(path)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            _, offsets = words.text_buffer(texts)
            for i, j in words.chunks(offsets):
                ids, bounds = own.encode(texts[i:j].to_pylist())
                columns = {c: batch.column(c)[i:j] for c in batch.schema.names if c != "text"}
                yield pa.record_batch(columns | {"ids": lists(ids.astype(np.int32), bounds, pa.int32())})

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(path)
        for batch in batches:
            ids = batch.column("ids")
            for i in range(0, batch.num_rows, 256):
                part = ids[i : i + 256]
                texts = [own.decode(x or []) for x in part.to_pylist()]
                flat = np.asarray(part.flatten(), "<u4")
                bounds = np.cumsum([0] + [len(x) if x.is_valid else 0 for x in part])
                columns = {c: batch.column(c)[i : i + 256] for c in batch.schema.names if c != "ids"}
                yield pa.record_batch(
                    columns
                    | {
                        "decoded": pa.array(texts, pa.string()),
                        "n_tokens": pa.array(np.diff(bounds)),
                        "ids_crc32": pa.array(
                            [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])], pa.int64()
                        ),
                    }
                )

    return run


def _kept_schema(df: DataFrame, without: str) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields if f.name != without)


def encode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with column ids (array of piece ids) in place of the text.

    Defined cases: a null or empty text has no ids; all other columns, nulls
    and repeated rows included, are returned as they are; a column that is
    named ids already is replaced; an empty table gives an empty one; a very long
    text is encoded whole, its ids are held at once.
    """
    rows = docs.drop("ids") if text_col != "ids" else docs
    rows = rows.withColumn(text_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    if text_col != "text":
        rows = rows.drop("text").withColumnRenamed(text_col, "text")
    return rows.mapInArrow(_encode(model_path), _kept_schema(rows, "text") + "ids array<int>")


def decode(coded: DataFrame, model_path: str) -> DataFrame:
    """``coded`` with columns decoded, n_tokens and ids_crc32 (ids as little-endian 32-bit
    integers) in place of ids; null ids decode to an empty text."""
    rows = coded.drop("decoded", "n_tokens", "ids_crc32")
    return rows.mapInArrow(
        _decode(model_path), _kept_schema(rows, "ids") + "decoded string, n_tokens bigint, ids_crc32 bigint"
    )
