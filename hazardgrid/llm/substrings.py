"""Removal of passages that already stand in an earlier document.

Every window of ``width`` consecutive words gets a Rabin-Karp hash. A window is
repeated if its hash also starts in a document with a smaller id. Counting all
windows would shuffle a row per word, so windows are first screened: each one
names the least hash of the shorter grams inside it, which depends on its
content only. A window whose named gram is found in one document cannot repeat
elsewhere; all others are counted in Spark in full. The screen loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid.llm import words
from hazardgrid.llm.batches import lists, stored

#: Stands for a null id in joins.
_NO_ID = -(1 << 63)


def _sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, at the first one."""
    done = 1
    while done * 2 <= width:
        g = np.minimum(g[:-done], g[done:])
        done *= 2
    return np.minimum(g[: len(g) - (width - done)], g[width - done :]) if done < width else g


def _named_grams(h: np.ndarray, width: int, gram: int) -> np.ndarray:
    """For each window of ``width`` words, the least hash of its grams."""
    if len(h) < width:
        return np.empty(0, np.uint64)
    return _sliding_min(words.rolling(h, gram, 7), width - gram + 1)


def _hashed(texts: pa.Array, second: bool) -> Iterator[tuple]:
    """Row range, word hashes, word offsets and digests of the words or their second hashes,
    for a bounded part of the rows at a time."""
    data, offsets = words.text_buffer(texts)
    for i, j in words.chunks(offsets):
        part, local = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = words.spans(part, local)
        more = words.hashes(part, starts, ends, 1) if second else words.digests(part, local)
        yield i, j, words.hashes(part, starts, ends), first, more


def _sketch(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, h, first, keys in _hashed(batch.column("text"), False):
                at, bounds = words.doc_windows(first, width)
                named = _named_grams(h, width, gram)[at]
                new = np.ones(len(named), dtype=bool)
                new[1:] = named[1:] != named[:-1]
                new[bounds[:-1][np.diff(bounds) > 0]] = True
                kept = np.concatenate([[0], np.cumsum(new)])[bounds]
                yield pa.record_batch(
                    {
                        "rid": batch.column("rid")[i:j],
                        "tk": batch.column("tk")[i:j],
                        "n": pa.array(np.diff(first), pa.int32()),
                        "k1": pa.array(keys[0]),
                        "k2": pa.array(keys[1]),
                        "named": lists(named[new].view(np.int64), kept, pa.int64()),
                    }
                )

    return run


def _windows(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, h, first, h2 in _hashed(batch.column("text"), True):
                at, bounds = words.doc_windows(first, width)
                named = _named_grams(h, width, gram)[at].view(np.int64)
                marks = batch.column("marks")[i:j]
                row = np.repeat(np.arange(j - i), np.diff(bounds))
                owner = np.repeat(np.arange(j - i), np.diff(np.asarray(marks.offsets)))
                hit = _pairs_in(row, named, owner, np.asarray(marks.flatten()))
                at, row = at[hit], row[hit]
                window = words.rolling(h, width, 3)[at].view(np.int64)
                other = words.rolling(h2, width, 5)[at].view(np.int64)
                # One row per text and window, however often the text repeats it.
                order = np.lexsort((at, other, window, row))
                at, row, window, other = at[order], row[order], window[order], other[order]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1]) | (other[1:] != other[:-1])
                one = np.flatnonzero(new)
                yield pa.record_batch(
                    {
                        "h": pa.array(window[one]),
                        "h2": pa.array(other[one]),
                        "rid": batch.column("rid")[i:j].take(pa.array(row[one])),
                        "tk": batch.column("tk")[i:j].take(pa.array(row[one])),
                        "pos": lists((at - first[:-1][row]).astype(np.int32), np.append(one, len(at)), pa.int32()),
                    }
                )

    return run


def _pairs_in(row: np.ndarray, value: np.ndarray, owner: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether each (row, value) is among the (owner, mark) pairs."""
    known = np.unique(marks)
    if not len(known):
        return np.zeros(len(row), dtype=bool)
    place = np.minimum(np.searchsorted(known, value), len(known) - 1)
    found = known[place] == value
    wanted = np.unique(owner * len(known) + np.searchsorted(known, marks))
    code = row * len(known) + place
    where = np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)
    return found & (wanted[where] == code)


def _cut(width: int):
    removed_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            rows = {"doc_id": [], "n_words": [], "n_removed": [], "removed": [], "kept": []}
            size = 0
            for k in range(batch.num_rows):
                parts = (texts[k].as_py() or b"").split()
                n = len(parts)
                if batch.column("whole")[k].as_py():
                    starts, ends = [0], [n]
                else:
                    at = batch.column("at")[k].values
                    at = np.sort(np.asarray(at)) if at is not None else np.empty(0, np.int32)
                    gap = np.flatnonzero(at[1:] > at[:-1] + width)
                    starts = at[np.concatenate([[0], gap + 1])].tolist() if len(at) else []
                    ends = (at[np.concatenate([gap, [len(at) - 1]])] + width).tolist() if len(at) else []
                kept, last = [], 0
                for s, e in zip(starts, ends):
                    kept += parts[last:s]
                    last = e
                kept = b" ".join(kept + parts[last:] if starts else parts)
                rid = batch.column("rid")[k].as_py()
                rows["doc_id"].append(None if rid == _NO_ID else rid)
                rows["n_words"].append(n)
                rows["n_removed"].append(sum(ends) - sum(starts))
                rows["removed"].append([{"start": s, "end": e} for s, e in zip(starts, ends)])
                rows["kept"].append(kept)
                size += len(kept)
                if size > words.CHUNK_BYTES or k == batch.num_rows - 1:
                    yield pa.record_batch(
                        {
                            "doc_id": pa.array(rows["doc_id"], pa.int64()),
                            "n_words": pa.array(rows["n_words"], pa.int64()),
                            "n_removed": pa.array(rows["n_removed"], pa.int64()),
                            "removed": pa.array(rows["removed"], removed_type),
                            "kept": pa.array(rows["kept"], pa.binary()).cast(pa.string()),
                        }
                    )
                    rows = {c: [] for c in rows}
                    size = 0

    return run


def remove_repeated(
    spark: SparkSession,
    docs: DataFrame,
    width: int = 50,
    gram: int = 25,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, removed, kept.

    ``removed`` lists the maximal intervals [start, end) of word positions that
    repeated windows cover, ``kept`` joins all other words by one space. A
    window repeats if the same words start in a document with a smaller id;
    windows are judged on the input. Rows that hold exactly the same words are
    compared once, through the smallest id among them.

    Defined cases: a null or empty text has no words; a text shorter than the
    window keeps all; a null id is neither a source nor changed; rows with one
    id are judged each for itself and never against each other; columns other
    than id and text are ignored; a very long text's words are held at once.
    A window is known by two independent 64-bit hashes of its words, a text by a
    128-bit digest.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("rid"),
        F.xxhash64(F.col(text_col)).alias("tk"),
        F.col(text_col).cast("string").alias("text"),
    )
    sketch = stored(
        spark,
        rows.mapInArrow(
            _sketch(width, gram), "rid bigint, tk bigint, n int, k1 bigint, k2 bigint, named array<bigint>"
        ).where((F.col("n") >= width) & (F.col("rid") != _NO_ID)),
        "sketch",
    )
    first = sketch.groupBy("k1", "k2", "n").agg(F.min("rid").alias("rep"))
    ranked = sketch.join(first, ["k1", "k2", "n"])
    copies = ranked.where("rid > rep").select("rid", "tk", F.lit(True).alias("whole")).distinct()
    grams = ranked.where("rid = rep").select("rid", "tk", F.explode("named").alias("g"))
    shared = grams.groupBy("g").agg(F.min("rid").alias("lo"), F.max("rid").alias("hi")).where("lo < hi")
    marks = stored(
        spark,
        grams.join(shared.select("g"), "g").groupBy("rid", "tk").agg(F.collect_set("g").alias("marks")),
        "marks",
    )
    found = (
        rows.join(marks, ["rid", "tk"])
        .select("rid", "tk", "text", "marks")
        .mapInArrow(_windows(width, gram), "h bigint, h2 bigint, rid bigint, tk bigint, pos array<int>")
    )
    earliest = found.groupBy("h", "h2").agg(F.min("rid").alias("lo"), F.max("rid").alias("hi")).where("lo < hi")
    covered = (
        found.join(earliest.select("h", "h2", "lo"), ["h", "h2"])
        .where("rid > lo")
        .groupBy("rid", "tk")
        .agg(F.flatten(F.collect_list("pos")).alias("at"))
    )
    decided = covered.withColumn("whole", F.lit(False)).unionByName(
        copies.withColumn("at", F.lit(None).cast("array<int>"))
    )
    return (
        rows.join(decided, ["rid", "tk"], "left")
        .select("rid", "text", "at", F.coalesce("whole", F.lit(False)).alias("whole"))
        .mapInArrow(
            _cut(width),
            "doc_id bigint, n_words bigint, n_removed bigint, removed array<struct<start:int,end:int>>, kept string",
        )
    )
