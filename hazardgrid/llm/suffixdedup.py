"""Removal of byte strings that start anywhere else, by a suffix order.

1. Screen. Each ``width``-byte window names the least hash of the grams inside it,
   which depends on its content only. A window whose named gram is found at one
   place of all distinct texts starts nowhere else; nothing is lost by leaving it out.
2. Anchor. The windows left are anchored at their leftmost least gram of nearly the
   whole width. Windows with one anchor make a run; a run whose bytes are those of
   another run is repeated as a whole (128-bit BLAKE2 digests), and one whose anchor
   is found once is not repeated. This is done twice: anchors well short of the window
   make few, long runs, which settle the inside of what is shared; only runs that
   share an anchor with runs of different bytes are anchored again, close to the width.
3. Order. Where runs of different bytes share an anchor, each becomes a string of
   letters: the bytes before the anchor, one letter for the anchor's gram (named by
   its digest), the bytes behind. A window is a prefix of a suffix of that string.
   The suffixes are ordered by the difference-cover algorithm, and suffixes next to
   each other with the same prefix are windows that start elsewhere too.
4. Cut. Windows found are merged into maximal spans of each text and cut out.

Texts that are equal are worked on once. Screening works on hashes that only ever
keep too much; what is removed has been compared letter by letter or by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid.llm import suffixes, words
from hazardgrid.llm.batches import binaries, lists, scratch, stored

#: Bytes of a window, of the screen's grams and, less than the window, of the anchors' grams.
#: A window is one letter more than the last, so two levels of names reach it.
WIDTH, SCREEN, SPARE = 400, 200, 8
#: The same of the first anchors, in units of the last.
FIRST = 4
#: Windows of a text that are worked on at once; bits that their places fit, spare ones included.
BLOCK, PLACE = 1 << 20, 22
#: Bytes of short texts that are screened at once: their hashes stay in a core's cache.
CHUNK = 1 << 16


def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, at the first one."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def _leftmost(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value of every ``width`` consecutive ones, by the bits a place leaves free.

    These bits are as many for every block: equal windows have their place chosen alike.
    """
    low = np.uint64((1 << PLACE) - 1)
    return (_slide((x & ~low) | np.arange(len(x), dtype=np.uint64), width) & low).astype(np.int64)


def _hashes(data: np.ndarray, gram: int) -> np.ndarray:
    return words.rolling(words._BYTE[data], gram, 7)


def _blocks(data: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first window, bytes) of bounded parts of a text that hold every window once."""
    for low in range(0, len(data) - width + 1, BLOCK):
        yield low, data[low : low + BLOCK + width - 1]


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _longs(digests: list[bytes]) -> tuple[pa.Array, pa.Array]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return pa.array(both[:, 0]), pa.array(both[:, 1])


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    column = batch.column("text").cast(pa.large_binary())
    for k in range(batch.num_rows):
        yield k, column[k].as_py() or b""


def _names(h: np.ndarray, width: int, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows ``keep``, each ``width`` grams: those that name another place than the one before, and the places."""
    at = _leftmost(h, width)[keep]
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else at
    return new, at[new]


def _named(data: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all grams that a window of the joined texts names."""
    places, values = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for i, j in words.chunks(offsets, CHUNK):
        chunk, base = data[offsets[i] : offsets[j]], offsets[i]
        whole, _ = words.doc_windows(offsets[i : j + 1] - base, width)
        for low, part in _blocks(chunk, width):
            keep = whole[slice(*np.searchsorted(whole, [low, low + BLOCK]))] - low
            h = _hashes(part, gram)
            _, at = _names(h, width - gram + 1, keep)
            places.append(at + (low + base))
            values.append(h[at])
    places, first = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(values)[first]


def _sketch(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.text_buffer(batch.column("text"))
            texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            d1, d2 = _longs([_digest(t) for t in texts])
            column = {"doc_id": batch.column("doc_id"), "d1": d1, "d2": d2, "n": pa.array(np.diff(offsets), pa.int64())}
            column["sha"] = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
            places, values = _named(data, offsets, width, gram)
            rows = np.searchsorted(offsets, places, "right") - 1
            order = np.lexsort((values, rows))
            rows, values = rows[order], values[order]
            first = np.ones(len(rows), bool)
            first[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
            again = np.zeros(len(rows), bool)  # the second of a text's equal ones
            again[1:] = ~first[1:] & first[:-1]
            for name, own in (("named", first), ("twice", again)):
                bounds = np.searchsorted(rows[own], np.arange(batch.num_rows + 1))
                column[name] = lists(values[own].view(np.int64), bounds, pa.int64())
            yield pa.record_batch(column)

    return run


def _digested(width: int):
    """Texts of at least a window with their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t for _, t in _texts(batch) if len(t) >= width]
            d1, d2 = _longs([_digest(t) for t in found])
            yield pa.record_batch({"d1": d1, "d2": d2, "text": binaries(found)})

    return run


def _marked(text: bytes, marks: np.ndarray, width: int, gram: int) -> Iterator[tuple]:
    """(first window, bytes, windows that name a mark, their owner) of a text's blocks."""
    for low, part in _blocks(np.frombuffer(text, np.uint8), width):
        h, n = _hashes(part, gram), len(part) - width + 1
        new, at = _names(h, width - gram + 1, np.arange(n))
        place = np.minimum(np.searchsorted(marks, h[at]), len(marks) - 1)
        keep = np.flatnonzero(np.repeat(marks[place] == h[at], np.diff(np.append(new, n))))
        yield low, part, keep, np.zeros(len(keep), np.int64)


def _ranged(text: bytes, first: np.ndarray, size: np.ndarray, width: int) -> Iterator[tuple]:
    """The same of the windows of sorted ranges, each range an owner."""
    for low, part in _blocks(np.frombuffer(text, np.uint8), width):
        start, end = np.maximum(first - low, 0), np.minimum(first + size - low, len(part) - width + 1)
        owner = np.repeat(np.arange(len(first)), np.maximum(end - start, 0))
        counts = np.bincount(owner, minlength=len(first))
        yield low, part, np.arange(len(owner)) + (start - np.cumsum(counts) + counts)[owner], owner


def _runs(blocks: Iterator[tuple], width: int, spare: int) -> Iterator[tuple]:
    """First window, windows, anchor's distance, anchor's hash and owner of all runs, a block's at a time."""
    for low, part, keep, owner in blocks:
        if not len(keep):
            continue
        part, low, keep = part[keep[0] : keep[-1] + width], low + keep[0], keep - keep[0]
        h = _hashes(part, width - spare)
        anchor = _leftmost(h, spare + 1)[keep]
        cut = np.flatnonzero((keep[1:] != keep[:-1] + 1) | (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])) + 1
        one, last = np.append(0, cut), np.append(cut - 1, len(keep) - 1)
        first, at = keep[one], anchor[one]
        yield first + low, keep[last] - first + 1, at - first, h[at].view(np.int64), owner[one]


def _anchored(width: int, gram: int, spare: int):
    """A row per text and different run, with the places of the equal ones.

    The runs are of a text's windows that name one of its ``marks``, a text that is found
    ``copies`` times; or else of its ``ranges`` of windows, each with its own times.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in _texts(batch):
                if "marks" in batch.schema.names:
                    marks = np.sort(np.asarray(batch.column("marks")[k].values).view(np.uint64))
                    blocks, weights = _marked(text, marks, width, gram), np.asarray(batch.column("copies"))[k : k + 1]
                else:
                    ranges = batch.column("ranges")[k].values
                    first, size, times = (np.asarray(ranges.field(f)).astype(np.int64) for f in ("at", "size", "times"))
                    order = np.argsort(first)
                    blocks, weights = _ranged(text, first[order], size[order], width), times[order]
                for at, size, off, h, owner in _runs(blocks, width, spare):
                    places: dict[tuple, list[int]] = {}
                    firsts = []
                    weight = weights[owner]
                    ends = (at + size + (width - 1)).tolist()
                    for i, (a, e, w) in enumerate(zip(at.tolist(), ends, weight.tolist())):
                        key = (_digest(text[a:e]), w)
                        if key in places:
                            places[key].append(a)
                        else:
                            places[key] = [a]
                            firsts.append(i)
                    c1, c2 = _longs([c for c, _ in places])
                    bounds = np.concatenate([[0], np.cumsum([len(a) for a in places.values()])])
                    yield pa.record_batch(
                        {
                            "tid": pa.array(np.full(len(firsts), batch.column("tid")[k].as_py())),
                            "copies": pa.array(weight[firsts]),
                            "at": lists(np.concatenate(list(places.values())), bounds, pa.int64()),
                            "size": pa.array(size[firsts], pa.int32()),
                            "off": pa.array(off[firsts], pa.int32()),
                            "h": pa.array(h[firsts]),
                            "c1": c1,
                            "c2": c2,
                        }
                    )

    return run


def _strings(width: int, spare: int):
    """Strings of runs: bytes as letters from 1 on, 0 in the anchor's place, and its gram's digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in _texts(batch):
                runs = batch.column("runs")[k].as_py()
                letters, bounds, grams = [], [0], []
                for r in runs:
                    start, end = r["at"] + r["off"], r["at"] + r["off"] + width - spare
                    tail = text[end : r["at"] + r["size"] - 1 + width]
                    for part in (text[r["at"] : start], None, tail):
                        x = np.zeros(1, np.int64) if part is None else np.frombuffer(part, np.uint8).astype(np.int64) + 1
                        letters.append(x)
                    bounds.append(bounds[-1] + r["off"] + 1 + len(tail))
                    grams.append(_digest(text[start:end]))
                k1, k2 = _longs(grams)
                yield pa.record_batch(
                    {
                        "sid": pa.array([r["sid"] for r in runs], pa.int64()),
                        "size": pa.array([r["size"] for r in runs], pa.int32()),
                        "k1": k1,
                        "k2": k2,
                        "c": lists(np.concatenate(letters), bounds, pa.int64()),
                    }
                )

    return run


def spans_of(at: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal intervals that windows [at, end) cover; windows that touch make one."""
    order = np.argsort(at, kind="stable")
    at, reach = at[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(at[1:] > reach[:-1]) + 1
    return list(zip(at[np.append(0, new)].tolist(), reach[np.append(new - 1, len(at) - 1)].tolist()))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for k, text in _texts(batch):
            hits = batch.column("hits")[k].values
            spans = spans_of(np.asarray(hits.field("at")), np.asarray(hits.field("end")))
            starts, ends = [0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)]
            kept = b"".join(text[s:e] for s, e in zip(starts, ends))
            yield pa.record_batch(
                {
                    "d1": batch.column("d1")[k : k + 1],
                    "d2": batch.column("d2")[k : k + 1],
                    "spans": pa.array([[{"start": s, "end": e} for s, e in spans]], kind),
                    "kept": binaries([kept]),
                }
            )


_RUNS = "tid bigint, copies bigint, at array<bigint>, size int, off int, h bigint, c1 bigint, c2 bigint"


def _settled(spark: SparkSession, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tid, at, size) of the runs found elsewhere too, whose own times are 1; and one
    (times, tid, at, size, off) for each content of the anchors whose runs are not settled yet."""
    # Anchors whose runs are all alike settle them at once; a single run is not repeated.
    content = F.struct("c1", "c2")
    times = F.sum(F.size("at") * F.col("copies"))
    buckets = runs.groupBy("h").agg(F.min(content).alias("low"), F.max(content).alias("high"), times.alias("times"))
    buckets = stored(
        spark, buckets.where("times > 1").select("h", (F.col("low") != F.col("high")).alias("mixed")), "buckets"
    )
    mixed = stored(spark, runs.join(buckets.where("mixed").select("h"), "h"), "mixed")
    one = F.min(F.struct("tid", F.get("at", F.lit(0)).alias("at"), "size", "off"))
    contents = stored(spark, mixed.groupBy("h", "c1", "c2").agg(times.alias("times"), one.alias("one")), "contents")
    unsettled = contents.groupBy("h").agg(F.min("times").alias("least")).where("least = 1")
    # Texts with copies go as a whole; of the others these runs.
    alike = runs.where("copies = 1").join(buckets.where("not mixed").select("h"), "h").select("tid", "at", "size")
    repeated = contents.where("times > 1").select("h", "c1", "c2")
    again = mixed.where("copies = 1").join(repeated, ["h", "c1", "c2"]).select("tid", "at", "size")
    return alike.union(again), contents.join(unsettled.select("h"), "h").select("times", "one.*")


def remove_repeated(
    spark: SparkSession,
    docs: DataFrame,
    width: int = WIDTH,
    screen: int = SCREEN,
    spare: int = SPARE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, spans, kept, kept_sha256.

    Bytes covered by a ``width``-byte string that also starts at another place of any
    row, the same one included, are removed; strings are judged on the input and never
    cross rows. ``spans`` lists the maximal removed runs [start, end) of the text's UTF-8
    bytes, ``kept`` has the other bytes where something was removed and is null where
    the text stays as it is.

    Defined cases: a null text is empty; a text shorter than the window keeps all; every
    row counts, so repeated rows remove each other, whatever their ids; a null id stays
    null; a very long text is held once and worked on in blocks; an empty table gives an
    empty one; columns other than id and text are ignored, whatever their names.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    sketch = stored(
        spark,
        rows.mapInArrow(
            _sketch(width, screen),
            "doc_id bigint, d1 bigint, d2 bigint, n bigint, sha string, named array<bigint>, twice array<bigint>",
        ),
        "sketch",
    )
    texts = (
        sketch.where(F.col("n") >= width)
        .groupBy("d1", "d2")
        .agg(F.count("*").alias("copies"), F.first("named").alias("named"), F.first("twice").alias("twice"))
    )
    texts = stored(spark, texts.withColumn("tid", F.monotonically_increasing_id()), "texts")
    grams = texts.select("tid", F.explode("named").alias("g"))
    places = grams.withColumn("again", F.lit(0)).union(texts.select("tid", F.explode("twice"), F.lit(1)))
    shared = (
        places.groupBy("g")
        .agg(F.min("tid").alias("low"), F.max("tid").alias("high"), F.max("again").alias("again"))
        .where("low < high or again = 1")
        .select("g")
    )
    marks = (
        grams.join(shared, "g")
        .groupBy("tid")
        .agg(F.collect_list("g").alias("marks"))
        .join(texts.select("tid", "d1", "d2", "copies"), "tid")
    )
    once = rows.mapInArrow(_digested(width), "d1 bigint, d2 bigint, text binary")
    once = once.groupBy("d1", "d2").agg(F.first("text").alias("text"))
    suspects = stored(spark, once.join(marks, ["d1", "d2"]), "suspects")
    first = max(spare, min(FIRST * spare, width - screen))
    runs = stored(
        spark,
        suspects.select("tid", "copies", "text", "marks").mapInArrow(_anchored(width, screen, first), _RUNS),
        "runs",
    )
    alike, ranges = _settled(spark, runs)
    ranges = ranges.groupBy("tid").agg(F.collect_list(F.struct("at", "size", "times")).alias("ranges"))
    close = ranges.join(suspects.select("tid", "text"), "tid").select("tid", "text", "ranges")
    runs = stored(spark, close.mapInArrow(_anchored(width, screen, spare), _RUNS), "runs")
    again, contested = _settled(spark, runs)
    contested = stored(spark, contested.withColumn("sid", F.monotonically_increasing_id()), "contested")
    # What the order is made from goes before the last join, which is the largest.
    with scratch(spark, "order") as passing:
        strings = (
            contested.groupBy("tid")
            .agg(F.collect_list(F.struct("sid", "at", "size", "off")).alias("runs"))
            .join(suspects.select("tid", "text"), "tid")
            .select("text", "runs")
            .mapInArrow(_strings(width, spare), "sid bigint, size int, k1 bigint, k2 bigint, c array<bigint>")
        )
        strings = stored(spark, strings, "strings", passing)
        # Letters 1 to 256 are bytes, the anchors' grams come after them.
        names = strings.select("k1", "k2").distinct().withColumn("k", F.monotonically_increasing_id() + 257)
        strings = stored(
            spark,
            strings.join(stored(spark, names, "anchors", passing), ["k1", "k2"]).select(
                "sid",
                F.expr("transform(c, x -> if(x = 0, k, x))").alias("c"),
                F.expr("transform(sequence(0, size(c) - 1), i -> i < size)").alias("want"),
            ),
            "letters",
            passing,
        )
        ranks = suffixes.order(spark, strings, spare + 1, under=passing)
        windows = (
            strings.join(ranks, "sid")
            .select("sid", "c", F.posexplode("ranks").alias("i", "rank"))
            .where("rank is not null")
            .select("sid", "i", "rank", F.expr(f"slice(c, i + 1, {spare + 1})").alias("prefix"))
        )
        neighbours = suffixes.shared_prefixes(spark, windows)
    found = neighbours.join(contested.where("times = 1"), "sid")
    hits = found.select("tid", F.array(F.col("at") + F.col("i")).alias("at"), F.lit(1).alias("size"))
    hits = hits.union(alike).union(again)
    covered = F.expr(f"transform(at, a -> struct(a as at, a + size + {width - 1} as end))")
    hits = hits.select("tid", covered.alias("hits")).groupBy("tid").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    changed = stored(
        spark,
        suspects.join(hits, "tid")
        .select("d1", "d2", "text", "hits")
        .mapInArrow(_cut, "d1 bigint, d2 bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"),
        "changed",
    )
    copied = texts.where("copies > 1").select("d1", "d2", F.lit(True).alias("copied"))
    return (
        sketch.join(copied, ["d1", "d2"], "left")
        .join(changed, ["d1", "d2"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_bytes"),
            F.expr("if(copied, array(named_struct('start', 0L, 'end', n)), coalesce(spans, array()))").alias("spans"),
            F.expr("if(copied, cast('' as binary), kept)").alias("kept"),
            "sha",
        )
        .select(
            "doc_id",
            "n_bytes",
            F.expr("aggregate(spans, 0L, (s, x) -> s + x.end - x.start)").alias("n_removed"),
            "spans",
            "kept",
            F.expr("if(kept is null, sha, sha2(kept, 256))").alias("kept_sha256"),
        )
    )
