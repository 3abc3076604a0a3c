"""Similarity join of texts by the Jaccard measure of their word n-grams.

A MinHash LSH forest finds candidates: every text has ``trees`` labels of
``depth`` minima, and texts whose labels share a prefix stand under one node of
that tree's trie. Prefixes are shortened level by level until a pair at the
threshold is found with the target recall. Texts that meet in a node are only
chained, never paired; the chains' components are then compared exactly, in
cells of bounded size, and each cell reports counts and a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid.llm import words
from hazardgrid.llm.batches import binaries, groups, lists, stored
from hazardgrid.llm.graph import class_components, components, roots

_NO_ID = -(1 << 63)
#: Bounds of one block of a cell.
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1 << 19
#: Shingles in at most this many texts of a cell are counted pair by pair.
_RARE = 8


def matched_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """Longest prefix at which a pair at ``threshold`` meets with probability ``recall``."""
    for level in range(depth, 0, -1):
        if 1 - (1 - threshold**level) ** trees >= recall:
            return level
    raise ValueError("even one level does not reach the recall; plant more trees")


def _shingles(texts: pa.Array, n: int) -> Iterator[tuple]:
    """Row range, digests of the words, distinct shingle hashes and their offsets.

    A text of one to n-1 words has one shingle, all its words.
    """
    data, offsets = words.text_buffer(texts)
    for i, j in words.chunks(offsets):
        part, local = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = words.spans(part, local)
        h = words.hashes(part, starts, ends)
        rolled = words.rolling(h, n, 11)
        counts = np.diff(first)
        sets = []
        for a, c in zip(first[:-1].tolist(), counts.tolist()):
            if c >= n:
                sets.append(np.unique(rolled[a : a + c - n + 1]))
            elif c:
                sets.append(words.rolling(h[a : a + c], c, 13 + c))
            else:
                sets.append(h[:0])
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        yield i, j, words.digests(part, local), np.concatenate(sets), bounds


def _nodes(flat: np.ndarray, bounds: np.ndarray, trees: int, level: int, seed: int) -> np.ndarray:
    """Trie node (tree and label prefix of ``level`` minima) of every non-empty row."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 2**31, (trees, level), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    flips = rng.integers(0, 2**32, (trees, level), dtype=np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    at = bounds[full]
    low = (flat >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(full), trees), np.uint64)
    for t in range(trees):
        label = np.full(len(full), t + 1, np.uint64)
        for d in range(level):
            v = low ^ flips[t, d]
            v *= factors[t, d]
            v ^= v >> np.uint32(15)
            v *= np.uint32(0x2C1B3C6D)
            label = words.mix(label * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(v, at))
        out[:, t] = label
    return full, out


def _sketch(n: int, trees: int, level: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, keys, flat, bounds in _shingles(batch.column("text"), n):
                counts = np.zeros(j - i, np.int64)
                nodes = np.empty((0, trees), np.uint64)
                if len(flat):
                    full, nodes = _nodes(flat, bounds, trees, level, seed)
                    counts[full] = trees
                yield pa.record_batch(
                    {
                        "rid": batch.column("rid")[i:j],
                        "tk": batch.column("tk")[i:j],
                        "n": pa.array(np.diff(bounds), pa.int32()),
                        "k1": pa.array(keys[0]),
                        "k2": pa.array(keys[1]),
                        "nodes": lists(
                            nodes.reshape(-1).view(np.int64), np.concatenate([[0], np.cumsum(counts)]), pa.int64()
                        ),
                    }
                )

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, _, flat, bounds in _shingles(batch.column("text"), n):
                columns = {c: batch.column(c)[i:j] for c in ("comp", "cells", "block", "rep", "size")}
                columns["shingles"] = binaries([flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])])
                yield pa.record_batch(columns)

    return run


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of how many shingles each two sets share."""
    m = len(sets)
    doc = np.repeat(np.arange(m), [len(s) for s in sets])
    value = np.concatenate(sets)
    order = np.argsort(value, kind="stable")
    value, doc = value[order], doc[order]
    column = np.cumsum(np.concatenate([[0], value[1:] != value[:-1]]))
    df = np.bincount(column)
    common = df[column] > _RARE
    shared = np.zeros((m, m), np.float32)
    rare_doc, rare_col = doc[~common], column[~common]
    for step in range(1, _RARE):
        same = np.flatnonzero(rare_col[step:] == rare_col[:-step])
        if not len(same):
            break
        np.add.at(shared, (rare_doc[same], rare_doc[same + step]), 1)
    shared += shared.T
    doc, column = doc[common], np.unique(column[common], return_inverse=True)[1]
    wide = 4096
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + wide, wide))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            dense = np.zeros((m, wide), np.float32)
            dense[doc[a:b], column[a:b] % wide] = 1
            shared += dense @ dense.T
    return shared


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in groups(batches, ["comp", "a", "b"]):
            rep = np.asarray(cell.column("rep"))
            rep, at = np.unique(rep, return_index=True)
            block = np.asarray(cell.column("block"))[at]
            size = np.asarray(cell.column("size"))[at]
            raw = cell.column("shingles")
            sets = [np.frombuffer(raw[k].as_py(), np.uint64) for k in at.tolist()]
            counts = np.array([len(s) for s in sets], np.float64)
            shared = _shared_counts(sets)
            both = counts[:, None] + counts[None, :] - shared
            linked = shared >= threshold * both - 1e-9
            np.fill_diagonal(linked, False)
            if cell.column("a")[0].as_py() != cell.column("b")[0].as_py():
                linked &= block[:, None] != block[None, :]
            links = linked @ size
            hit = np.flatnonzero(links)
            if len(hit):
                root = roots(len(rep), *np.nonzero(linked))
                yield pa.record_batch(
                    {
                        "rep": pa.array(rep[hit], pa.int64()),
                        "root": pa.array(rep[root[hit]], pa.int64()),
                        "links": pa.array(links[hit], pa.int64()),
                    }
                )

    return run


def _cells(members: DataFrame, threshold: float) -> DataFrame:
    """(comp, cells, block, cid, rep, tk, size): the cells each member is compared in.

    A small component is one cell. A large one is dealt by set size, as linked
    sets differ in size by the threshold at most, and each size class is salted
    into blocks of bounded size; every two blocks of the same or of
    neighbouring classes meet in one cell.
    """
    width = math.log(1 / threshold) * (1 + 1e-9)
    members = members.withColumn("sc", F.floor(F.log("n") / F.lit(width)).cast("int"))
    classes = members.groupBy("comp", "sc").agg(F.count("*").alias("docs"), F.sum("n").alias("total"))
    blocks = F.ceil(F.greatest(F.col("docs") / BLOCK_DOCS, F.col("total") / BLOCK_SHINGLES)).cast("int")
    # A component has as many classes as the logarithm of its largest set at most.
    classes = classes.withColumn("nb", blocks).groupBy("comp")
    classes = classes.agg(
        F.map_from_entries(F.collect_list(F.struct("sc", "nb"))).alias("nb"),
        F.sum("docs").alias("docs"),
        F.sum("total").alias("total"),
    ).select("comp", "nb", (blocks == 1).alias("small"))
    code = lambda sc, s: F.shiftleft(sc.cast("bigint"), 32) + s
    sc, own = F.col("sc"), F.col("s")
    pair = lambda a, b: F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    salts = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cells = F.concat(
        F.transform(salts("here"), lambda x: pair(code(sc, F.least(x, own)), code(sc, F.greatest(x, own)))),
        F.when(F.col("above") > 0, F.transform(salts("above"), lambda x: pair(code(sc, own), code(sc + 1, x)))).otherwise(none),
        F.when(F.col("below") > 0, F.transform(salts("below"), lambda x: pair(code(sc - 1, x), code(sc, own)))).otherwise(none),
    )
    one = F.array(pair(F.lit(-1), F.lit(-1)))
    return (
        members.join(classes, "comp")
        .withColumns({"here": F.col("nb")[sc], "above": F.col("nb")[sc + 1], "below": F.col("nb")[sc - 1]})
        .withColumn("s", F.pmod(F.xxhash64("cid"), F.col("here")).cast("int"))
        .select(
            "comp",
            F.when(F.col("small"), one).otherwise(cells).alias("cells"),
            F.when(F.col("small"), F.lit(-1)).otherwise(code(sc, own)).cast("bigint").alias("block"),
            "cid",
            "rep",
            "tk",
            "size",
        )
    )


def join_similar(
    spark: SparkSession,
    docs: DataFrame,
    threshold: float = 0.8,
    n: int = 5,
    trees: int = 32,
    depth: int = 8,
    recall: float = 0.99999,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id, n_links, component_id, kept.

    ``class_id`` is the smallest id whose text holds exactly the same words,
    ``n_links`` the number of other documents whose n-gram sets have a Jaccard
    measure of at least ``threshold`` (copies included), ``component_id`` the
    smallest id reachable by links, ``kept`` whether the row has that id.

    Defined cases: a text without words links with nothing and is a class
    alone; a text of fewer than n words has one shingle, all its words; a null
    id links with nothing (its ids are null, it is kept); a repeated row counts
    once as a document and is returned each time; different texts under one id each
    have their own row of links and share a component. A very long text is hashed
    whole, its words are held at once. Columns other than id and text are ignored,
    whatever their names. Links found are exact; a pair at the threshold is
    missed with probability 1 - recall at most, similar pairs far less often.
    """
    level = matched_depth(threshold, trees, depth, recall)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("rid"),
        F.xxhash64(F.col(text_col)).alias("tk"),
        F.col(text_col).cast("string").alias("text"),
    )
    sketch = stored(
        spark,
        rows.mapInArrow(
            _sketch(n, trees, level, seed), "rid bigint, tk bigint, n int, k1 bigint, k2 bigint, nodes array<bigint>"
        ),
        "sketch",
    )
    known = sketch.where((F.col("n") > 0) & (F.col("rid") != _NO_ID))
    key = ["k1", "k2", "n"]
    classes = stored(
        spark,
        known.groupBy(*key, "rid")
        .agg(F.min("tk").alias("tk"))
        .groupBy(*key)
        .agg(F.min("rid").alias("rep"), F.min_by("tk", "rid").alias("tk"), F.count("*").alias("size"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    at = known.join(classes.select("cid", "rep", "tk", *key), [*key, "tk"]).where("rid = rep")
    # A row that is repeated brings its nodes again; chains do not mind.
    at = at.select("cid", F.explode("nodes").alias("node"))
    heads = at.groupBy("node").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo < hi")
    chains = at.join(heads.select("node", "lo"), "node").where("cid > lo")
    found = components(chains.select(F.col("lo").alias("a"), F.col("cid").alias("b")))
    members = classes.join(found.select(F.col("node").alias("cid"), F.col("component").alias("comp")), "cid")
    cells = stored(spark, _cells(members, threshold), "cells")
    sets = (
        rows.join(cells.withColumnRenamed("rep", "rid"), ["rid", "tk"])
        .select("comp", "cells", "block", F.col("cid").alias("rep"), "size", "text")
        .mapInArrow(
            _sets(n),
            "comp bigint, cells array<struct<a:bigint,b:bigint>>, block bigint, rep bigint, size bigint, "
            "shingles binary",
        )
        .select("comp", F.explode("cells").alias("cell"), "block", "rep", "size", "shingles")
        .select("comp", "cell.a", "cell.b", "block", "rep", "size", "shingles")
    )
    linked = stored(
        spark,
        sets.repartition("comp", "a", "b")
        .sortWithinPartitions("comp", "a", "b")
        .mapInArrow(_verify(threshold), "rep bigint, root bigint, links bigint"),
        "links",
    )
    counts = linked.groupBy(F.col("rep").alias("cid")).agg(F.sum("links").alias("links"))
    components_of = class_components(
        classes, known.select("rid", *key), key, linked.select(F.col("rep").alias("a"), F.col("root").alias("b"))
    )
    result = (
        classes.join(counts, "cid", "left")
        .join(components_of, "cid", "left")
        .select(
            *key,
            F.col("rep").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    )
    own = F.when(F.col("rid") != _NO_ID, F.col("rid"))
    return (
        sketch.select("rid", *key, ((F.col("n") > 0) & (F.col("rid") != _NO_ID)).alias("known"))
        .join(result.withColumn("known", F.lit(True)), [*key, "known"], "left")
        .select(
            own.alias("doc_id"),
            F.coalesce("class_id", own).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", own).alias("component_id"),
            F.coalesce(F.col("component_id") == own, F.lit(True)).alias("kept"),
        )
    )
