"""Exact range join of vectors by angle, with pivots and the triangle inequality.

Pivots split the vectors into cells: the nearest pivot, then rings of angle
around it. A cell knows the least and the greatest angle of its members to its
pivot; a vector is copied to a cell only if the triangle inequality leaves room
for a neighbour there. Cells are cut into blocks of bounded size, and every two
blocks that may hold neighbours are compared on their own, in double precision.

Angles are a metric, so nothing is lost. How much is pruned depends on the data:
vectors without any clusters are nearly equally far from every pivot, and then
most blocks meet; that is in the nature of the problem.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardgrid.llm.batches import binaries, groups, stored
from hazardgrid.llm.graph import class_components, roots

_NO_ID = -(1 << 63)
#: Rows of a block, and pivots at most.
BLOCK_ROWS, MAX_PIVOTS = 8192, 256
#: Room for rounding of angles; comparisons themselves are not affected.
_SLACK = 1e-6


def _usable(kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = np.asarray(batch.column("rid"))
            raw = []
            for v in batch.column("v"):
                values = v.values
                fits = v.is_valid and len(values) > 0 and values.null_count == 0
                x = np.asarray(values, kind) if fits else None
                good = fits and np.isfinite(x).all() and x.any()
                raw.append(x.tobytes() if good else None)
            yield pa.record_batch({"rid": pa.array(rids, pa.int64()), "vec": binaries(raw)})

    return run


def _matrix(column, kind) -> np.ndarray:
    """Unit rows in double precision."""
    x = np.frombuffer(b"".join(v.as_py() for v in column), kind).reshape(len(column), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1, 1))


def _home(pivots: np.ndarray, width: float, kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                angle = _angles(_matrix(batch.column("vec"), kind), pivots)
                near = angle.argmin(axis=1)
                own = angle[np.arange(len(near)), near]
                yield pa.record_batch(
                    {c: batch.column(c) for c in ("cid", "size", "vec", "salt")}
                    | {
                        "pivot": pa.array(near, pa.int32()),
                        "ring": pa.array((own / width).astype(np.int32)),
                        "angle": pa.array(own),
                    }
                )

    return run


def _deal(pivots: np.ndarray, cells: list, reach: float, kind):
    """Copy every vector to the pairs of blocks in which it may have a neighbour."""
    index = {(p, r): k for k, (p, r, *_) in enumerate(cells)}
    first = np.cumsum([0] + [c[4] for c in cells])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                angle = _angles(_matrix(part.column("vec"), kind), pivots)
                own = np.asarray(part.column("angle"))
                cid = np.asarray(part.column("cid"))
                cell = np.array([index[k] for k in zip(part.column("pivot").to_pylist(), part.column("ring").to_pylist())])
                counts = np.array([c[4] for c in cells])[cell]
                block = first[cell] + np.asarray(part.column("salt")) % counts
                for k, (p, _, low, high, blocks) in enumerate(cells):
                    away = angle[:, p]
                    may = (away >= low - reach) & (away <= high + reach) & (away <= own + 2 * reach)
                    may |= cell == k
                    rows = np.flatnonzero(may)
                    for b in range(int(first[k]), int(first[k]) + blocks) if len(rows) else ():
                        yield pa.record_batch(
                            {
                                "a": pa.array(np.minimum(block[rows], b), pa.int32()),
                                "b": pa.array(np.maximum(block[rows], b), pa.int32()),
                                "block": pa.array(block[rows], pa.int32()),
                                "cid": pa.array(cid[rows], pa.int64()),
                                "size": part.column("size").take(pa.array(rows)),
                                "vec": part.column("vec").take(pa.array(rows)),
                            }
                        )

    return run


def _compare(least: float, kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in groups(batches, ["a", "b"]):
            cid, size = np.asarray(cell.column("cid")), np.asarray(cell.column("size"))
            block = np.asarray(cell.column("block"))
            a, b = cell.column("a")[0].as_py(), cell.column("b")[0].as_py()
            left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
            if not len(left) or not len(right):
                continue
            unit = _matrix(cell.column("vec"), kind)
            links = np.zeros(len(cid), np.int64)
            label = np.arange(len(cid))
            other = unit[right].T.copy()
            for i in range(0, len(left), 256):
                rows = left[i : i + 256]
                hit = unit[rows] @ other >= least
                if a == b:
                    hit &= rows[:, None] != right[None, :]
                x, y = np.nonzero(hit)
                if not len(x):
                    continue
                links[rows] += hit @ size[right]
                if a != b:
                    links[right] += size[rows] @ hit
                every = np.arange(len(cid))
                label = roots(len(cid), np.concatenate([every, rows[x]]), np.concatenate([label, right[y]]))
            found = np.flatnonzero(links)
            if len(found):
                yield pa.record_batch(
                    {
                        "a": pa.array(cid[found], pa.int64()),
                        "b": pa.array(cid[label[found]], pa.int64()),
                        "links": pa.array(links[found], pa.int64()),
                    }
                )

    return run


def _links_of_one_length(
    spark: SparkSession, vectors: DataFrame, n: int, cosine: float, block_rows: int, kind
) -> DataFrame:
    """(a, b, links) of ``n`` vectors (cid, size, vec, salt) of one length: pivots, rings, blocks."""
    pivots = vectors.orderBy("salt", "cid").limit(min(max(-(-n // block_rows), 1), MAX_PIVOTS)).select("vec").collect()
    width = math.acos(cosine)
    centers = _matrix(pa.array([bytes(p["vec"]) for p in pivots], pa.binary()), kind)
    homes = stored(
        spark,
        vectors.mapInArrow(
            _home(centers, width, kind),
            "cid bigint, size bigint, vec binary, salt bigint, pivot int, ring int, angle double",
        ),
        "homes",
    )
    cells = (
        homes.groupBy("pivot", "ring")
        .agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("n"))
        .orderBy("pivot", "ring")
        .collect()  # a few rings of each pivot
    )
    cells = [(c["pivot"], c["ring"], c["low"], c["high"], -(-c["n"] // block_rows)) for c in cells]
    pairs = homes.mapInArrow(_deal(centers, cells, width + _SLACK, kind), _BLOCKS)
    linked = pairs.repartition("a", "b").sortWithinPartitions("a", "b")
    return linked.mapInArrow(_compare(cosine, kind), "a bigint, b bigint, links bigint")


_BLOCKS = "a int, b int, block int, cid bigint, size bigint, vec binary"


def join_near(
    spark: SparkSession,
    vectors: DataFrame,
    cosine: float = 0.9,
    block_rows: int | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other vectors with a cosine of at least ``cosine``
    (in double precision), ``component_id`` is the smallest id reachable by
    links, itself included. Equal vectors are compared once, through their
    smallest id.

    Defined cases: a vector that is null, empty, zero or has null or non-finite
    components links with nothing; so does a null id (its component is null, it is
    kept); vectors of different lengths do not link; a repeated row counts once;
    different vectors under one id each have their own row of links and share a
    component; an empty table gives an empty one; columns other than id and vector
    are ignored, whatever their names.
    """
    block_rows = block_rows or BLOCK_ROWS
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"
    rows = vectors.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("rid"),
        F.col(vector_col).cast("array<float>" if single else "array<double>").alias("v"),
    )
    known = stored(spark, rows.mapInArrow(_usable(kind), "rid bigint, vec binary"), "vectors")
    usable = known.where((F.col("rid") != _NO_ID) & F.col("vec").isNotNull())
    classes = usable.distinct().groupBy("vec").agg(F.min("rid").alias("rep"), F.count("*").alias("size"))
    classes = classes.withColumn("bytes", F.octet_length("vec")).withColumn("cid", F.monotonically_increasing_id())
    classes = stored(spark, classes, "classes")
    salt = F.pmod(F.xxhash64("rep", "vec"), F.lit(1 << 30))
    joining = classes.select("cid", "size", "vec", "bytes", salt.alias("salt"))
    sizes = joining.groupBy("bytes").count().collect()  # a row per length of vectors
    large = [r for r in sizes if r["count"] > block_rows]
    # Vectors of a length that fit one block need no pivots: they are its only cell.
    small = joining.where(~F.col("bytes").isin([r["bytes"] for r in large])) if large else joining
    cells = small.select(
        F.col("bytes").alias("a"), F.col("bytes").alias("b"), F.col("bytes").alias("block"), "cid", "size", "vec"
    )
    cells = cells.repartition("a", "b").sortWithinPartitions("a", "b")
    linked = cells.mapInArrow(_compare(cosine, kind), "a bigint, b bigint, links bigint")
    for r in large:
        own = joining.where(F.col("bytes") == r["bytes"]).drop("bytes")
        linked = linked.union(_links_of_one_length(spark, own, r["count"], cosine, block_rows, kind))
    linked = stored(spark, linked, "links")
    counts = linked.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    joined = class_components(classes, usable, ["vec"], linked.select("a", "b"))
    result = (
        classes.join(counts, "cid", "left")
        .join(joined, "cid", "left")
        .select(
            "vec",
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    )
    own = F.when(F.col("rid") != _NO_ID, F.col("rid"))
    return (
        known.withColumn("vec", F.when(F.col("rid") != _NO_ID, F.col("vec")))
        .join(result, "vec", "left")
        .select(
            own.alias("vec_id"),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", own).alias("component_id"),
            F.coalesce(F.col("component_id") == own, F.lit(True)).alias("kept"),
        )
    )
