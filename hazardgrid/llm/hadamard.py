"""Centroid clustering with an exact integer Walsh-Hadamard search.

Vectors become integers and are transformed once; the transform is orthogonal up
to the factor 64, so distances can be added up coefficient by coefficient, from
coarse to fine. A centroid whose part of the sum already exceeds a distance that
another centroid reaches in full is strictly worse and leaves the search; those
that stay are summed over all 64 coefficients. Everything is exact.

A round is one pass over the stored coefficients: each task returns a count and
64 sums per centroid, and the driver gets as many rows as there are centroids.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid.llm.batches import binaries, stored

DIM, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, "3"
#: Ends of the groups of coefficients that are added up at once.
BANDS = (1, 2, 4, 8, 16, 32, 64)
#: Pairs of a vector and a centroid that are compared at once.
PAIRS = 1 << 16
#: Components beyond it would not leave room for their transform in a long.
WIDEST = 1 << 56
_NARROW = 1 << 28
_LONG = (1 << 63) - 1


def _sequency(n: int) -> np.ndarray:
    """Coefficients by their number of sign changes, slowest first."""
    signs = transform(np.eye(n, dtype=np.int64), order=None)
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def transform(x: np.ndarray, order: np.ndarray | None) -> np.ndarray:
    """Walsh-Hadamard transform of the rows, exact in integers of any kind."""
    n = x.shape[1]
    half = 1
    while half < n:
        pairs = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x if order is None else x[:, order]


ORDER = _sequency(DIM)


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can be used, and their components as integers."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    rows = np.flatnonzero(lengths == DIM)
    values = column.take(pa.array(rows)).flatten()
    full = np.asarray(values.is_valid()).reshape(-1, DIM).all(axis=1)
    x = np.asarray(values.fill_null(0.0), np.float64).reshape(-1, DIM)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(x * SCALE)
        good = full & (np.abs(x) < WIDEST).all(axis=1)
    return rows[good], x[good].astype(np.int64)


def _coefficients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, x = integers(batch.column("v"))
        h = transform(x, ORDER).astype("<i8")
        yield pa.record_batch(
            {"vid": batch.column("vid").take(pa.array(rows)), "h": binaries([r.tobytes() for r in h])}
        )


def search(h: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and 64 times the squared distance to it."""
    n, k = len(h), len(centroids)
    first = h[:, :1] - centroids[None, :, 0]
    part = first * first
    guess = np.asarray(np.argmin(part, axis=1))
    rest = h - centroids[guess]
    bound = (rest * rest).sum(axis=1)
    alive = part <= bound[:, None]
    for low, high in zip(BANDS[:-1], BANDS[1:]):
        row, number = np.nonzero(alive)
        rest = h[row, low:high] - centroids[number, low:high]
        part[row, number] += (rest * rest).sum(axis=1)
        alive[row, number] = part[row, number] <= bound[row]
    part[~alive] = (bound.max() if n else 0) + 1
    best = np.asarray(np.argmin(part, axis=1))
    return best, part[np.arange(n), best]


def _nearest(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    """(ids, coefficients, cluster, squared distance) of bounded parts of the batches."""
    widest = int(np.abs(centroids).max())
    step = max(PAIRS // len(centroids), 1)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            h = np.frombuffer(b"".join(part.column("h").to_pylist()), "<i8").reshape(-1, DIM)
            if int(np.abs(h).max()) + widest >= _NARROW:
                h, c = h.astype(object), centroids.astype(object)
            else:
                h, c = h, centroids.astype(np.int64)
            cluster, distance = search(h, c)
            yield part.column("vid"), h, cluster, distance // DIM


def _sums(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        count, sums = [0] * k, np.zeros((k, DIM), object)
        for _, h, cluster, _ in _nearest(batches, centroids):
            for c in np.unique(cluster).tolist():
                own = h[cluster == c]
                count[c] += len(own)
                wide = own.dtype == object or int(np.abs(own).max()) > _LONG // len(own)
                sums[c] += own.astype(object if wide else np.int64).sum(axis=0).astype(object)
        found = [c for c in range(k) if count[c]]
        yield pa.record_batch(
            {
                "cluster": pa.array(found, pa.int32()),
                "n": pa.array([count[c] for c in found], pa.int64()),
                "sums": pa.array(
                    [[Decimal(int(s)) for s in sums[c]] for c in found], pa.list_(pa.decimal128(38, 0))
                ),
            }
        )

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for vid, _, cluster, distance in _nearest(batches, centroids):
            fits = [int(d) if d <= _LONG else None for d in distance]
            yield pa.record_batch(
                {
                    "vec_id": vid,
                    "cluster": pa.array(cluster, pa.int32()),
                    "distance": pa.array(fits, pa.int64()),
                }
            )

    return run


def _moved(old: np.ndarray, rows: list) -> np.ndarray:
    """Centroids after a round: exact floor of the mean; empty clusters keep theirs."""
    new = old.copy()
    undo = np.argsort(ORDER)
    for row in rows:
        sums = np.array([[int(row[f"s{i}"]) for i in range(DIM)]], object)[:, undo]
        new[row["cluster"]] = transform(sums, order=None)[0] // DIM // row["n"]
    return new


def cluster(
    spark: SparkSession,
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: str = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    A vector is used if it has 64 components, none null or non-finite; component x
    counts as the integer floor(1024 * x). The k vectors whose ``seed:id`` has the
    least SHA-256 are the first centroids; ``rounds`` times every vector goes to the
    nearest one and every non-empty centroid becomes the floor of its vectors' mean.

    Defined cases: other vectors (null, empty, another length) are left out, and so
    are those with a component of 2^56 or more after scaling; a null id takes part
    but is no first centroid; every repeated row counts, and repeated ids follow
    each other by components when centroids are chosen; of equally near centroids
    the smaller number wins; with fewer than k vectors there are fewer centroids; a
    distance or sum that no long can hold is null; an empty table gives an empty
    one; columns other than id and vector are ignored, whatever their names.
    """
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vid"), F.col(vector_col).cast("array<double>").alias("v")
    )
    known = stored(spark, rows.mapInArrow(_coefficients, "vid bigint, h binary"), "coefficients")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vid").cast("string")), 256)
    fits = (F.size("v") == DIM) & F.forall("v", lambda x: x.isNotNull() & (F.abs(x * SCALE) < float(WIDEST)))
    first = rows.where(F.col("vid").isNotNull() & fits).orderBy(key, "vid", "v").limit(k).select("v").collect()
    schema = "vec_id bigint, cluster int, distance bigint"
    if not first:
        end = ", cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], schema + end)
    centroids = np.array([[math.floor(x * SCALE) for x in r["v"]] for r in first], object)
    for _ in range(rounds):
        parts = known.mapInArrow(
            _sums(transform(centroids, ORDER)), "cluster int, n bigint, sums array<decimal(38,0)>"
        )
        totals = parts.groupBy("cluster").agg(
            F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(DIM)]
        )
        centroids = _moved(centroids, totals.collect())  # a row per centroid
    found = stored(spark, known.mapInArrow(_assigned(transform(centroids, ORDER)), schema), "assigned")
    totals = (
        found.groupBy("cluster")
        .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"), F.count_if(F.col("distance").isNull()).alias("m"))
        .collect()  # a row per centroid
    )
    fit = lambda d, missing: int(d) if not missing and d <= _LONG else None
    missing = sum(t["m"] for t in totals)
    whole = fit(sum(int(t["d"] or 0) for t in totals), missing)
    digest = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    ends = [(t["cluster"], fit(int(t["d"] or 0), t["m"]), whole, digest[t["cluster"]]) for t in totals]
    return found.join(
        spark.createDataFrame(ends, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"),
        "cluster",
    ).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
