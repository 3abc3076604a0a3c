import hashlib

import numpy as np

from hazardgrid.llm import hadamard, queries
from tests.llm import brute
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


def check(spark, rows, **more):
    schema = "vec_id BIGINT, embedding ARRAY<DOUBLE>, cluster INT, h STRING"
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], schema)
    got = hadamard.cluster(spark, df, **more)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute.clusters(rows, **more), key=key)


def test_query_equals_sql_and_brute_force(spark):
    df = queries.QUERIES["op12_centroid_clustering"](spark, SF)
    assert compare(df, connect(SF), queries.ORACLES["op12_centroid_clustering"]) == []
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, df.collect())) == sorted(brute.clusters(rows))


def test_transform_keeps_distances_and_inverts():
    x = np.random.default_rng(1).integers(-2000, 2000, (9, 64))
    h = hadamard.transform(x, hadamard.ORDER)
    assert (((h[0] - h[1:]) ** 2).sum(1) == 64 * ((x[0] - x[1:]) ** 2).sum(1)).all()
    assert (hadamard.transform(h[:, np.argsort(hadamard.ORDER)], None) == 64 * x).all()


def test_search_finds_the_smallest_number_of_equally_near_ones():
    rng = np.random.default_rng(2)
    x, c = rng.integers(-3, 4, (500, 64)), rng.integers(-3, 4, (12, 64))
    c[7], c[11] = c[2], c[4]
    best, d = hadamard.search(hadamard.transform(x, hadamard.ORDER), hadamard.transform(c, hadamard.ORDER))
    full = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (d == 64 * full.min(1)).all()


def test_ties_repeated_rows_and_empty_clusters(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-2, 3, (6, 64)) / 1024
    rows = [(int(i), [float(x) for x in base[i % 6]]) for i in range(60)] + [(5, [0.0] * 64), (5, [0.0] * 64)]
    check(spark, rows)
    check(spark, rows[:3], k=8, rounds=2)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    ones = [1.0] * 64
    rows = [(i, [float((i * j) % 7) - 3.5 for j in range(64)]) for i in range(20)]
    rows += [(100, None), (101, []), (102, ones[:63]), (103, [*ones, 1.0]), (104, [nan, *ones[1:]])]
    rows += [(105, [inf, *ones[1:]]), (106, [None, *ones[1:]]), (None, ones), (107, [1e300, *ones[1:]])]
    check(spark, rows)
    assert hadamard.cluster(spark, spark.createDataFrame([], "vec_id INT, embedding ARRAY<FLOAT>")).count() == 0


def test_wide_components_are_exact(spark):
    rows = [(i, [1e6 * ((i * j) % 5) + i / 3 for j in range(64)]) for i in range(30)]
    check(spark, rows)
    far = [(i, [1e12 * (i % 3)] * 64) for i in range(9)]
    check(spark, [*rows, *far])


def test_centroid_digest_is_of_decimal_integers():
    assert brute.clusters([(1, [0.5] * 64)])[0][5] == hashlib.sha256(",".join(["512"] * 64).encode()).hexdigest()
