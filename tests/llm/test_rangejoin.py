import math

import numpy as np
import pytest

from hazardgrid.llm import graph, queries, rangejoin
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def near(vectors, cosine=0.9):
    """vectors: {id: list or None} -> {id: (n_links, component_id)}."""
    good = {
        i: np.array(v, float)
        for i, v in vectors.items()
        if v is not None and None not in v and np.isfinite(v).all() and np.any(v)
    }
    links = []
    for i, x in good.items():
        for j, y in good.items():
            if i < j and len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= cosine:
                links.append((i, j))
    comp = brute.components(vectors, links)
    count = dict.fromkeys(vectors, 0)
    for pair in links:
        for i in pair:
            count[i] += 1
    return {i: (count[i], comp[i]) for i in vectors}


def outcome(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_query_equals_brute_force(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    assert outcome(queries.QUERIES["op3_embedding_near_dedup"](spark, SF)) == near(vectors)


@pytest.mark.parametrize("block_rows", [16, 100])
def test_many_cells_and_hot_cluster(spark, block_rows):
    rng = np.random.default_rng(block_rows)
    centers = rng.normal(size=(6, 8))
    pick = rng.choice(6, 400, p=[0.5, 0.1, 0.1, 0.1, 0.1, 0.1])
    x = centers[pick] + rng.normal(size=(400, 8)) * 0.25
    x[50:80] = x[50]
    vectors = {i: [float(c) for c in v] for i, v in enumerate(x)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    assert outcome(rangejoin.join_near(spark, df, block_rows=block_rows)) == near(vectors)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0]),
        (2, [2.0, 0.0]),
        (3, [0.0, 0.0]),
        (4, None),
        (5, [nan, 1.0]),
        (6, [inf, 1.0]),
        (7, [None, 1.0]),
        (8, [1.0]),
        (9, []),
        (10, [-1.0, 0.0]),
        (11, [1e-30, 1e-31]),
        (12, [1.0, 0.0]),
        (12, [1.0, 0.0]),
    ]
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>, rep STRING, size INT"
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in [*rows, (None, [1.0, 0.0])]], schema)
    got = rangejoin.join_near(spark, df).collect()
    want = near(dict(rows))
    assert len(got) == len(rows) + 1
    for r in got:
        assert (r.n_links, r.component_id) == want.get(r.vec_id, (0, None))
        assert r.kept == (r.vec_id == r.component_id)
    assert rangejoin.join_near(spark, df.limit(0)).count() == 0


def test_every_vector_under_an_id_and_of_every_length_links(spark):
    rows = [
        (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (4, [1.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.01]),
        (6, [5.0]), (7, [2.0]), (7, [2.0]), (8, [-1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    for block_rows in (1, 2, 100):
        got = sorted((r.vec_id, r.n_links, r.component_id) for r in rangejoin.join_near(spark, df, block_rows=block_rows).collect())
        assert got == [
            (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 6), (7, 1, 6), (8, 0, 8),
        ]


def test_integers_are_compared_in_double_precision(spark):
    rows = [(1, [100_000_001, 7]), (2, [100_000_003, 9]), (3, [-1, 1])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<BIGINT>")
    got = {r.vec_id: r.n_links for r in rangejoin.join_near(spark, df).collect()}
    assert got == {1: 1, 2: 1, 3: 0}


def test_components_by_contraction_equal_the_local_finish(spark, monkeypatch):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(i, i + 1) for i in range(200, 240)]
    df = spark.createDataFrame(edges, "a BIGINT, b BIGINT")
    want = brute.components({x for e in edges for x in e}, edges)
    assert {r.node: r.component for r in graph.components(df).collect()} == want
    monkeypatch.setattr(graph, "LOCAL_EDGES", 1)
    assert {r.node: r.component for r in graph.components(df).collect()} == want
