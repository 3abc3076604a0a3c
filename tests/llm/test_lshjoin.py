import random

import numpy as np
import pytest

from hazardgrid.llm import lshjoin, queries
from hazardgrid.llm.graph import components
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = brute.similar(docs)
    got = queries.QUERIES["op2_ngram_jaccard_join"](spark, SF).collect()
    assert {r.doc_id: (r.class_id, r.n_links, r.component_id) for r in got} == want
    assert len(got) == len(docs) and all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_group_of_near_copies_over_several_cells(spark, monkeypatch):
    monkeypatch.setattr(lshjoin, "BLOCK_DOCS", 7)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    docs = {}
    for d in range(60):
        w = list(base[: rng.choice([100, 110, 120])])
        for _ in range(rng.choice([0, 1, 2, 3])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        docs[d] = " ".join(w)
    df = spark.createDataFrame(list(docs.items()), "doc_id BIGINT, text STRING")
    got = lshjoin.join_similar(spark, df).collect()
    assert {r.doc_id: (r.class_id, r.n_links, r.component_id) for r in got} == brute.similar(docs)


def test_odd_rows(spark):
    rows = [
        (1, "a b c"),
        (2, "a\tb c"),
        (3, None),
        (4, ""),
        (5, " \n"),
        (6, "a b c d"),
        (7, "z " * 3000),
        (8, "z " * 2000),
        (None, "a b c"),
        (1, "a b c"),
        (9, "q"),
    ]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id BIGINT, text STRING, rep STRING, comp INT")
    got = lshjoin.join_similar(spark, df).collect()
    plain = {d: t for d, t in rows if d is not None}
    want = brute.similar(plain)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.class_id, r.n_links, r.component_id) == want[r.doc_id]
    empty = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert lshjoin.join_similar(spark, empty).count() == 0


def test_prefixes_shorten_until_the_recall_is_met():
    assert lshjoin.matched_depth(0.8, 32, 8, 0.99999) == 5
    assert lshjoin.matched_depth(0.8, 32, 8, 0.9) == 8
    with pytest.raises(ValueError):
        lshjoin.matched_depth(0.1, 1, 8, 0.99)


def test_minima_estimate_the_measure():
    rng = np.random.default_rng(0)
    both = rng.integers(0, 2**64, 800, dtype=np.uint64)
    a, b = rng.integers(0, 2**64, (2, 100), dtype=np.uint64)
    flat = np.concatenate([np.unique(np.concatenate([both, x])) for x in (a, b)])
    _, nodes = lshjoin._nodes(flat, np.array([0, 900, 1800]), 2000, 1, 5)
    assert abs((nodes[0] == nodes[1]).mean() - 0.8) < 0.03


def test_components_of_a_long_path_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (7, 7), (900, 901), (901, 900)]
    df = spark.createDataFrame(edges, "a BIGINT, b BIGINT")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 900: 900, 901: 900}


def test_every_text_under_an_id_links(spark):
    """Two texts under id 1, one near the text of 2, the other near that of 3."""
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, one), (1, two), (2, one + " z"), (3, two + " z"), (4, "other words alone"), (4, two), (5, "other words alone")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = sorted((r.doc_id, r.class_id, r.n_links, r.component_id) for r in lshjoin.join_similar(spark, df).collect())
    assert found == [(1, 1, 1, 1), (1, 1, 2, 1), (2, 2, 1, 1), (3, 3, 2, 1), (4, 1, 2, 1), (4, 4, 1, 1), (5, 4, 1, 1)]
