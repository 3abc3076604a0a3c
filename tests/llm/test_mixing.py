from collections import Counter

import pytest

from hazardgrid.llm import mixing, queries
from tests.llm import brute
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


def corpus(spark, sizes, source_of):
    rows = [(d, " ".join(f"w{d}_{i}" for i in range(n)), source_of(d)) for d, n in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")


def targets(sizes, weights=(1, 2, 3), ceiling=3):
    """sizes: {source: words} in order -> {source: target} by cutting and sharing again."""
    w = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    cut = set()
    while True:
        left = sum(sizes.values()) - sum(ceiling * sizes[s] for s in cut)
        share = {s: left * w[s] / sum(w[x] for x in sizes if x not in cut) for s in sizes if s not in cut}
        over = {s for s in share if share[s] >= ceiling * sizes[s]}
        if not over:
            return {s: ceiling * sizes[s] if s in cut else share[s] for s in sizes}
        cut |= over


def test_query_equals_sql_and_runs_agree(spark):
    con = connect(SF)
    for _ in range(2):
        got = queries.QUERIES["op4_source_mixing"](spark, SF)
        assert compare(got, con, queries.ORACLES["op4_source_mixing"]) == []


def test_sources_come_near_their_targets(spark):
    sizes = [5 + (d * 37) % 400 for d in range(400)]
    names = ["big", "mid", "tiny", "Ä", None]
    source = lambda d: names[0] if d < 300 else names[1] if d < 380 else names[2] if d < 383 else names[3 + d % 2]
    plan = mixing.plan_mix(spark, corpus(spark, sizes, source), block=16, shard_words=2000).collect()
    own, taken, target = Counter(), Counter(), {}
    for r in plan:
        own[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert all(r.source_size == own[r.source] for r in plan)
    order = sorted((s for s in own if s is not None)) + [None]
    want = targets({s: own[s] for s in order})
    for s in order:
        assert target[s] == pytest.approx(want[s])
        # A block from the quota, and the short last block of each shard in each pass.
        assert abs(taken[s] - target[s]) <= 16 * (2 + 3 * own[s] / 2000)
    assert target["tiny"] == taken["tiny"] == 3 * own["tiny"]


def seats(weights, n):
    won = dict.fromkeys(weights, 0)
    for _ in range(n):
        best = min(weights, key=lambda k: (-weights[k] / (2 * won[k] + 1), k))
        won[best] += 1
    return won


@pytest.mark.parametrize("n", [0, 1, 5, 23, 400])
def test_apportionment_equals_seat_by_seat(spark, n):
    weights = {1: 7, 2: 7, 3: 1, 4: 0, 5: 90, 6: 33, 7: 2}
    df = spark.createDataFrame([("g", k, w, n) for k, w in weights.items()], "g STRING, k BIGINT, w BIGINT, n BIGINT")
    for group in (None, "g"):
        got = {r.k: r.won for r in mixing._seats(df, group, "n", "w", "k", "won").collect()}
        assert got == seats(weights, n)


def test_mixed_documents_are_what_the_plan_takes(spark):
    df = corpus(spark, [3, 40, 200, 7, 0, 90, 500, 64, 64, 1], lambda d: f"s{d % 3}")
    plan = {r.doc_id: r for r in mixing.plan_mix(spark, df, block=8).collect()}
    texts = {r.doc_id: r.text for r in df.collect()}
    mixed = mixing.mix_documents(spark, df, block=8)
    assert mixed.columns == df.columns
    words = {}
    for r in mixed.collect():
        words.setdefault(r.doc_id, []).append(brute.words(r.text))
    for d, r in plan.items():
        got = words.get(d, [])
        assert sum(map(len, got)) == r.taken
        assert sum(w == brute.words(texts[d]) for w in got) >= r.passes * (r.size > 0)


def test_odd_rows(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, "d e", None), (2, None, "y"), (3, "", "y"), (4, " \n", None)]
    rows += [(5, "w " * 30000, "z")]
    schema = "doc_id BIGINT, text STRING, source STRING, size STRING, llm_no INT"
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], schema)
    plan = mixing.plan_mix(spark, df, block=1).collect()
    assert sorted((str(r.doc_id), r.size) for r in plan) == [("1", 3), ("1", 3), ("2", 0), ("3", 0), ("4", 0), ("5", 30000), ("None", 2)]
    by = {(r.doc_id, r.source): r for r in plan}
    assert by[(2, "y")].target == 0 and by[(1, "x")].taken == 9 and by[(None, None)].target == 6
    mixed = mixing.mix_documents(spark, df.select("doc_id", "text", "source"), block=1).collect()
    assert Counter(r.doc_id for r in mixed)[1] == 6 and not {2, 3, 4} & {r.doc_id for r in mixed}
    assert mixing.plan_mix(spark, df.limit(0)).count() == 0
    nothing = mixing.plan_mix(spark, df.where("doc_id in (2, 3)")).collect()
    assert {(r.target, r.taken) for r in nothing} == {(0.0, 0)}


def test_equal_documents_of_two_sources_keep_their_own_words(spark):
    """One text under one id, in a source that gives all of it three times and one that gives little."""
    text = " ".join(f"w{i}" for i in range(640))
    rows = [(1, text, "a"), (1, text, "b")] + [(10 + i, " ".join(f"x{i}y{j}" for j in range(640)), "a") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    taken = {(r.doc_id, r.source): r.taken for r in mixing.plan_mix(spark, df).where("doc_id = 1").collect()}
    assert taken[1, "a"] != taken[1, "b"] == 3 * 640
    got = {}
    for r in mixing.mix_documents(spark, df).where("doc_id = 1").collect():
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + len(r.text.split())
    assert got == {k: v for k, v in taken.items() if v}
