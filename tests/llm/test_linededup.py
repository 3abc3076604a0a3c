import random

import pytest

from hazardgrid.llm import linededup, queries
from tests.llm import brute
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"
KEY = lambda r: tuple((x is None, str(x)) for x in r)


def outcome(df):
    rows = df.select("doc_id", "llm_lines", "llm_dropped", "llm_kept").collect()
    return sorted(map(tuple, rows), key=KEY)


def test_query_equals_sql(spark):
    con = connect(SF)
    assert compare(queries.QUERIES["op8_line_dedup"](spark, SF), con, queries.ORACLES["op8_line_dedup"]) == []


def test_odd_rows(spark):
    docs = [
        (3, "A Common Line here\nown line of three\n\n  "),
        (1, "\ta common line HERE \r\nshort\nshort"),
        (2, "a common line here\na common line here\nÀ COMMON LINE HERE"),
        (4, "à common line here\nshort"),
        (None, "a common line here"),
        (5, None),
        (6, ""),
        (7, "own line of three"),
        (8, "x" * 200000 + "\nown line of three"),
        (9, "twice in the same one\ntwice in the same one"),
        (3, "own line of three\nanother text of three"),
        (7, "own line of three"),
    ]
    df = spark.createDataFrame([(d, t, "a", 2) for d, t in docs], "doc_id BIGINT, text STRING, llm_runs STRING, pos INT")
    got = linededup.dedup_lines(spark, df)
    assert got.columns[:3] == ["doc_id", "text", "pos"]
    assert outcome(got) == sorted(brute.deduped_lines(docs), key=KEY)
    for r in got.collect():
        lines = (r.text or "").split("\n")
        kept = [x for run in r.llm_runs for x in lines[run.start : run.end]]
        assert "\n".join(kept) == r.llm_kept
    assert linededup.dedup_lines(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [0.0, 1e9])
def test_hot_lines_in_slices_and_without(spark, monkeypatch, hot):
    monkeypatch.setattr(linededup, "HOT", hot)
    monkeypatch.setattr(linededup, "SLICES", 4)
    rng = random.Random(4)
    pool = [f"shared line number {i}" for i in range(12)]
    docs = [(d, "\n".join(["a very common header line", *rng.choices(pool, k=4), f"line of {d} alone"])) for d in range(150)]
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    assert outcome(linededup.dedup_lines(spark, df)) == sorted(brute.deduped_lines(docs), key=KEY)
