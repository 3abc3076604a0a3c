import random

from hazardgrid.llm import queries, substrings
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = sorted((d, n, k, brute.sha(t)) for d, n, k, t in brute.repeated_windows(docs))
    assert sorted(map(tuple, queries.QUERIES["op6_substring_dedup"](spark, SF).collect())) == want


def test_odd_rows(spark):
    rng = random.Random(5)
    base = [rng.choice("abcdefgh") for _ in range(40)]
    docs = [
        (1, " ".join(base)),
        (2, "x\t" + " \x0b".join(base[5:25]) + " y"),
        (2, " ".join(base[:12])),
        (3, None),
        (4, ""),
        (5, " ".join(base)),
        (5, " ".join(base)),
        (None, " ".join(base)),
        (6, "a " * 5000),
        (7, "a " * 30),
        (0, "a " * 11),
    ]
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in docs], "doc_id BIGINT, text STRING, tk INT, rid STRING")
    got = substrings.remove_repeated(spark, df, width=6, gram=3).collect()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=key) == sorted(
        brute.repeated_windows(docs, 6), key=key
    )
    for r in got:
        assert sum(x.end - x.start for x in r.removed) == r.n_removed
        assert all(x.end < y.start for x, y in zip(r.removed, r.removed[1:]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert substrings.remove_repeated(spark, df).count() == 0
