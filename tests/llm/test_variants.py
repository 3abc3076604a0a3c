import random

import pytest

from hazardgrid.llm import queries, variants
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def outcome(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id BIGINT, text STRING, word STRING, n INT")


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = queries.QUERIES["op11_spelling_variants"](spark, SF)
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert outcome(df) == brute.variants(brute.variant_words(docs))


@pytest.mark.parametrize("often", [0, 2, 10**9])
def test_near_words_at_any_pruning(spark, often):
    rng = random.Random(often)
    n = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 9))): rng.randint(3, 40) for _ in range(400)}
    n |= {"a" * k: 50 * k for k in (5, 6, 7, 300, 301)}
    df = spark.createDataFrame(list(n.items()), "word STRING, n BIGINT")
    got = {}
    for r in variants.near_words(spark, df, often).collect():
        assert r.n == n[r.word] and r.other_n == n[r.other]
        got.setdefault(r.word, []).append(r.other)
    want = {w: sorted(x for x in n if brute.one_edit(w, x)) for w in n}
    assert {w: sorted(x) for w, x in got.items()} == {w: x for w, x in want.items() if x}


def test_chains_and_ties(spark):
    n = {"abcdef": 3, "abcdeg": 6, "abcdhg": 12, "abckhg": 24, "abcdex": 6, "zzzzz": 9, "zzzzy": 5}
    text = " ".join(" ".join([w] * c) for w, c in n.items())
    rows = [(i, text) for i in range(1, 4)]
    got = outcome(variants.group_variants(spark, table(spark, rows)))
    assert got == brute.variants(brute.variant_words(rows))


def test_odd_rows(spark):
    long = ("Straße " * 3 + "×÷×÷× " * 3) * 20_000 + "q" * 3_000_000
    rows = [
        (1, None), (2, ""), (3, "1234 !!"), (None, "Garden garden GARDEN gardan gardan gardan"), (4, long),
        (4, long), (5, "Étésé étésé Étésé āgardenā garden"), (6, "q" * 3_000_000),
    ]
    docs = table(spark, rows)
    got = {r.word: r.n for r in variants.vocabulary(docs).collect()}
    assert got == brute.variant_words(rows)
    short = [r for r in rows if len(r[1] or "") < 1000]
    assert outcome(variants.group_variants(spark, table(spark, short))) == brute.variants(brute.variant_words(short))
    assert variants.group_variants(spark, docs.limit(0)).count() == 0


def test_rarest_grams_that_lie_apart():
    grams = [(i, i + q, 5) for i in range(8) for q in (2, 3) if i + q <= 8]
    own = variants.decompose(grams)
    assert own == [(i, i + 3, 5) for i in range(6)]
    assert variants.rarest_apart(own) == (3, 3)
    rare = [(s, e, 1 if s in (1, 5) else 9) for s, e, _ in own]
    assert variants.rarest_apart(rare) == (4, 5)
    assert variants.rarest_apart([(0, 2, 1), (1, 3, 1), (2, 4, 1), (3, 5, 7)]) == (2, 2)
