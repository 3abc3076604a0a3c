import zlib

import numpy as np
import pyarrow as pa
import pytest

from hazardgrid.llm import langid, queries
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op5_language_id"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        letter = any(c.isalpha() for c in docs[r.doc_id].text)
        assert (r.lang_pred == "und") == (not letter)
    held = [r for r in got if r.held_out and r.lang_pred != "und" and len(docs[r.doc_id].text) > 20]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.97 * len(held)


def test_query_equals_the_plain_version(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = sorted(queries.QUERIES["op5_language_id"](spark, "/root/testdata/sf0.001").collect())
    want = sorted(brute.languages(docs))
    assert [(r.doc_id, r.held_out, r.lang_pred) for r in got] == [w[:3] for w in want]
    assert all(abs(r.score - w[3]) < 1e-9 for r, w in zip(got, want))


def test_odd_rows(spark):
    rows = [(i, "the house is over there", "en", 1) for i in range(20)]
    rows += [(i, "das Haus steht ÜBER dort und schläft", "de", 1) for i in range(20, 40)]
    odd = [(None, "the house", None), (50, None, "en"), (51, "", None), (52, "123 +-", "de"), (53, "漢", None), (54, "über das Haus", None)]
    odd += [(54, "über das Haus", None), (55, "the there " * 20000, None)]
    df = spark.createDataFrame([*rows, *((a, b, c, 2) for a, b, c in odd)], "doc_id BIGINT, text STRING, lang STRING, score INT")
    got = [r for r in langid.identify(df).collect() if r.doc_id is None or r.doc_id >= 50]
    found = {r.doc_id: r.lang_pred for r in got}
    assert found == {None: "en", 50: "und", 51: "und", 52: "und", 53: found[53], 54: "de", 55: "en"}
    assert len(got) == len(odd)
    tie = next(r for r in got if r.doc_id == 53)
    assert tie.ambiguous
    assert langid.identify(df.limit(0)).count() == 0
    one = langid.identify(df.where("lang = 'en'")).where("doc_id < 20").collect()
    assert {(r.lang_pred, r.score) for r in one} == {("en", 1.0)}
    none = langid.identify(df.where("lang is null")).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 9, 40, 300])
def test_codewords_differ_in_many_bits(n):
    codes = langid.codewords(n)
    assert codes.shape[0] == n and all(len(set(column)) == 2 for column in codes.T)
    for i in range(n):
        for j in range(i):
            assert (codes[i] != codes[j]).sum() >= max(1, codes.shape[1] // 3)


def test_every_label_is_a_language(spark):
    """300 labels of five texts each, some far rarer than others."""
    rows = [(1000 * k + i, f"q{k}z w{k}v x{k}y " * 5, f"l{k:03d}") for k in range(300) for i in range(8 if k % 2 else 60)]
    letters = str.maketrans("0123456789", "abcdefghij")
    rows = [(i, t.translate(letters), x) for i, t, x in rows]
    got = langid.identify(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")).collect()
    label = {i: x for i, _, x in rows}
    assert sum(r.lang_pred == label[r.doc_id] for r in got) >= 0.97 * len(rows)
    assert len({r.lang_pred for r in got}) >= 290


def test_a_wrong_bit_is_corrected():
    codes = langid.codewords(4)
    odds = np.zeros((7, langid.BUCKETS))
    texts = pa.array(["abc"])
    bucket, _ = langid._grams(texts)
    bucket = bucket[bucket > 0][0]
    odds[:, bucket] = codes[2] * 3
    odds[4, bucket] *= -1
    best, score, gap = langid.decide(langid.Model(tuple("abcd"), codes, odds, np.ones(7)), texts)
    assert best[0] == 2 and gap[0] > 1 and 0.5 < score[0] < 1


def test_only_the_text_decides(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(df)
    plain = langid.identify(df, model).orderBy("doc_id").select("lang_pred", "score").collect()
    blind = df.selectExpr("doc_id + 7 as doc_id", "text", "'xx' as lang")
    assert langid.identify(blind, model).orderBy("doc_id").select("lang_pred", "score").collect() == plain
