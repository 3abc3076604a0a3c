import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hazardgrid.llm import queries, simple8b, tokenids

tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.01"
PATH = queries.tokenizer("word_bpe_49k.json")


def want(docs, end_id=1):
    t = tokenizers.Tokenizer.from_file(PATH)
    rows, start = [], 0
    for doc_id, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [end_id]
        rows.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


def test_query_equals_the_library(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = queries.QUERIES["op1_token_ids"](spark, SF).collect()
    assert sorted(map(tuple, got)) == want(docs)


def test_odd_rows(spark):
    docs = [
        (None, "no id"),
        (-5, None),
        (0, ""),
        (1, "It's we'll DON'T 'twas ... , .;' x's"),
        (2, "ΣΑΣ İstanbul ŉ é Å   \x1c a\x0bb 　 漢字"),
        (3, "<|endoftext|> a <|startoftext|>b <|ENDOFTEXT|>"),
        (4, "word " * 60000),
        (4, "zz"),
        (7, "a" * 100000),
        (8, "\n\n \t"),
        (9, "ÀÉÎ straße µ ÿ 12345 x1y2"),
    ]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id BIGINT, text STRING, shard STRING")
    got = tokenids.token_ids(spark, df.repartition(3), PATH).orderBy("start").collect()
    assert [tuple(r) for r in got] == want(docs)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert tokenids.token_ids(spark, df, PATH).count() == 0


def test_files_hold_the_ids(spark, tmp_path):
    docs = [(i, "some words here " * i) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    tokenids.write_ids(spark, df, PATH, str(tmp_path / "ids"), end_id=None)
    t = tokenizers.Tokenizer.from_file(PATH)
    got = {}
    for file in (tmp_path / "ids").glob("part-*"):
        for _, _, ids, lengths, flat in tokenids.unpack(file.read_bytes()):
            for d, part in zip(ids.tolist(), np.split(flat, np.cumsum(lengths)[:-1])):
                got[d] = part.tolist()
    assert got == {d: t.encode(x, add_special_tokens=False).ids for d, x in docs}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(values):
    x = np.array(values, np.uint64)
    coded, offsets, literals = simple8b.encode(x)
    assert simple8b.decode(coded, offsets, literals, len(x)).tolist() == values


def test_simple8b_packs_small_values():
    coded, _, literals = simple8b.encode(np.ones(60 * 4, np.uint64))
    assert (len(coded), len(literals)) == (4, 0)
    coded, _, literals = simple8b.encode(np.full(3, (1 << 64) - 1, np.uint64))
    assert (len(coded), len(literals)) == (3, 3)


def test_word_memo_forgets_and_relearns(spark, monkeypatch):
    from hazardgrid.llm import memo

    monkeypatch.setattr(memo, "WORDS_HELD", 5)
    b = tokenids.BatchTokenizer(PATH)
    t = tokenizers.Tokenizer.from_file(PATH)
    for k in range(8):
        texts = [f"alpha beta{k} gamma{k}", "", f"alpha delta{k + 1} beta{k}"]
        ids, at = b.encode(texts)
        assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == [t.encode(x).ids for x in texts]
