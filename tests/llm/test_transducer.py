import random
import zlib

import numpy as np
import pytest

from hazardgrid.llm import pieces, queries, transducer
from tests.llm.brute import sha

sp = pytest.importorskip("sentencepiece")
SF = "/root/testdata/sf0.01"
PATH = queries.tokenizer("piece_bpe_32k.model")
ODD = [
    "Hello  world",
    "   lead",
    "trail   ",
    "\n\n a\nb \n c",
    "▁ mark",
    "a▁b  ▁▁ c",
    "漢字   x  漢",
    "\t tab",
    " " * 40 + "x",
    " " * 31,
    "",
    "x",
    "😀  😀",
    "a" * 5000,
    "\u0000x",
    "é" * 100,
]


@pytest.fixture(scope="module")
def library():
    return sp.SentencePieceProcessor(model_file=PATH)


def noise(seed, n):
    rng = random.Random(seed)
    letters = "ab  \n▁漢éTh.,e1ing"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(70))) for _ in range(n)]


def test_query_equals_the_library(spark, library):
    got = queries.QUERIES["op7_sentencepiece_round_trip"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == sha(docs[r.doc_id])


def test_paths_and_decoding_equal_the_library(library):
    own = transducer.transducer(PATH)
    texts = ODD + noise(1, 1500)
    ids, at = own.encode(texts)
    for k, t in enumerate(texts):
        path = ids[at[k] : at[k + 1]].tolist()
        assert path == library.encode(t), t
        assert own.decode(path) == library.decode(path), t
    for path in ([200], [230, 180, 3, 0, 1], [259, 259, 300], []):
        assert own.decode(path) == library.decode(path)


def test_side_by_side_paths_equal_plain_merging():
    own = transducer.transducer(PATH)
    units = ["▁" + "".join(w.split()) for w in noise(2, 300)]
    for unit, path in zip(units, own._paths(units)):
        assert path.tolist() == own._merged(unit).tolist()


def unigram_model(tmp_path, byte_fallback=True):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = pieces.UNIGRAM
    for p in proto.pieces:
        if p.type == pieces.NORMAL:  # small scores, so that the library's single precision is exact
            p.score = -20.0 if p.score < -40000 else p.score / 4096
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


def test_unigram_shortest_path(tmp_path):
    path = unigram_model(tmp_path)
    own, library = transducer.Transducer(pieces.load(path)), sp.SentencePieceProcessor(model_file=path)
    texts = [t for t in ODD if len(t) < 1000] + noise(3, 300)
    ids, at = own.encode(texts)
    for k, t in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == library.encode(t), t


def test_odd_rows(spark, library):
    docs = [(None, "no id"), (1, None), (2, ""), (3, "a  b\n"), (3, "a  b\n"), (4, "word " * 50000)]
    df = spark.createDataFrame([(d, t, 5, None) for d, t in docs], "doc_id BIGINT, text STRING, ids INT, decoded STRING")
    coded = transducer.encode(df, PATH)
    assert coded.columns == ["doc_id", "decoded", "ids"]
    got = transducer.decode(coded, PATH).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n_tokens, r.decoded) for r in got), key=key) == sorted(
        ((d, len(library.encode(t or "")), t or "") for d, t in docs), key=key
    )
    empty = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert transducer.decode(transducer.encode(empty, PATH), PATH).count() == 0
