import random
from collections import Counter

import pytest

import corpus_pipeline
from hazardgrid.llm import langid, mixing, queries
from tests.llm import brute

sp = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    """Invented prose of two languages with copies, near copies, shared lines and junk."""
    rng = random.Random(11)
    syllables = {"en": ["the", "ing", "er", "wh", "on", "ly"], "de": ["sch", "ein", "ü", "ung", "cht", "ver"]}
    rows = []
    for d in range(240):
        lang = rng.choice(["en", "de"])
        lines = []
        for _ in range(rng.randrange(1, 6)):
            line = ["".join(rng.choices(syllables[lang], k=3)) for _ in range(rng.randrange(3, 30))]
            lines.append(" ".join(line))
        rows.append([d, "\n".join(lines), lang, f"s{d % 5}"])
    for d in range(240, 300):
        text = rows[rng.randrange(240)][1].split(" ")
        if d % 3:
            text[rng.randrange(len(text))] = "changed"
        rows.append([d, " ".join(text), None if d % 7 == 0 else "en", f"s{d % 5}"])
    for d in range(300, 320):
        rows.append([d, rng.choice(["123 456", "", None, "!!! ??"]), None, None])
    for d in range(320, 330):
        rows.append([d, "a common header line of the host\n" + rows[d - 320][1] + f" tail{d} " * 9, "en", "s1"])
    path = tmp_path_factory.mktemp("corpus")
    docs = [(d, t, lang, s, len(t or "")) for d, t, lang, s in rows]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    spark.createDataFrame(docs, schema).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages_against_plain_versions(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "line_dedup",
        "ngram_jaccard_join",
        "source_mixing",
        "sentencepiece",
    ]
    rows = {r.doc_id: r for r in docs.collect()}
    # 5: what has no letter or no clear language goes.
    verdict = {r.doc_id: r for r in langid.identify(docs).collect()}
    want = {d for d, r in verdict.items() if r.lang_pred != "und" and not r.ambiguous}
    assert set(range(240)) <= want and not want & set(range(300, 320))
    known = stages["language_id"](spark, docs, corpus)
    got = {r.doc_id: r for r in known.collect()}
    assert set(got) == want and known.columns == docs.columns
    for d, r in got.items():
        assert (r.text, r.source, r.lang) == (rows[d].text, rows[d].source, rows[d].lang or verdict[d].lang_pred)
    # 8: lines of earlier documents go.
    cut = stages["line_dedup"](spark, known, corpus)
    plain = {d: t for d, _, _, t in brute.deduped_lines([(d, r.text) for d, r in got.items()])}
    got = {r.doc_id: r for r in cut.collect()}
    assert {d: r.text for d, r in got.items()} == plain
    assert all(r.n_chars == len(r.text) for r in got.values()) and cut.columns == docs.columns
    # 2: one document of each group stays.
    single = stages["ngram_jaccard_join"](spark, cut, corpus)
    groups = brute.similar(plain)
    plain = {d: t for d, t in plain.items() if groups[d][2] == d}
    assert {r.doc_id: r.text for r in single.collect()} == plain
    # 4: as many words of each source as its plan takes, all of them the document's own.
    mixed = stages["source_mixing"](spark, single, corpus)
    plan = mixing.plan_mix(spark, single).collect()
    taken = Counter()
    for r in mixed.collect():
        taken[r.doc_id] += len(brute.words(r.text))
        assert not Counter(brute.words(r.text)) - Counter(brute.words(plain[r.doc_id])) and r.n_chars == len(r.text)
    assert taken == Counter({r.doc_id: r.taken for r in plan if r.taken})
    # 7: the library's ids.
    coded = stages["sentencepiece"](spark, mixed, corpus)
    library = sp.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    texts = sorted((r.doc_id, library.encode(r.text)) for r in mixed.collect())
    assert sorted((r.doc_id, r.ids) for r in coded.collect()) == texts
    # All of it in one go.
    assert sorted((r.doc_id, r.ids) for r in corpus_pipeline.run(spark, corpus).collect()) == texts


def test_stages_take_empty_tables(spark, tmp_path):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    docs = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0
