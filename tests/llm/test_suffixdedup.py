import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardgrid.llm import queries, suffixdedup, suffixes
from hazardgrid.session import list_dir, shared_dir
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def check(spark, rows, **more):
    schema = "doc_id BIGINT, text STRING, n INT, spans STRING, tid BIGINT, h STRING"
    df = spark.createDataFrame([(i, t, 1, "x", 2, "y") for i, t in rows], schema)
    got = []
    for r in suffixdedup.remove_repeated(spark, df, **more).collect():
        spans = tuple((s.start, s.end) for s in r.spans)
        assert r.n_removed == sum(e - s for s, e in spans) and (r.kept is None) == (not spans)
        got.append((r.doc_id, r.n_bytes, spans, r.kept_sha256))
    width = more.get("width", 400)
    want = [(d, n, tuple(s), hashlib.sha256(k).hexdigest()) for d, n, s, k in brute.repeated_bytes(rows, width)]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1:])) == sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    return got


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op13_suffix_array_dedup"](spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = [
        (d, n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for d, n, spans, kept in brute.repeated_bytes(docs)
    ]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(w[3] for w in want) > 100


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_passages_edited_and_shared(spark, monkeypatch, letters):
    monkeypatch.setattr(suffixdedup, "BLOCK", 64)
    rng = random.Random(len(letters))
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [word(n) for n in (19, 20, 21, 35, 60, 150)]
    rows = []
    for i in range(120):
        text = "".join(word(rng.randint(0, 12)) + rng.choice(passages) for _ in range(rng.randint(0, 4)))
        for _ in range(rng.randint(0, 3)):  # an edit in the midst of a passage
            if text:
                p = rng.randrange(len(text))
                text = text[:p] + rng.choice(["", "Z", "é"]) + text[p + 1 :]
        rows.append((i, text))
    rows += rows[:5] + [(300, "a" * 90), (301, "ab" * 40), (302, "a" * 31)]
    found = check(spark, rows, width=20, screen=10, spare=4)
    assert sum(len(r[2]) for r in found) > 50


def test_odd_rows(spark):
    rng = random.Random(9)
    a = "".join(rng.choice("abc ñ") for _ in range(900))
    rows = [
        (1, None), (2, ""), (3, "x" * 399), (4, "y" * 400), (4, "y" * 400), (None, a), (5, "é" + a[3:500]), (6, "z" * 401),
        (7, a[:250] + a[650:]), (8, a[200:650] + "q" + a[200:650]), (9, "new " * 300_000),
    ]
    check(spark, rows)
    assert suffixdedup.remove_repeated(spark, spark.createDataFrame([], "doc_id INT, text STRING")).count() == 0


@pytest.mark.parametrize("depth", [1, 4, 200])
def test_suffix_order(spark, depth):
    rng = random.Random(depth)
    strings = [[rng.randint(1, 3) for _ in range(rng.randint(1, 14))] for _ in range(60)] + [[1] * 20, [1] * 21, [2]]
    want = [[rng.random() < 0.7 for _ in s] for s in strings]
    df = spark.createDataFrame(list(zip(range(len(strings)), strings, want)), "sid BIGINT, c ARRAY<BIGINT>, want ARRAY<BOOLEAN>")
    ranks = {r.sid: r.ranks for r in suffixes.order(spark, df, depth).collect()}
    places = []
    for sid, s in enumerate(strings):
        own = ranks.get(sid, [None] * len(s))
        assert [r is not None for r in own] == want[sid]
        places += [(r, s[i : i + depth]) for i, r in enumerate(own) if r is not None]
    places.sort(key=lambda x: x[0])
    assert [p for _, p in places] == sorted(p for _, p in places)


def test_neighbours_across_partitions(spark):
    rows = [(i, 0, i // 3 if i < 30 else i, [i // 3 if i < 30 else i]) for i in range(60)]
    df = spark.createDataFrame(rows, "sid BIGINT, i INT, rank BIGINT, prefix ARRAY<BIGINT>")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        found = suffixes.shared_prefixes(spark, df.repartition(5)).agg(F.sort_array(F.collect_list("sid"))).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found == list(range(30))


def test_frames_of_the_suffix_order_do_not_stay(spark):
    """They would take disk while the last and largest join runs."""
    folder = shared_dir(spark)
    frames = lambda: {(n, f) for n in list_dir(spark, folder) if n.startswith("llm-") for f in list_dir(spark, f"{folder}/{n}")}
    before = frames()
    text = "".join(random.Random(3).choice("abcdefgh") for _ in range(300))
    check(spark, [(1, text + "xy" + text[:90]), (2, "q" + text[40:180] + "z"), (3, text[100:260])], width=60, screen=30, spare=4)
    left = {f for _, f in frames() - before}
    assert {"runs", "adjacent"} <= left
    assert not left & {"strings", "anchors", "letters", "level", "names", "merged", "keys"}


def test_few_runs_inside_shared_passages(spark, monkeypatch):
    """Each is digested and sent by its anchor; the inside of what is shared needs only long ones."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh") for _ in range(6000))
    rows = [(i, f"{i}" * 7 + passage[i * 300 : 3000 + i * 300] + f"{i}" * 9) for i in range(8)]
    sizes = []

    def counted(spark, df, name, *more, stored=suffixdedup.stored):
        frame = stored(spark, df, name, *more)
        if name == "runs":
            sizes.append(frame.agg(F.sum(F.size("at"))).first()[0] or 0)
        return frame

    monkeypatch.setattr(suffixdedup, "stored", counted)
    check(spark, rows)
    windows = sum(len(t) - 399 for _, t in rows)
    assert 0 < sum(sizes) < windows / 8


def test_ranges_of_windows_across_blocks(monkeypatch):
    monkeypatch.setattr(suffixdedup, "BLOCK", 16)
    rng = random.Random(8)
    text = bytes(rng.choice(b"abcd") for _ in range(150))
    first, size = np.array([0, 3, 40, 60, 61, 139]), np.array([3, 1, 20, 1, 50, 2])
    got = []
    for low, part, keep, owner in suffixdedup._ranged(text, first, size, 10):
        assert part.tobytes() == text[low : low + 25]
        got += list(zip((keep + low).tolist(), owner.tolist()))
    assert got == [(a + k, i) for i, (a, n) in enumerate(zip(first.tolist(), size.tolist())) for k in range(n)]
    runs = [r for at, n, _, _, own in suffixdedup._runs(suffixdedup._ranged(text, first, size, 10), 10, 4) for r in zip(at.tolist(), n.tolist(), own.tolist())]
    assert [(a + k, i) for a, n, i in runs for k in range(n)] == got


def test_places_do_not_depend_on_the_block():
    """Values alike in the bits that are compared: the leftmost, however long the block."""
    x = np.array([7, 5, 1 << 30, 3], "u8")
    tail = np.full(5000, 1 << 60, "u8")
    assert suffixdedup._leftmost(x, 4).tolist() == [0]
    assert suffixdedup._leftmost(np.concatenate([x, tail]), 4)[0] == 0


def test_grams_of_joined_texts_are_those_of_each(monkeypatch):
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (0, 5, 19, 20, 21, 200, 0, 60, 20)] + [b"ab" * 40, b""]
    ends = np.cumsum([0, *map(len, texts)])
    want = []
    for start, text in zip(ends.tolist(), texts):
        grams = [int(h) for h in suffixdedup._hashes(np.frombuffer(text, "u1"), 10)]
        least = lambda i: min(range(i, i + 11), key=lambda k: (grams[k] >> suffixdedup.PLACE, k))  # noqa: B023, E731
        want += [(start + p, grams[p]) for p in sorted({least(i) for i in range(len(text) - 19)})]
    for block, chunk in ((1 << 20, 1 << 16), (32, 50), (7, 1)):
        monkeypatch.setattr(suffixdedup, "BLOCK", block)
        monkeypatch.setattr(suffixdedup, "CHUNK", chunk)
        places, values = suffixdedup._named(np.frombuffer(b"".join(texts), "u1"), ends, 20, 10)
        assert list(zip(places.tolist(), values.tolist())) == want
