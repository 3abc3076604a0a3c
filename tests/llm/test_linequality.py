from hazardgrid.llm import linequality, queries
from tests.llm import brute
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


def base(text):
    text = text or ""
    words = brute.words(text)
    grams = {}
    for i in range(len(words) - 4):
        grams.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if brute.words(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_query_equals_sql(spark):
    con = connect(SF)
    assert compare(queries.QUERIES["op9_line_quality"](spark, SF), con, queries.ORACLES["op9_line_quality"]) == []


def test_small_hosts_equal_sql_and_lose_lines(spark):
    name = "line_quality_small_hosts"
    df = queries.QUERIES[name](spark, SF)
    assert compare(df, connect(SF), queries.ORACLES[name]) == []
    assert df.where("n_line_words > 0").count() > 100


def test_odd_rows(spark):
    texts = [
        None, "", " \n\t", "a b c d e f g h i j", "a b c d e a b c d e", "x " * 3000 + "y", "é ü\x0bñ <#|> $",
        "one line\none line\n one line\n\n\n", "a b c d e f a b c d e f a b c d e f", "w" * 100000, "1 2 3 4 5 1 2 3 4",
        " ".join(f"w{i}" for i in range(20000)) + " w1 w2 w3 w4 w5",
    ]
    rows = [(i, t, "h", "x") for i, t in enumerate(texts)] + [(None, texts[3], None, "x"), (3, texts[3], "h", "x")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING, llm_words STRING")
    got = linequality.judge(spark, df).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t in enumerate(texts):
        r = by_id[i]
        want = base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t[:50]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed)
    assert by_id[None].kept
    assert linequality.judge(spark, df.limit(0)).count() == 0


def test_repeated_rows_are_one_document(spark):
    """Sixty documents share a line; one of them is in the table 3,000 times."""
    line = "one header of many words that every page of the host repeats again and again"
    rows = [(d, f"{line}\n" + " ".join(f"w{d}x{i}" for i in range(5)), "a") for d in range(60)]
    df = spark.createDataFrame([*rows, *rows[7:8] * 2999], "doc_id BIGINT, text STRING, source STRING")
    got = linequality.judge(spark, df).where("n_line_words = 15").select("doc_id").distinct()
    assert got.count() == 59


def test_lines_above_the_limit_deplete_documents(spark):
    body = lambda d, n: " ".join(f"w{d}x{i}" for i in range(n))
    header = "one header of many words that every page of the host repeats again and again"
    rows = [(d, f"{header}\n{body(d, 5)}", "a") for d in range(60)]  # mostly header
    rows += [(100 + d, f" {header.upper()} \n{body(d, 60)}", "a") for d in range(20)]  # mostly own words
    rows += [(200 + d, f"{header}\n{body(d, 5)}", "b") for d in range(10)]  # few pages of another host
    rows += [(300 + d, f"{header}\n{body(d, 5)}", None) for d in range(60)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    got = {r.doc_id: r for r in linequality.judge(spark, df, max_share=0.02, min_docs=50).collect()}
    for d, r in got.items():
        first = d in (0, 300)
        assert r.n_line_words == (0 if first or 200 <= d < 300 else 15)
        assert r.kept == (first or 100 <= d < 300)
