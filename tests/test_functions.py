import datetime as dt
import math
from urllib.parse import urljoin

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardgrid import constants as C
from hazardgrid.functions import lookups, numbers, scoring, text, times

V = F.col


def test_round_half_even_is_exact_binary_rounding(one):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.floats(-1e6, 1e6), min_size=50, max_size=200), st.sampled_from([2, 4]))
    def check(values, digits):
        values = values + [1.005, 2.675, 0.125, 0.375, 2.5, -2.5, -0.125, 34.765, 1e-9, 0.0]
        values += [round(v, 3) for v in values[:50]]
        got = one(numbers.round_half_even(V("v"), digits), "DOUBLE", values)
        assert got == [round(v, digits) for v in values]

    check()


def test_round_half_even_passes_null_nan_and_huge(one):
    got = one(numbers.round_half_even(V("v"), 2), "DOUBLE", [None, math.nan, math.inf, 1e300])
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [math.inf, 1e300]


def test_round_half_up_ignores_addition_noise(one):
    values = [0.1 + 0.2, 12.345, 12.344999999999999, 2.5, None]
    assert one(numbers.round_half_up(V("v"), 2), "DOUBLE", values) == [0.3, 12.35, 12.35, 2.5, None]


def test_json_number(one):
    texts = ["12.5", "-1e3", '"NaN"', "NaN", '"Infinity"', '"-Infinity"', "abc", "12.5d", "12f", "", None, " 7 "]
    got = one(numbers.json_number(V("v")), "STRING", texts)
    assert got[:2] == [12.5, -1000.0]
    assert math.isnan(got[2]) and math.isnan(got[3])
    assert got[4:6] == [math.inf, -math.inf]
    assert got[6:] == [None, None, None, None, None, 7.0]


def test_cap_at_100_keeps_null(one):
    assert one(numbers.cap_at_100(V("v")), "DOUBLE", [None, 5.0, 250.0]) == [None, 5.0, 100.0]


def test_clamp_percent(one):
    values = [None, -3.0, 5.0, 250.0, math.nan]
    assert one(numbers.clamp_percent(V("v")), "DOUBLE", values) == [0.0, 0.0, 5.0, 100.0, 100.0]


def test_strip_ws(one):
    assert one(text.strip_ws(V("v")), "STRING", [" \n\ta b\r\n ", None]) == ["a b", None]
    assert one(text.text_or_null(V("v")), "STRING", [" \n", "x "]) == [None, "x"]


def test_alert_identifier(one):
    urls = ["https://h/a/AL1_alert.xml", "https://h/a/AL2_alert.xml/", "https://h/a/AL3", "AL4_alert.xml"]
    assert one(text.alert_identifier(V("v")), "STRING", urls) == ["AL1", "AL2", "AL3", "AL4"]


def test_resolve_link_follows_rfc3986(one):
    base = "https://h.example/feeds/id/rss.xml?x=1"
    links = [
        "https://o.example/a", "//o.example/b", "/c/d.xml", "e.xml", "./e.xml", "../f/g.xml", "../../../h.xml",
        "i/./j/../k.xml", "?q=1", "#frag", "l.xml?q=1#f", "..", ".", "m/", "mailto:a@b", "n/..",
    ]
    assert one(text.resolve_link(base, V("v")), "STRING", links) == [urljoin(base, link) for link in links]


def test_fold_texts(one):
    rows = [["Rain", "Heavy Rain", "Rain", None, "Wind"], [None, ""], [], ["Heavy Rain", "Rain"], None]
    got = one(text.fold_texts(V("v")), "ARRAY<STRING>", rows)
    assert got == ["Rain; Heavy Rain; Wind", None, None, "Heavy Rain", None]


def test_utf8(one):
    rows = [b"ok", b"\xffA"]
    assert one(text.utf8_text(V("v")), "BINARY", rows) == ["ok", None]
    assert one(text.utf8_lossy(V("v")), "BINARY", rows) == ["ok", "�A"]


def test_parse_iso(one):
    good = [
        "2025-11-04T21:00:00Z", "2025-11-04T21:00:00+07:00", "2025-11-04 21:00:00", "2025-11-04",
        "2025-11-04T21:00", "2025-11-04T21", "2025-11-04T21:00:00.123456-03:30", "20251104T210000Z",
        "20251104T210000", "20251104T2100+0700", "2025-11-04T21:00Z", "2025-11-04T21:00+07:00", "2025-11-04T21Z",
        "2025-11-04T21:00:00+0700", "2025-11-04T21:00:00-07",
    ]
    bad = ["2025", "12:30", "garbage", "", "2025-13-01", "2025-02-30T00:00:00Z", "2025-11-04T25:00:00Z", "21:00:00Z", "123"]

    def expected(value):
        parsed = dt.datetime.fromisoformat(value)
        if parsed.tzinfo is None:
            parsed = parsed.replace(tzinfo=dt.UTC)
        return int(parsed.timestamp() * 1_000_000 + 0.5)

    got = one(F.unix_micros(times.parse_iso(V("v"))), "STRING", good)
    assert got == [expected(g) for g in good]
    assert one(times.parse_iso(V("v")), "STRING", [*bad, None]) == [None] * (len(bad) + 1)


def test_has_offset(one):
    values = ["2025-11-04T21:00:00Z", "2025-11-04T21:00:00+07:00", "2025-11-04T21:00:00", "2025-11-04"]
    assert one(times.has_offset(V("v")), "STRING", values) == [True, True, False, False]


def test_severity_risk(one):
    values = ["Minor", "MODERATE", " severe ", "extreme", "unknown", "", None]
    assert one(lookups.severity_risk(V("v")), "STRING", values) == [25.0, 50.0, 80.0, 100.0, 0.0, 0.0, 0.0]
    assert one(lookups.severity_risk(V("v"), trim=False), "STRING", [" severe ", "Severe"]) == [0.0, 80.0]


def test_normalize_area(one):
    values = [" Kep. Riau ", "Kep. Bangka Belitung", "Jawa Barat\n", None]
    assert one(lookups.normalize_area(V("v")), "STRING", values) == [
        "Kepulauan Riau", "Kepulauan Bangka Belitung", "Jawa Barat", "",
    ]


def test_station_city(one):
    assert one(lookups.station_city(V("v")), "BIGINT", [8320, 5586536, 1, 2**40, None]) == [
        "Jakarta", "Medan", None, None, None,
    ]
    assert len({s[0] for s in C.STATION_SEED}) == 22


def test_band_edges(one):
    values = [0.0, 24.99, 25.0, 49.99, 50.0, 74.99, 75.0, 100.0]
    assert one(scoring.band(V("v")), "DOUBLE", values) == [
        "LOW", "LOW", "MODERATE", "MODERATE", "HIGH", "HIGH", "CRITICAL", "CRITICAL",
    ]


def test_compact_stamp(spark):
    row = spark.sql("SELECT TIMESTAMP '2024-01-05 07:08:09' AS t").select(times.compact_stamp(V("t")).alias("s"))
    assert row.first()["s"] == "20240105T070809Z"


def test_rounding_of_large_and_odd_values(one):
    inf = float("inf")
    values = [351843720888.336, 2.0**51 + 0.25, 1e25, -1e25, 0.5, None]
    assert one(numbers.round_half_even(V("v"), 2), "DOUBLE", values) == [
        None if v is None else round(v, 2) for v in values
    ]
    odd = [1e25, inf, -inf, 0.0049999999, 2.675, 0.005, None]
    assert one(numbers.round_half_up(V("v"), 2), "DOUBLE", odd) == [1e25, inf, -inf, 0.0, 2.68, 0.01, None]


def test_values_computed_once_keep_other_columns(spark):
    from hazardgrid.functions.staging import evaluate_once

    df = spark.sql("SELECT 1 AS `a.b`, 'x' AS v")
    rows = evaluate_once(df, "twice", F.concat("v", "v"))
    assert rows.columns == ["a.b", "v", "twice"] and tuple(rows.first()) == (1, "x", "xx")


def test_utf8_of_ascii_and_other_bytes(one):
    rows = [b"plain", "é".encode(), b"\xe9", b"ab\x80", "€ 1".encode(), b"", None]
    assert one(text.utf8_text(V("v")), "BINARY", rows) == ["plain", "é", None, None, "€ 1", "", None]
