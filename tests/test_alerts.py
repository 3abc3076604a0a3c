import time
from datetime import date
from random import Random
from urllib.parse import urljoin
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from hazardgrid import constants as C
from hazardgrid.functions import lookups
from hazardgrid.functions.text import alert_identifier
from hazardgrid.operators import alerts
from hazardgrid.sources import landed

D = date(2024, 1, 5)
NS = f'xmlns="{C.CAP_NAMESPACE}"'


def cap(identifier="A1", event="Rain", severity="Moderate", area="Jawa Barat", ns=NS):
    return (
        f"<alert {ns}><identifier> {identifier} </identifier><info><event>{event}</event>"
        f"<severity>{severity}</severity><effective>2024-01-01T10:00:00+07:00</effective>"
        f"<headline>H {identifier}</headline>"
        f"<area><areaDesc>{area}</areaDesc><polygon>1,2</polygon></area><area><areaDesc>other</areaDesc></area>"
        f"</info><info><event>second</event></info></alert>"
    )


def objects(spark, docs, date="2024-01-05"):
    rows = [(f"/b/ingestion_date={date}/{name}_alert.xml", bytearray(doc.encode())) for name, doc in docs]
    return spark.createDataFrame(rows, "path STRING, content BINARY")


def test_parse_takes_first_info_and_area(spark):
    (row,) = alerts.parse_alerts(objects(spark, [("a", cap())])).collect()
    assert (row.parse_status, row.identifier, row.event, row.area_desc, row.polygon) == (
        "PARSED", "A1", "Rain", "Jawa Barat", "1,2",
    )
    assert str(row.ingestion_date) == "2024-01-05" and row.urgency is None


def test_prefixed_namespace(spark):
    doc = (
        f'<cap:alert xmlns:cap="{C.CAP_NAMESPACE}"><cap:identifier>P</cap:identifier>'
        "<cap:info><cap:event>E</cap:event></cap:info></cap:alert>"
    )
    (row,) = alerts.parse_alerts(objects(spark, [("a", doc)])).collect()
    assert (row.parse_status, row.identifier, row.event, row.area_desc) == ("PARSED", "P", "E", "")


def test_bad_objects_are_set_aside(spark):
    docs = [
        ("ok", cap()),
        ("cut", cap()[:-20]),
        ("noinfo", f"<alert {NS}><identifier>N</identifier></alert>"),
        ("foreign", cap(ns='xmlns="urn:other"')),
        ("empty", ""),
    ]
    parsed = alerts.parse_alerts(objects(spark, docs))
    undated = spark.createDataFrame([("/b/x_alert.xml", bytearray(cap().encode()))], "path STRING, content BINARY")
    binary = spark.createDataFrame(
        [("/b/ingestion_date=2024-01-05/y_alert.xml", bytearray(b"\xff\xfe<alert/>"))], "path STRING, content BINARY"
    )
    bad = parsed.union(alerts.parse_alerts(undated)).union(alerts.parse_alerts(binary))
    got = {r.path.rsplit("/", 1)[1]: r.parse_status for r in alerts.rejected_alerts(bad).collect()}
    assert got == {
        "cut_alert.xml": "MALFORMED_XML",
        "noinfo_alert.xml": "NO_INFO",
        "foreign_alert.xml": "NO_INFO",
        "empty_alert.xml": "MALFORMED_XML",
        "x_alert.xml": "NO_INGESTION_DATE",
        "y_alert.xml": "MALFORMED_XML",
    }


def daily(spark, docs):
    mapped = alerts.map_alerts(alerts.parse_alerts(objects(spark, docs)), lookups.province_cities(spark))
    return alerts.weather_daily(mapped)


def test_roll_up_keeps_first_record_and_folds_events(spark):
    docs = [
        ("b", cap("B", "Heavy Rain", "Severe")),
        ("a", cap("A", "Rain", "Minor")),
        ("c", cap("C", "Rain", "Extreme")),
        ("d", cap("D", "Wind and Heavy Rain", "Unknown")),
        ("e", cap("E", "Wind", "Unknown")),
        ("f", cap("F", "Fog", area="Papua")),
    ]
    (row,) = daily(spark, docs).collect()
    assert (row.city, row.weather_risk, row.active_weather_alerts) == ("Bandung", 100.0, 5)
    assert (row.bmkg_alert_id, row.severity, row.headline) == ("A", "Minor", "H A")
    assert row.weather_event == "Rain; Heavy Rain; Wind and Heavy Rain"


def test_roll_up_with_missing_event(spark):
    (row,) = daily(spark, [("a", cap("A", "")), ("b", cap("B", "Rain"))]).collect()
    assert row.weather_event == "Rain" and row.active_weather_alerts == 2
    (row,) = daily(spark, [("a", cap("A", ""))]).collect()
    assert row.weather_event is None


def test_load_rows(spark):
    (row,) = alerts.weather_load_rows(daily(spark, [("a", cap())])).collect()
    assert row.air_quality_risk is None and "headline" not in row.asDict()
    assert str(row.effective) == "2024-01-01 03:00:00" and row.expires is None


def test_unmapped(spark):
    parsed = alerts.parse_alerts(objects(spark, [("a", cap(area="Papua")), ("b", cap())]))
    assert [r.area_desc for r in alerts.unmapped_alerts(parsed, lookups.province_cities(spark)).collect()] == ["Papua"]


def test_feed_links(spark):
    rss = (
        "<rss><channel><link>https://h/</link><item><link> a_alert.xml </link></item>"
        "<item><title>none</title></item><item><link></link><link>b</link></item></channel></rss>"
    )
    rdf = '<rdf:RDF xmlns:rdf="x"><item><link>/z/c_alert.xml</link></item></rdf:RDF>'
    feeds = spark.createDataFrame(
        [(1, bytearray(rss.encode())), (2, bytearray(rdf.encode())), (3, bytearray(b"<broken"))], "id INT, content BINARY"
    )
    got = alerts.feed_links(feeds, "https://h/feeds/rss.xml").orderBy("id").collect()
    assert [(r.id, r.url, r.identifier) for r in got] == [
        (1, "https://h/feeds/a_alert.xml", "a"), (2, "https://h/z/c_alert.xml", "c"),
    ]


def test_landed_objects(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        folder = tmp_path / f"ingestion_date={day}"
        folder.mkdir()
        (folder / "A_alert.xml").write_text(cap())
        (folder / "other.txt").write_text("x")
    (tmp_path / "B_alert.xml").write_text(cap())
    assert landed.alert_objects(spark, str(tmp_path)).count() == 3
    only = alerts.parse_alerts(landed.alert_objects(spark, str(tmp_path), ["2024-01-02"])).collect()
    assert [str(r.ingestion_date) for r in only] == ["2024-01-02"]


def test_many_alerts_of_one_city_group_by_event(spark):
    """A city with most of the alerts reaches its final group as distinct events."""
    plan = daily(spark, [("a", cap())])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    lines = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("weather_event" in line for line in lines)


def test_handover_must_not_be_empty(spark, tmp_path):
    (tmp_path / "empty.jsonl").write_text("\n")
    with pytest.raises(ValueError, match="no records"):
        landed.weather_daily_json(spark, str(tmp_path / "empty.jsonl"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landed.weather_daily_json(spark, str(tmp_path / "absent.jsonl"))


def test_fixed_tables_are_broadcast_by_their_known_size(spark):
    mapped = alerts.map_alerts(alerts.parse_alerts(objects(spark, [("a", cap())])), lookups.province_cities(spark))
    plan = mapped._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "LocalTableScan" in lookups.station_seed(spark)._jdf.queryExecution().executedPlan().toString()


def test_roll_up_against_a_loop(spark):
    """Many alerts in few cities, with event texts that contain one another."""
    random = Random(5)
    names = ["Rain", "Heavy Rain", "Rain; Wind", "Wind", "Heavy Rain and Wind", "", "Fog", "Dense Fog"]
    risks = {"Minor": 25.0, "Moderate": 50.0, "Severe": 80.0, "Extreme": 100.0, "Other": 0.0}
    docs = []
    for i in range(300):
        area = random.choice(["Jawa Barat", "DKI Jakarta", "Jakarta", "Papua"])
        docs.append((f"{i:04d}", random.choice(names), random.choice(list(risks)), area))
    expected = {}
    for name, event, severity, area in docs:
        city = {"Jawa Barat": "Bandung", "DKI Jakarta": "Jakarta", "Jakarta": "Jakarta"}.get(area)
        if city is None:
            continue
        cell = expected.setdefault(city, {"risk": 0.0, "n": 0, "events": "", "first": name})
        cell["risk"] = max(cell["risk"], risks[severity])
        cell["n"] += 1
        if event and event not in cell["events"]:
            cell["events"] = f"{cell['events']}; {event}" if cell["events"] else event
    shuffled = random.sample(docs, len(docs))
    got = daily(spark, [(n, cap(n, e, s, a)) for n, e, s, a in shuffled]).collect()
    assert {
        r.city: {"risk": r.weather_risk, "n": r.active_weather_alerts, "events": r.weather_event, "first": r.bmkg_alert_id}
        for r in got
    } == expected


def links(spark, *documents):
    feeds = spark.createDataFrame([(i, bytearray(d.encode())) for i, d in enumerate(documents)], "id INT, content BINARY")
    return [(r.id, r.item_pos, r.url) for r in alerts.feed_links(feeds, "https://h/f/r.xml").orderBy("id", "item_pos").collect()]


def test_feed_links_behind_markup_in_text(spark):
    one = "<rss><item><title><![CDATA[</item> x]]></title><link>a</link></item><item><link>b</link></item></rss>"
    two = "<rss><item><title><![CDATA[<!--]]></title><link>a</link></item><item><link>b</link><!-- --></item></rss>"
    both = [(0, "https://h/f/a"), (1, "https://h/f/b")]
    assert links(spark, one, two) == [(i, n, url) for i in (0, 1) for n, url in both]


def test_feed_links_of_nested_prefixed_and_partial_elements(spark):
    document = (
        "<?xml version='1.0'?><!DOCTYPE rss><rss xmlns:m='urn:m'><m:item t='x>y'><m:link rel=\"a>b\">p<!-- no -->q<![CDATA[&r]]><b/>s</m:link>"
        "<newsitem><m:link>&#65;&amp;b</m:link></newsitem><link>late</link></m:item>"
        "<item/><item><group><link>deep</link></group><link/><link>second</link></item><item><hyperlink> </hyperlink></item>"
        "<item><link><b>in</b></link></item></rss>"
    )
    assert links(spark, document) == [(0, 0, "https://h/f/pq&r"), (0, 1, "https://h/f/A&b"), (0, 4, "https://h/f/r.xml")]


def test_feed_links_equal_a_tree_walk(spark):
    """Random well-formed feeds against the library's own tree."""
    random = Random(11)
    names = ["item", "link", "x:item", "x:link", "title", "myitem", "backlink"]

    def element(depth):
        name = random.choice(names)
        parts = [random.choice(["", " ", "a", "&lt;b", "<!-- <item> -->", "<![CDATA[<link>]]>", "<?p </item>?>"]) for _ in range(2)]
        inner = "".join(random.choice([parts[0], parts[1], element(depth + 1) if depth < 4 else ""]) for _ in range(random.randint(0, 4)))
        return f"<{name}>{inner}</{name}>" if inner or random.random() < 0.5 else f"<{name}/>"

    feeds = [f"<rss xmlns:x='urn:x'>{''.join(element(0) for _ in range(4))}</rss>" for _ in range(150)]
    want = []
    for i, feed in enumerate(feeds):
        items = [e for e in ElementTree.fromstring(feed).iter() if e.tag.endswith("item")]
        for n, item in enumerate(items):
            link = next((c for c in item if c.tag.endswith("link")), None)
            if link is not None and link.text:
                want.append((i, n, urljoin("https://h/f/r.xml", link.text.strip())))
    assert len(want) > 50 and links(spark, *feeds) == want


def test_the_signal_equals_the_daily_rows(spark):
    rows = [(D, "A", f"e{i % 3}", float(i), 1, f"p{i}") for i in range(9)] + [(D, "B", None, None, 1, "q")]
    schema = "event_date DATE, city STRING, weather_event STRING, weather_risk DOUBLE, active_weather_alerts BIGINT, path STRING"
    mapped = spark.createDataFrame(rows, schema)
    for c in ("bmkg_alert_id", "severity", "urgency", "certainty", "area_desc", "effective", "expires", "headline", "processed_at"):
        mapped = mapped.withColumn(c, F.col("path"))
    events = alerts.weather_events_daily(mapped)
    daily = alerts.fold_events(events)
    shown = lambda df: sorted(map(tuple, df.select("city", "weather_risk", "active_weather_alerts").collect()))
    assert shown(alerts.weather_signal(mapped)) == shown(alerts.weather_signal(events)) == shown(daily) == [("A", 8.0, 9), ("B", None, 1)]


def test_feed_links_of_a_feed_with_very_many_items(spark):
    n = 4_000
    document = "<rss>" + "".join(f"<item><title>t</title><link>a{i}</link></item>" for i in range(n)) + "</rss>"
    start = time.perf_counter()
    assert links(spark, document) == [(0, i, f"https://h/f/a{i}") for i in range(n)]
    assert time.perf_counter() - start < 15


def test_feed_links_that_a_reader_changes(spark):
    """References, line ends and the end of literal text are read as XML, all else as it is."""
    feed = "<rss>{}</rss>".format("".join(f"<item><link>{t}</link></item>" for t in (
        "a&#x2f;b", "a&lt;b", "a\r\nb", "<![CDATA[a]]]]><![CDATA[>b]]>", "\u00e9\u2028", "a/./b//c/", "x?y=/../z", "x_alert.xml_alert.xml//",
    )))
    assert [u.removeprefix("https://h/f/") for _, _, u in links(spark, feed)] == [
        "a/b", "a<b", "a\nb", "r.xml", "\u00e9\u2028", "a/b/c/", "x?y=/../z", "x_alert.xml_alert.xml/",
    ]


def test_identifier_is_the_last_segment_without_suffix(one):
    urls = ["h/a_alert.xml", "h/a_alert.xml_alert.xml//", "/", "", None, "h/_alert.xml", "h/b\n", "h/\u00e9_alert.xml", "h/c\u2028", "h/d_alert.xml\n"]
    assert one(alert_identifier(F.col("v")), "STRING", urls) == [
        "a", "a_alert.xml", "", "", None, "", "b", "\u00e9", "c", "d",
    ]
