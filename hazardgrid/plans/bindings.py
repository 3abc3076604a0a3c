"""The driver's tables shaped into the inputs of the jobs.

Every binding is a row-wise projection (plus key joins) of whole tables, so its
size follows the tables. The texts it builds, CAP XML and event JSON, carry
deliberate faults at fixed positions, for the parsers to deal with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardgrid import constants as C
from hazardgrid import schemas

AS_OF = "2024-01-20 00:00:00"
FEED_URL = "https://alerts.example/feeds/id/rss.xml"
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


_LONG, _INT, _DOUBLE, _STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

# The columns the bindings use. Declaring them saves the job that reads a file
# footer to infer a schema.
TABLES = {
    "nation": _columns(n_nationkey=_INT, n_name=_STRING),
    "customer": _columns(c_custkey=_LONG, c_name=_STRING, c_nationkey=_INT, c_mktsegment=_STRING),
    "orders": _columns(o_orderkey=_LONG, o_custkey=_LONG),
    "lineitem": _columns(
        l_orderkey=_LONG, l_suppkey=_LONG, l_linenumber=_INT, l_quantity=_DOUBLE, l_discount=_DOUBLE, l_tax=_DOUBLE
    ),
    "events": _columns(
        event_id=_LONG, ts=T.TimestampNTZType(), user_id=_LONG, event_type=_STRING, value=_DOUBLE
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _cut(name: str, n: int, characters: int) -> Column:
    """The text of a column, shortened at the end in every n-th row."""
    text = F.col(name)
    return F.when(_every(n), F.substring(text, F.lit(1), F.length(text) - characters)).otherwise(text)


def _followed(name: str, n: int) -> Column:
    """The text of a column, in every n-th row with text behind it that ends an array."""
    text = F.col(name)
    return F.when(_every(n), F.concat(text, F.lit(",{}] {"))).otherwise(text)


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored without a zone; the values are UTC.
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def spread(events: DataFrame) -> DataFrame:
    """Event rows dealt out by their id, whatever their number.

    Landed texts come as many objects, the table they are built from as one row
    group; so the texts are built, and parsed, by as many tasks as a shuffle has.
    """
    width = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return events.repartition(width, "event_id")


def driver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery events: all order lines, in the nation of their customer.

    Every fifth nation delivers under the name of a hub, so that its own name
    has no deliveries and the hub has neither weather nor air quality.
    """
    hub = F.concat(F.lit("HUB_"), F.col("n_nationkey"))
    nation = table(spark, sf_dir, "nation").withColumn(
        "n_name", F.when(F.col("n_nationkey") % 5 == 0, hub).otherwise(F.col("n_name"))
    )
    order_city = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "n_name")
    )
    lines = table(spark, sf_dir, "lineitem")
    delay = F.greatest(F.lit(0.0), F.round(F.col("l_tax") * 100) * 5 - 10)
    expected = F.col("l_quantity") + 20
    offset = (F.col("l_suppkey") % 10) * F.lit(0.01)
    day = F.timestamp_seconds(F.lit(1704067200) + (F.col("o_orderkey") % 30) * 86400 + F.col("l_linenumber") * 3600)
    return lines.join(order_city, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "o_orderkey", "l_linenumber").alias("event_id"),
        day.alias("event_ts"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("DRV-"), F.col("l_suppkey")).alias("driver_id"),
        F.concat(F.lit("ORD-"), F.col("o_orderkey")).alias("order_id"),
        (F.lit(-6.0) + offset).alias("latitude"),
        (F.lit(106.8) + offset).alias("longitude"),
        expected.alias("expected_delivery_min"),
        (expected + delay).alias("actual_delivery_min"),
        delay.alias("delay_min"),
        (F.lit(2.5) + F.col("l_discount") * 25).alias("route_rating"),
    )


def _alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(events_table(spark, sf_dir).select("event_id", "ts", "user_id"))


def _alert_id() -> Column:
    return F.concat(F.lit("AL"), F.lpad(F.col("event_id").cast("string"), 10, "0"))


def alert_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CAP documents as landed objects (``path``, ``content``).

    Every 50th uses a namespace prefix, every 97th is cut off, every 101st is of
    another namespace (and names the right one in a comment), every 103rd has
    text behind its root, and every 107th is written in Latin-1 and says so.
    """
    events = _alert_events(spark, sf_dir)
    severity = F.element_at(
        F.array(*[F.lit(s) for s in ("Minor", "Moderate", " SEVERE ", "extreme", "Unknown", None)]),
        (F.col("event_id") % 6).cast("int") + 1,
    )
    stamp = lambda ts: F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def document(prefix: str) -> Column:
        tag = lambda name, text: F.concat(F.lit(f"<{prefix}{name}>"), text, F.lit(f"</{prefix}{name}>"))
        xmlns = f"xmlns:{prefix[:-1]}" if prefix else "xmlns"
        event = F.concat(F.lit("EV-"), F.char((F.lit(65) + F.col("event_id") % 7)))
        info = F.concat(
            tag("event", event),
            tag("urgency", F.lit("Immediate")),
            F.coalesce(tag("severity", severity), F.lit("")),
            tag("certainty", F.lit("Observed")),
            tag("effective", stamp(F.col("ts"))),
            tag("expires", stamp(F.col("ts") + F.expr("INTERVAL 3 HOURS"))),
            tag("headline", F.concat(F.when(_every(107), "Alerté ").otherwise("Alert "), F.col("event_id"))),
            tag(
                "area",
                F.concat(
                    tag("areaDesc", F.concat(F.lit(" Province "), F.col("user_id") % 30, F.lit("\n"))),
                    tag("polygon", F.lit("-6.1,106.7 -6.2,106.8 -6.1,106.7")),
                ),
            ),
        )
        other = F.when(_every(101), f'urn:other"><!-- "{C.CAP_NAMESPACE}" --').otherwise(f'{C.CAP_NAMESPACE}"')
        return F.concat(
            F.lit(f'<{prefix}alert {xmlns}="'),
            other,
            F.lit(">"),
            tag("identifier", _alert_id()),
            tag("info", info),
            F.lit(f"</{prefix}alert>"),
        )

    whole = F.when(_every(50), document("cap:")).otherwise(document(""))
    path = F.concat(
        F.lit("/bronze/alerts/ingestion_date="), F.to_date("ts").cast("string"), F.lit("/"), _alert_id(), F.lit(C.CAP_FILE_SUFFIX)
    )
    latin = F.encode(F.concat(F.lit('<?xml version="1.0" encoding="ISO-8859-1"?>'), F.col("content")), "ISO-8859-1")
    return (
        events.select("event_id", path.alias("path"), whole.alias("content"))
        .withColumn("content", _cut("content", 97, 40))
        .withColumn("content", F.when(_every(103), F.concat("content", F.lit("<x/>"))).otherwise(F.col("content")))
        .select("path", F.when(_every(107), latin).otherwise(F.col("content").cast("binary")).alias("content"))
    )


def alert_provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Province to city: one province per nation; provinces 25 to 29 have no city."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("Province "), F.col("n_nationkey")).alias("area_desc"), F.col("n_name").alias("city")
    )


def feed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert feed per event, with links of every relative form and an item deeper down.

    The last item is of another namespace, has its link partly in a CDATA section and
    holds an item whose title looks like markup.

    Every 89th is cut off and every 113th ends with a byte that is no UTF-8.
    """
    name = F.concat(_alert_id(), F.lit(C.CAP_FILE_SUFFIX))
    item = lambda *parts: F.concat(F.lit("<item><title>t</title>"), *parts, F.lit("</item>"))
    link = lambda *parts: F.concat(F.lit("<link>"), *parts, F.lit("</link>"))
    content = F.concat(
        F.lit('<rss version="2.0" xmlns:atom="http://www.w3.org/2005/Atom"><channel><link>https://alerts.example/</link>'),
        item(link(F.lit("https://mirror.example/cap/"), name)),
        item(link(F.lit(" "), name, F.lit("\n")), link(F.lit("second"))),
        item(link(F.lit("../cap/./"), name)),
        item(link(F.lit("/cap/"), _alert_id(), F.lit("/"))),
        item(),
        item(F.lit("<link/>"), link(F.lit("ignored"))),
        F.lit("<group>"),
        item(link(F.lit("https://alerts.example/deep/"), _alert_id())),
        F.lit("</group><!-- "),
        item(link(F.lit("https://alerts.example/hidden/"), _alert_id())),
        F.lit(" --><x:item xmlns:x='urn:x' note='a > b'><x:link><![CDATA[/cap/a&b]]>"),
        _alert_id(),
        F.lit("<br/>cut</x:link><item><title><![CDATA[</item><!--]]></title><link>inner/&amp;"),
        _alert_id(),
        F.lit("</link></item><link>later</link></x:item></channel></rss>"),
    )
    events = _alert_events(spark, sf_dir).select("event_id", content.alias("content"))
    text = _cut("content", 89, 12).cast("binary")
    return events.select(
        "event_id", F.when(_every(113), F.concat(text, F.unhex(F.lit("FF")))).otherwise(text).alias("content")
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PM2.5 event messages with their publish time (see ``message_columns``)."""
    return message_stream(events_table(spark, sf_dir))


def message_stream(events: DataFrame) -> DataFrame:
    """The messages of a frame or stream of event rows."""
    return message_columns(spread(events.select("event_id", "ts", "user_id", "value")))


#: Deliveries in which the messages arrive.
ARRIVALS = 5


def arrival() -> Column:
    """Which delivery brings an event: by day of the month, every tenth event one later."""
    return F.floor((F.dayofmonth("ts") - 1) * 4 / 31) + F.when(_every(10), 1).otherwise(0)


def message_columns(events: DataFrame) -> DataFrame:
    """Event rows as JSON messages; faults repeat with the event id.

    Negative value (17), other parameter (23), out of bounds (29), value key
    absent (31), cut-off JSON (37), unreadable time (41), value in quotes (43),
    text behind the object (47), a second value key (59), no utc (61), a huge
    value (1009), an infinite one (1013).
    """
    number = (
        F.when(_every(1009), 1e25)
        .when(_every(1013), float("inf"))
        .when(_every(17), -F.col("value"))
        .otherwise(F.col("value"))
    )
    moment = F.struct(
        F.when(_every(61), F.lit(None)).when(_every(41), "garbage").otherwise(F.date_format("ts", _ISO)).alias("utc"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("local"),
    )
    ingested = F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 36).cast("int"))
    head = [
        F.lit(C.EVENT_SOURCE).alias("source"),
        F.date_format(ingested, _ISO).alias("ingestion_timestamp"),
        F.col("user_id").alias("location_id"),
        F.concat(F.lit("Station "), F.col("user_id")).alias("location_name"),
        F.lit(None).cast("string").alias("locality"),
        F.lit(C.COUNTRY_CODE).alias("country_code"),
        F.when(_every(29), 10.0).otherwise(-6.2).alias("latitude"),
        F.lit(106.8).alias("longitude"),
        F.when(_every(23), "pm10").otherwise(C.PM25_NAME).alias("parameter"),
        F.when(_every(23), 1).otherwise(C.PM25_ID).alias("parameter_id"),
        F.lit("PM2.5").alias("parameter_display_name"),
        F.lit("µg/m³").alias("unit"),
    ]
    tail = [
        moment.alias("measurement_datetime"),
        F.col("user_id").alias("sensor_id"),
        F.col("user_id").alias("source_location_id"),
    ]
    write = lambda *value: F.to_json(F.struct(*head, *value, *tail), {"ignoreNullFields": "false"})
    text = (
        F.when(_every(31), write())
        .when(_every(43), write(number.cast("string").alias("value")))
        .otherwise(write(number.alias("value")))
    )
    # The writer puts quotes around an infinite number; nothing is searched for in other texts.
    quoted = F.when(number == float("inf"), '"value":"Infinity"').otherwise("")
    text = F.replace(text, quoted, F.lit('"value":Infinity'))
    text = F.when(_every(59), F.regexp_replace(text, r"\}$", ',"value":-5.5}')).otherwise(text)
    return (
        events.select("event_id", F.col("ts").alias("published_at"), text.alias("value"))
        .withColumn("value", _cut("value", 37, 5))
        .withColumn("value", _followed("value", 47))
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station mapping: every user is a station, but not every station is mapped.

    A third of the stations has no operating city and so no row in the mapping.
    """
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("user_id") % 3 != 0)
        .select(
            F.col("user_id").alias("location_id"),
            F.concat(F.lit("NATION_"), F.col("user_id") % 25).alias("city"),
        )
        .distinct()
    )


def combined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combined_columns(events_table(spark, sf_dir))


def combined_columns(events: DataFrame) -> DataFrame:
    """Records holding all three signals, as JSON; every 53rd is cut off, every 47th has text behind it."""
    severity = F.element_at(
        F.array(*[F.lit(s) for s in ("Minor", "Moderate", " SEVERE ", "extreme", "Unknown", None)]),
        (F.col("event_id") % 6).cast("int") + 1,
    )
    rest = [
        F.concat(F.lit("NATION_"), F.col("user_id") % 25).alias("city"),
        F.col("value").alias("pm25"),
        ((F.col("event_id") % 11) / F.lit(10.0)).alias("delay_rate"),
    ]
    head = [
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", _ISO).alias("event_ts"),
    ]
    write = lambda key: F.to_json(F.struct(*head, severity.alias(key), *rest), {"ignoreNullFields": "false"})
    text = F.when(_every(2), write("severity")).otherwise(write("weather_severity"))
    return (
        spread(events.select("event_id", "ts", "user_id", "value"))
        .select("event_id", text.alias("value"))
        .select("event_id", _cut("value", 53, 5).alias("value"))
        .select(F.col("event_id").alias("row_id"), _followed("value", 47).alias("value"))
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring locations: customers in key order."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("pos"),
        key.alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("locality"),
        F.struct(F.when(key % 13 == 0, "BG").otherwise("id").alias("code")).alias("country"),
        F.struct(
            F.when(key % 11 == 0, 40.0).otherwise(-6.2).alias("latitude"), F.lit(106.8).alias("longitude")
        ).alias("coordinates"),
    )


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements: all events, taken by the user's own sensor."""
    return events_table(spark, sf_dir).select(
        F.col("user_id").alias("locationsId"),
        F.when(_every(19), 0).otherwise(F.col("user_id")).alias("sensorsId"),
        "value",
        F.struct(
            F.date_format("ts", _ISO).alias("utc"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("local"),
        ).alias("datetime"),
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor metadata: every fourth sensor measures PM10."""
    key = F.col("user_id")
    other = key % 4 == 0
    return (
        table(spark, sf_dir, "events")
        .select("user_id")
        .distinct()
        .select(
            key.alias("id"),
            F.struct(
                F.when(other, 1).otherwise(2).cast("bigint").alias("id"),
                F.when(other, "pm10").otherwise("PM25").alias("name"),
                F.when(other, "PM10").otherwise("PM2.5").alias("displayName"),
                F.lit("µg/m³").alias("units"),
            ).alias("parameter"),
        )
    )


def unobserved_cell(spark: SparkSession) -> DataFrame:
    """A weather row without a risk, the only way to the no-data band."""
    row = spark.sql("SELECT DATE '2024-01-15' AS event_date, 'UNOBSERVED' AS city, 0L AS active_weather_alerts")
    return row.select(
        *[
            (F.col(f.name) if f.name in row.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.ENVIRONMENT_RISK_DAILY
        ]
    )


def broken_delivery(spark: SparkSession) -> DataFrame:
    """Delivery rows that break each not-null check, one more of them every time."""
    return spark.sql(
        """SELECT * FROM VALUES (NULL, 'A', 1L, 0.0D), (DATE '2024-02-01', NULL, 1L, 0.0D),
        (DATE '2024-02-02', NULL, 1L, 0.0D), (DATE '2024-02-01', 'A', NULL, NULL),
        (DATE '2024-02-02', 'A', NULL, NULL), (DATE '2024-02-03', 'A', NULL, NULL),
        (DATE '2024-02-04', 'A', 1L, NULL) AS t(event_date, city, orders, delay_rate)"""
    )


def broken_gold(spark: SparkSession) -> DataFrame:
    """Gold rows that break each check: null keys, score and band, range, unknown and wrong bands."""
    return spark.sql(
        """SELECT * FROM VALUES (NULL, 'A', 10.0D, 'LOW', 10.0D), (DATE '2024-02-01', NULL, 10.0D, 'LOW', 10.0D),
        (DATE '2024-02-02', NULL, 10.0D, 'LOW', 10.0D), (DATE '2024-02-01', 'A', NULL, NULL, 10.0D),
        (DATE '2024-02-02', 'A', 10.0D, NULL, 10.0D), (DATE '2024-02-03', 'A', -0.5D, 'LOW', 10.0D),
        (DATE '2024-02-04', 'A', 100.5D, 'CRITICAL', 10.0D), (DATE '2024-02-05', 'A', 10.0D, 'SEVERE', 10.0D),
        (DATE '2024-02-06', 'A', 25.0D, 'LOW', 10.0D), (DATE '2024-02-07', 'A', 75.0D, 'HIGH', 10.0D),
        (DATE '2024-02-08', 'A', 49.99D, 'HIGH', 10.0D), (DATE '2024-02-09', 'A', 0.0D, 'INSUFFICIENT_DATA', 10.0D),
        (DATE '2024-02-10', 'A', 0.0D, 'INSUFFICIENT_DATA', NULL)
        AS t(event_date, city, risk_score, risk_band, weather_risk)"""
    )


def earlier_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content of a daily table before an upsert: (event_date, city, n), a day behind the events."""
    city = F.concat(F.lit("NATION_"), F.col("user_id") % 25)
    return (
        events_table(spark, sf_dir)
        .groupBy(F.date_sub(F.to_date("ts"), 1).alias("event_date"), city.alias("city"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
