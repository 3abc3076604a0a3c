import json

import pytest
from pyspark.sql import functions as F

from hazardgrid.operators import airquality, events
from hazardgrid.sinks.eventstore import EventStore
from hazardgrid.sources import landed
from hazardgrid.streaming import pipelines

GOOD = {
    "source": "openaq",
    "ingestion_timestamp": "2024-01-10T12:00:00+00:00",
    "location_id": 8320,
    "location_name": "Stasiun é",
    "locality": None,
    "country_code": "ID",
    "latitude": -6.2,
    "longitude": 106.8,
    "parameter": "pm25",
    "parameter_id": 2,
    "parameter_display_name": "PM2.5",
    "unit": "µg/m³",
    "value": 19.0,
    "measurement_datetime": {"utc": "2024-01-10T11:00:00Z", "local": "2024-01-10T18:00:00+07:00"},
    "sensor_id": 1,
    "source_location_id": 8320,
}
AS_OF = "2024-01-10 12:30:00"


def message(**changes):
    record = {**GOOD, **changes}
    return json.dumps({k: v for k, v in record.items() if v is not ...}, ensure_ascii=False)


def strict(spark, *messages, as_of=AS_OF):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "i INT, value STRING")
    checked = events.validate_strict(events.parse_messages(df), F.lit(as_of).cast("timestamp"))
    return checked.orderBy("i").collect()


def lenient(spark, *messages):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "i INT, value STRING")
    return events.validate_ingest_age(events.parse_messages(df)).orderBy("i").collect()


def errors(rows):
    return [r["validation_error"] for r in rows]


def test_valid_event_is_enriched(spark):
    (row,) = strict(spark, message())
    assert (row.validation_status, row.validation_error, row.freshness_status) == ("VALID", None, "CURRENT")
    assert row.measurement_age_hours == 1.5
    assert row.location_name == "Stasiun é" and row.measurement_datetime.utc == "2024-01-10T11:00:00Z"
    assert row.raw_message is None and row.record_json == message()


def test_parse_rejects(spark):
    bad = [
        "", "null", "[1]", '"text"', "12", '{"a":1', "{'a':1}", '{"a":1,}',
        message() + " x", message() + "}", message() + "\n" + message(), message() + "," + message(),
    ]
    rows = strict(spark, *bad)
    assert errors(rows) == ["JSON_PARSE_ERROR"] * len(bad)
    assert [r.raw_message for r in rows] == bad
    assert all(r.freshness_status is None and r.processed_at is not None for r in rows)


def test_surrounding_whitespace_is_fine(spark):
    assert errors(strict(spark, "  " + message() + " \n")) == [None]


def test_absent_key_is_missing_but_null_is_not(spark):
    rows = strict(
        spark,
        message(source=..., value=...),
        message(source=None),
        message(value=None),
        "{}",
    )
    assert errors(rows) == [
        "MISSING_FIELD:source;MISSING_FIELD:value",
        None,
        "INVALID_VALUE",
        ";".join(
            f"MISSING_FIELD:{f}"
            for f in (
                "source", "ingestion_timestamp", "location_id", "latitude", "longitude",
                "parameter", "value", "measurement_datetime",
            )
        ),
    ]
    assert rows[0].freshness_status is None and rows[0].measurement_age_hours is None


@pytest.mark.parametrize(
    "changes, error",
    [
        ({"parameter": "PM25", "parameter_id": 9}, None),
        ({"parameter": "pm10", "parameter_id": 2}, None),
        ({"parameter": None, "parameter_id": ...}, "NOT_PM25"),
        ({"parameter": "pm10", "parameter_id": 1}, "NOT_PM25"),
        ({"value": "12.5"}, None),
        ({"value": "abc"}, "INVALID_VALUE"),
        ({"value": float("nan")}, "NAN_VALUE"),
        ({"value": float("inf")}, None),
        ({"value": -0.5}, "NEGATIVE_VALUE"),
        ({"latitude": "x"}, "INVALID_COORDINATES"),
        ({"longitude": None}, "INVALID_COORDINATES"),
        ({"latitude": 6.0, "longitude": 141.0}, None),
        ({"latitude": 6.01}, "OUTSIDE_INDONESIA_BOUNDS"),
        ({"latitude": float("nan")}, "OUTSIDE_INDONESIA_BOUNDS"),
        ({"measurement_datetime": None}, "MISSING_MEASUREMENT_UTC"),
        ({"measurement_datetime": "2024-01-10"}, "MISSING_MEASUREMENT_UTC"),
        ({"measurement_datetime": {"local": "x"}}, "MISSING_MEASUREMENT_UTC"),
        ({"measurement_datetime": {"utc": ""}}, "MISSING_MEASUREMENT_UTC"),
        ({"measurement_datetime": {"utc": "2025"}}, "INVALID_MEASUREMENT_TIMESTAMP"),
        ({"measurement_datetime": {"utc": 12345}}, "INVALID_MEASUREMENT_TIMESTAMP"),
        ({"measurement_datetime": {"utc": "2024-01-09T12:30:00Z"}}, None),
        ({"measurement_datetime": {"utc": "2024-01-09T12:29:59Z"}}, "STALE_MEASUREMENT"),
        ({"measurement_datetime": {"utc": "2024-01-10T12:30:01"}}, "FUTURE_MEASUREMENT"),
        (
            {"parameter": "x", "parameter_id": 0, "value": -1, "latitude": 50, "measurement_datetime": {}},
            "NOT_PM25;NEGATIVE_VALUE;OUTSIDE_INDONESIA_BOUNDS;MISSING_MEASUREMENT_UTC",
        ),
    ],
)
def test_strict_rules(spark, changes, error):
    assert errors(strict(spark, message(**changes))) == [error]


SAMPLES = [
    message(parameter_id=..., ingestion_timestamp="2026-09-18T01:00:00+00:00", value=19.0,
            measurement_datetime={"utc": "2025-11-04T21:00:00Z", "local": "2025-11-05T04:00:00+07:00"}),
    message(parameter_id=..., ingestion_timestamp="2026-09-18T01:00:00+00:00", value=-999.0,
            measurement_datetime={"utc": "2016-11-09T16:00:00Z", "local": "2016-11-09T23:00:00+07:00"}),
    message(parameter_id=..., ingestion_timestamp="2026-09-18T01:00:00+00:00", value=42.559375,
            measurement_datetime={"utc": "2024-03-09T19:00:00Z", "local": "2024-03-10T02:00:00+07:00"}),
]


def test_sample_events(spark):
    assert errors(strict(spark, *SAMPLES, as_of="2026-09-18 01:00:00")) == [
        "STALE_MEASUREMENT", "NEGATIVE_VALUE;STALE_MEASUREMENT", "STALE_MEASUREMENT",
    ]
    rows = lenient(spark, *SAMPLES)
    assert [(r.validation_status, r.freshness_status) for r in rows] == [
        ("VALID", "STALE"), ("INVALID", None), ("VALID", "STALE"),
    ]
    assert rows[1].validation_error == "Negative PM2.5 value: -999.0"


def test_ingest_age_rules(spark):
    rows = lenient(
        spark,
        message(measurement_datetime={"utc": "2024-01-09T12:00:00Z"}),
        message(measurement_datetime={"utc": "2024-01-09T11:59:00Z"}),
        message(measurement_datetime={"utc": "2024-01-11T12:00:00Z"}),
        message(value="x"),
        message(value=None),
        message(measurement_datetime={"utc": "garbage"}),
        message(measurement_datetime={"utc": "2024-01-10T11:00:00"}),
        message(source=..., value=...),
        "nope",
        message(latitude=..., parameter=...),
    )
    assert [(r.freshness_status, r.measurement_age_hours) for r in rows[:3]] == [
        ("CURRENT", 24.0), ("STALE", 24.02), ("CURRENT", -24.0),
    ]
    assert errors(rows)[3:] == [
        "INVALID_VALUE",
        "NULL_VALUE",
        "INVALID_MEASUREMENT_TIMESTAMP",
        "MIXED_TIME_ZONES",
        "Missing required fields: ['source', 'value']",
        "JSON parsing error",
        None,
    ]


def test_bytes_messages(spark):
    df = spark.createDataFrame([(bytearray(message().encode()),), (bytearray(b'{"a":"\xff"}'),)], "value BINARY")
    rows = events.validate_strict(events.parse_messages(df), F.lit(AS_OF).cast("timestamp")).collect()
    by_status = {r.validation_status: r for r in rows}
    assert by_status["VALID"].location_id == 8320
    assert by_status["INVALID"].validation_error == "JSON_PARSE_ERROR"
    assert by_status["INVALID"].raw_message == '{"a":"�"}'


def test_routing_keeps_every_record(spark):
    df = spark.createDataFrame([(message(),), (message(value=-1),), ("bad",)], "value STRING")
    checked = events.validate_strict(events.parse_messages(df), F.lit(AS_OF).cast("timestamp"))
    silver = events.silver_events(checked).collect()
    assert [r.record_json for r in silver] == [message()]
    audit = {(r.raw_message, r.record_json) for r in events.audit_events(checked).collect()}
    assert audit == {("bad", None), (None, message(value=-1))}


def test_text_behind_the_object_and_repeated_keys(spark):
    plain = message()
    texts = [
        plain + '{"a":1}]', plain + ",{}]", plain + ",{}] junk", plain + "]", plain + ",", "[" + plain + "]",
        plain[:-1] + ', "value": -5}', plain[:-1] + ', "value": 7}', plain + "  ",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, value STRING")
    checked = events.validate_strict(events.parse_messages(df), F.lit(AS_OF).cast("timestamp"))
    got = {r.i: (r.validation_error, r.value) for r in checked.collect()}
    assert all(got[i] == ("JSON_PARSE_ERROR", None) for i in range(6))
    assert got[6] == ("NEGATIVE_VALUE", -5.0) and got[7] == (None, 7.0) and got[8][0] is None


def test_to_message_keeps_nulls_and_unicode(spark):
    df = spark.createDataFrame([("µg", None)], "a STRING, b STRING")
    assert events.to_message(df).first()["value"] == '{"a":"µg","b":null}'


def test_parser_runs_once_per_row(spark):
    df = spark.createDataFrame([(message(),)], "value STRING")
    checked = events.validate_strict(events.parse_messages(df), F.lit(AS_OF).cast("timestamp"))
    plan = airquality.admissible(events.silver_events(checked))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(ArrayType(") == 1
    assert plan.count("NEGATIVE_VALUE") == 1


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    lines = [message(location_id=i, value=v) for i, v in enumerate([1, -1, 3, "x", 5])] + ["broken"]
    for part in range(3):
        (source / f"part{part}.jsonl").write_text("\n".join(lines[part * 2 : part * 2 + 2]), encoding="utf-8")
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(source))
    as_of = F.lit(AS_OF).cast("timestamp")
    query = pipelines.event_pipeline(
        stream, f"{tmp_path}/store", f"{tmp_path}/cp", as_of=as_of, once=True
    )
    query.awaitTermination()
    batch = events.validate_strict(events.parse_messages(spark.read.text(str(source))), as_of)
    for part, expected in (("silver", events.silver_events(batch)), ("audit", events.audit_events(batch))):
        written = EventStore(spark, f"{tmp_path}/store").read(expected.schema, part).select(*expected.columns)
        assert written.exceptAll(expected).isEmpty() and expected.exceptAll(written).isEmpty()
        assert len(list((tmp_path / "store/data").glob("part=batch-*"))) == 3
    # Running again over the same input adds nothing.
    pipelines.event_pipeline(
        spark.readStream.format("text").load(str(source)),
        f"{tmp_path}/store", f"{tmp_path}/cp", as_of=as_of, once=True,
    ).awaitTermination()
    assert landed.silver_events(spark, f"{tmp_path}/store").count() == 3


def test_late_records_miss_closed_windows(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    schema = "published_at TIMESTAMP, validation_status STRING"
    first = [("2024-01-01 00:00:10", "VALID"), ("2024-01-01 00:03:00", "VALID")]
    late = [("2024-01-01 00:00:20", "VALID"), ("2024-01-01 00:06:00", "INVALID")]
    for n, rows in enumerate((first, late)):
        df = spark.createDataFrame(rows, "t STRING, validation_status STRING")
        df = df.select(F.col("t").cast("timestamp").alias("published_at"), "validation_status")
        df.coalesce(1).write.parquet(f"{source}/batch{n}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(source))
        pipelines.window_count_pipeline(stream, f"{tmp_path}/out", f"{tmp_path}/cp", once=True).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out").orderBy("window_start").collect()
    assert [(str(r.window_start), r.validation_status, r.records) for r in out] == [
        ("2024-01-01 00:00:00", "VALID", 1),
        ("2024-01-01 00:03:00", "VALID", 1),
    ]


def station_events(spark, rows):
    schema = (
        "location_id BIGINT, value DOUBLE, utc STRING, ingestion_timestamp STRING, "
        "parameter STRING, parameter_id BIGINT"
    )
    df = spark.createDataFrame(rows, schema)
    return df.select(
        "*",
        F.struct("utc").alias("measurement_datetime"),
        F.lit("VALID").alias("validation_status"),
        F.lit("CURRENT").alias("freshness_status"),
    )


def test_latest_per_station_day(spark):
    day = "2024-01-01T"
    rows = [
        (1, 10.0, day + "10:00:00Z", "a", "pm25", 2),
        (1, 20.0, day + "11:00:00Z", "a", "pm25", 2),
        (1, 30.0, day + "11:00:00Z", "b", "pm25", 2),
        (1, 40.0, "2024-01-02T00:00:00Z", "a", "pm25", 2),
        (2, 50.0, day + "10:00:00Z", "a", "PM25", 2),
        (2, 60.0, day + "10:00:00Z", "a", "pm25", None),
        (2, float("nan"), day + "10:00:00Z", "a", "pm25", 2),
        (2, -1.0, day + "10:00:00Z", "a", "pm25", 2),
        (3, 70.0, day + "10:00:00Z", "a", "pm25", 2),
    ]
    # Station 1 is mapped twice, as after a repeated seed load.
    stations = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B")], "location_id BIGINT, city STRING")
    latest = airquality.latest_per_station_day(station_events(spark, rows), stations)
    got = sorted((str(r.event_date), r.city, r.pm25) for r in latest.collect())
    assert got == [("2024-01-01", "A", 30.0), ("2024-01-02", "A", 40.0)]
    daily = airquality.air_quality_daily(latest).orderBy("event_date").collect()
    assert [(r.avg_pm25, r.air_quality_risk, r.station_count, r.observation_count) for r in daily] == [
        (30.0, 40.0, 1, 1), (40.0, 53.33, 1, 1),
    ]


def test_duplicate_station_is_an_error(spark):
    stations = spark.createDataFrame(
        [(1, "A", "m", None), (1, "A", "m", None)],
        "location_id BIGINT, city STRING, mapping_method STRING, notes STRING",
    )
    with pytest.raises(Exception, match="duplicate station 1"):
        airquality.assert_unique_stations(stations).collect()
