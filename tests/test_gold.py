import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazardgrid import schemas
from hazardgrid.operators import arearisk, delivery, quality, rowscore, upsert
from hazardgrid.sinks import jsonlines
from hazardgrid.streaming import pipelines

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def frame(spark, schema, rows):
    names = schema.fieldNames()
    loose = "".join(f", {f.name} {f.dataType.simpleString()}" for f in schema)[2:]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], loose)


def signals(spark, delivery_rows=(), weather_rows=(), air_rows=()):
    return (
        frame(spark, schemas.DELIVERY_PERFORMANCE, delivery_rows),
        frame(spark, schemas.ENVIRONMENT_RISK_DAILY, weather_rows),
        frame(spark, schemas.AIR_QUALITY_DAILY, air_rows),
    )


def row(date, city, **values):
    return {"event_date": date, "city": city, **values}


CASES = dict(
    delivery_rows=[
        row(D1, "A", orders=3, delay_rate=0.5),
        row(D1, "B", orders=1, delay_rate=1.7),
        row(D1, None, orders=9, delay_rate=1.0),
        row(None, "A", orders=8, delay_rate=1.0),
        row(D2, "Q", orders=1, delay_rate=None),
    ],
    weather_rows=[
        row(D1, "A", weather_risk=80.0, active_weather_alerts=2),
        row(D1, "A", weather_risk=50.0, active_weather_alerts=7),
        row(D2, "N", weather_risk=None, active_weather_alerts=1),
        row(D1, None, weather_risk=100.0, active_weather_alerts=1),
        row(D2, "W", weather_risk=100.0, active_weather_alerts=1),
    ],
    air_rows=[
        row(D1, "A", avg_pm25=48.0, air_quality_risk=64.0, station_count=2, observation_count=3),
        row(D2, "X", avg_pm25=75.0, air_quality_risk=100.0, station_count=1, observation_count=1),
    ],
)


def test_one_pass_equals_spine_and_joins(spark):
    inputs = signals(spark, **CASES)
    one = arearisk.score(arearisk.combine_in_one_pass(*inputs))
    joined = arearisk.score(arearisk.combine_by_joins(*inputs))
    assert one.columns == joined.columns == schemas.AREA_RISK_DAILY.fieldNames()
    assert one.count() == joined.count() == 8
    assert one.exceptAll(joined).isEmpty() and joined.exceptAll(one).isEmpty()


def test_gold_scores_and_flags(spark):
    gold = {(r.event_date, r.city): r for r in arearisk.area_risk_daily(*signals(spark, **CASES)).collect()}
    a = gold[(D1, "A")]
    assert (a.risk_score, a.risk_band, a.weather_risk, a.active_weather_alerts) == (68.4, "HIGH", 80.0, 7)
    assert a.has_weather_data and a.has_air_quality_data
    # No deliveries means no delay risk, not full delay risk.
    assert gold[(D2, "W")].risk_score == 45.0 and not gold[(D2, "W")].has_air_quality_data
    # The delay risk is bounded.
    assert gold[(D1, "B")].risk_score == 20.0 and not gold[(D1, "B")].has_weather_data
    # All inputs missing: score 0 in a band of its own.
    for key in ((D2, "N"), (D2, "Q"), (D1, None)):
        assert (gold[key].risk_score, gold[key].risk_band) == (0.0, "INSUFFICIENT_DATA")
    # Null keys match nothing.
    assert gold[(D1, None)].orders is None and gold[(None, "A")].orders is None


def test_band_is_taken_before_rounding(spark):
    inputs = signals(spark, air_rows=[row(D1, "A", air_quality_risk=71.4171)])
    gold = arearisk.area_risk_daily(*inputs)
    (r,) = gold.collect()
    assert (r.risk_score, r.risk_band) == (25.0, "LOW")
    failed = {c.check_name: c.failed_rows for c in quality.run_checks(gold, quality.gold_checks()).collect()}
    assert failed["band_consistency"] == 1


def test_checks(spark):
    rows = [
        row(D1, "A", risk_score=10.0, risk_band="LOW"),
        row(None, "A", risk_score=101.0, risk_band="CRITICAL"),
        row(D1, "B", risk_score=-1.0, risk_band="ODD"),
        row(D1, "C", risk_score=60.0, risk_band="LOW"),
        row(D1, "C", risk_score=60.0, risk_band="MODERATE"),
        row(D1, "C", risk_score=75.0, risk_band="HIGH"),
        row(D1, "C", risk_score=74.0, risk_band="CRITICAL"),
        row(D1, "C", risk_score=0.0, risk_band="INSUFFICIENT_DATA", delay_rate=0.1),
        row(D1, "C", risk_score=0.0, risk_band="INSUFFICIENT_DATA"),
        row(D1, None, risk_score=None, risk_band=None),
    ]
    gold = frame(spark, schemas.AREA_RISK_DAILY, rows)
    failed = {c.check_name: c.failed_rows for c in quality.run_checks(gold, quality.gold_checks()).collect()}
    assert failed == {
        "not_null_event_date": 1, "not_null_city": 1, "not_null_risk_score": 1, "not_null_risk_band": 1,
        "accepted_values_risk_band": 1, "score_range": 2, "band_consistency": 5,
    }
    assert quality.failing_rows(gold, quality.score_range()).count() == 2
    with pytest.raises(quality.ChecksFailed, match="score_range: 2 rows"):
        quality.enforce(gold, quality.gold_checks())
    quality.enforce(gold.limit(1), quality.gold_checks())


def test_kpis(spark):
    rows = [
        row(D1, "A", risk_score=80.0, risk_band="CRITICAL", delay_rate=0.5, has_air_quality_data=True),
        row(D2, "A", risk_score=60.0, risk_band="HIGH", has_air_quality_data=False),
        row(D1, "B", risk_score=0.0, risk_band="INSUFFICIENT_DATA", has_air_quality_data=False),
        row(D2, "B", risk_score=20.0, risk_band="LOW", delay_rate=0.1, has_air_quality_data=True),
    ]
    gold = frame(spark, schemas.AREA_RISK_DAILY, rows)
    assert tuple(arearisk.kpi_overview(gold).first()) == (40.0, 2, 0.3, 0.5)
    by_city = arearisk.kpi_by_city(gold).collect()
    assert [(r.city, r.areas, r.avg_risk_score, r.high_or_critical, r.insufficient_data) for r in by_city] == [
        ("A", 2, 70.0, 2, 0), ("B", 2, 10.0, 0, 1),
    ]
    assert [r.event_date for r in arearisk.kpi_trend(gold).collect()] == [D1, D2]
    assert [(r.event_date, r.city) for r in arearisk.detail_table(gold).collect()][:2] == [(D2, "A"), (D2, "B")]


def test_delivery(spark):
    bronze = spark.createDataFrame(
        [
            ("e1", "2024-01-01 23:30:00", "A", "d", "o1", "1.5", "2", 20.0, 25.0, 5.5, "4.0"),
            ("e2", "2024-01-01T23:40:00Z", "A", "d", "o1", "1.5", "2", 20.0, 20.0, 0.0, "5.0"),
            ("e3", "2024-01-01 23:50:00+07:00", "A", "d", "o2", "1.5", "2", 30.0, 30.4, 0.4, None),
            ("e4", "2024-01-02 00:00:00", "A", "d", "o2", "1.5", "2", None, None, None, None),
        ],
        "event_id STRING, event_ts STRING, city STRING, driver_id STRING, order_id STRING, latitude STRING, "
        "longitude STRING, expected_delivery_min DOUBLE, actual_delivery_min DOUBLE, delay_min DOUBLE, route_rating STRING",
    )
    staged = delivery.stage_driver_events(bronze)
    assert staged.schema.simpleString() == schemas.DRIVER_EVENTS.simpleString()
    assert [r.delay_min for r in staged.orderBy("event_id").collect()] == [6, 0, 0, None]
    first, second = delivery.delivery_performance(staged).orderBy("event_date").collect()
    # Distinct orders, but the delay rate is per event row.
    assert (first.orders, first.delay_rate, first.avg_route_rating) == (2, pytest.approx(1 / 3), 4.5)
    assert (second.orders, second.delay_rate, second.avg_delay_min) == (1, 0.0, None)


KEYS = ["event_date", "city"]


def test_upsert_updates_inserts_and_keeps(spark):
    schema = "event_date DATE, city STRING, a BIGINT, kept STRING"
    target = spark.createDataFrame([(D1, "A", 1, "x"), (D1, "B", 2, "y")], schema)
    source = spark.createDataFrame([(D1, "A", 10), (D2, "C", 30)], "event_date DATE, city STRING, a BIGINT")
    once = upsert.upsert(target, source, KEYS, ["a"])
    got = sorted(tuple(r) for r in once.collect())
    assert got == [(D1, "A", 10, "x"), (D1, "B", 2, "y"), (D2, "C", 30, None)]
    twice = upsert.upsert(once, source, KEYS, ["a"])
    assert sorted(tuple(r) for r in twice.collect()) == got
    filled = upsert.upsert(target, source, KEYS, ["a"], {"kept": F.lit("new")})
    assert {r.kept for r in filled.filter("city = 'C'").collect()} == {"new"}
    cleared = spark.createDataFrame([(D1, "A", None)], "event_date DATE, city STRING, a BIGINT")
    assert upsert.upsert(target, cleared, KEYS, ["a"]).filter("city = 'A'").first().a is None


@pytest.mark.parametrize(
    "rows, message",
    [([(D1, "A", 1), (D1, "A", 2)], "duplicate merge key"), ([(D1, None, 1)], "incomplete merge key")],
)
def test_upsert_refuses_bad_keys(spark, rows, message):
    schema = "event_date DATE, city STRING, a BIGINT"
    target = spark.createDataFrame([(D2, "Z", 1)], schema)
    with pytest.raises(Exception, match=message):
        upsert.upsert(target, spark.createDataFrame(rows, schema), KEYS, ["a"]).collect()


def scores(spark, *messages):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "i INT, value STRING")
    return rowscore.score_rows(df).orderBy("i").collect()


@pytest.mark.parametrize(
    "message, score, band",
    [
        ('{"severity":"extreme","pm25":75,"delay_rate":1}', 100.0, "CRITICAL"),
        ('{"severity":"unknown","pm25":0,"delay_rate":0}', 0.0, "LOW"),
        ('{"severity":"moderate","pm25":0,"delay_rate":0}', 22.5, "LOW"),
        ('{"severity":"severe","pm25":50,"delay_rate":0.5}', 69.33, "HIGH"),
        ('{"weather_severity":"severe","pm25":0,"delay_rate":0}', 36.0, "MODERATE"),
        ('{"event_id":"demo-001","weather_severity":"severe","pm25":48,"delay_rate":0.25}', 63.4, "HIGH"),
        ('{"event_id":"demo-002","weather_severity":"moderate","pm25":22,"delay_rate":0.10}', 34.77, "MODERATE"),
        ('{"event_id":"demo-003","weather_severity":"extreme","pm25":60,"delay_rate":0.40}', 81.0, "CRITICAL"),
        ('{"severity":null,"weather_severity":"extreme"}', 0.0, "LOW"),
        ('{"severity":" severe "}', 0.0, "LOW"),
        ('{"severity":"SEVERE","pm25":"75","delay_rate":7}', 91.0, "CRITICAL"),
        ('{"pm25":-5,"delay_rate":-1}', 0.0, "LOW"),
        ("{}", 0.0, "LOW"),
    ],
)
def test_row_scores(spark, message, score, band):
    (r,) = scores(spark, message)
    assert (r.risk_score, r.risk_band, r.error) == (score, band, None)


def test_row_scores_use_the_rounded_band(spark):
    (r,) = scores(spark, '{"pm25":53.565,"delay_rate":0}')
    assert (r.risk_score, r.risk_band) == (25.0, "MODERATE")


def test_unreadable_rows_are_dead_letters(spark):
    bad = ["nope", "[1]", '{"pm25":"abc"}', ""]
    rows = scores(spark, *bad)
    assert [r.error for r in rows] == ["JSON_PARSE_ERROR", "JSON_PARSE_ERROR", "INVALID_NUMBER", "JSON_PARSE_ERROR"]
    assert [r.raw for r in rows] == bad and all(r.risk_score is None for r in rows)


def test_scoring_batch_and_stream_write_the_same(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jsonl").write_text('{"event_id":"1","severity":"severe"}\nbad\n{"event_id":"2","pm25":30}\n')
    at = F.lit("2024-01-01").cast("timestamp")
    jsonlines.write_scored(rowscore.score_rows(spark.read.text(str(source)), processed_at=at), f"{tmp_path}/batch")
    pipelines.scoring_pipeline(
        spark.readStream.text(str(source)), f"{tmp_path}/stream", f"{tmp_path}/cp", processed_at=at, once=True
    ).awaitTermination()
    for suffix, rows in (("", 2), ("_dead_letter", 1)):
        batch = sorted(r.value for r in spark.read.text(f"{tmp_path}/batch{suffix}").collect())
        stream = sorted(r.value for r in spark.read.text(f"{tmp_path}/stream{suffix}/*").collect())
        assert batch == stream and len(batch) == rows
    assert '"city":null' in batch[0] or '"raw":"bad"' in batch[0]
