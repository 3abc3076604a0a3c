"""The daily batch end to end over landed files and catalog tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from hazardgrid import schemas
from hazardgrid.functions import lookups
from hazardgrid.operators import discovery
from hazardgrid.plans import jobs
from hazardgrid.sinks import jsonlines, tables
from hazardgrid.sinks.tables import Warehouse
from hazardgrid.sources import landed
from hazardgrid.streaming import pipelines
from tests.test_alerts import cap
from tests.test_events import message

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


@pytest.fixture(scope="module")
def warehouse(spark):
    house = Warehouse(spark, "t")
    jobs.prepare(house)
    return house


def files(spark, table):
    return {r.f for r in spark.table(table).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}


def test_prepare_is_repeatable(warehouse):
    jobs.prepare(warehouse)
    assert warehouse.table("openaq_station_mapping").count() == 22
    names = {r.namespace for r in warehouse.spark.sql("SHOW DATABASES").collect()}
    assert {"t_bronze", "t_silver", "t_gold", "t_audit"} <= names
    assert warehouse.table("environment_risk_daily").columns == schemas.ENVIRONMENT_RISK_DAILY.fieldNames()


def weather(spark, rows):
    blank = {f.name: None for f in schemas.ENVIRONMENT_RISK_DAILY}
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.ENVIRONMENT_RISK_DAILY)
    return spark.createDataFrame([tuple({**blank, **r}.values()) for r in rows], ddl)


def test_weather_upsert_rewrites_only_its_dates(spark, warehouse):
    name = warehouse.name("environment_risk_daily")
    rows = [
        {"event_date": D1, "city": "A", "weather_risk": 25.0},
        {"event_date": D2, "city": "A", "weather_risk": 50.0},
        {"event_date": D3, "city": "B", "weather_risk": 50.0},
    ]
    tables.upsert_weather(warehouse, weather(spark, rows))
    before = files(spark, name)
    change = [
        {"event_date": D1, "city": "B", "weather_risk": 80.0},
        {"event_date": D3, "city": "B", "weather_risk": 100.0},
    ]
    tables.upsert_weather(warehouse, weather(spark, change))
    tables.upsert_weather(warehouse, weather(spark, change))
    got = {(r.event_date, r.city): r.weather_risk for r in warehouse.table("environment_risk_daily").collect()}
    assert got == {(D1, "A"): 25.0, (D1, "B"): 80.0, (D2, "A"): 50.0, (D3, "B"): 100.0}
    kept = before & files(spark, name)
    assert kept and all("event_date=2024-01-02" in f for f in kept)
    stages = [r.tableName for r in spark.sql(f"SHOW TABLES IN {warehouse.namespace('silver')}").collect()]
    assert not [s for s in stages if "stage" in s]


def test_upsert_failure_leaves_the_table_alone(spark, warehouse):
    twice = [{"event_date": D1, "city": "A", "weather_risk": 1.0}] * 2
    before = sorted(map(tuple, warehouse.table("environment_risk_daily").collect()), key=str)
    with pytest.raises(Exception, match="duplicate merge key"):
        tables.upsert_weather(warehouse, weather(spark, twice))
    with pytest.raises(Exception, match="city must not be null"):
        tables.upsert_weather(warehouse, weather(spark, [{"event_date": D1}]))
    assert sorted(map(tuple, warehouse.table("environment_risk_daily").collect()), key=str) == before


def test_land_records_replaces_same_day_reingest(spark, tmp_path):
    path = f"{tmp_path}/bronze"

    def land(day, *rows):
        df = spark.createDataFrame(rows, "identifier STRING, body STRING, seq INT")
        tables.land_records(df, path, "identifier", "seq", day)

    land("2024-01-01", ("a", "1", 1), ("b", "1", 2))
    land("2024-01-02", ("a", "1", 3))
    land("2024-01-01", ("a", "2", 4), ("a", "3", 5), ("c", "1", 6))
    got = sorted((r.ingestion_date, r.identifier, r.body) for r in spark.read.parquet(path).collect())
    assert got == [(D1, "a", "3"), (D1, "b", "1"), (D1, "c", "1"), (D2, "a", "1")]


def test_landing_does_not_depend_on_the_order_of_rows(spark, tmp_path):
    rows = [("a", f"body{i}", 7) for i in range(20)]
    won = set()
    for n, order in enumerate((rows, rows[::-1], rows[7:] + rows[:7])):
        df = spark.createDataFrame(order, "identifier STRING, body STRING, seq INT").repartition(4)
        tables.land_records(df, f"{tmp_path}/{n}", "identifier", "seq", "2024-01-01")
        won.add(spark.read.parquet(f"{tmp_path}/{n}").first().body)
    assert len(won) == 1


def test_stream_writes_json_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.jsonl").write_text(message() + "\nbroken\n", encoding="utf-8")
    pipelines.event_pipeline(
        landed.message_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/store", f"{tmp_path}/cp",
        as_of=F.lit("2024-01-10 12:30:00").cast("timestamp"), once=True, fmt="json",
    ).awaitTermination()
    (event,) = landed.silver_events(spark, f"{tmp_path}/store", "json").collect()
    assert (event.location_id, event.measurement_age_hours, event.locality) == (8320, 1.5, None)
    assert event.measurement_datetime.utc == "2024-01-10T11:00:00Z" and event.processed_at is not None
    (line,) = spark.read.text(f"{tmp_path}/store/data/*/output=audit/*").collect()
    assert json.loads(line["value"])["raw_message"] == "broken" and json.loads(line["value"])["location_id"] is None


def test_daily_run(spark, tmp_path):
    house = Warehouse(spark, "daily")
    day = "2024-01-10"
    folder = tmp_path / "alerts" / f"ingestion_date={day}"
    folder.mkdir(parents=True)
    (folder / "A_alert.xml").write_text(cap("A", "Rain", "Severe", "DKI Jakarta"))
    (folder / "B_alert.xml").write_text(cap("B", "Wind", "Minor", "DKI Jakarta"))
    (folder / "C_alert.xml").write_text(cap("C")[:-30])
    lines = [
        message(value=40.0, ingestion_timestamp="2024-01-10T12:00:00+00:00"),
        message(value=30.0, location_id=2537),
        message(value=-5.0),
        "junk",
    ]
    (tmp_path / "messages").mkdir()
    (tmp_path / "messages" / "m.jsonl").write_text("\n".join(lines), encoding="utf-8")
    pipelines.event_pipeline(
        landed.message_stream(spark, f"{tmp_path}/messages"), f"{tmp_path}/store",
        f"{tmp_path}/cp", as_of=F.lit("2024-01-10 12:30:00").cast("timestamp"), once=True,
    ).awaitTermination()
    csv = tmp_path / "drivers.csv"
    csv.write_text(
        ",".join(schemas.DRIVER_EVENTS_CSV.fieldNames())
        + "\ne1,2024-01-10T08:00:00+00:00,Jakarta,x,D1,O1,-6.2,106.8,30,40,10,4.5,completed"
        + "\ne2,2024-01-10T09:00:00+00:00,Jakarta,x,D1,O2,-6.2,106.8,30,30,0,3.5,delayed"
        + "\ne3,2024-01-10T09:00:00+00:00,Medan,x,D1,O3,3.5,98.6,30,30,0,3.5,completed\n"
    )
    jobs.prepare(house)
    for _ in range(2):
        jobs.run_weather(house, f"{tmp_path}/alerts", f"{tmp_path}/daily.jsonl", [day])
        jobs.run_air_quality(house, landed.silver_events(spark, f"{tmp_path}/store"))
        jobs.run_delivery(house, landed.driver_events_csv(spark, str(csv)))
        jobs.run_gold(house)
        jobs.run_checks(house)
    gold = {r.city: r for r in house.table("fact_area_risk_daily").collect()}
    assert set(gold) == {"Jakarta", "Medan"}
    jakarta = gold["Jakarta"]
    assert (jakarta.weather_risk, jakarta.active_weather_alerts, jakarta.avg_pm25) == (80.0, 2, 35.0)
    assert (jakarta.orders, jakarta.delay_rate, jakarta.station_count) == (2, 0.5, 2)
    assert jakarta.risk_score == round(0.45 * 80 + 0.35 * 46.67 + 0.2 * 50, 2) and jakarta.risk_band == "HIGH"
    assert (gold["Medan"].risk_band, gold["Medan"].has_weather_data) == ("LOW", False)
    (handed,) = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/daily.jsonl").collect()]
    assert handed["weather_event"] == "Rain; Wind" and handed["expires"] is None and handed["headline"] == "H A"


def test_handover_is_sorted_across_parts(spark, tmp_path):
    rows = [(D2, "B"), (D1, "Z"), (D2, "A"), (D1, "C")]
    daily = spark.createDataFrame(rows, "event_date DATE, city STRING").repartition(4)
    jsonlines.write_weather_daily(daily, f"{tmp_path}/out")
    parts = sorted((tmp_path / "out").glob("part-*"))
    lines = [json.loads(line) for p in parts for line in p.read_text().splitlines()]
    assert [(r["event_date"], r["city"]) for r in lines] == [
        ("2024-01-01", "C"), ("2024-01-01", "Z"), ("2024-01-02", "A"), ("2024-01-02", "B"),
    ]


def landed_frames(spark):
    """60 locations; every third has no PM2.5, some are invalid."""
    locations, measurements, sensors = [], [], []
    for pos in range(1, 61):
        code = "BG" if pos % 10 == 0 else "id"
        lat = None if pos % 11 == 0 else -6.0
        locations.append((pos, None if pos == 7 else 100 + pos, f"L{pos}", None, (code,), (lat, 107.0)))
        name = "pm10" if pos % 3 == 0 else "pm25"
        sensors.append((1000 + pos, (1 if pos % 3 == 0 else 9, name, name.upper(), "u")))
        for k in range(120 if pos == 1 else 2):
            minute = f"2024-01-10T{k // 60:02d}:{k % 60:02d}:00Z"
            measurements.append((100 + pos, 1000 + pos, float(k), (minute, None)))
        measurements.append((100 + pos, None, 0.0, ("2024-01-10T00:00:30Z", None)))
        measurements.append((100 + pos, 1000 + pos, 99.0, ("2024-01-08T00:00:00Z", None)))
    ddl = lambda s: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in s)
    return (
        spark.createDataFrame(locations, ddl(schemas.LOCATIONS)),
        spark.createDataFrame(measurements, ddl(schemas.MEASUREMENTS)),
        spark.createDataFrame(sensors, ddl(schemas.SENSORS)),
        F.lit("2024-01-10 12:00:00").cast("timestamp"),
    )


def test_discovery_against_a_loop(spark):
    expected, active, checked, skipped, seen, other = [], 0, 0, 0, 0, 0
    for pos in range(1, 61):
        if pos == 7:
            continue
        if pos % 10 == 0 or pos % 11 == 0:
            skipped += 1
            continue
        checked += 1
        # One more row has no sensor, and an old one is left out.
        usable = 120 if pos == 1 else 2
        seen += usable + 1
        if pos % 3 == 0:
            other += usable
        else:
            active += 1
            expected += [pos] * usable
    frames = landed_frames(spark)
    events = discovery.discovered_events(*frames).collect()
    assert sorted(e.location_id - 100 for e in events) == expected
    assert {(e.parameter, e.parameter_id, e.source) for e in events} == {("pm25", 9, "openaq")}
    assert events[0].ingestion_timestamp == "2024-01-10T12:00:00.000000+00:00"
    assert discovery.discovery_summary(*frames).first().asDict() == {
        "locations_discovered": 60,
        "locations_checked": checked,
        "non_indonesia_skipped": skipped,
        "active_locations": active,
        "measurements_checked": seen,
        "pm25_found": len(expected),
        "non_pm25_skipped": other,
        "published": len(expected),
    }


def test_publish(spark, tmp_path):
    jobs.publish_discovered(discovery.discovered_events(*landed_frames(spark)), f"{tmp_path}/topic")
    record = json.loads(spark.read.text(f"{tmp_path}/topic").first()["value"])
    assert list(record) == schemas.EVENT.fieldNames() and record["locality"] is None


def test_seed_matches_city_lookup(spark):
    seed = lookups.station_seed(spark)
    assert seed.filter(lookups.station_city(F.col("location_id")) != F.col("city")).isEmpty()


def air_rows(spark, *rows):
    df = spark.createDataFrame([(d, c, float(n)) for d, c, n in rows], "event_date DATE, city STRING, avg_pm25 DOUBLE")
    fill = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.AIR_QUALITY_DAILY}
    return df.select(*[c if c in df.columns else fill[c] for c in fill])


def air_content(house):
    return sorted((r.event_date, r.city, r.avg_pm25) for r in house.table("openaq_air_quality_daily").collect())


@pytest.fixture
def air_house(spark, request):
    house = Warehouse(spark, request.node.name[:40])
    jobs.prepare(house)
    tables.upsert_air_quality(house, air_rows(spark, (D1, "A", 1), (D1, "B", 2), (D2, "A", 3)))
    return house


def test_a_date_is_replaced_in_one_step(spark, air_house, monkeypatch):
    """A run that stops between two dates leaves each of them whole, old or new."""
    seen, sql = [], type(spark).sql

    def stopping(self, text, *args, **kwargs):
        if "SET LOCATION" in text:
            seen.append(air_content(air_house))
            if len(seen) == 2:
                raise InterruptedError
        return sql(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", stopping)
    with pytest.raises(InterruptedError):
        tables.upsert_air_quality(air_house, air_rows(spark, (D1, "A", 10), (D1, "C", 30), (D2, "A", 40)))
    monkeypatch.undo()
    old, new = [(D1, "A", 1.0), (D1, "B", 2.0)], [(D1, "A", 10.0), (D1, "B", 2.0), (D1, "C", 30.0)]
    assert seen == [[*old, (D2, "A", 3.0)], [*new, (D2, "A", 3.0)]]
    assert air_content(air_house) == [*new, (D2, "A", 3.0)]
    tables.upsert_air_quality(air_house, air_rows(spark, (D1, "A", 10), (D1, "C", 30), (D2, "A", 40)))
    assert air_content(air_house) == [*new, (D2, "A", 40.0)]


def test_vacuum_keeps_what_is_in_use(spark, air_house):
    table = "openaq_air_quality_daily"
    for n in (5, 6):
        tables.upsert_air_quality(air_house, air_rows(spark, (D1, "A", n)))
    top = air_house.location(table)
    folder = top.removeprefix("file:")
    import pathlib

    parts = lambda: sorted(p.name for p in pathlib.Path(folder).rglob("event_date=*"))
    assert len(parts()) == 4
    air_house.vacuum(table)
    assert parts() == [f"event_date={D1}", f"event_date={D2}"]
    assert air_content(air_house) == [(D1, "A", 6.0), (D1, "B", 2.0), (D2, "A", 3.0)]


def test_marts_of_given_dates(spark, tmp_path):
    """Only the dates of the run are written; one that has no rows any more is dropped."""
    house = Warehouse(spark, "dated")
    jobs.prepare(house)
    schema = schemas.DRIVER_EVENTS

    def bronze(*rows):
        values = [(f"e{i}", dt.datetime.combine(d, dt.time(8)), c, "D", o, 0.0, 0.0, 30, 40, 10, 4.0) for i, (d, c, o) in enumerate(rows)]
        return spark.createDataFrame(values, schema)

    def mart(table):
        return sorted((r.event_date, r.city, r.orders) for r in house.table(table).collect())

    house.overwrite(bronze((D1, "A", "o1"), (D2, "A", "o2")), "driver_events")
    jobs.run_delivery(house, dates=[str(D1), str(D2)])
    jobs.run_gold(house, [str(D1), str(D2)])
    kept = house.location("fact_delivery_performance", f"event_date={D2}")
    # The second date's rows have changed as well, but the run is not about it.
    house.overwrite(bronze((D1, "A", "o1"), (D1, "B", "o3"), (D2, "Z", "o9")), "driver_events")
    jobs.run_delivery(house, dates=[str(D1)])
    jobs.run_gold(house, [str(D1)])
    want = [(D1, "A", 1), (D1, "B", 1), (D2, "A", 1)]
    assert mart("fact_delivery_performance") == mart("fact_area_risk_daily") == want
    assert house.location("fact_delivery_performance", f"event_date={D2}") == kept
    house.overwrite(bronze((D1, "A", "o1")), "driver_events")
    jobs.run_delivery(house, dates=[str(D2)])
    jobs.run_gold(house, [str(D2)])
    assert mart("fact_delivery_performance") == mart("fact_area_risk_daily") == want[:2]
    jobs.run_delivery(house)
    jobs.run_gold(house)
    assert mart("fact_delivery_performance") == mart("fact_area_risk_daily") == want[:1]


def test_unpartitioned_tables_are_written_once(spark):
    """The stage becomes the table; a job that fails leaves the previous content, and nothing else is left."""
    house = Warehouse(spark, "once")
    house.create_namespaces()
    mapping = house.name("openaq_station_mapping")
    values = [tuple(r) for r in lookups.station_seed(spark).collect()]
    first = spark.createDataFrame(values[:5], schemas.STATION_MAPPING)
    house.overwrite(first, "openaq_station_mapping")
    spark.sparkContext.setJobGroup("once", "one table")
    try:
        house.overwrite(spark.createDataFrame(values[:3], schemas.STATION_MAPPING), "openaq_station_mapping")
        jobs_run = spark.sparkContext.statusTracker().getJobIdsForGroup("once")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs_run) == 1
    assert spark.table(mapping).count() == 3
    broken = spark.createDataFrame(values[:1], schemas.STATION_MAPPING).withColumn("city", F.raise_error(F.lit("no city")))
    with pytest.raises(Exception, match="no city"):
        house.overwrite(broken, "openaq_station_mapping")
    assert spark.table(mapping).count() == 3
    # A table may be computed from itself.
    house.overwrite(house.table("openaq_station_mapping").limit(2), "openaq_station_mapping")
    assert house.table("openaq_station_mapping").count() == 2
    left = spark.sql(f"SHOW TABLES IN {house.namespace('silver')}").where("NOT isTemporary").collect()
    assert [r.tableName for r in left] == ["openaq_station_mapping"]


def test_a_stage_that_cannot_take_the_name_leaves_the_table(spark):
    house = Warehouse(spark, "named")
    house.create_namespaces()
    house.seed_stations()
    with pytest.raises(Exception):
        house._take_name("openaq_station_mapping", f"{house.namespace('silver')}.absent")
    assert house.table("openaq_station_mapping").count() == 22
