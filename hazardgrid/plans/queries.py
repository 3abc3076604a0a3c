"""Named queries over the driver's tables, one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardgrid import constants as C
from hazardgrid import schemas
from hazardgrid.functions import lookups, text, times
from hazardgrid.operators import (
    airquality,
    alerts,
    arearisk,
    delivery,
    discovery,
    events,
    quality,
    rowscore,
    upsert,
)
from hazardgrid.plans import bindings as B
from hazardgrid.plans import jobs
from hazardgrid.session import configure, delete_dir, path_exists, shared_dir
from hazardgrid.sinks import jsonlines, tables
from hazardgrid.sinks.eventstore import EventStore, committed_batch
from hazardgrid.sinks.tables import Warehouse
from hazardgrid.sources import landed
from hazardgrid.streaming import pipelines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


# --- logistics ---------------------------------------------------------------


@query
def stg_driver_events(spark, sf):
    staged = delivery.stage_driver_events(B.driver_events(spark, sf))
    return staged.withColumn("event_ts", F.unix_seconds("event_ts"))


@query
def delivery_performance(spark, sf):
    staged = delivery.stage_driver_events(B.driver_events(spark, sf))
    return delivery.delivery_performance(staged)


# --- weather -----------------------------------------------------------------


@query
def feed_links(spark, sf):
    return alerts.feed_links(B.feed_objects(spark, sf), B.FEED_URL)


@query
def feed_rejects(spark, sf):
    return alerts.feed_rejects(B.feed_objects(spark, sf))


@query
def cap_alerts_parsed(spark, sf):
    return alerts.parse_alerts(B.alert_objects(spark, sf))


@query
def cap_alerts_rejected(spark, sf):
    return alerts.rejected_alerts(alerts.parse_alerts(B.alert_objects(spark, sf)))


def _mapped(spark, sf):
    parsed = alerts.parse_alerts(B.alert_objects(spark, sf))
    return alerts.map_alerts(parsed, B.alert_provinces(spark, sf), B.as_of())


@query
def weather_alerts_mapped(spark, sf):
    return _mapped(spark, sf).drop("processed_at")


@query
def weather_alerts_unmapped(spark, sf):
    parsed = alerts.parse_alerts(B.alert_objects(spark, sf))
    return alerts.unmapped_alerts(parsed, B.alert_provinces(spark, sf))


@query
def weather_events_daily(spark, sf):
    return alerts.weather_events_daily(_mapped(spark, sf)).drop("processed_at")


@query
def weather_risk_daily(spark, sf):
    daily = alerts.weather_daily(_mapped(spark, sf)).drop("processed_at")
    return daily.orderBy("event_date", "city")


@query
def weather_handover(spark, sf):
    """The daily weather as it comes back from its hand-over file."""
    out = _run_dir(spark, "handover")
    jsonlines.write_weather_daily(alerts.weather_daily(_mapped(spark, sf)), out)
    (daily,) = _taken(spark, out, landed.weather_daily_json(spark, out))
    return daily.drop("processed_at")


@query
def landed_records(spark, sf):
    """Newest record per user and ingestion date: two days landed, the first of them again.

    Arrival is known to the hour, so records tie; their content settles it.
    """
    out = _run_dir(spark, "landing")
    hour = F.floor(F.unix_seconds("ts") / 3600)
    rows = B.events_table(spark, sf).select("event_id", "user_id", hour.alias("arrival"))
    for day, part in (("2024-02-01", 2), ("2024-02-02", 3), ("2024-02-01", 5)):
        batch = rows.where(F.col("event_id") % part == 0)
        tables.land_records(batch.select("user_id", "arrival", "event_id"), out, "user_id", "arrival", day)
    schema = "user_id BIGINT, arrival BIGINT, event_id BIGINT, ingestion_date DATE"
    (landed_rows,) = _taken(spark, out, _written(spark, schema, out))
    return landed_rows


@query
def landing_names(spark, sf):
    """Object names under which feeds land: ingestion date folder and compact stamp."""
    return B.events_table(spark, sf).select(
        "event_id",
        F.concat(
            F.lit("ingestion_date="), F.to_date("ts").cast("string"), F.lit("/feed_"), times.compact_stamp(F.col("ts")), F.lit(".xml")
        ).alias("name"),
    )


@query
def undecodable_text(spark, sf):
    """Bytes that are no UTF-8 in every third row: no text to parse, a repaired copy to keep."""
    good = F.concat(F.lit("event é "), F.col("event_id")).cast("binary")
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(good, F.unhex(F.lit("C3")))).otherwise(good)
    rows = B.events_table(spark, sf).select("event_id", raw.alias("raw"))
    return rows.select("event_id", text.utf8_text(F.col("raw")).alias("strict"), text.utf8_lossy(F.col("raw")).alias("kept"))


def _environment(spark, sf):
    return alerts.weather_load_rows(alerts.weather_daily(_mapped(spark, sf)))


def _text_times(df, *columns):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


def _earlier_weather(spark, sf):
    fill = {
        "event_date": F.col("event_date"),
        "city": F.col("city"),
        "weather_risk": F.lit(10.0),
        "air_quality_risk": F.col("n").cast("double"),
        "active_weather_alerts": F.col("n"),
        "bmkg_alert_id": F.lit("earlier"),
    }
    return B.earlier_daily(spark, sf).select(
        *[
            fill.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.ENVIRONMENT_RISK_DAILY
        ]
    )


@query
def weather_upsert(spark, sf):
    target = _earlier_weather(spark, sf)
    keys = ["event_date", "city"]
    update = [c for c in target.columns if c not in (*keys, "air_quality_risk")]
    merged = upsert.upsert(target, _environment(spark, sf), keys, update)
    return _text_times(merged, "effective", "expires", "processed_at")


# --- air quality -------------------------------------------------------------


def _flat(validated):
    return validated.select(
        "event_id",
        "location_id",
        "parameter",
        "parameter_id",
        "latitude",
        "longitude",
        F.col("value").alias("pm25"),
        F.col("measurement_datetime.utc").alias("measurement_utc"),
        "measurement_age_hours",
        "freshness_status",
        "validation_status",
        "validation_error",
    )


@query
def event_validation_ingest_age(spark, sf):
    return _flat(events.validate_ingest_age(events.parse_messages(B.messages(spark, sf))))


@query
def event_validation_strict(spark, sf):
    return _flat(events.validate_strict(events.parse_messages(B.messages(spark, sf)), B.as_of()))


@query
def audit_stream_union(spark, sf):
    checked = events.validate_strict(events.parse_messages(B.messages(spark, sf)), B.as_of())
    return events.audit_events(checked).select(
        "event_id",
        "validation_status",
        "validation_error",
        "freshness_status",
        F.col("raw_message").isNotNull().alias("has_raw_message"),
        F.col("record_json").isNotNull().alias("has_record"),
    )


def _latest(spark, sf):
    checked = events.validate_ingest_age(events.parse_messages(B.messages(spark, sf)))
    return airquality.latest_per_station_day(checked, B.stations(spark, sf))


@query
def air_quality_latest(spark, sf):
    return _latest(spark, sf).withColumn("measurement_utc", F.unix_micros("measurement_utc"))


@query
def air_quality_daily(spark, sf):
    return airquality.air_quality_daily(_latest(spark, sf), B.as_of()).drop("processed_at")


def _earlier_air(spark, sf):
    return B.earlier_daily(spark, sf).select(
        "event_date",
        "city",
        F.lit(1.0).alias("avg_pm25"),
        F.lit(2.0).alias("air_quality_risk"),
        F.col("n").alias("station_count"),
        F.col("n").alias("observation_count"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("processed_at"),
    )


@query
def air_quality_upsert(spark, sf):
    source = airquality.air_quality_daily(_latest(spark, sf), B.as_of())
    target = _earlier_air(spark, sf)
    keys = ["event_date", "city"]
    merged = upsert.upsert(target, source, keys, [c for c in target.columns if c not in keys])
    return _text_times(merged, "processed_at")


@query
def station_lookup(spark, sf):
    """City of the fixed stations by map and by seed table; every 23rd id is no station."""
    ids = F.array(*[F.lit(r[0]).cast("bigint") for r in C.STATION_SEED], F.lit(1).cast("bigint"))
    at = (F.col("user_id") % (len(C.STATION_SEED) + 1) + 1).cast("int")
    rows = B.events_table(spark, sf).select("event_id", F.element_at(ids, at).alias("location_id"))
    seed = lookups.station_seed(spark).select("location_id", F.col("city").alias("seed_city"))
    return rows.withColumn("city", lookups.station_city(F.col("location_id"))).join(seed, "location_id", "left")


# --- gold --------------------------------------------------------------------


def _signals(spark, sf):
    deliveries = delivery_performance(spark, sf)
    signal = alerts.weather_signal(_mapped(spark, sf))
    environment = signal.unionByName(B.unobserved_cell(spark).select(*signal.columns))
    air = airquality.air_quality_daily(_latest(spark, sf), B.as_of())
    return deliveries, environment, air


@query
def date_city_spine(spark, sf):
    return arearisk.date_city_spine(*_signals(spark, sf))


def _gold(spark, sf):
    return arearisk.area_risk_daily(*_signals(spark, sf))


@query
def area_risk_daily(spark, sf):
    return _gold(spark, sf)


@query
def area_risk_daily_joined(spark, sf):
    """Gold by spine and joins over the daily signals, each computed once and kept."""
    shared_dir(spark)
    return arearisk.score(arearisk.combine_by_joins(*[s.checkpoint() for s in _signals(spark, sf)]))


@query
def kpi_overview(spark, sf):
    return _rounded(arearisk.kpi_overview(_gold(spark, sf)))


@query
def kpi_by_city(spark, sf):
    return _rounded(arearisk.kpi_by_city(_gold(spark, sf)))


@query
def kpi_trend(spark, sf):
    return _rounded(arearisk.kpi_trend(_gold(spark, sf)))


@query
def kpi_detail(spark, sf):
    return arearisk.detail_table(_gold(spark, sf))


def _rounded(df):
    """Averages at 6 digits: their last bits depend on the order of addition."""
    return df.withColumns(
        {c: F.round(c, 6) for c, t in df.dtypes if t == "double"}
    )


# --- stored tables -----------------------------------------------------------


def _house(spark):
    """A warehouse of its own for one run of a query."""
    house = Warehouse(spark, f"run_{uuid.uuid4().hex[:12]}")
    house.create_namespaces()
    return house


def _kept(house, *frames):
    """Frames over a warehouse's tables, kept as checkpoints; the warehouse is dropped."""
    kept = [f.checkpoint() for f in frames]
    for layer in C.LAYERS:
        house.spark.sql(f"DROP DATABASE {house.namespace(layer)} CASCADE")
    return kept


@query
def weather_upsert_stored(spark, sf):
    """The daily weather merged into a stored table, date by date, with another signal's column kept."""
    house = _house(spark)
    house.overwrite(_earlier_weather(spark, sf), "environment_risk_daily")
    tables.upsert_weather(house, _environment(spark, sf))
    house.vacuum("environment_risk_daily")
    (stored,) = _kept(house, house.table("environment_risk_daily"))
    return _text_times(stored, "effective", "expires", "processed_at")


@query
def air_quality_upsert_stored(spark, sf):
    """The daily air quality merged into a stored table."""
    house = _house(spark)
    house.overwrite(_earlier_air(spark, sf), "openaq_air_quality_daily")
    tables.upsert_air_quality(house, airquality.air_quality_daily(_latest(spark, sf), B.as_of()))
    (stored,) = _kept(house, house.table("openaq_air_quality_daily"))
    return _text_times(stored, "processed_at")


@query
def daily_run_stored(spark, sf):
    """Gold as the daily batch leaves it in its table: Bronze, Silver and marts stored, two runs of dates."""
    house = _house(spark)
    jobs.prepare(house)
    house.overwrite(delivery.stage_driver_events(B.driver_events(spark, sf)), "driver_events")
    tables.upsert_weather(house, _environment(spark, sf).unionByName(B.unobserved_cell(spark)))
    tables.upsert_air_quality(house, airquality.air_quality_daily(_latest(spark, sf), B.as_of()))
    days = [d.isoformat() for d in sorted(_days(house))]
    for part in (days[::2], days[1::2], days[:3]):  # the last days come again
        jobs.run_delivery(house, dates=part)
        jobs.run_gold(house, part)
    quality.enforce(house.table("fact_delivery_performance"), quality.delivery_checks())
    quality.enforce(house.table("fact_area_risk_daily"), [c for c in quality.gold_checks() if c.name.startswith("not_null")])
    (gold,) = _kept(house, house.table("fact_area_risk_daily"))
    return gold


def _days(house):
    """Dates of the signals: as many rows as there are days."""
    bronze = house.table("driver_events").select(F.to_date("event_ts").alias("d"))
    daily = [house.table(t).select(F.col("event_date").alias("d")) for t in ("environment_risk_daily", "openaq_air_quality_daily")]
    return [r.d for r in bronze.union(daily[0]).union(daily[1]).where("d is not null").distinct().collect()]


# --- data checks -------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    deliveries, environment, air = _signals(spark, sf)
    gold = arearisk.area_risk_daily(deliveries, environment, air)
    deliveries = deliveries.unionByName(B.broken_delivery(spark), allowMissingColumns=True)
    gold = gold.unionByName(B.broken_gold(spark), allowMissingColumns=True)
    prefix = lambda df, name: df.withColumn("check_name", F.concat(F.lit(name + "."), "check_name"))
    not_null = [c for c in quality.gold_checks() if c.name.startswith("not_null")]
    return prefix(quality.run_checks(deliveries, quality.delivery_checks()), "delivery").unionByName(
        prefix(quality.run_checks(gold, not_null), "area_risk")
    )


def _gold_check(spark, sf, name):
    """One check over gold and rows that are known to break it."""
    rows = _gold(spark, sf).unionByName(B.broken_gold(spark), allowMissingColumns=True)
    return quality.run_checks(rows, [c for c in quality.gold_checks() if c.name == name])


@query
def dq_accepted_values(spark, sf):
    return _gold_check(spark, sf, "accepted_values_risk_band")


@query
def dq_score_range(spark, sf):
    return _gold_check(spark, sf, "score_range")


@query
def dq_band_consistency(spark, sf):
    return _gold_check(spark, sf, "band_consistency")


# --- row scorer and discovery ------------------------------------------------


@query
def risk_row_scores(spark, sf):
    rows = rowscore.score_rows(B.combined_rows(spark, sf), processed_at=B.as_of())
    return rowscore.scored(rows).drop("processed_at")


@query
def risk_row_dead_letters(spark, sf):
    rows = rowscore.score_rows(B.combined_rows(spark, sf), processed_at=B.as_of())
    return rowscore.dead_letters(rows).select("row_id", "error", F.regexp_extract("raw", '"event_id":"([0-9]+)"', 1).alias("raw_event_id"))


def _landed(spark, sf):
    return B.locations(spark, sf), B.measurements(spark, sf), B.sensors(spark, sf), B.as_of()


@query
def station_discovery(spark, sf):
    found = discovery.discovered_events(*_landed(spark, sf))
    return found.select(
        *[c for c in found.columns if c != "measurement_datetime"],
        F.col("measurement_datetime.utc").alias("measurement_utc"),
        F.col("measurement_datetime.local").alias("measurement_local"),
    )


@query
def published_messages(spark, sf):
    """The discovered events as the JSON messages put on the topic."""
    return events.to_message(discovery.discovered_events(*_landed(spark, sf)))


@query
def discovery_summary(spark, sf):
    return discovery.discovery_summary(*_landed(spark, sf))


# --- streaming ---------------------------------------------------------------


def _run_dir(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _taken(spark, folder, *frames):
    """Frames over files in ``folder``, kept as checkpoints; the folder is deleted."""
    kept = [f.checkpoint() for f in frames]
    delete_dir(spark, folder)
    return kept


def _written(spark, schema, path):
    """What a stream wrote to ``path``; without any batch there is no folder."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _event_stream(spark, sf):
    """The events table as a file stream, be it one file or a folder of parts.

    The path is given as a pattern, as a stream does not take the path of a file.
    """
    stream = spark.readStream.schema(B.TABLES["events"]).parquet(f"{sf}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_window_counts(spark, sf):
    checked = events.validate_strict(events.parse_messages(B.messages(spark, sf)), B.as_of())
    return _window_columns(pipelines.window_counts(checked))


def _window_columns(counts):
    return counts.withColumns(
        {"window_start": F.unix_seconds("window_start"), "window_end": F.unix_seconds("window_end")}
    )


@query
def stream_window_counts_closed(spark, sf):
    """The windows a stream over the table has closed when its input ends."""
    out = _run_dir(spark, "window-counts")
    checked = events.validate_strict(
        events.parse_messages(B.message_stream(_event_stream(spark, sf))), B.as_of()
    )
    pipelines.window_count_pipeline(checked, f"{out}/data", f"{out}/checkpoint", once=True).awaitTermination()
    schema = "window_start TIMESTAMP, window_end TIMESTAMP, validation_status STRING, records BIGINT"
    (counts,) = _taken(spark, out, _written(spark, schema, f"{out}/data"))
    return _window_columns(counts)


@query
def stream_silver(spark, sf):
    """Silver and audit rows written by the streaming job over the table."""
    out = _run_dir(spark, "events")
    stream = B.message_stream(_event_stream(spark, sf))
    pipelines.event_pipeline(
        stream, f"{out}/store", f"{out}/checkpoint", as_of=B.as_of(), once=True
    ).awaitTermination()
    rows = EventStore(spark, f"{out}/store").read(_stream_schema(schemas.SILVER_EVENT))
    (rows,) = _taken(
        spark, out, rows.select("output", "event_id", "location_id", "measurement_age_hours", "validation_status", "validation_error")
    )
    return rows


def _stream_schema(schema):
    """Columns that the messages of the table bring along, and those of the events."""
    return T.StructType([*T.StructType.fromDDL("event_id BIGINT, published_at TIMESTAMP").fields, *schema.fields])


LATENESS = "1 day"


def _arrivals(spark, sf, name):
    """The event job run once for each arrival of messages; its folder, with store and panes."""
    out = _run_dir(spark, name)
    schema = "event_id BIGINT, published_at TIMESTAMP, value STRING"
    for n in range(B.ARRIVALS):
        arrived = B.message_stream(B.events_table(spark, sf).where(B.arrival() == n))
        arrived.write.mode("append").parquet(f"{out}/in")
        stream = spark.readStream.schema(schema).parquet(f"{out}/in")
        pipelines.event_pipeline(
            stream, f"{out}/store", f"{out}/checkpoint", as_of=B.as_of(), once=True, panes=f"{out}/windows", late=LATENESS
        ).awaitTermination()
    return out


@query
def stream_window_panes(spark, sf):
    """Counts per window and status as the batches emitted them, late records left out."""
    out = _arrivals(spark, sf, "panes")
    (panes,) = _taken(spark, out, pipelines.read_panes(spark, f"{out}/windows"))
    return _window_columns(panes)


@query
def stream_late_records(spark, sf):
    """Records that came after their window, with the watermark they met."""
    out = _arrivals(spark, sf, "late")
    late = pipelines.read_late(spark, f"{out}/windows", _stream_schema(schemas.SILVER_EVENT))
    (late,) = _taken(spark, out, late.select("event_id", "validation_status", "window_start", "window_end", "watermark", "late_reason"))
    return _window_columns(late).withColumn("watermark", F.unix_micros("watermark"))


@query
def silver_compacted(spark, sf):
    """Silver read back after its batches have been compacted, all but the last one."""
    out = _arrivals(spark, sf, "compacted")
    store = EventStore(spark, f"{out}/store")
    store.compact(committed_batch(spark, f"{out}/checkpoint") - 1, _stream_schema(schemas.SILVER_EVENT))
    store.vacuum()
    rows = landed.silver_events(spark, f"{out}/store")
    (rows,) = _taken(
        spark,
        out,
        rows.select(
            "location_id", F.col("value").alias("pm25"), F.col("measurement_datetime.utc").alias("measurement_utc"),
            "measurement_age_hours", "freshness_status",
        ),
    )
    return rows


@query
def stream_scores(spark, sf):
    """Scores and dead letters written by the scoring stream over the table."""
    out = _run_dir(spark, "scores")
    stream = B.combined_columns(_event_stream(spark, sf))
    pipelines.scoring_pipeline(stream, f"{out}/scored", f"{out}/checkpoint", B.as_of(), once=True).awaitTermination()
    schema = "row_id BIGINT, risk_score DOUBLE, risk_band STRING, error STRING"
    frames = []
    for name in ("scored", "scored_dead_letter"):
        found = path_exists(spark, f"{out}/{name}")
        rows = spark.read.schema(schema).json(f"{out}/{name}") if found else spark.createDataFrame([], schema)
        frames.append(rows.select(F.lit(name).alias("output"), "row_id", "risk_score", "risk_band", "error"))
    scored, dead = _taken(spark, out, *frames)
    return scored.unionByName(dead)
