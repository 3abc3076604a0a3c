"""The daily batch: landed files to Silver tables, marts, gold and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid.functions import lookups
from hazardgrid.operators import airquality, alerts, arearisk, delivery, events, quality
from hazardgrid.session import configure
from hazardgrid.sinks import jsonlines, tables
from hazardgrid.sinks.tables import Warehouse
from hazardgrid.sources import landed


def prepare(warehouse: Warehouse) -> None:
    """Create namespaces and tables, and write the station mapping."""
    configure(warehouse.spark)
    warehouse.create_namespaces()
    for table in tables.TABLES:
        warehouse.create_table(table)
    warehouse.seed_stations()


def process_alerts(
    warehouse: Warehouse,
    bronze_root: str,
    dates: list[str] | None = None,
    provinces: DataFrame | None = None,
    processed_at: Column | None = None,
) -> DataFrame:
    """Alerts of the landed objects (of the given dates), by date, city and event."""
    objects = landed.alert_objects(warehouse.spark, bronze_root, dates)
    mapped = alerts.map_alerts(
        alerts.parse_alerts(objects),
        lookups.province_cities(warehouse.spark) if provinces is None else provinces,
        processed_at,
    )
    return alerts.weather_events_daily(mapped)


def load_weather(warehouse: Warehouse, handover: str) -> None:
    """Merge a daily weather hand-over file into the environment-risk table."""
    daily = landed.weather_daily_json(warehouse.spark, handover)
    tables.upsert_weather(warehouse, alerts.weather_load_rows(daily))


def run_weather(
    warehouse: Warehouse,
    bronze_root: str,
    handover: str,
    dates: list[str] | None = None,
    provinces: DataFrame | None = None,
    processed_at: Column | None = None,
) -> None:
    """Alert objects to the table of events, on to the hand-over file and into the daily table.

    The documents are parsed once. The table of events and the file are restart
    points; texts are folded only on the way into the file. Objects without an
    ingestion date have no day and stay out.
    """
    found = process_alerts(warehouse, bronze_root, dates, provinces, processed_at)
    _store_mart(warehouse, found, "weather_events_daily", dates)
    events_of_days = _of_dates(warehouse.table("weather_events_daily"), F.col("event_date"), dates)
    jsonlines.write_weather_daily(alerts.fold_events(events_of_days), handover)
    load_weather(warehouse, handover)


def validate_events(messages: DataFrame, as_of: Column | None = None, lenient: bool = False) -> DataFrame:
    """Batch form of the event stream: messages with their verdict."""
    parsed = events.parse_messages(messages)
    return events.validate_ingest_age(parsed) if lenient else events.validate_strict(parsed, as_of)


def run_air_quality(
    warehouse: Warehouse, silver: DataFrame, processed_at: Column | None = None
) -> None:
    """Merge the daily air quality of accepted events into its table."""
    stations = airquality.assert_unique_stations(warehouse.table("openaq_station_mapping"))
    latest = airquality.latest_per_station_day(silver, stations)
    tables.upsert_air_quality(warehouse, airquality.air_quality_daily(latest, processed_at))


def _of_dates(df: DataFrame, day: Column, dates: list[str] | None) -> DataFrame:
    return df.where(day.isin([F.lit(d).cast("date") for d in dates])) if dates else df


def _store_mart(warehouse: Warehouse, mart: DataFrame, table: str, dates: list[str] | None) -> None:
    if dates:
        warehouse.replace_dates(table, mart, dates)
    else:
        warehouse.overwrite(mart, table)


def run_delivery(
    warehouse: Warehouse, bronze: DataFrame | None = None, dates: list[str] | None = None
) -> None:
    """Build the delivery mart from Bronze delivery events, of the given dates or all anew."""
    source = warehouse.table("driver_events") if bronze is None else bronze
    staged = delivery.stage_driver_events(source)
    staged.createOrReplaceTempView("stg_driver_events")
    mart = delivery.delivery_performance(_of_dates(staged, F.to_date("event_ts"), dates))
    _store_mart(warehouse, mart, "fact_delivery_performance", dates)


def run_gold(warehouse: Warehouse, dates: list[str] | None = None) -> None:
    """Build the area-risk mart from the three stored daily tables, of the given dates or all anew."""
    signals = ("fact_delivery_performance", "environment_risk_daily", "openaq_air_quality_daily")
    gold = arearisk.area_risk_daily(*[_of_dates(warehouse.table(t), F.col("event_date"), dates) for t in signals])
    _store_mart(warehouse, gold, "fact_area_risk_daily", dates)


def run_checks(warehouse: Warehouse) -> None:
    """Fail the run when a mart breaks one of its checks."""
    quality.enforce(warehouse.table("fact_delivery_performance"), quality.delivery_checks())
    quality.enforce(warehouse.table("fact_area_risk_daily"), quality.gold_checks())


def run_daily(
    warehouse: Warehouse,
    alerts_root: str,
    handover: str,
    silver_path: str,
    dates: list[str] | None = None,
) -> None:
    """The whole daily run after the stream has filled Silver; with dates, of these only."""
    prepare(warehouse)
    run_weather(warehouse, alerts_root, handover, dates)
    run_air_quality(warehouse, landed.silver_events(warehouse.spark, silver_path, dates=dates))
    run_delivery(warehouse, dates=dates)
    run_gold(warehouse, dates)
    run_checks(warehouse)


def publish_discovered(found: DataFrame, path: str) -> None:
    """Write discovered events as topic messages; a Kafka writer takes the same frame."""
    events.to_message(found).write.mode("append").text(path)

