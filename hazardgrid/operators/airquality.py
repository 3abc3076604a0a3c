"""Daily air quality per city from validated events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazardgrid import constants as C
from hazardgrid.functions import scoring, times
from hazardgrid.functions.numbers import round_half_up
from hazardgrid.operators.events import CURRENT, VALID


def admissible(events: DataFrame) -> DataFrame:
    """Events fit for the daily figures; name and id must both say PM2.5."""
    return events.filter(
        (F.col("validation_status") == VALID)
        & (F.col("freshness_status") == CURRENT)
        & (F.col("parameter") == C.PM25_NAME)
        & (F.col("parameter_id") == C.PM25_ID)
        & (F.col("value") >= 0)
        & ~F.isnan("value")
    )


def latest_per_station_day(events: DataFrame, stations: DataFrame) -> DataFrame:
    """Each mapped station's last observation of each day.

    The ranking comes before the station join. Each task keeps its best row per
    station-day before the shuffle (``WindowGroupLimit``), so a station that
    produces a third of all events sends one row per task, and the join sees
    station-days instead of raw events. Stations are taken one city each, which
    makes both orders give the same rows.
    """
    measured = times.parse_iso(F.col("measurement_datetime.utc"))
    ranked = (
        admissible(events)
        .select(
            "location_id",
            F.col("value").alias("pm25"),
            measured.alias("measurement_utc"),
            "ingestion_timestamp",
        )
        .withColumn("event_date", F.to_date("measurement_utc"))
        .withColumn(
            "rn",
            F.row_number().over(
                Window.partitionBy("event_date", "location_id").orderBy(
                    F.col("measurement_utc").desc_nulls_last(),
                    F.col("ingestion_timestamp").desc_nulls_last(),
                    F.col("pm25").asc_nulls_last(),
                )
            ),
        )
        .filter("rn = 1")
    )
    one_city = stations.groupBy("location_id").agg(F.min("city").alias("city"))
    return ranked.join(one_city, "location_id").select(
        "event_date", "city", "location_id", "pm25", "measurement_utc", "ingestion_timestamp"
    )


def air_quality_daily(latest: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Average PM2.5, its risk and coverage counts per date and city."""
    return (
        latest.groupBy("event_date", "city")
        .agg(
            F.avg("pm25").alias("_avg"),
            F.countDistinct("location_id").alias("station_count"),
            F.count(F.lit(1)).alias("observation_count"),
        )
        .select(
            "event_date",
            "city",
            round_half_up(F.col("_avg"), 2).alias("avg_pm25"),
            round_half_up(scoring.air_quality_risk(F.col("_avg")), 2).alias("air_quality_risk"),
            "station_count",
            "observation_count",
            (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
        )
    )


def assert_unique_stations(stations: DataFrame) -> DataFrame:
    """Fail the job when a station is mapped more than once."""
    checked = stations.groupBy("location_id").agg(
        *[F.any_value(c).alias(c) for c in stations.columns if c != "location_id"],
        F.count(F.lit(1)).alias("_n"),
    )
    complain = F.raise_error(F.concat(F.lit("duplicate station "), F.col("location_id").cast("string")))
    return checked.withColumn(
        "city", F.when(F.col("_n") > 1, complain).otherwise(F.col("city"))
    ).select(*stations.columns)
