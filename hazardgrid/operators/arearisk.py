"""Gold: one row per date and city with the three signals, score and band."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid import constants as C
from hazardgrid import schemas
from hazardgrid.functions import scoring
from hazardgrid.functions.numbers import round_half_up

KEYS = ["event_date", "city"]
DELIVERY_COLS = [
    "orders", "avg_actual_delivery_min", "avg_expected_delivery_min",
    "avg_delay_min", "delay_rate", "avg_route_rating",
]
AIR_COLS = ["avg_pm25", "air_quality_risk", "station_count", "observation_count"]
GOLD_COLS = schemas.AREA_RISK_DAILY.fieldNames()


def weather_signal(environment: DataFrame) -> DataFrame:
    """Highest risk and alert count per date and city."""
    return environment.groupBy(*KEYS).agg(
        F.max("weather_risk").alias("weather_risk"),
        F.max("active_weather_alerts").alias("active_weather_alerts"),
        (F.count("weather_risk") > 0).alias("has_weather_data"),
    )


def date_city_spine(*signals: DataFrame) -> DataFrame:
    """All (date, city) pairs any signal knows."""
    return reduce(DataFrame.union, [s.select(*KEYS) for s in signals]).distinct()


def combine_by_joins(delivery: DataFrame, environment: DataFrame, air: DataFrame) -> DataFrame:
    """Spine plus three left joins, for signals that are small stored tables."""
    weather = weather_signal(environment)
    combined = (
        date_city_spine(delivery, weather, air)
        .join(delivery.select(*KEYS, *DELIVERY_COLS), KEYS, "left")
        .join(weather, KEYS, "left")
        .join(air.select(*KEYS, *AIR_COLS), KEYS, "left")
    )
    return _with_flags(combined)


def combine_in_one_pass(delivery: DataFrame, environment: DataFrame, air: DataFrame) -> DataFrame:
    """The same rows from one union and one aggregation.

    The spine reads every signal a second time, which is costly when the
    signals are still being computed from raw data. Each signal has at most one
    row per key after its own aggregation, so merging the padded signals by key
    gives the joined row: every input is read once and only daily rows shuffle.
    A key with a null part matches nothing in a join; its payload is dropped
    here to the same effect.
    """
    has_key = F.col("event_date").isNotNull() & F.col("city").isNotNull()

    def padded(signal: DataFrame, columns: list[str]) -> DataFrame:
        return signal.select(*KEYS, *[F.when(has_key, F.col(c)).alias(c) for c in columns])

    stacked = (
        padded(delivery, DELIVERY_COLS)
        .unionByName(padded(environment, ["weather_risk", "active_weather_alerts"]), allowMissingColumns=True)
        .unionByName(padded(air, AIR_COLS), allowMissingColumns=True)
    )
    payload = [c for c in stacked.columns if c not in KEYS]
    combined = stacked.groupBy(*KEYS).agg(
        *[F.max(c).alias(c) for c in payload],
        (F.count("weather_risk") > 0).alias("has_weather_data"),
    )
    return _with_flags(combined)


def _with_flags(combined: DataFrame) -> DataFrame:
    return combined.withColumns(
        {
            "has_weather_data": F.coalesce(F.col("has_weather_data"), F.lit(False)),
            "has_air_quality_data": F.col("air_quality_risk").isNotNull(),
        }
    )


def score(combined: DataFrame) -> DataFrame:
    """Rounded score, and the band of the score before rounding."""
    raw = _raw_score()
    inputs = [F.col(c) for c in ("weather_risk", "air_quality_risk", "delay_rate")]
    return combined.withColumns(
        {
            "risk_score": round_half_up(raw, 2),
            "risk_band": scoring.band_or_no_data(raw, *inputs),
        }
    ).select(*GOLD_COLS)


def _raw_score() -> Column:
    return scoring.weighted_score(
        F.col("weather_risk"),
        F.col("air_quality_risk"),
        scoring.logistics_risk(F.col("delay_rate")),
    )


def area_risk_daily(delivery: DataFrame, environment: DataFrame, air: DataFrame) -> DataFrame:
    """The gold table from its three daily inputs."""
    return score(combine_in_one_pass(delivery, environment, air))


# --- serving figures ---------------------------------------------------------


def kpi_overview(gold: DataFrame) -> DataFrame:
    """Headline figures: mean score, alerting areas, mean delay, coverage."""
    return gold.agg(
        F.avg("risk_score").alias("avg_risk_score"),
        F.count_if(F.col("risk_band").isin(C.ALERTING_BANDS)).alias("high_or_critical_areas"),
        F.avg("delay_rate").alias("avg_delay_rate"),
        F.avg(F.col("has_air_quality_data").cast("int")).alias("air_quality_coverage"),
    )


def _series(gold: DataFrame, key: str) -> DataFrame:
    return (
        gold.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("areas"),
            F.avg("risk_score").alias("avg_risk_score"),
            F.avg("weather_risk").alias("avg_weather_risk"),
            F.avg("air_quality_risk").alias("avg_air_quality_risk"),
            F.avg("delay_rate").alias("avg_delay_rate"),
            F.count_if(F.col("risk_band").isin(C.ALERTING_BANDS)).alias("high_or_critical"),
            F.count_if(F.col("risk_band") == C.NO_DATA_BAND).alias("insufficient_data"),
        )
        .orderBy(F.col(key).asc_nulls_first())
    )


def kpi_by_city(gold: DataFrame) -> DataFrame:
    """Mean risks per city; areas without data stay visible."""
    return _series(gold, "city")


def kpi_trend(gold: DataFrame) -> DataFrame:
    """Mean risks over time."""
    return _series(gold, "event_date")


def detail_table(gold: DataFrame) -> DataFrame:
    """All gold rows in reading order."""
    return gold.orderBy(F.col("event_date").desc_nulls_last(), F.col("city").asc_nulls_first())
