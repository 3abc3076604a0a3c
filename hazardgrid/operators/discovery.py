"""Select locations and recent PM2.5 measurements and shape them into events.

The inputs are landed frames: locations, measurements, and sensor metadata. All
of them are looked at; how many requests a client would have needed plays no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid import constants as C
from hazardgrid.functions.text import lower_or_empty, upper_or_empty


def in_country(location: Column) -> Column:
    """Country code and coordinates both place the location in the country."""
    lat = location["coordinates"]["latitude"].try_cast("double")
    lon = location["coordinates"]["longitude"].try_cast("double")
    inside = lat.between(C.LAT_MIN, C.LAT_MAX) & lon.between(C.LON_MIN, C.LON_MAX)
    return (upper_or_empty(location["country"]["code"]) == C.COUNTRY_CODE) & F.coalesce(inside, F.lit(False))


def is_pm25(parameter: Column) -> Column:
    """Sensor measures PM2.5 by id or by name; a missing sensor does not."""
    by_id = parameter["id"].eqNullSafe(C.PM25_ID)
    return by_id | (lower_or_empty(parameter["name"]) == C.PM25_NAME)


def has_id(col: Column) -> Column:
    return F.coalesce(col, F.lit(0)) != 0


def recent(measurements: DataFrame, as_of: Column) -> DataFrame:
    """Measurements of the 24 hours up to ``as_of`` and anything later."""
    taken = F.col("datetime.utc").try_cast("timestamp")
    return measurements.filter(taken >= as_of - F.expr(f"INTERVAL {C.FRESHNESS_HOURS} HOURS"))


def judged_locations(locations: DataFrame) -> DataFrame:
    """All locations, each marked valid or not."""
    location = F.struct(*[F.col(c) for c in locations.columns])
    return locations.select(
        location.alias("location"), has_id(F.col("id")).alias("has_id"), in_country(location).alias("in_country")
    )


def inspected_measurements(
    locations: DataFrame, measurements: DataFrame, sensors: DataFrame, as_of: Column
) -> DataFrame:
    """All recent measurements of the valid locations, with sensor metadata.

    Plain joins on the location and on the sensor: Catalyst broadcasts the
    metadata while their measured size allows it.
    """
    valid = judged_locations(locations).filter("has_id AND in_country")
    known = sensors.groupBy(F.col("id").alias("sensorsId")).agg(F.min("parameter").alias("parameter"))
    return (
        recent(measurements, as_of)
        .select("locationsId", "sensorsId", "value", "datetime")
        .join(valid.select(F.col("location.id").alias("locationsId"), "location"), "locationsId")
        .join(known, "sensorsId", "left")
        .withColumn("usable", has_id(F.col("sensorsId")) & is_pm25(F.col("parameter")))
    )


def discovered_events(
    locations: DataFrame,
    measurements: DataFrame,
    sensors: DataFrame,
    as_of: Column,
    ingestion_timestamp: Column | None = None,
) -> DataFrame:
    """PM2.5 observations of the valid locations, flattened to events."""
    published = inspected_measurements(locations, measurements, sensors, as_of).filter("usable")
    stamp = ingestion_timestamp
    if stamp is None:
        stamp = F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return published.select(
        F.lit(C.EVENT_SOURCE).alias("source"),
        stamp.alias("ingestion_timestamp"),
        F.col("location.id").alias("location_id"),
        F.col("location.name").alias("location_name"),
        F.col("location.locality").alias("locality"),
        F.col("location.country.code").alias("country_code"),
        F.col("location.coordinates.latitude").alias("latitude"),
        F.col("location.coordinates.longitude").alias("longitude"),
        F.coalesce("parameter.name", F.lit(C.PM25_NAME)).alias("parameter"),
        F.col("parameter.id").alias("parameter_id"),
        F.col("parameter.displayName").alias("parameter_display_name"),
        F.col("parameter.units").alias("unit"),
        "value",
        F.col("datetime").alias("measurement_datetime"),
        F.col("sensorsId").alias("sensor_id"),
        F.col("locationsId").alias("source_location_id"),
    )


def discovery_summary(
    locations: DataFrame, measurements: DataFrame, sensors: DataFrame, as_of: Column
) -> DataFrame:
    """Counts over all locations and their recent measurements, as a single row."""
    valid = F.col("has_id") & F.col("in_country")
    places = judged_locations(locations).agg(
        F.count(F.lit(1)).alias("locations_discovered"),
        F.count_if(valid).alias("locations_checked"),
        F.count_if(F.col("has_id") & ~F.col("in_country")).alias("non_indonesia_skipped"),
    )
    readings = (
        inspected_measurements(locations, measurements, sensors, as_of)
        .groupBy("locationsId")
        .agg(
            F.count(F.lit(1)).alias("measurements"),
            F.count_if("usable").alias("pm25"),
            F.count_if(has_id(F.col("sensorsId")) & ~F.col("usable")).alias("non_pm25"),
        )
        .agg(
            F.count_if(F.col("pm25") > 0).alias("active_locations"),
            F.coalesce(F.sum("measurements"), F.lit(0)).alias("measurements_checked"),
            F.coalesce(F.sum("pm25"), F.lit(0)).alias("pm25_found"),
            F.coalesce(F.sum("non_pm25"), F.lit(0)).alias("non_pm25_skipped"),
        )
    )
    merged = places.unionByName(readings, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns]).withColumn("published", F.col("pm25_found"))
