"""Declared schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
DATE, TIMESTAMP, BOOLEAN = T.DateType(), T.TimestampType(), T.BooleanType()


def _struct(required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields.items()])


_KEYS = ("event_date", "city")

# --- weather -----------------------------------------------------------------
CAP_DOCUMENT = _struct(
    identifier=STRING,
    info=T.ArrayType(
        _struct(
            event=STRING,
            urgency=STRING,
            severity=STRING,
            certainty=STRING,
            effective=STRING,
            expires=STRING,
            headline=STRING,
            description=STRING,
            area=T.ArrayType(_struct(areaDesc=STRING, polygon=STRING)),
        )
    ),
)

FEED_ITEM = _struct(link=T.ArrayType(STRING))

PROVINCE_CITY = _struct(area_desc=STRING, city=STRING)

# Alerts of a day and city by event; the hand-over folds them into one row.
WEATHER_EVENTS_DAILY = _struct(
    ("event_date", "city"),
    event_date=DATE,
    city=STRING,
    weather_event=STRING,
    weather_risk=DOUBLE,
    active_weather_alerts=LONG,
    first_path=STRING,
    bmkg_alert_id=STRING,
    severity=STRING,
    urgency=STRING,
    certainty=STRING,
    area_desc=STRING,
    effective=STRING,
    expires=STRING,
    headline=STRING,
    processed_at=TIMESTAMP,
)

# Daily weather hand-over file (text timestamps, includes the headline).
WEATHER_DAILY_JSON = _struct(
    event_date=DATE,
    city=STRING,
    weather_risk=DOUBLE,
    active_weather_alerts=LONG,
    bmkg_alert_id=STRING,
    weather_event=STRING,
    severity=STRING,
    urgency=STRING,
    certainty=STRING,
    area_desc=STRING,
    effective=STRING,
    expires=STRING,
    headline=STRING,
    processed_at=STRING,
)

ENVIRONMENT_RISK_DAILY = _struct(
    _KEYS,
    event_date=DATE,
    city=STRING,
    weather_risk=DOUBLE,
    air_quality_risk=DOUBLE,
    active_weather_alerts=LONG,
    bmkg_alert_id=STRING,
    weather_event=STRING,
    severity=STRING,
    urgency=STRING,
    certainty=STRING,
    area_desc=STRING,
    effective=TIMESTAMP,
    expires=TIMESTAMP,
    processed_at=TIMESTAMP,
)

# --- air quality -------------------------------------------------------------
_MOMENT = _struct(utc=STRING, local=STRING)

EVENT = _struct(
    source=STRING,
    ingestion_timestamp=STRING,
    location_id=LONG,
    location_name=STRING,
    locality=STRING,
    country_code=STRING,
    latitude=DOUBLE,
    longitude=DOUBLE,
    parameter=STRING,
    parameter_id=LONG,
    parameter_display_name=STRING,
    unit=STRING,
    value=DOUBLE,
    measurement_datetime=_MOMENT,
    sensor_id=LONG,
    source_location_id=LONG,
)

_VERDICT = _struct(
    measurement_age_hours=DOUBLE,
    freshness_status=STRING,
    processed_at=TIMESTAMP,
    validation_status=STRING,
    validation_error=STRING,
)
SILVER_EVENT = T.StructType([*EVENT.fields, *_VERDICT.fields, T.StructField("record_json", T.StringType())])

STATION_MAPPING = _struct(
    ("location_id", "city", "mapping_method"),
    location_id=LONG,
    city=STRING,
    mapping_method=STRING,
    notes=STRING,
)

AIR_QUALITY_DAILY = _struct(
    _KEYS,
    event_date=DATE,
    city=STRING,
    avg_pm25=DOUBLE,
    air_quality_risk=DOUBLE,
    station_count=LONG,
    observation_count=LONG,
    processed_at=TIMESTAMP,
)

LOCATIONS = _struct(
    pos=INT,
    id=LONG,
    name=STRING,
    locality=STRING,
    country=_struct(code=STRING),
    coordinates=_struct(latitude=DOUBLE, longitude=DOUBLE),
)
MEASUREMENTS = _struct(locationsId=LONG, sensorsId=LONG, value=DOUBLE, datetime=_MOMENT)
SENSORS = _struct(id=LONG, parameter=_struct(id=LONG, name=STRING, displayName=STRING, units=STRING))

# --- logistics ---------------------------------------------------------------
DRIVER_EVENTS = _struct(
    event_id=STRING,
    event_ts=TIMESTAMP,
    city=STRING,
    driver_id=STRING,
    order_id=STRING,
    latitude=DOUBLE,
    longitude=DOUBLE,
    expected_delivery_min=LONG,
    actual_delivery_min=LONG,
    delay_min=LONG,
    route_rating=DOUBLE,
)

LOGISTICS_EVENTS = T.StructType(
    [
        T.StructField("event_id", STRING, False),
        *DRIVER_EVENTS.fields[1:],
        T.StructField("status", STRING),
    ]
)

# CSV landing format of driver events; staging casts it.
DRIVER_EVENTS_CSV = _struct(
    event_id=STRING,
    event_ts=STRING,
    city=STRING,
    district=STRING,
    driver_id=STRING,
    order_id=STRING,
    latitude=STRING,
    longitude=STRING,
    expected_delivery_min=STRING,
    actual_delivery_min=STRING,
    delay_min=STRING,
    route_rating=STRING,
    status=STRING,
)

_DELIVERY_FIGURES = dict(
    orders=LONG,
    avg_actual_delivery_min=DOUBLE,
    avg_expected_delivery_min=DOUBLE,
    avg_delay_min=DOUBLE,
    delay_rate=DOUBLE,
    avg_route_rating=DOUBLE,
)
DELIVERY_PERFORMANCE = _struct(event_date=DATE, city=STRING, **_DELIVERY_FIGURES)

# --- gold --------------------------------------------------------------------
AREA_RISK_DAILY = _struct(
    event_date=DATE,
    city=STRING,
    **_DELIVERY_FIGURES,
    weather_risk=DOUBLE,
    active_weather_alerts=LONG,
    has_weather_data=BOOLEAN,
    avg_pm25=DOUBLE,
    air_quality_risk=DOUBLE,
    station_count=LONG,
    observation_count=LONG,
    has_air_quality_data=BOOLEAN,
    risk_score=DOUBLE,
    risk_band=STRING,
)
