"""Air-quality event messages: parsing, validation, routing.

Two rule sets exist. ``strict`` measures the age of an observation against the
processing time and rejects stale or future ones; ``ingest_age`` measures it
against the ingestion stamp and only marks stale ones. Both are per-row column
expressions, so the same code serves batch and stream and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardgrid import constants as C
from hazardgrid import schemas
from hazardgrid.functions import times
from hazardgrid.functions.jsontext import bigint, lacks, with_object
from hazardgrid.functions.numbers import json_number, round_half_even
from hazardgrid.functions.staging import evaluate_once
from hazardgrid.functions.text import lower_or_empty, utf8_lossy, utf8_text

VALID, INVALID = "VALID", "INVALID"
CURRENT, STALE, FUTURE, UNKNOWN = "CURRENT", "STALE", "FUTURE", "UNKNOWN"

EVENT_COLS = schemas.EVENT.fieldNames()
SILVER_COLS = schemas.SILVER_EVENT.fieldNames()
AUDIT_COLS = [*SILVER_COLS, "raw_message"]
_INTERNAL = ["_message", "_obj", "_missing", "_measured_at", "_ingested_at", "_age", "_error"]


def message_text(df: DataFrame, message: str) -> tuple[Column, Column]:
    """(text to parse, text to keep for the audit) of a string or bytes column."""
    col = F.col(message)
    if isinstance(df.schema[message].dataType, T.BinaryType):
        return utf8_text(col), utf8_lossy(col)
    return col, col


def parse_messages(df: DataFrame, message: str = "value") -> DataFrame:
    """Messages to typed event columns plus ``_obj``, null where parsing failed.

    A number may be written in quotes; any other text leaves the column null.
    """
    text, kept = message_text(df, message)
    others = [c for c in df.columns if c != message]
    obj = F.col("_obj")
    when = F.from_json(obj["measurement_datetime"], schemas.EVENT["measurement_datetime"].dataType)
    typed = {
        "location_id": bigint(obj, "location_id"),
        "parameter_id": bigint(obj, "parameter_id"),
        "sensor_id": bigint(obj, "sensor_id"),
        "source_location_id": bigint(obj, "source_location_id"),
        "latitude": json_number(obj["latitude"]),
        "longitude": json_number(obj["longitude"]),
        "value": json_number(obj["value"]),
        "measurement_datetime": when,
    }
    kept_text = df.select("*", kept.alias("_message"))
    return with_object(kept_text, text, "_obj").select(
        *others,
        "_message",
        "_obj",
        *[typed.get(c, obj[c]).alias(c) for c in EVENT_COLS],
    )


def _joined(*checks: Column, separator: str = ";") -> Column:
    """Join the texts of the checks that fired; empty when none did."""
    return F.concat_ws(separator, *checks)


def validate_strict(parsed: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Apply the strict rules; every violated rule is reported, in rule order.

    ``as_of`` is the processing time and defaults to the clock.
    """
    now = F.current_timestamp() if as_of is None else as_of
    obj = F.col("_obj")
    missing = _joined(
        *[F.when(lacks(obj, k), f"MISSING_FIELD:{k}") for k in C.STRICT_REQUIRED_FIELDS]
    )
    utc = F.col("measurement_datetime.utc")
    age = F.col("_age")
    inside = F.col("latitude").between(C.LAT_MIN, C.LAT_MAX) & F.col("longitude").between(C.LON_MIN, C.LON_MAX)
    violated = _joined(
        F.when(
            (lower_or_empty(F.col("parameter")) != C.PM25_NAME) & ~F.col("parameter_id").eqNullSafe(C.PM25_ID),
            "NOT_PM25",
        ),
        F.when(F.col("value").isNull(), "INVALID_VALUE")
        .when(F.isnan("value"), "NAN_VALUE")
        .when(F.col("value") < 0, "NEGATIVE_VALUE"),
        F.when(F.col("latitude").isNull() | F.col("longitude").isNull(), "INVALID_COORDINATES")
        .when(~inside, "OUTSIDE_INDONESIA_BOUNDS"),
        F.when(F.coalesce(utc, F.lit("")) == "", "MISSING_MEASUREMENT_UTC")
        .when(age.isNull(), "INVALID_MEASUREMENT_TIMESTAMP")
        .when(age < 0, "FUTURE_MEASUREMENT")
        .when(age > C.FRESHNESS_HOURS, "STALE_MEASUREMENT"),
    )
    error = (
        F.when(obj.isNull(), "JSON_PARSE_ERROR")
        .when(F.col("_missing") != "", F.col("_missing"))
        .otherwise(violated)
    )
    freshness = (
        F.when(age.isNull(), UNKNOWN)
        .when(age < 0, FUTURE)
        .when(age <= C.FRESHNESS_HOURS, CURRENT)
        .otherwise(STALE)
    )
    complete = obj.isNotNull() & (F.col("_missing") == "")
    staged = (
        parsed.withColumn("_missing", F.when(obj.isNotNull(), missing))
        .withColumn("_age", times.hours_between(now, times.parse_iso(utc)))
    )
    return _finish(
        staged,
        error,
        freshness=F.when(complete, freshness),
        age=F.when(complete, age),
        age_digits=4,
        processed_at=now,
    )


def validate_ingest_age(parsed: DataFrame) -> DataFrame:
    """Apply the lenient rules: the first problem is reported, stale stays valid.

    Parser, missing fields and negative values are reported in this rule set's own
    words; whatever else cannot be worked with has a token of its own.
    """
    obj = F.col("_obj")
    missing = _joined(
        *[F.when(lacks(obj, k), f"'{k}'") for k in C.INGEST_AGE_REQUIRED_FIELDS], separator=", "
    )
    utc = F.col("measurement_datetime.utc")
    stamp = F.col("ingestion_timestamp")
    # The first two texts and that of a negative value.
    error = (
        F.when(obj.isNull(), "JSON parsing error")
        .when(F.col("_missing") != "", F.concat(F.lit("Missing required fields: ["), F.col("_missing"), F.lit("]")))
        .when(obj["value"].isNull(), "NULL_VALUE")
        .when(F.col("value").isNull(), "INVALID_VALUE")
        .when(F.col("value") < 0, F.concat(F.lit("Negative PM2.5 value: "), F.col("value").cast("string")))
        .when(obj["measurement_datetime"].isNull(), "MISSING_MEASUREMENT_DATETIME")
        .when(utc.isNull(), "MISSING_MEASUREMENT_UTC")
        .when(F.col("_measured_at").isNull(), "INVALID_MEASUREMENT_TIMESTAMP")
        .when(F.col("_ingested_at").isNull(), "INVALID_INGESTION_TIMESTAMP")
        .when(times.has_offset(utc) != times.has_offset(stamp), "MIXED_TIME_ZONES")
        .otherwise("")
    )
    age = F.col("_age")
    staged = (
        parsed.withColumn("_missing", F.when(obj.isNotNull(), missing))
        .withColumn("_measured_at", times.parse_iso(utc))
        .withColumn("_ingested_at", times.parse_iso(stamp))
        .withColumn("_age", times.hours_between(F.col("_ingested_at"), F.col("_measured_at")))
        .withColumn("_error", error)
    )
    valid = F.col("_error") == ""
    return _finish(
        staged,
        F.col("_error"),
        freshness=F.when(valid, F.when(age <= C.FRESHNESS_HOURS, CURRENT).otherwise(STALE)),
        age=F.when(valid, age),
        age_digits=2,
        processed_at=F.lit(None).cast("timestamp"),
    )


def _finish(
    staged: DataFrame, error: Column, freshness: Column, age: Column, age_digits: int, processed_at: Column
) -> DataFrame:
    """Common output shape of both rule sets; an empty ``error`` means valid.

    The verdict is pinned, so selecting valid or rejected rows afterwards does
    not run the rules a second time.
    """
    others = [c for c in staged.columns if c not in EVENT_COLS and c not in _INTERNAL]
    verdict = F.struct(error.alias("error"), freshness.alias("freshness"), age.alias("age"))
    judged = evaluate_once(staged, "_verdict", verdict)
    rejected = F.col("_verdict.error") != ""
    parsed = F.col("_obj").isNotNull()
    enrichment = {
        "measurement_age_hours": round_half_even(F.col("_verdict.age"), age_digits),
        "freshness_status": F.col("_verdict.freshness"),
        "processed_at": processed_at,
        "validation_status": F.when(rejected, INVALID).otherwise(VALID),
        "validation_error": F.when(rejected, F.col("_verdict.error")),
        # Rejects of the parser keep the message, all others their record, and
        # with it the keys that are no column.
        "raw_message": F.when(~parsed, F.col("_message")),
        "record_json": F.when(parsed, F.col("_message")),
    }
    return judged.select(
        *others, *EVENT_COLS, *[enrichment[c].alias(c) for c in AUDIT_COLS if c not in EVENT_COLS]
    )


def silver_events(validated: DataFrame) -> DataFrame:
    """Accepted events."""
    extra = [c for c in validated.columns if c not in AUDIT_COLS]
    return validated.filter(F.col("validation_status") == VALID).select(*extra, *SILVER_COLS)


def audit_events(validated: DataFrame) -> DataFrame:
    """Rejected messages of parser and rules together, in one pass."""
    extra = [c for c in validated.columns if c not in AUDIT_COLS]
    return validated.filter(F.col("validation_status") == INVALID).select(*extra, *AUDIT_COLS)


def to_message(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows as JSON text in ``value``, null fields written out."""
    fields = F.struct(*[F.col(c) for c in (columns or df.columns)])
    return df.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))
