"""Score records that already carry all three signals in one JSON object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid.functions import lookups, scoring
from hazardgrid.functions.jsontext import with_object
from hazardgrid.functions.numbers import clamp_percent, json_number, round_half_even
from hazardgrid.functions.staging import evaluate_once
from hazardgrid.operators.events import message_text

SCORED_COLS = [
    "event_id", "event_ts", "city", "severity", "pm25", "delay_rate",
    "risk_score", "risk_band", "processed_at", "record",
]


def score_rows(messages: DataFrame, message: str = "value", processed_at: Column | None = None) -> DataFrame:
    """Scored records, with ``raw``/``error`` set on the ones that cannot be scored.

    The severity is read from ``severity`` when that key exists, even if its
    value is null, and from ``weather_severity`` otherwise. The band is that of
    the rounded score. ``record`` keeps the whole text of a scored record, and
    with it the keys that the scorer does not know.
    """
    text, kept = message_text(messages, message)
    others = [c for c in messages.columns if c != message]
    obj = F.col("_obj")
    severity = F.when(F.map_contains_key(obj, F.lit("severity")), obj["severity"]).otherwise(obj["weather_severity"])
    # Empty text counts as missing, like null.
    number = lambda key: json_number(F.nullif(obj[key], F.lit("")))
    unreadable = lambda key: (F.coalesce(obj[key], F.lit("")) != "") & F.col(key).isNull()
    parsed = with_object(messages.select("*", kept.alias("_raw")), text, "_obj").select(
        *others,
        "_raw",
        "_obj",
        *[obj[c].alias(c) for c in ("event_id", "event_ts", "city")],
        severity.alias("severity"),
        number("pm25").alias("pm25"),
        number("delay_rate").alias("delay_rate"),
    )
    error = (
        F.when(obj.isNull(), "JSON_PARSE_ERROR")
        .when(unreadable("pm25") | unreadable("delay_rate"), "INVALID_NUMBER")
        .otherwise("")
    )
    raw_score = clamp_percent(
        scoring.weighted_score(
            lookups.severity_risk(F.col("severity"), trim=False),
            scoring.row_air_risk(F.col("pm25")),
            scoring.row_logistics_risk(F.col("delay_rate")),
        )
    )
    judged = evaluate_once(parsed.withColumn("_score", raw_score), "_error", error)
    good = F.col("_error") == ""
    return (
        judged.withColumn("risk_score", F.when(good, round_half_even(F.col("_score"), 2)))
        .withColumn("risk_band", F.when(good, scoring.band(F.col("risk_score"))))
        .withColumn("processed_at", F.current_timestamp() if processed_at is None else processed_at)
        .withColumn("record", F.when(good, F.col("_raw")))
        .withColumn("raw", F.when(~good, F.col("_raw")))
        .withColumn("error", F.when(~good, F.col("_error")))
        .select(*others, *SCORED_COLS, "raw", "error")
    )


def scored(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("error").isNull()).drop("raw", "error")


def dead_letters(rows: DataFrame) -> DataFrame:
    extra = [c for c in rows.columns if c not in SCORED_COLS and c not in ("raw", "error")]
    return rows.filter(F.col("error").isNotNull()).select(*extra, "raw", "error")
