"""JSON-lines output; null fields are written out and text is not escaped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardgrid.functions import times
from hazardgrid.operators import rowscore


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_weather_daily(daily: DataFrame, path: str) -> None:
    """Hand-over file ordered by date and city across its parts."""
    ordered = daily.orderBy(F.col("event_date").asc_nulls_first(), F.col("city").asc_nulls_first())
    write_json_lines(ordered, path)


def write_scored(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Scored records to ``path``, unreadable ones to ``path_dead_letter``."""
    rows = rows.persist()
    try:
        write_json_lines(rowscore.scored(rows), path, mode)
        write_json_lines(rowscore.dead_letters(rows), f"{path}_dead_letter", mode)
    finally:
        rows.unpersist()


def silver_layout(df: DataFrame) -> DataFrame:
    """Events with the partition column of the Silver layout.

    Events without a readable measurement time go to the default partition.
    """
    return df.withColumn("event_date", F.to_date(times.parse_iso(F.col("measurement_datetime.utc"))))


