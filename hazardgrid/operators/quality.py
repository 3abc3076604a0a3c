"""Data checks: a check lists the rows that break it and passes when there are none."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid import constants as C


@dataclass(frozen=True)
class Check:
    name: str
    broken: Column  # true for a row that breaks the check; null passes


def not_null(column: str) -> Check:
    return Check(f"not_null_{column}", F.col(column).isNull())


def accepted_values(column: str, values: list[str]) -> Check:
    return Check(f"accepted_values_{column}", ~F.col(column).isin(values))


def score_range() -> Check:
    return Check("score_range", (F.col("risk_score") < 0) | (F.col("risk_score") > 100))


def band_consistency() -> Check:
    """Band and rounded score must agree; the no-data band needs empty inputs."""
    score, band = F.col("risk_score"), F.col("risk_band")
    lower = None
    broken = F.lit(False)
    for upper, name in [*C.BAND_EDGES, (None, C.TOP_BAND)]:
        inside = F.lit(True)
        if lower is not None:
            inside = inside & (score >= lower)
        if upper is not None:
            inside = inside & (score < upper)
        broken = broken | ((band == name) & ~inside)
        lower = upper
    empty = F.col("weather_risk").isNull() & F.col("air_quality_risk").isNull() & F.col("delay_rate").isNull()
    return Check("band_consistency", broken | ((band == C.NO_DATA_BAND) & ~empty))


def delivery_checks() -> list[Check]:
    return [not_null(c) for c in ("event_date", "city", "orders", "delay_rate")]


def gold_checks() -> list[Check]:
    return [
        *[not_null(c) for c in ("event_date", "city", "risk_score", "risk_band")],
        accepted_values("risk_band", C.RISK_BANDS),
        score_range(),
        band_consistency(),
    ]


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows that break a check."""
    return df.filter(check.broken)


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check_name, failed_rows) for all checks in a single pass over the data."""
    counts = df.agg(*[F.count_if(c.broken).alias(c.name) for c in checks])
    pairs = F.array(
        *[F.struct(F.lit(c.name).alias("check_name"), F.col(c.name).alias("failed_rows")) for c in checks]
    )
    return counts.select(F.inline(pairs))


class ChecksFailed(RuntimeError):
    """At least one data check found rows that break it."""


def enforce(df: DataFrame, checks: list[Check]) -> None:
    """Run the checks and raise if any of them fails (one row per check is fetched)."""
    failed = {r["check_name"]: r["failed_rows"] for r in run_checks(df, checks).filter("failed_rows > 0").collect()}
    if failed:
        raise ChecksFailed(", ".join(f"{name}: {n} rows" for name, n in sorted(failed.items())))


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """NOT NULL on key columns, enforced while the rows are written."""
    for key in keys:
        guard = F.raise_error(F.lit(f"{key} must not be null"))
        df = df.withColumn(key, F.when(F.col(key).isNull(), guard).otherwise(F.col(key)))
    return df
