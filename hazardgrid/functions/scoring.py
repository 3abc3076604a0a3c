"""Component risks, weighted score and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardgrid import constants as C
from hazardgrid.functions.numbers import cap_at_100, clamp_percent


def pm25_percent(pm25: Column) -> Column:
    """PM2.5 as a share of the full-risk concentration, not yet bounded."""
    return pm25 / F.lit(C.PM25_FULL_RISK) * F.lit(100.0)


def air_quality_risk(pm25: Column) -> Column:
    """Bounded PM2.5 risk; null stays null."""
    return cap_at_100(pm25_percent(pm25))


def logistics_risk(delay_rate: Column) -> Column:
    """Bounded delay risk; null stays null."""
    return cap_at_100(delay_rate * F.lit(100.0))


def weighted_score(weather: Column, air: Column, logistics: Column) -> Column:
    """Weighted sum of the three components, a missing component counting as 0."""
    zero = F.lit(0.0)
    return (
        F.lit(C.WEATHER_WEIGHT) * F.coalesce(weather, zero)
        + F.lit(C.AIR_WEIGHT) * F.coalesce(air, zero)
        + F.lit(C.LOGISTICS_WEIGHT) * F.coalesce(logistics, zero)
    )


def band(score: Column) -> Column:
    """Band of a score; the upper edge of a band belongs to the next one."""
    edges = iter(C.BAND_EDGES)
    limit, name = next(edges)
    chain = F.when(score < limit, F.lit(name))
    for limit, name in edges:
        chain = chain.when(score < limit, F.lit(name))
    return chain.otherwise(F.lit(C.TOP_BAND))


def band_or_no_data(score: Column, *inputs: Column) -> Column:
    """Band of a score, or the no-data band when every input is missing."""
    nothing = F.lit(True)
    for value in inputs:
        nothing = nothing & value.isNull()
    return F.when(nothing, F.lit(C.NO_DATA_BAND)).otherwise(band(score))


def row_air_risk(pm25: Column) -> Column:
    """PM2.5 risk of a single combined row: missing is 0, negatives are 0."""
    return clamp_percent(pm25_percent(F.coalesce(pm25, F.lit(0.0))))


def row_logistics_risk(delay_rate: Column) -> Column:
    return clamp_percent(F.coalesce(delay_rate, F.lit(0.0)) * F.lit(100.0))
