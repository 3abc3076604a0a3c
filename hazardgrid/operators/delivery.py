"""Delivery events: typed staging and daily performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardgrid import schemas


def stage_driver_events(bronze: DataFrame) -> DataFrame:
    """Driver events with the declared types.

    Text timestamps are UTC when they carry no zone. A fractional number going
    into a whole-number column is rounded, not truncated; text must be whole.
    """
    types = dict(bronze.dtypes)

    def typed(name: str, target: str) -> Column:
        col = F.col(name)
        if target == "bigint" and types[name] in ("double", "float"):
            col = F.round(col)
        return col.cast(target).alias(name)

    return bronze.select(*[typed(f.name, f.dataType.simpleString()) for f in schemas.DRIVER_EVENTS])


def delivery_performance(staged: DataFrame) -> DataFrame:
    """Daily delivery figures per city.

    ``orders`` counts distinct orders while ``delay_rate`` is a share of event
    rows. The distinct count makes Spark aggregate by (date, city, order) first,
    so even a single dominant city is spread over all tasks.
    """
    return staged.groupBy(F.to_date("event_ts").alias("event_date"), "city").agg(
        F.countDistinct("order_id").alias("orders"),
        F.avg("actual_delivery_min").alias("avg_actual_delivery_min"),
        F.avg("expected_delivery_min").alias("avg_expected_delivery_min"),
        F.avg("delay_min").alias("avg_delay_min"),
        F.try_divide(F.count_if(F.col("delay_min") > 0), F.count(F.lit(1))).alias("delay_rate"),
        F.avg("route_rating").alias("avg_route_rating"),
    )
