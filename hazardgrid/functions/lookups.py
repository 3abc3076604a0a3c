"""Fixed lookup tables as Spark maps and literal relations."""

from __future__ import annotations

from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hazardgrid import constants as C
from hazardgrid import schemas
from hazardgrid.functions.text import lower_or_empty, strip_ws


def _map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(entries.items())])


def severity_risk(severity: Column, trim: bool = True) -> Column:
    """Risk of an alert severity; unknown or missing severities are 0."""
    key = lower_or_empty(strip_ws(severity) if trim else severity)
    return F.coalesce(F.try_element_at(_map(C.SEVERITY_RISK), key), F.lit(0.0))


def normalize_area(area: Column) -> Column:
    """Trimmed area name with abbreviations spelt out; missing names are empty."""
    name = F.coalesce(strip_ws(area), F.lit(""))
    return F.coalesce(F.try_element_at(_map(C.AREA_ALIASES), name), name)


def _literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Fixed rows as a local relation, whose size Catalyst knows.

    Rows handed over as Python objects become an RDD of unknown size, which a
    join would shuffle the other side for.
    """
    columns = [list(c) for c in zip(*rows)]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def province_cities(spark: SparkSession) -> DataFrame:
    """Province to operating city (8 literal rows)."""
    return _literal_table(spark, list(C.PROVINCE_CITY.items()), schemas.PROVINCE_CITY)


def station_seed(spark: SparkSession) -> DataFrame:
    """Monitoring stations mapped to operating cities (22 literal rows)."""
    return _literal_table(spark, C.STATION_SEED, schemas.STATION_MAPPING)


def station_city(location_id: Column) -> Column:
    """Operating city of a station id, null when the station is not mapped."""
    cities = _map({s[0]: s[1] for s in C.STATION_SEED}).cast("map<bigint,string>")
    return F.try_element_at(cities, location_id.cast("bigint"))
