"""Catalog tables: namespaces, declared tables, marts and upserts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardgrid import constants as C
from hazardgrid import schemas
from hazardgrid.functions import lookups
from hazardgrid.operators import airquality, quality
from hazardgrid.operators.upsert import upsert
from hazardgrid.session import delete_dir, list_dir

KEYS = ["event_date", "city"]
#: Where a table keeps the partitions of later runs; readers of folders pass it by.
VERSIONS = "_versions"

# table -> (layer, schema, partition column, order inside the files)
TABLES: dict[str, tuple[str, T.StructType, str | None, list[str]]] = {
    "driver_events": ("bronze", schemas.DRIVER_EVENTS, None, ["city"]),
    "weather_events_daily": ("silver", schemas.WEATHER_EVENTS_DAILY, "event_date", ["city", "weather_event"]),
    "environment_risk_daily": ("silver", schemas.ENVIRONMENT_RISK_DAILY, "event_date", ["city"]),
    "openaq_air_quality_daily": ("silver", schemas.AIR_QUALITY_DAILY, "event_date", ["city"]),
    "openaq_station_mapping": ("silver", schemas.STATION_MAPPING, None, ["location_id"]),
    "logistics_events": (
        "silver",
        T.StructType([*schemas.LOGISTICS_EVENTS.fields, T.StructField("event_date", T.DateType())]),
        "event_date",
        ["city", "driver_id"],
    ),
    "fact_delivery_performance": ("gold", schemas.DELIVERY_PERFORMANCE, "event_date", ["city"]),
    "fact_area_risk_daily": ("gold", schemas.AREA_RISK_DAILY, "event_date", ["city"]),
}


class Warehouse:
    """Names and creation of the tables the jobs read and write."""

    def __init__(self, spark: SparkSession, prefix: str = "hazardgrid"):
        self.spark = spark
        self.prefix = prefix

    def namespace(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def name(self, table: str) -> str:
        return f"{self.namespace(TABLES[table][0])}.{table}"

    def create_namespaces(self) -> None:
        for layer in C.LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace(layer)}")

    def create_table(self, table: str) -> str:
        """Create a declared table unless it exists; returns its full name."""
        _, schema, partition, _ = TABLES[table]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        layout = f"PARTITIONED BY ({partition})" if partition else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet {layout}")
        return self.name(table)

    def table(self, table: str) -> DataFrame:
        """A table's rows in declared column order."""
        return self.spark.table(self.name(table)).select(*TABLES[table][1].fieldNames())

    @contextmanager
    def staged(self, df: DataFrame, table: str) -> Iterator[str]:
        """Name of a stage table ``df`` is written to, once; what has that name afterwards is dropped."""
        stage = f"{self.name(table)}_stage_{uuid.uuid4().hex[:12]}"
        try:
            df.write.format("parquet").saveAsTable(stage)
            yield stage
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {stage}")

    def overwrite(self, df: DataFrame, table: str) -> None:
        """Replace a whole table, as materialising a mart does.

        The rows are computed into a stage first: a job that fails leaves the
        previous content in place. A table without partitions is written once, its
        stage takes the table's name.
        """
        _, schema, partition, order = TABLES[table]
        rows = _conform(df, schema)
        if partition is None:
            with self.staged(_clustered(rows, partition, order), table) as stage:
                self._take_name(table, stage)
            return
        with self.staged(rows, table) as stage:
            writer = _clustered(self.spark.table(stage), partition, order).write.mode("overwrite").format("parquet")
            # Also drops the partitions the new content no longer has.
            writer = writer.partitionBy(partition).option("partitionOverwriteMode", "static")
            writer.saveAsTable(self.name(table))

    def _take_name(self, table: str, stage: str) -> None:
        """Give a stage the name of a table; the table it replaces is dropped last."""
        name, old = self.name(table), f"{self.name(table)}_old_{uuid.uuid4().hex[:12]}"
        replaces = self.spark.catalog.tableExists(name)
        if replaces:
            self.spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        try:
            self.spark.sql(f"ALTER TABLE {stage} RENAME TO {name}")
        except Exception:
            if replaces:
                self.spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
            raise
        if replaces:
            self.spark.sql(f"DROP TABLE {old}")

    def seed_stations(self) -> None:
        """(Re)write the station mapping; running it again does not duplicate it."""
        seed = airquality.assert_unique_stations(lookups.station_seed(self.spark))
        self.overwrite(seed, "openaq_station_mapping")

    def upsert(
        self,
        table: str,
        source: DataFrame,
        update_cols: list[str],
        insert_defaults: dict[str, Column] | None = None,
    ) -> None:
        """Merge rows into a date-partitioned table, replacing only their dates.

        The source is written to a stage table once, since both its dates and
        its rows are needed. The stage's first and last date (one row fetched)
        restrict the target scan to those partitions by a constant, the exact
        dates follow by a semi join. One writer per table is assumed.
        """
        _, schema, partition, order = TABLES[table]
        self.create_table(table)
        with self.staged(quality.require_keys(source.select(*KEYS, *update_cols), KEYS), table) as stage:
            rows = self.spark.table(stage)
            first, last = rows.agg(F.min(partition), F.max(partition)).first()
            if first is None:
                return
            touched = (
                self.table(table)
                .filter(F.col(partition).between(F.lit(first), F.lit(last)))
                .join(rows.select(partition).distinct(), partition, "left_semi")
            )
            self.replace_dates(table, upsert(touched, rows, KEYS, update_cols, insert_defaults))

    def replace_dates(self, table: str, rows: DataFrame, dates: list[str] | None = None) -> None:
        """Put ``rows`` in place of all rows of their dates, and of ``dates``.

        The rows are written to a new version folder; then each date's partition is
        pointed at it, which the catalog does in one step. So a reader sees a date
        before or after, never in between, and a run that fails leaves the dates it
        has not reached as they were. One of ``dates`` without rows is dropped. Old
        files stay for readers at work until ``vacuum``. One writer per table.
        """
        _, schema, partition, order = TABLES[table]
        name = self.create_table(table)
        folder = f"{self.location(table)}/{VERSIONS}/{uuid.uuid4().hex}"
        _clustered(_conform(rows, schema), partition, order).write.partitionBy(partition).parquet(folder)
        written = [n for n in list_dir(self.spark, folder) if n.startswith(f"{partition}=")]
        known = {r["partition"] for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        for place in written:  # as many as dates touched
            spec = f"({partition} = DATE '{place.split('=', 1)[1]}')"
            change = f"PARTITION {spec} SET" if place in known else f"ADD PARTITION {spec}"
            self.spark.sql(f"ALTER TABLE {name} {change} LOCATION '{folder}/{place}'")
        for day in dates or []:
            if f"{partition}={day}" not in written:
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition} = DATE '{day}')")

    def location(self, table: str, partition: str = "") -> str:
        """Folder of a table or of one of its partitions (as ``SHOW PARTITIONS`` writes it)."""
        spec = f"PARTITION ({partition.replace('=', ' = DATE ' + chr(39))}{chr(39)})" if partition else ""
        told = self.spark.sql(f"DESCRIBE FORMATTED {self.name(table)} {spec}").collect()
        return next(r["data_type"] for r in told if r["col_name"] == "Location")

    def vacuum(self, table: str) -> None:
        """Delete the files of dates that have been replaced; no reader of them may be left."""
        partition = TABLES[table][2]
        shown = [r["partition"] for r in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()]
        used = {self.location(table, p) for p in shown}
        top = self.location(table)
        runs = [top, *(f"{top}/{VERSIONS}/{n}" for n in list_dir(self.spark, f"{top}/{VERSIONS}"))]
        for run in runs:
            for place in list_dir(self.spark, run):
                if place.startswith(f"{partition}=") and f"{run}/{place}" not in used:
                    delete_dir(self.spark, f"{run}/{place}")


def upsert_weather(warehouse: Warehouse, rows: DataFrame) -> None:
    """Merge daily weather; the air-quality column of existing rows is kept."""
    keep = {*KEYS, "air_quality_risk"}
    columns = [c for c in schemas.ENVIRONMENT_RISK_DAILY.fieldNames() if c not in keep]
    warehouse.upsert("environment_risk_daily", rows, columns)


def upsert_air_quality(warehouse: Warehouse, rows: DataFrame) -> None:
    """Merge daily air quality; every value of a matched row is replaced."""
    columns = [c for c in schemas.AIR_QUALITY_DAILY.fieldNames() if c not in KEYS]
    warehouse.upsert("openaq_air_quality_daily", rows, columns)


def content_hash(columns: list[str]) -> Column:
    """SHA-256 of columns as one JSON object with null fields written out."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def land_records(df: DataFrame, path: str, key: str, arrival: str, ingestion_date: str) -> None:
    """Land records under ``ingestion_date=`` so that a re-ingest replaces its own.

    Within a batch the record with the highest ``arrival`` wins, of several with it the
    one whose content has the largest SHA-256; records landed
    earlier the same day stay unless the batch brings the same key. Only the
    folder of that day is read and rewritten.
    """
    values = [c for c in df.columns if c != key]
    landed = (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*values), F.struct(F.col(arrival), content_hash(values))).alias("_row"))
        .select(key, *[F.col("_row")[c].alias(c) for c in values])
        .select(*df.columns)
    )
    schema = T.StructType([*df.schema.fields, T.StructField("ingestion_date", T.DateType())])
    today = F.lit(ingestion_date).cast("date")
    try:
        stored = df.sparkSession.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        earlier = stored.filter(F.col("ingestion_date") == today).drop("ingestion_date")
        landed = landed.unionByName(earlier.join(landed.select(key), key, "left_anti"))
    (
        landed.withColumn("ingestion_date", today)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingestion_date")
        .parquet(path)
    )


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns, types and NOT NULL keys."""
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    return quality.require_keys(typed, [f.name for f in schema if not f.nullable])


def _clustered(df: DataFrame, partition: str | None, order: list[str]) -> DataFrame:
    """Few well-filled files per date, ordered for min/max skipping.

    A rebalance, unlike a repartition by date, lets AQE split a date that is
    much larger than the others.
    """
    if partition is None:
        return df.sortWithinPartitions(*order)
    return df.hint("rebalance", partition).sortWithinPartitions(partition, *order)
