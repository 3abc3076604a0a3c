"""Files as they were landed: alert objects, feeds, messages, CSV and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid import constants as C
from hazardgrid import schemas
from hazardgrid.session import path_exists
from hazardgrid.sinks.eventstore import EventStore


_OBJECTS = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _objects(spark: SparkSession, root: str, glob: str, dates: list[str] | None) -> DataFrame:
    # Objects without a date folder may lie next to dated ones, which partition
    # discovery refuses; the date is taken from the path by the parser instead.
    # Naming the dates keeps a daily run from listing the whole history; a date
    # on which nothing landed has no folder.
    paths = [root]
    if dates:
        paths = [p for p in (f"{root}/ingestion_date={d}" for d in dates) if path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], _OBJECTS)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(paths)
        .select("path", "modificationTime", "length", "content")
    )


def alert_objects(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    """Landed CAP documents, one row per ``*_alert.xml`` object."""
    return _objects(spark, root, f"*{C.CAP_FILE_SUFFIX}", dates)


def feed_objects(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    """Landed alert feeds, one row per ``feed_*.xml`` object."""
    return _objects(spark, root, "feed_*.xml", dates)


def message_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines text, one message per row in ``value``."""
    return spark.read.text(path)


def message_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """JSON-lines files arriving in a folder, as a stream."""
    return spark.readStream.options(**options).format("text").load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a topic as a stream of bytes with their publish time."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
        .select(F.col("value"), F.col("timestamp").alias("published_at"))
    )


def silver_events(
    spark: SparkSession, path: str, fmt: str = "parquet", dates: list[str] | None = None
) -> DataFrame:
    """Accepted events of an event store, or of one folder of Parquet or JSON lines.

    ``dates`` prunes an event store or a dated layout to the folders of those dates.
    """
    if EventStore.is_store(spark, path):
        stored = EventStore(spark, path, fmt).read(schemas.SILVER_EVENT, "silver", dates)
        return stored.select(*schemas.SILVER_EVENT.fieldNames())
    stored = spark.read.schema(schemas.SILVER_EVENT).format(fmt).load(path)
    if dates:
        stored = stored.filter(F.col("event_date").isin([F.lit(d).cast("date") for d in dates]))
    return stored.select(*schemas.SILVER_EVENT.fieldNames())


def driver_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """Delivery events from CSV with a header; staging applies the types."""
    return spark.read.schema(schemas.DRIVER_EVENTS_CSV).option("header", "true").csv(path)


def driver_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DRIVER_EVENTS).parquet(path)


def weather_daily_json(spark: SparkSession, path: str) -> DataFrame:
    """Daily weather hand-over file; a missing, unreadable or empty one is an error."""
    records = spark.read.schema(schemas.WEATHER_DAILY_JSON).option("mode", "FAILFAST").json(path)
    if records.isEmpty():
        raise ValueError(f"no records found in {path}")
    return records
