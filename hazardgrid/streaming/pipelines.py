"""Streaming jobs built from the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hazardgrid import constants as C
from hazardgrid.operators import events, rowscore
from hazardgrid.session import path_exists
from hazardgrid.sinks.eventstore import EventStore
from hazardgrid.sinks.jsonlines import silver_layout

SILVER, AUDIT = "silver", "audit"
LATE, UNDATED = "LATE_RECORD", "NO_PUBLISH_TIME"
_PANE = "window_start TIMESTAMP, window_end TIMESTAMP, validation_status STRING, records BIGINT, batch_id BIGINT"
_PROGRESS = "latest TIMESTAMP"


def _start(writer, once: bool, every: str) -> StreamingQuery:
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()


def event_pipeline(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    as_of: Column | None = None,
    rules: Callable[..., DataFrame] = events.validate_strict,
    once: bool = False,
    every: str = C.STREAM_EARLY_TRIGGER,
    fmt: str = "parquet",
    panes: str | None = None,
    late: str = "0 seconds",
) -> StreamingQuery:
    """Validate a message stream into an event store with outputs ``silver`` and ``audit``.

    Each record is written once, by the micro-batch that read it, in one partitioned
    write; none waits for a watermark and none is dropped as late. A batch goes to a
    folder of its own that a replay of the same batch overwrites.

    With a folder for ``panes``, the windows of publish time are counted as well, from
    the stored batch: see ``write_panes``.
    """
    store = EventStore(messages.sparkSession, path, fmt)

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = events.parse_messages(batch)
        checked = rules(parsed, as_of) if rules is events.validate_strict else rules(parsed)
        output = F.when(F.col("validation_status") == events.VALID, SILVER).otherwise(AUDIT)
        store.write(silver_layout(checked).withColumn("output", output), batch_id)
        if panes:
            write_panes(store.read_batch(batch_id, checked.schema), panes, batch_id, late)

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer, once, every)


def scoring_pipeline(
    messages: DataFrame,
    output: str,
    checkpoint: str,
    processed_at: Column | None = None,
    once: bool = False,
    every: str = C.STREAM_WINDOW,
) -> StreamingQuery:
    """Score a stream of combined records; the batch job uses the same operator."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = rowscore.score_rows(batch, processed_at=processed_at).persist()
        try:
            for part, path in ((rowscore.scored(rows), output), (rowscore.dead_letters(rows), f"{output}_dead_letter")):
                (
                    part.write.mode("overwrite")
                    .option("ignoreNullFields", "false")
                    .json(f"{path}/batch_id={batch_id}")
                )
        finally:
            rows.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer, once, every)


def window_counts(validated: DataFrame, published_at: str = "published_at", late: str = "0 seconds") -> DataFrame:
    """Records per 60-second window of publish time and validation status.

    On a stream, records behind the watermark are left out, as there is no
    allowed lateness; on a batch frame the watermark has no effect.
    """
    if validated.isStreaming:
        validated = validated.withWatermark(published_at, late)
    return (
        validated.groupBy(F.window(published_at, C.STREAM_WINDOW).alias("_w"), "validation_status")
        .agg(F.count(F.lit(1)).alias("records"))
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "validation_status",
            "records",
        )
    )


def window_count_pipeline(
    validated: DataFrame,
    output: str,
    checkpoint: str,
    published_at: str = "published_at",
    late: str = "0 seconds",
    once: bool = False,
    every: str = C.STREAM_WINDOW,
) -> StreamingQuery:
    """Append closed windows to a Parquet folder.

    Records may arrive ``late`` by so much; ``late_records`` counts the ones
    that came later still and are in no window.
    """
    writer = (
        window_counts(validated, published_at, late)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, once, every)


def late_records(query: StreamingQuery) -> int:
    """Records that a window-count stream left out in the progress Spark still has of it.

    Spark keeps the last batches only and drops the records themselves; ``write_panes``
    keeps both.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def write_panes(rows: DataFrame, path: str, batch_id: int, late: str = "0 seconds", published_at: str = "published_at") -> None:
    """Count a micro-batch's records per window, apart from those that come late.

    The watermark is the latest publish time of all earlier batches less ``late``. A
    record is late if its window has ended by then; it goes to the late output with
    the reason, and so does one without a publish time. All others are counted in the
    window's pane of this batch: panes are discarding, each holds its own batch's
    records only, and their sum is the window. Every output has a folder per batch,
    so a replay overwrites what it wrote before.
    """
    spark = rows.sparkSession
    before = f"{path}/progress/batch_id={batch_id - 1}"
    latest = spark.read.schema(_PROGRESS).parquet(before) if path_exists(spark, before) else spark.createDataFrame([], _PROGRESS)
    latest = latest.first()  # one row
    size = int(C.STREAM_WINDOW.split()[0])
    time = F.col(published_at)
    start = F.timestamp_seconds(F.floor(F.unix_micros(time) / (size * 1_000_000)) * size)
    end = F.col("window_start") + F.expr(f"INTERVAL {size} SECONDS")
    past = F.lit(latest["latest"] if latest else None).cast("timestamp")
    watermark = past - F.expr(f"INTERVAL {late}")
    reason = F.when(time.isNull(), UNDATED).when(F.col("window_end") <= F.col("watermark"), LATE)
    marked = (
        rows.withColumn("window_start", start)
        .withColumn("window_end", end)
        .withColumn("watermark", watermark)
        .withColumn("late_reason", reason)
    )
    counts = (
        marked.where("late_reason IS NULL")
        .groupBy("window_start", "window_end", "validation_status")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    progress = rows.agg(F.greatest(F.max(time), past).alias("latest"))
    parts = {"panes": counts, "late": marked.where("late_reason IS NOT NULL"), "progress": progress}
    for name, part in parts.items():  # progress last: the next batch reads it
        part.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")


def read_panes(spark: SparkSession, path: str) -> DataFrame:
    """All panes, numbered within their window in the order they were emitted."""
    if not path_exists(spark, f"{path}/panes"):
        stored = spark.createDataFrame([], _PANE)
    else:
        stored = spark.read.schema(_PANE).parquet(f"{path}/panes")
    order = Window.partitionBy("window_start").orderBy("batch_id")
    return stored.select(
        "window_start", "window_end", "validation_status", (F.dense_rank().over(order) - 1).alias("pane"), "records"
    )


def closed_windows(spark: SparkSession, path: str, late: str = "0 seconds") -> DataFrame:
    """Windows that no record can enter any more, each the sum of its panes."""
    latest = F.lit(None).cast("timestamp")
    if path_exists(spark, f"{path}/progress"):
        # Progress never goes back, and a batch has one row of it.
        latest = F.lit(spark.read.schema(_PROGRESS).parquet(f"{path}/progress").agg(F.max("latest")).first()[0]).cast("timestamp")
    return (
        read_panes(spark, path)
        .where(F.col("window_end") <= latest - F.expr(f"INTERVAL {late}"))
        .groupBy("window_start", "window_end", "validation_status")
        .agg(F.sum("records").alias("records"))
    )


def read_late(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records that came late, with their window, the watermark they met and the reason."""
    extra = "window_start TIMESTAMP, window_end TIMESTAMP, watermark TIMESTAMP, late_reason STRING"
    whole = T.StructType([*schema.fields, *T.StructType.fromDDL(extra).fields])
    if not path_exists(spark, f"{path}/late"):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(f"{path}/late")
