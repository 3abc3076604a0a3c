from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardgrid.plans.queries import QUERIES
from hazardgrid.session import create_text, list_dir
from hazardgrid.sinks.eventstore import EventStore, committed_batch
from hazardgrid.sources import landed
from hazardgrid.streaming import pipelines
from tests.test_events import message

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("id", T.LongType())])


@pytest.fixture
def store(spark, tmp_path):
    return EventStore(spark, f"{tmp_path}/store")


def put(store, batch_id, *rows):
    schema = "id BIGINT, output STRING, event_date DATE"
    store.write(store.spark.createDataFrame(rows, schema), batch_id)


def ids(store, **more):
    return sorted(r.id for r in store.read(SCHEMA, **more).collect())


D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def test_rows_are_seen_once_before_and_after_compaction(store):
    assert ids(store) == [] and not store.compact(5, SCHEMA)
    put(store, 0, (1, "silver", D1), (2, "audit", D1))
    put(store, 1, (3, "silver", D2))
    put(store, 2, (4, "silver", None))
    put(store, 3)
    put(store, 1, (3, "silver", D2), (5, "audit", None))  # the batch is replayed
    assert ids(store) == [1, 2, 3, 4, 5] and ids(store, output="silver", dates=["2024-01-02"]) == [3]
    before = store.parts()
    assert store.compact(1, SCHEMA) and store.manifest()["upto"] == 1
    assert ids(store) == [1, 2, 3, 4, 5] and ids(store, output="audit") == [2, 5]
    # A reader that listed the store before still has all its folders.
    assert sorted(r.id for r in store._load(before, SCHEMA).collect()) == [1, 2, 3, 4, 5]
    store.vacuum()
    assert store.batches() == [2, 3] and ids(store) == [1, 2, 3, 4, 5]
    put(store, 4, (6, "silver", D1))
    assert store.compact(4, SCHEMA) and not store.compact(4, SCHEMA)
    assert store.manifest()["parts"] == ["compacted-0-1", "compacted-2-4"]
    put(store, 5, (7, "silver", D1))
    assert store.compact(9, SCHEMA, most=2)
    store.vacuum()
    assert store.manifest()["parts"] == ["compacted-0-5"] and list_dir(store.spark, f"{store.root}/data") == ["part=compacted-0-5"]
    assert ids(store) == [1, 2, 3, 4, 5, 6, 7] and ids(store, output="silver", dates=["2024-01-01"]) == [1, 6, 7]


def test_compaction_that_failed_is_repeated(store):
    put(store, 0, (1, "silver", D1))
    store._save(store._load(["batch-0"], SCHEMA), "compacted-0-0")  # no manifest
    assert ids(store) == [1]
    assert store.compact(0, SCHEMA) and ids(store) == [1]


def test_a_manifest_is_not_overwritten(spark, tmp_path):
    create_text(spark, f"{tmp_path}/m/1.json", "{}")
    with pytest.raises(FileExistsError):
        create_text(spark, f"{tmp_path}/m/1.json", "{}")
    assert list_dir(spark, f"{tmp_path}/m") == ["1.json"]


def test_compacted_scan_prunes_dates_and_outputs(store):
    put(store, 0, (1, "silver", D1), (2, "silver", D2), (3, "audit", D1))
    store.compact(0, SCHEMA)
    plan = store.read(SCHEMA, "silver", ["2024-01-01"])._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "output" in pruned and "event_date" in pruned and "Filter (" not in plan


def run(spark, folder, lines, late="0 seconds", once=True):
    rows = spark.createDataFrame(lines, "value STRING, t STRING").select("value", F.col("t").cast("timestamp").alias("published_at"))
    rows.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema("value STRING, published_at TIMESTAMP").parquet(f"{folder}/in")
    pipelines.event_pipeline(
        stream, f"{folder}/store", f"{folder}/cp", as_of=F.lit("2024-01-10 12:30:00").cast("timestamp"), once=once,
        panes=f"{folder}/windows", late=late,
    ).awaitTermination()


def panes(df):
    return sorted((str(r.window_start)[11:], r.validation_status, r.pane, r.records) for r in df.collect())


def test_panes_and_late_records(spark, tmp_path):
    good, bad = message(), "broken"
    day = "2024-01-01 00:"
    run(spark, tmp_path, [(good, f"{day}00:10"), (good, f"{day}00:59.999999"), (bad, f"{day}00:20"), (good, f"{day}03:00")])
    run(spark, tmp_path, [(good, f"{day}00:30"), (good, f"{day}02:59.999999"), (good, f"{day}03:10"), (bad, f"{day}01:00"), (bad, None)])
    run(spark, tmp_path, [(good, f"{day}03:59"), (bad, f"{day}02:30"), (good, f"{day}05:00")])
    found = pipelines.read_panes(spark, f"{tmp_path}/windows")
    # Three minutes had been reached when the second batch came: windows that had ended by then are closed.
    assert panes(found) == [
        ("00:00:00", "INVALID", 0, 1), ("00:00:00", "VALID", 0, 2), ("00:03:00", "VALID", 0, 1),
        ("00:03:00", "VALID", 1, 1), ("00:03:00", "VALID", 2, 1), ("00:05:00", "VALID", 0, 1),
    ]
    schema = landed.silver_events(spark, f"{tmp_path}/store").schema
    extra = T.StructType.fromDDL("published_at TIMESTAMP, raw_message STRING")
    late = pipelines.read_late(spark, f"{tmp_path}/windows", T.StructType([*schema.fields, *extra.fields])).collect()
    assert sorted((str(r.published_at)[14:19], r.late_reason, str(r.watermark)[14:]) for r in late) == [
        ("", "NO_PUBLISH_TIME", "03:00"), ("00:30", "LATE_RECORD", "03:00"), ("01:00", "LATE_RECORD", "03:00"),
        ("02:30", "LATE_RECORD", "03:10"), ("02:59", "LATE_RECORD", "03:00"),
    ]
    assert {r.raw_message for r in late if r.validation_status == "INVALID"} == {"broken"}
    counted = found.agg(F.sum("records")).first()[0]
    store = EventStore(spark, f"{tmp_path}/store")
    assert counted + len(late) == store.read(schema).count() == 12
    closed = pipelines.closed_windows(spark, f"{tmp_path}/windows").collect()
    assert sorted((str(r.window_start)[14:], r.validation_status, r.records) for r in closed) == [
        ("00:00", "INVALID", 1), ("00:00", "VALID", 2), ("03:00", "VALID", 3),
    ]
    assert committed_batch(spark, f"{tmp_path}/cp") == 2


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    rows = [(message(), "2024-01-01 00:00:10"), (message(), "2024-01-01 00:02:10")]
    run(spark, tmp_path, rows)
    run(spark, tmp_path, [(message(), "2024-01-01 00:00:20"), (message(), "2024-01-01 00:02:20")])
    before = panes(pipelines.read_panes(spark, f"{tmp_path}/windows"))
    (tmp_path / "cp" / "commits" / "1").unlink()
    (tmp_path / "cp" / "commits" / ".1.crc").unlink(missing_ok=True)
    stream = spark.readStream.schema("value STRING, published_at TIMESTAMP").parquet(f"{tmp_path}/in")
    pipelines.event_pipeline(
        stream, f"{tmp_path}/store", f"{tmp_path}/cp", as_of=F.lit("2024-01-10 12:30:00").cast("timestamp"), once=True,
        panes=f"{tmp_path}/windows",
    ).awaitTermination()
    assert panes(pipelines.read_panes(spark, f"{tmp_path}/windows")) == before == [
        ("00:00:00", "VALID", 0, 1), ("00:02:00", "VALID", 0, 1), ("00:02:00", "VALID", 1, 1),
    ]
    assert landed.silver_events(spark, f"{tmp_path}/store").count() == 4


def test_panes_and_late_records_make_up_the_table(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").count()
    counted = QUERIES["stream_window_panes"](spark, SF).agg(F.sum("records")).first()[0]
    late = QUERIES["stream_late_records"](spark, SF).count()
    assert counted + late == events and late > 0
