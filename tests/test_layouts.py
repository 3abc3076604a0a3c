"""Tables stored as folders of parts, late stream records, and the optional part left out."""

import importlib
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hazardgrid.plans.queries import QUERIES
from hazardgrid.sources import landed
from hazardgrid.streaming import pipelines

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("nation", "customer", "orders", "lineitem", "events")
NAMES = [
    "area_risk_daily",
    "cap_alerts_parsed",
    "delivery_performance",
    "discovery_summary",
    "stream_scores",
    "stream_silver",
    "stream_window_counts_closed",
    "weather_upsert",
]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    for name in TABLES:
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(4).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_folder_of_parts_gives_the_same(spark, parts, name):
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    want = rows(QUERIES[name](spark, SF_DIR))
    assert want and rows(QUERIES[name](spark, parts)) == want


def test_late_records_are_counted(spark, tmp_path):
    schema = "published_at TIMESTAMP, validation_status STRING"
    for k, minutes in enumerate(([0, 10], [11], [1, 12], [20])):
        stamps = [(f"2024-01-01 00:{m:02d}:00", "VALID") for m in minutes]
        df = spark.createDataFrame(stamps, "t STRING, validation_status STRING")
        df = df.select(F.col("t").cast("timestamp").alias("published_at"), "validation_status")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"{k}"))
    # A batch is held against the watermark that the batch before the last one left.
    dropped = {}
    for late in ("0 seconds", "1 hour"):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        out = f"{tmp_path}/out-{late[0]}"
        query = pipelines.window_count_pipeline(stream, f"{out}/data", f"{out}/checkpoint", late=late, once=True)
        query.awaitTermination()
        dropped[late] = pipelines.late_records(query)
    assert dropped["1 hour"] == 0 and dropped["0 seconds"] >= 1


def test_a_date_without_objects_is_no_failure(spark, tmp_path):
    folder = tmp_path / "ingestion_date=2024-01-01"
    folder.mkdir()
    (folder / "a_alert.xml").write_text("<alert/>")
    found = landed.alert_objects(spark, str(tmp_path), ["2024-01-01", "2024-01-02"])
    assert found.count() == 1
    assert landed.alert_objects(spark, str(tmp_path), ["2024-01-02"]).count() == 0


def test_message_lines(spark, tmp_path):
    Path(tmp_path / "m.jsonl").write_text('{"a":1}\nbad\n')
    assert [r.value for r in landed.message_lines(spark, str(tmp_path / "m.jsonl")).collect()] == ['{"a":1}', "bad"]


def test_entry_points_without_the_optional_part(monkeypatch):
    import __spark_entry__

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        entry = importlib.reload(__spark_entry__)
        assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
