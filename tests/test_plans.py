"""The physical plans: what is pruned, pushed down, shuffled and broadcast."""

import pytest
from pyspark.sql import functions as F

from hazardgrid.operators import airquality, arearisk, events, upsert
from hazardgrid.plans import bindings
from hazardgrid.plans.queries import QUERIES
from hazardgrid.sinks import jsonlines
from hazardgrid.sources import landed
from tests.test_events import message

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_inside_spark(spark, name):
    """No Python node, no cartesian or nested-loop join, in any query."""
    if name in ("stream_silver", "stream_window_counts_closed"):
        pytest.skip("reads back files the stream wrote")
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize(
    "name, parser",
    [
        ("audit_stream_union", "from_json(ArrayType("),
        ("air_quality_daily", "from_json(ArrayType("),
        ("weather_risk_daily", "from_xml("),
        ("risk_row_dead_letters", "from_json(ArrayType("),
    ],
)
def test_texts_are_parsed_once(spark, name, parser):
    assert plan_of(QUERIES[name](spark, SF_DIR), "simple").count(parser) == 1


def test_gold_reads_every_signal_once(spark):
    plan = plan_of(QUERIES["area_risk_daily"](spark, SF_DIR), "simple")
    assert plan.count("lineitem.parquet") == 1 and plan.count("from_xml(") == 1
    assert plan.count("from_json(ArrayType(") == 1


def test_joined_gold_reads_kept_signals(spark):
    """Spine and joins read the signals twice, so each is computed before them."""
    plan = plan_of(QUERIES["area_risk_daily_joined"](spark, SF_DIR), "simple")
    for source in ("lineitem.parquet", "events.parquet", "from_xml(", "from_json("):
        assert source not in plan


def test_latest_observation_is_ranked_before_the_shuffle_and_the_join(spark):
    plan = plan_of(QUERIES["air_quality_latest"](spark, SF_DIR), "simple")
    lines = plan.splitlines()
    at = lambda text: next(i for i, line in enumerate(lines) if text in line)
    # Plans are printed from the last step up to the scans.
    assert at("Join") < at(", Final") < at("Exchange hashpartitioning(event_date") < at(", Partial")


@pytest.fixture
def silver(spark, tmp_path):
    df = spark.createDataFrame([(message(location_id=i),) for i in range(4)], "value STRING")
    checked = events.validate_strict(events.parse_messages(df), F.lit("2024-01-10 12:30:00").cast("timestamp"))
    rows = jsonlines.silver_layout(events.silver_events(checked))
    rows.write.partitionBy("event_date").parquet(f"{tmp_path}/silver/batch_id=0")
    return f"{tmp_path}/silver"


def test_silver_scan_prunes_dates_columns_and_values(spark, silver):
    stored = landed.silver_events(spark, silver, dates=["2024-01-10"])
    stations = spark.createDataFrame([(1, "A")], "location_id BIGINT, city STRING")
    plan = plan_of(airquality.latest_per_station_day(stored, stations))
    scan = plan[plan.index("Scan parquet") :]
    assert "event_date" in scan.split("PartitionFilters: ")[1].split("]")[0]
    pushed = scan.split("PushedFilters: ")[1].split("\n")[0]
    for needed in ("validation_status", "freshness_status", "parameter", "parameter_id", "value"):
        assert needed in pushed
    read = scan.split("ReadSchema: ")[1].split("\n")[0]
    assert "latitude" not in read and "location_name" not in read and "local:" not in read
    assert airquality.latest_per_station_day(stored, stations).count() == 1
    assert landed.silver_events(spark, silver, dates=["2024-01-11"]).count() == 0


def test_date_filter_on_gold_reaches_all_scans(spark, tmp_path):
    day = spark.sql("SELECT DATE '2024-01-01' AS event_date, 'A' AS city")
    frames = []
    for name, columns in (
        ("delivery", arearisk.DELIVERY_COLS),
        ("environment", ["weather_risk", "active_weather_alerts"]),
        ("air", arearisk.AIR_COLS),
    ):
        values = day.select("*", *[F.lit(1).cast("double").alias(c) for c in columns])
        values.write.partitionBy("event_date").parquet(f"{tmp_path}/{name}")
        frames.append(spark.read.parquet(f"{tmp_path}/{name}"))
    gold = arearisk.area_risk_daily(*frames).filter("event_date = DATE '2024-01-01'")
    filters = [p.split("]")[0] for p in plan_of(gold).split("PartitionFilters: ")[1:]]
    assert len(filters) == 3 and all("event_date" in f for f in filters)
    assert gold.count() == 1


def test_upsert_shuffles_each_side_once(spark):
    """The uniqueness check and the merge join share the source's partitioning."""
    schema = "event_date DATE, city STRING, a BIGINT"
    target = bindings.earlier_daily(spark, SF_DIR).withColumnRenamed("n", "a")
    source = spark.createDataFrame([], schema)
    plan = plan_of(upsert.upsert(target, source, ["event_date", "city"], ["a"]), "simple")
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name, parser", [("event_validation_strict", "from_json("), ("cap_alerts_parsed", "from_xml(")])
def test_parsers_and_rules_stand_in_projections(spark, name, parser):
    """Inside a generator an expression is interpreted once its stage is too large to compile."""
    plan = plan_of(QUERIES[name](spark, SF_DIR), "simple")
    generators = [line for line in plan.splitlines() if "Generate explode(" in line]
    assert len(generators) == 2 and parser in plan
    assert all("Generate explode(array(_once" in line for line in generators)


def test_all_messages_are_read_under_the_same_names(spark):
    """A name per message would fill the reader's table of names."""
    plan = plan_of(QUERIES["event_validation_strict"](spark, SF_DIR), "simple")
    (read,) = [line for line in plan.splitlines() if "from_json(ArrayType(" in line]
    assert ',{"end":", md5(' in read
