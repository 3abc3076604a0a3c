from __future__ import annotations

import pytest

from hazardgrid.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "hazardgrid-tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(shared / "checkpoint"),
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column over literal rows: one(fn, type, values) -> list."""

    def run(expression, ddl, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {ddl}")
        rows = df.select("i", expression.alias("r")).orderBy("i").collect()
        return [r["r"] for r in rows]

    return run
