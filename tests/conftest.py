from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def column(spark):
    """Evaluate a column expression over a list of values."""
    from pyspark.sql import functions as F

    def evaluate(values, expression, kind="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i long, v {kind}")
        picked = rows.select("i", expression(F.col("v")).alias("r")).collect()
        return [row.r for row in sorted(picked, key=lambda row: row.i)]

    return evaluate
