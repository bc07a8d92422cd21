from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from kerbside.schemas import BRONZE_TRIPS, SILVER_TRIPS  # noqa: E402
from kerbside.session import BASE_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[8]").appName("tests")
    local = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
    }
    for key, value in {**BASE_CONF, **local}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


@pytest.fixture
def bronze(spark):
    """Bronze trips from tuples; what a test leaves out is an ordinary trip."""

    def make(*rows: dict):
        usual = {
            "pickup": "2025-03-01 10:00:00",
            "dropoff": "2025-03-01 10:10:00",
            "passengers": 1,
            "miles": 2.5,
            "pu": 1,
            "do": 2,
        }
        full = [{**usual, **row} for row in rows]
        data = [(at(r["pickup"]), at(r["dropoff"]), r["passengers"], r["miles"], r["pu"], r["do"]) for r in full]
        return spark.createDataFrame(data, BRONZE_TRIPS)

    return make


@pytest.fixture
def silver(spark):
    def make(*rows: dict):
        usual = {
            "pickup": "2025-03-01 10:00:00",
            "dropoff": "2025-03-01 10:10:00",
            "passengers": 1,
            "miles": 2.5,
            "pu": 1,
            "do": 2,
            "seconds": 600,
        }
        full = [{**usual, **row} for row in rows]
        data = [
            (at(r["pickup"]), at(r["dropoff"]), r["passengers"], r["miles"], r["pu"], r["do"], r["seconds"])
            for r in full
        ]
        return spark.createDataFrame(data, SILVER_TRIPS)

    return make


@pytest.fixture
def lookup(spark):
    def make(*pairs: tuple):
        return spark.createDataFrame(list(pairs), "zone_LocationID INT, Borough STRING")

    return make


def rows(frame) -> list[tuple]:
    return [tuple(r) for r in frame.collect()]


def plan(frame) -> str:
    """Physical plan text as planned, before adaptive execution."""
    return frame._jdf.queryExecution().executedPlan().toString()
