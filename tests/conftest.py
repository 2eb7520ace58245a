"""One Spark session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from slotcast.session import build_session

    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import compare

    return compare.connect(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


LABELLED = ("Index bigint, geohash string, day int, timestamp string, RoadType string, NumberofLanes int, "
            "LargeVehicles string, Landmarks string, Temperature double, Weather string, demand double")


@pytest.fixture(scope="session")
def observed(spark):
    """Builds labelled rows from (key, day, slot, value) and optional attribute values."""
    from slotcast.sources.tables import with_time

    def build(rows, value=True, temperature=None):
        data = [
            (i, k, day, f"{slot // 60}:{slot % 60}", "Street", 2, "Allowed", "No",
             None if temperature is None else temperature[i], "Sunny", None if v is None else float(v))
            for i, (k, day, slot, v) in enumerate(rows)
        ]
        df = with_time(spark.createDataFrame(data, LABELLED))
        return df if value else df.drop("demand")

    return build
