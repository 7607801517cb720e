from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldpulse.session import build_session, drop_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="fieldpulse-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


EPOCH = dt.datetime(2024, 1, 1)


def at(seconds: float) -> dt.datetime:
    """A time some seconds into the test day."""
    return EPOCH + dt.timedelta(seconds=seconds)


READING_SCHEMA = (
    "reading_id string, platform_id string, sensor_id string, sensor_type string, value double, "
    "unit string, time timestamp, quality_flag string"
)


def readings(spark, rows):
    """Readings from (sensor, seconds, value) triples; ids follow the list order."""
    full = [
        (f"r{i:06d}", "P1", sensor, "temperature", value, "celsius", at(s), "GOOD")
        for i, (sensor, s, value) in enumerate(rows)
    ]
    return spark.createDataFrame(full, READING_SCHEMA)
