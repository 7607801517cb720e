"""Runs that publish several outputs at once: broken, repeated and replaced ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fieldpulse.plans import flow
from fieldpulse.sources import publish, readers
from tests.conftest import at
from tests.test_sinks_streams import DOCUMENTS, dims, raw_file  # noqa: F401

ROWS = "n int, text string"
FOLDERS = "stage string, date date"


def write(spark, path, rows):
    df = spark.createDataFrame(rows, "n int, text string, stage string, date string")
    df.write.partitionBy("stage", "date").json(f"{path}/below")


def read(spark, base):
    rows = publish.read_published(spark, base, "dlq", ROWS, FOLDERS, "json").collect()
    return sorted((r.run, r.n, r.stage, str(r.date)) for r in rows)


def test_only_committed_attempts_are_read(spark, tmp_path):
    base = str(tmp_path)
    assert read(spark, base) == []
    first = publish.begin(spark, base, "r1")
    write(spark, first.path("dlq"), [(1, "x", "a+b: 5%", "2024-01-01"), (2, "y", None, "2024-01-02")])
    assert read(spark, base) == []
    publish.commit(spark, first)
    want = [("r1", 1, "a+b: 5%", "2024-01-01"), ("r1", 2, None, "2024-01-02")]
    assert read(spark, base) == want
    again = publish.begin(spark, base, "r1")
    write(spark, again.path("dlq"), [(3, "z", "p", "2024-01-03")])
    other = publish.begin(spark, base, "r2")
    publish.commit(spark, other)  # a run without rows in this output
    assert read(spark, base) == want
    publish.commit(spark, again)
    assert read(spark, base) == [("r1", 3, "p", "2024-01-03")]
    with pytest.raises(Exception, match="exist"):
        publish.commit(spark, again)
    assert publish.drop_superseded(spark, base, ["dlq", "none"]) == 1
    assert read(spark, base) == [("r1", 3, "p", "2024-01-03")]
    with pytest.raises(ValueError):
        publish.begin(spark, base, "a/b")


def outputs(spark, base):
    """All outputs over all runs, as sorted rows."""
    one = "reading_id string"
    found = {
        "readings": publish.read_published(spark, base, "readings", one, "date date"),
        "alerts": publish.read_published(spark, base, "alerts", one + ", anomaly_type string", "date date"),
        "compliance": publish.read_published(spark, base, "compliance", "report_type string", "date date"),
        "archive": publish.read_published(spark, base, "archive", one, "platform string, type string, hour string", "json"),
        "dlq": publish.read_published(spark, base, "dlq", "error_reason string, body string", "stage string", "json"),
        "topics": publish.read_published(spark, base, "topics", "key string, value string", "topic string"),
    }
    assert set(found) == set(flow.OUTPUTS)
    return {n: sorted(map(str, df.drop("run").collect())) for n, df in found.items()}


def test_a_run_that_breaks_off_is_invisible_and_repeatable(spark, tmp_path, dims, monkeypatch):  # noqa: F811
    source = str(tmp_path / "in")
    for i, documents in enumerate(DOCUMENTS):
        raw_file(source, i, documents)
    raw = readers.explode_batch(readers.read_readings(spark, source))
    config = flow.FlowConfig(failed_at=at(0).isoformat(" "))
    clean, base = str(tmp_path / "clean"), str(tmp_path / "out")
    flow.run_batch(raw, dims, clean, config, "r1")
    want = outputs(spark, clean)
    assert len(want["readings"]) == 5 and len(want["archive"]) == 5 and len(want["dlq"]) == 6
    assert all(want.values())

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(flow, "write_dlq", stop)
        with pytest.raises(RuntimeError):
            flow.run_batch(raw, dims, base, config, "r1")
    assert not any(outputs(spark, base).values())
    for _ in range(2):
        flow.run_batch(raw, dims, base, config, "r1")
        assert outputs(spark, base) == want
    flow.run_batch(raw.filter(F.lit(False)), dims, base, config, "r2")
    assert outputs(spark, base) == want
