"""The JVM interprets generated methods above 8,000 bytes, row by row, and never compiles them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fieldpulse.operators.detect import alerts_of_history
from fieldpulse.operators.parse import with_parsed
from fieldpulse.plans.views import FIXTURE


def longest_method(df) -> int:
    """Bytes of the longest method that Spark generates for a plan without a shuffle."""
    compiler = df.sparkSession._jvm.org.apache.spark.sql.catalyst.expressions.codegen.CodeGenerator
    nodes, found = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() == "WholeStageCodegenExec":
            found.append(compiler.compile(node.doCodeGen()._2())._2().maxMethodCodeSize())
        nodes += [node.children().apply(i) for i in range(node.children().length())]
    return max(found)


def test_parsing(spark, tmp_path):
    body = F.concat(F.lit('{"sensor_id":"s","value":'), F.col("id").cast("string"), F.lit("}"))
    path = str(tmp_path / "raw")
    spark.range(10).select(body.alias("body"), F.timestamp_seconds("id").alias("received_at")).write.parquet(path)
    assert 0 < longest_method(with_parsed(spark.read.parquet(path))) <= 8000


def test_alerts(spark, tmp_path):
    numbers, texts = ("value", "_mean", "_std", "_prev_value"), ("sensor_id", "platform_id", "sensor_type", "unit", "reading_id")
    columns = {n: F.col("id").cast("double") for n in numbers} | {n: F.col("id").cast("string") for n in texts}
    columns |= {"_n": F.col("id"), "_seen": F.lit(1)} | {n: F.timestamp_seconds("id") for n in ("time", "_prev_time")}
    path = str(tmp_path / "history")
    spark.range(10).select(*[c.alias(n) for n, c in columns.items()]).write.parquet(path)
    assert 0 < longest_method(alerts_of_history(spark.read.parquet(path), FIXTURE)) <= 8000


@pytest.mark.parametrize(
    "time, millis",
    [
        ("253402300799", 253402300799000),
        ("253402300800", None),
        ("253402300799999", 253402300799999),
        ("253402300800000", None),
        ('"0001-01-01T00:00:00Z"', -62135596800000),
        ('"+10000-01-01T00:00:00Z"', None),
        ('"NaN"', None),
        ('"Infinity"', None),
        ("1700000000.9", 1700000000000),
    ],
)
def test_times_at_the_bounds(spark, time, millis):
    row = spark.createDataFrame([('{"sensor_id":"s","value":1,"timestamp":%s}' % time,)], "body string")
    found = with_parsed(row).select(F.unix_millis("time"), "error_reason").first()
    assert tuple(found) == (millis, None if millis is not None else "bad_timestamp")
