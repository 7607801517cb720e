from __future__ import annotations

import datetime as dt

import math
import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import readings
from fieldpulse.config import PRESETS, DetectorConfig
from fieldpulse.operators.sequence import row_slices, with_preceding_rows_sized
from fieldpulse.operators.detect import (
    BY_ROWS,
    chain_to_alerts,
    detect_all,
    detector_chain,
    moving_average_detect,
    rate_of_change_detect,
    threshold_by_table,
    threshold_detect,
)
from fieldpulse.sources.reference import thresholds


@pytest.mark.parametrize(
    "value, severity, kind, limit",
    [
        (120.0, "CRITICAL", "threshold_exceeded", 120.0),
        (500.0, "CRITICAL", "threshold_exceeded", 120.0),
        (119.999, "WARNING", "threshold_warning", 100.0),
        (100.0, "WARNING", "threshold_warning", 100.0),
        (99.999, "NORMAL", "none", None),
        (10.001, "NORMAL", "none", None),
        (10.0, "WARNING", "threshold_warning", 10.0),
        (5.001, "WARNING", "threshold_warning", 10.0),
        (5.0, "CRITICAL", "threshold_exceeded", 5.0),
        (-3.0, "CRITICAL", "threshold_exceeded", 5.0),
        (float("nan"), "NORMAL", "none", None),
        (float("inf"), "CRITICAL", "threshold_exceeded", 120.0),
        (float("-inf"), "CRITICAL", "threshold_exceeded", 5.0),
        (None, "NORMAL", "none", None),
    ],
)
def test_threshold_branches(spark, value, severity, kind, limit):
    row = threshold_detect(readings(spark, [("S", 0, value)])).first().anomaly
    assert (row.severity, row.type, row.threshold_value) == (severity, kind, limit)
    assert row.detector == "ThresholdDetector"


def test_threshold_text(spark):
    rows = threshold_detect(readings(spark, [("S-1", 0, 130.5), ("S-1", 1, 50.0)])).collect()
    assert rows[0].anomaly.description == "S-1 read 130.5, at or above the critical maximum of 120.0"
    assert rows[1].anomaly.description == "S-1 read 50.0, inside all limits"


def test_overlapping_limits_take_critical_first(spark):
    config = DetectorConfig(critical_high=50, warning_high=10, critical_low=60, warning_low=70)
    row = threshold_detect(readings(spark, [("S", 0, 55.0)]), config).first().anomaly
    assert (row.severity, row.threshold_value) == ("CRITICAL", 50.0)


def test_threshold_without_sensor(spark):
    df = readings(spark, [(None, 0, 130.0)])
    assert threshold_detect(df).first().anomaly.description.startswith("unknown read ")


@pytest.mark.parametrize(
    "kind, subtype, value, severity, limit",
    [
        ("temperature", "bearing_temp", 119.0, "WARNING", 100.0),
        ("TEMPERATURE", "bearing_temp", 120.0, "CRITICAL", 120.0),
        ("temperature", None, 520.0, "WARNING", 500.0),
        ("temperature", "unheard_of", 600.0, "CRITICAL", 600.0),
        ("temperature", None, -20.0, "WARNING", -15.0),
        ("humidity", None, 9999.0, "NORMAL", None),
        ("vibration", "axial_vibration", 0.0, "CRITICAL", 0.0),
    ],
)
def test_threshold_table(spark, kind, subtype, value, severity, limit):
    df = readings(spark, [("S", 0, value)]).withColumns(
        {"sensor_type": F.lit(kind), "subtype": F.lit(subtype).cast("string")}
    )
    row = threshold_by_table(df, thresholds(spark)).first().anomaly
    assert (row.severity, row.threshold_value) == (severity, limit)


def series(seed: int, hot: int, others: int):
    """A sensor with many readings and several with few; steps, repeats and pauses included."""
    rng = random.Random(seed)
    rows = []
    for sensor, count in [("HOT", hot)] + [(f"S{i}", others) for i in range(5)]:
        t = rng.uniform(0, 50)
        for _ in range(count):
            t += rng.choice([0.5, 3, 7, 40, 400])
            value = 20.0 if rng.random() < 0.3 else round(rng.gauss(20, 4), 2)
            rows.append((sensor, round(t, 3), value * (8 if rng.random() < 0.02 else 1)))
    rng.shuffle(rows)
    return rows


def walk(rows, config: DetectorConfig):
    """The detectors as a plain loop over time-ordered readings."""
    windows = defaultdict(lambda: deque(maxlen=config.window_size))
    before, out = {}, {}
    ids = {i: f"r{i:06d}" for i in range(len(rows))}
    for i in sorted(ids, key=lambda i: (rows[i][1], ids[i])):
        sensor, t, value = rows[i]
        window = windows[sensor]
        window.append(value)
        n = len(window)
        mean = sum(window) / n
        std = math.sqrt(sum((x - mean) ** 2 for x in window) / n)
        deviation, ma = None, "NORMAL"
        if n >= max(5, config.window_size // 2):
            if std < 1e-10:
                deviation = 0.0
            else:
                deviation = abs(value - mean) / std
                if deviation > config.deviation_threshold * 1.5:
                    ma = "CRITICAL"
                elif deviation > config.deviation_threshold:
                    ma = "WARNING"
        rate, roc = None, "NORMAL"
        if sensor in before:
            dt = t - before[sensor][0]
            if 0 < dt <= config.rate_window_s:
                rate = abs(value - before[sensor][1]) / dt
                if rate > config.max_rate * 2:
                    roc = "CRITICAL"
                elif rate > config.max_rate:
                    roc = "WARNING"
        before[sensor] = (t, value)
        out[ids[i]] = (ma, deviation, mean, n, roc, rate)
    return out


@pytest.mark.parametrize("width", [None, "1 minute", "1 hour", BY_ROWS])
@pytest.mark.parametrize("size, k", [(1, 3.0), (7, 1.5), (20, 2.0), (60, 2.5)])
def test_chain_equals_walk(spark, width, size, k):
    rows = series(size, hot=600, others=40)
    config = DetectorConfig(window_size=size, deviation_threshold=k, max_rate=1.0, rate_window_s=60)
    expected = walk(rows, config)
    got = detector_chain(readings(spark, rows), config, slice_width=width).collect()
    assert len(got) == len(rows)
    seen = set()
    for r in got:
        ma, deviation, mean, n, roc, rate = expected[r.reading_id]
        m, c = r.moving_average, r.rate_of_change
        assert (m.severity, m.window_count, c.severity) == (ma, n, roc)
        assert m.mean == pytest.approx(mean, abs=1e-4)
        assert (m.deviation is None) == (deviation is None)
        if deviation is not None:
            assert m.deviation == pytest.approx(deviation, abs=1e-3)
        assert (c.rate is None) == (rate is None)
        if rate is not None:
            assert c.rate == pytest.approx(rate, abs=1e-5)
        seen.add((ma, roc))
    assert len(seen) > 2


def test_single_detectors_equal_chain(spark):
    df = readings(spark, series(3, 200, 30))
    config = DetectorConfig(window_size=10, deviation_threshold=2.0, max_rate=1.0)
    chain = {r.reading_id: r for r in detector_chain(df, config, slice_width="1 hour").collect()}
    for r in moving_average_detect(df, config, slice_width="10 minutes").collect():
        assert r.moving_average == chain[r.reading_id].moving_average
    for r in rate_of_change_detect(df, config, slice_width="10 minutes").collect():
        assert r.rate_of_change == chain[r.reading_id].rate_of_change


def test_constant_series_and_text(spark):
    rows = [("S", i, 0.1) for i in range(8)]
    got = moving_average_detect(readings(spark, rows), DetectorConfig(window_size=10)).orderBy("time")
    last = [r.moving_average for r in got.collect()]
    assert last[3].description == "S moving average: 4 of 10 readings so far, not judged yet"
    assert last[3].deviation is None
    assert last[7].deviation == 0.0
    assert last[7].description == "S moving average: all readings of the window are equal"


def test_excluding_current_reaches_flat_baseline(spark):
    rows = [("S", i, 10.0) for i in range(9)] + [("S", 9, 11.0)]
    config = DetectorConfig(window_size=8)
    last = (
        moving_average_detect(readings(spark, rows), config, exclude_current=True)
        .orderBy(F.desc("time"))
        .first()
        .moving_average
    )
    assert (last.severity, last.deviation) == ("CRITICAL", float("inf"))
    assert "after equal readings of 10.0" in last.description


def test_nan_in_baseline_is_normal(spark):
    rows = [("S", i, 10.0 + i) for i in range(9)] + [("S", 9, float("nan")), ("S", 10, 500.0)]
    config = DetectorConfig(window_size=8)
    got = moving_average_detect(readings(spark, rows), config).collect()
    assert {r.moving_average.severity for r in got} == {"NORMAL"}


def test_rate_window_edges(spark):
    rows = [("S", 0, 0.0), ("S", 60, 1200.0), ("S", 120.001, 0.0), ("S", 120.001, 5.0)]
    got = rate_of_change_detect(readings(spark, rows)).orderBy("reading_id").collect()
    found = [(r.rate_of_change.severity, r.rate_of_change.rate) for r in got]
    assert found == [("NORMAL", None), ("WARNING", 20.0), ("NORMAL", None), ("NORMAL", None)]
    texts = [r.rate_of_change.description for r in got]
    assert texts[0].endswith("no reading before this one")
    assert "60.0 s since the reading before, more than 60 s" in texts[2]
    assert "not later than the reading before (0.000 s)" in texts[3]


def test_arrival_order_shows_late_readings(spark):
    rows = [("S", 0, 0.0), ("S", 20, 10.0), ("S", 10, 500.0), ("S", 30, 500.0)]
    df = readings(spark, rows).withColumn("arrival", F.substring("reading_id", 2, 9).cast("int"))
    got = rate_of_change_detect(
        df, order=["arrival"], slice_by=F.floor(F.col("arrival") / 2)
    ).orderBy("arrival")
    result = [r.rate_of_change for r in got.collect()]
    assert [r.rate for r in result] == [None, 0.5, None, 0.0]
    assert "not later than the reading before (-10.000 s)" in result[2].description


def test_alert_rows(spark):
    rows = [("S", i, 50.0 + (i % 2)) for i in range(30)] + [("S", 30, 500.0)]
    config = DetectorConfig(window_size=20)
    alerts = detect_all(readings(spark, rows), config).collect()
    by_type = {a.anomaly_type: a for a in alerts}
    assert set(by_type) == {"threshold_exceeded", "moving_average_deviation", "rate_of_change_spike"}
    assert by_type["rate_of_change_spike"].threshold_value == 10.0
    ma = by_type["moving_average_deviation"]
    assert 50 < ma.threshold_value < 500 and ma.actual_value == 500.0
    assert len({a.alert_id for a in alerts}) == 3
    again = detect_all(readings(spark, rows), config).collect()
    assert {a.alert_id for a in again} == {a.alert_id for a in alerts}


def test_alerts_of_one_detector(spark):
    found = chain_to_alerts(threshold_detect(readings(spark, [("S", 0, 200.0), ("S", 1, 50.0)])))
    assert [a.reading_id for a in found.collect()] == ["r000000"]


def test_presets():
    assert PRESETS["dev"].window_size == 50 and PRESETS["staging"].window_size == 100
    assert (PRESETS["prod"].window_size, PRESETS["prod"].deviation_threshold) == (200, 3.5)
    with pytest.raises(ValueError):
        DetectorConfig(window_size=0)


def test_sensor_with_most_readings_is_sliced(spark):
    """No per-sensor window sees more than the borders of the slices."""
    df = readings(spark, [("HOT", i, float(i % 13)) for i in range(5000)])
    config = DetectorConfig(window_size=5)
    result = moving_average_detect(df, config, slice_width="1 hour")
    assert result.count() == 5000
    whole = moving_average_detect(df, config, slice_width=None)
    assert result.exceptAll(whole).count() == 0


@pytest.mark.parametrize("rows, merged", [(3, 2), (10, 2), (40, 3), (10_000, 64)])
@pytest.mark.parametrize("depth", [1, 4, 9])
def test_slices_by_rows_equal_one_window(spark, rows, merged, depth):
    """Also where a slice holds fewer rows than the look-back, and over all passes."""
    rng = random.Random(rows + depth)
    data = [("HOT", 10 * rng.random() ** 3 * i, float(i)) for i in range(400)]
    data += [(f"S{i % 7}", float(i % 5), float(i)) for i in range(60)] + [("ONE", 1.0, 1.0)]
    df = readings(spark, data)

    def add(frame, window):
        return frame.withColumn("seen", F.collect_list("reading_id").over(window.rowsBetween(-depth, 0)))

    whole = add(df, Window.partitionBy("sensor_id").orderBy("time", "reading_id"))
    got = with_preceding_rows_sized(df, ["sensor_id"], ["time", "reading_id"], depth, add, rows, merged)
    assert got.columns == whole.columns and got.count() == len(data)
    assert got.exceptAll(whole).count() == 0


def test_few_rows_are_repaired_with_long_windows(spark):
    """N = 200 at a steady cadence: a tenth of the rows lie at borders, none without need."""
    df = readings(spark, [("HOT", 10.0 * i, float(i % 13)) for i in range(40_000)] + [("S", 5000.0 * i, 1.0) for i in range(50)])
    again = []

    def add(frame, window):
        again.append(frame)
        return frame.withColumn("n", F.count("value").over(window.rowsBetween(-199, 0)))

    out = with_preceding_rows_sized(df, ["sensor_id"], ["time", "reading_id"], 199, add)
    assert out.count() == 40_050 and out.filter("n < 200").count() == 199 + 50
    second = again[1]
    assert second.count() < 0.2 * 40_050 and second.filter("sensor_id = 'S'").count() == 0


def _uneven(spark, start, per_key):
    """A burst inside one second, a reading every hour, one far off in time, null keys and times."""
    first = dt.datetime(2024, 1, 1)
    rows = []
    for key in ("A", "B", None)[:per_key]:
        times = [first + dt.timedelta(milliseconds=i % 997) for i in range(600)]
        times += [first + dt.timedelta(hours=i) for i in range(1, 80)]
        times += [dt.datetime(9000, 1, 1), dt.datetime(1971, 2, 3), None, None]
        rows += [(f"r{start + i:05d}", key, t, float(i % 13)) for i, t in enumerate(times)]
    rows.append(("s", "sparse", first, 1.0))
    return spark.createDataFrame(rows, "reading_id string, sensor_id string, time timestamp, value double")


def test_slices_follow_the_rows(spark):
    df = _uneven(spark, 0, 3)
    found = row_slices(df, ["sensor_id"], "time", 40)
    assert found.drop("_slice", "_last").columns == df.columns and found.count() == df.count()
    sizes = found.groupBy("sensor_id", "_slice").count().collect()
    assert max(r["count"] for r in sizes) <= 2 * 40
    by_key = {}
    for r in sizes:
        by_key.setdefault(r.sensor_id, []).append(r._slice)
    assert len(by_key["A"]) >= 683 // 80 and by_key["sparse"] == [0]
    rows = sorted((tuple(r[c] for c in ("sensor_id", "time", "_slice", "_last")) for r in found.collect() if r.sensor_id == "A" and r.time), key=lambda r: r[1])
    assert [r[2] for r in rows] == sorted(r[2] for r in rows) and all(r[2] <= r[3] for r in rows)


def test_uneven_series_match_a_plain_loop(spark):
    df = _uneven(spark, 0, 3)

    def add(frame, window):
        return frame.withColumn("sum3", F.sum("value").over(window.rowsBetween(-3, 0)))

    got = with_preceding_rows_sized(df, ["sensor_id"], ["time", "reading_id"], 3, add, 20, 4)
    want = add(df, Window.partitionBy("sensor_id").orderBy("time", "reading_id"))
    rows = lambda f: sorted(map(tuple, f.collect()), key=repr)
    assert rows(got.select(*want.columns)) == rows(want)
