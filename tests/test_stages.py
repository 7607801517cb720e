"""Record functions as stages: settings, failing records, results that do not fit."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldpulse.operators.stages import Property, isolated, settings
from fieldpulse.plans.flow import stage

PROPERTIES = (
    Property("limit", float, required=True, low=0.0, high=1000.0),
    Property("unit", str, "bar", choices=("bar", "psi")),
    Property("strict", bool, False),
)


def test_settings():
    assert settings(PROPERTIES, {"limit": "5"}) == {"limit": 5.0, "unit": "bar", "strict": False}
    assert settings(PROPERTIES, {"limit": 5, "strict": " TRUE", "unit": "psi"})["strict"] is True
    with pytest.raises(ValueError) as e:
        settings(PROPERTIES, {"unit": "m", "strict": "maybe", "x": 1})
    for part in ("limit: required", "unit: 'm'", "strict: 'maybe'", "x: not a property"):
        assert part in str(e.value)
    for bad in ("-1", "1001", "nan", "much"):
        with pytest.raises(ValueError, match="limit"):
            settings(PROPERTIES, {"limit": bad})


def ratio_of():
    """A function of its own, so that workers need not import this module."""

    def ratio(pdf: pd.DataFrame, config) -> pd.DataFrame:
        if (pdf["n"] % 97 == 3).any():
            raise ArithmeticError("bad record")
        out = pdf["n"] / config["limit"]
        return pd.DataFrame({"ratio": out.astype(object).where(pdf["n"] % 50 != 7, "no number"), "unit": config["unit"]})

    return ratio


def test_failing_records_are_isolated(spark):
    df = spark.range(0, 1000, 1, 3).select(F.col("id").cast("int").alias("n"), F.array("id").alias("kept"))
    run = stage(isolated(ratio_of(), "ratio double, unit string", PROPERTIES, {"limit": 4}), name="ratio")
    passed, failed = run(df)
    bad = {n for n in range(1000) if n % 97 == 3 or n % 50 == 7}
    good = passed.collect()
    assert sorted(r.n for r in good) == [n for n in range(1000) if n not in bad]
    assert all(r.ratio == r.n / 4 and r.unit == "bar" and r.kept == [r.n] for r in good)
    rows = {r.n: r for r in failed.collect()}
    assert set(rows) == bad
    assert all(r.stage == "ratio" and r.error_reason == "stage_error" and r.ratio is None for r in rows.values())
    assert rows[100].error_text == "ArithmeticError: bad record"


def test_few_calls_for_few_bad_records(spark, tmp_path):
    place = str(tmp_path / "calls")

    def counted(pdf, config):
        with open(place, "a") as f:
            f.write("x")
        if (pdf["id"] == 700).any():
            raise ValueError
        return pd.DataFrame({"y": pdf["id"]})

    result = isolated(counted, "y bigint")(spark.range(0, 1024, 1, 1)).collect()
    assert [r.id for r in result if r.error_reason] == [700]
    assert [r.id for r in result] == list(range(1024))
    assert len(open(place).read()) == 2 * 10 + 1


def test_wrong_results_empty_frames_and_clashes(spark):
    short = isolated(lambda pdf, config: pd.DataFrame({"y": [1] * (len(pdf) - 1)}), "y int")
    assert {r.error_reason for r in short(spark.range(3)).collect()} == {"stage_error"}
    lacking = isolated(lambda pdf, config: pd.DataFrame({"z": pdf["id"]}), "y int")
    assert all("KeyError" in r.error_text for r in lacking(spark.range(3)).collect())
    assert short(spark.range(0)).collect() == []
    with pytest.raises(ValueError, match="there already"):
        isolated(ratio_of(), "id int")(spark.range(1))


def test_many_bad_records_cost_few_calls_and_rows_in_one_piece(spark, tmp_path):
    """Every 16th record fails: by plain halving 10 calls a bad record, and one output batch a part."""
    place = str(tmp_path / "calls")

    def counted(pdf, config):
        with open(place, "a") as f:
            f.write("x")
        pdf["id"] += 1  # a frame of its own: nobody else sees this
        if (pdf["id"] % 16 == 0).any() or list(pdf.index) != list(range(len(pdf))):
            raise ValueError(int(pdf["id"].iloc[0]))
        return pd.DataFrame({"y": pdf["id"]})

    result = isolated(counted, "y bigint")(spark.range(0, 1024, 1, 1))
    pieces = result.mapInArrow(lambda batches: batches, result.schema)
    rows = pieces.collect()
    bad = [n for n in range(1024) if n % 16 == 15]
    assert [r.id for r in rows] == list(range(1024))
    assert [r.id for r in rows if r.error_reason] == bad
    assert all(r.error_text == f"ValueError: {r.id + 1}" if r.id in bad else r.y == r.id + 1 for r in rows)
    assert len(open(place).read()) < 8 * len(bad)


def test_types_of_a_part_are_its_own(spark):
    """A null elsewhere in the batch neither makes a whole number a float nor loses its last digit."""
    big = 2**53 + 1

    def exact(pdf, config):
        if pdf["n"].isna().any():
            raise ValueError("null")
        return pd.DataFrame({"y": pdf["n"]})

    df = spark.createDataFrame([(big,), (None,), (big + 2,), (7,)], "n bigint").coalesce(1)
    rows = isolated(exact, "y bigint")(df).collect()
    assert [r.y for r in rows] == [big, None, big + 2, 7]


def test_a_stored_stage_runs_its_function_once_per_row(spark, tmp_path):
    place = str(tmp_path / "rows")

    def odd(pdf, config):
        with open(place, "a") as f:
            f.write("x" * len(pdf))
        return pd.DataFrame({"y": ["no number" if n % 2 and len(pdf) == 1 else 1 for n in pdf["id"]]})

    run = stage(isolated(odd, "y int"), name="odd", stored=True)
    passed, failed = run(spark.range(0, 4, 1, 4))
    assert passed.unionByName(failed, allowMissingColumns=True).count() == 4
    assert (passed.count(), failed.count()) == (2, 2)
    assert len(open(place).read()) == 4
