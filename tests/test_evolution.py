"""Reader and writer versions of a contract."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from fieldpulse.sources.contracts import CONTRACTS, Contract, ContractField
from fieldpulse.sources.evolution import backward_reasons, read_versions, resolve, transitive_reasons


def contract(*fields):
    return Contract("reading", "t", tuple(ContractField(n, t, **kw) for n, t, kw in fields))


S, I, L, D, TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()
V1 = contract(("id", S, {}), ("value", I, {}), ("flag", S, {"enum": ("GOOD", "BAD", "SUSPECT")}))
V2 = contract(("id", S, {}), ("value", L, {"nullable": True}), ("flag", S, {"enum": ("GOOD", "BAD")}), ("extra", S, {}))
V3 = contract(
    ("id", S, {}), ("value", D, {"nullable": True}), ("flag", S, {"enum": ("GOOD", "BAD", "UNKNOWN"), "default": "GOOD"}),
    ("unit", S, {"default": "bar"}), ("note", S, {"nullable": True}),
)
BROKEN = contract(("value", S, {}), ("flag", S, {}))
FALLBACK = {"flag": "UNKNOWN"}


def test_reasons():
    assert backward_reasons(V1, V3, FALLBACK) == backward_reasons(V2, V3) == []
    assert backward_reasons(V1, V3) == ["enum:flag:SUSPECT"]
    assert backward_reasons(BROKEN, V3) == ["missing:id", "type:value:string->double", "enum:flag:any text"]
    assert backward_reasons(V2, V1) == ["type:value:bigint->int", "nullable:value"]
    assert backward_reasons(V3, V2) == ["type:value:double->bigint", "enum:flag:UNKNOWN", "missing:extra"]
    assert backward_reasons(V3, V3, {"flag": "NONE"}) == ["fallback:flag:NONE"]
    assert transitive_reasons([V1, V2, V3]) == {
        (0, 1): ["enum:flag:SUSPECT", "missing:extra"], (0, 2): ["enum:flag:SUSPECT"]
    }
    assert all(backward_reasons(c, c) == [] for c in CONTRACTS.values())


def test_files_of_three_versions(spark, tmp_path):
    rows = {
        "v1": (V1, [("a", 1, "GOOD"), ("b", 2, "SUSPECT")]),
        "v2": (V2, [("c", 2**53, "BAD", "x"), ("d", None, None, None)]),
        "broken": (BROKEN, [("1", "GOOD")]),
    }
    files = {}
    for name, (writer, data) in rows.items():
        path = str(tmp_path / name)
        spark.createDataFrame(data, writer.schema).write.parquet(path)
        files[name] = (writer, [path])
    got, rejected = read_versions(spark, files, V3, FALLBACK)
    assert got.columns == [*V3.names, "version"]
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", 1.0, "GOOD", "bar", None, "v1"), ("b", 2.0, "UNKNOWN", "bar", None, "v1"),
        ("c", float(2**53), "BAD", "bar", None, "v2"), ("d", None, "GOOD", "bar", None, "v2"),
    ]
    assert list(rejected) == ["broken"] and rejected["broken"][0] == "missing:id"
    scan = got._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in scan
    empty, _ = read_versions(spark, {"broken": files["broken"]}, V3, FALLBACK)
    assert empty.columns == got.columns and empty.count() == 0
    with pytest.raises(ValueError, match="missing:id"):
        resolve(spark.createDataFrame([], BROKEN.schema), BROKEN, V3)
