from __future__ import annotations

import math

import numpy as np
import pytest

from fieldpulse.llm.exact_topk import top_k, whole_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, id string, v string"


def brute(rows, k):
    fine = [
        (i, [math.floor(64 * e) for e in x])
        for i, x in rows
        if i is not None and x is not None and all(e is not None and math.isfinite(e) for e in x)
    ]
    out = []
    for q in sorted({i for i, _ in fine if i % 20 == 0}):
        asked = [x for i, x in fine if i == q]
        s = sorted((-sum(a * b for a, b in zip(x, c)), j) for x in asked for j, c in fine if j != q)[:k]
        out += [(q, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


def search(spark, rows, k=20, **options):
    df = spark.createDataFrame([(i, x, 0, "x", "y") for i, x in rows], SCHEMA)
    v = whole_vectors(df, "vec_id", "embedding").cache()
    return sorted(tuple(r) for r in top_k(v.where("id % 20 = 0"), v, k, **options).collect())


@pytest.mark.parametrize("kind", ["spread", "unit", "ties", "negative"])
def test_matches_brute_force(spark, kind):
    rng = np.random.default_rng(7)
    m = rng.normal(size=(400, 12)) * np.linspace(3, 0.05, 12)
    if kind == "spread":
        m *= rng.exponential(size=(400, 1)) ** 3
    elif kind == "unit":
        m /= np.linalg.norm(m, axis=1)[:, None]
    elif kind == "ties":
        m = rng.integers(-1, 2, (400, 3)).astype(float)
    else:
        m = -np.abs(m)
        m[::20] *= -1
    rows = [(i, x.tolist()) for i, x in enumerate(m)]
    assert search(spark, rows, 7, queries_per_block=8, vectors_per_block=64) == brute(rows, 7)


def test_bad_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]),
            (20, [0.0, 0.0]), (5, [3.0, 1.0]), (5, [3.0, 1.0]), (None, [9.0, 9.0]), (6, [1e7, -3.0])]
    assert search(spark, rows) == brute(rows, 20)
    assert search(spark, []) == []
    assert search(spark, [(1, [1.0, 2.0])]) == []
    assert search(spark, [(20, [1.0, 2.0])]) == []


def test_repeated_rows_count(spark):
    rng = np.random.default_rng(5)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(45, 4)))]
    rows += [rows[7]] * 2 + [rows[20]] * 3 + [(7, rows[9][1]), (40, rows[3][1]), (1000, rows[7][1])]
    rows += [(77, [9.0, 9.0, 9.0, 9.0])] * 60
    for k in (3, 20, 200):
        assert search(spark, rows, k, queries_per_block=4, vectors_per_block=16) == brute(rows, k)
