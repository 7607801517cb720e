from __future__ import annotations

import math

import numpy as np
import pytest

from fieldpulse.llm import grid_join
from fieldpulse.llm.grid_join import block_pairs, near_vectors

SCHEMA = "vec_id long, embedding array<{}>, label int, c long, key string"


def brute(rows, cosine=0.95):
    def fine(x):
        return x is not None and all(e is not None and math.isfinite(e) for e in x) and any(x)

    n = len(rows)
    width = max((len(x) for _, x in rows if x is not None), default=0)
    unit = []
    for _, x in rows:
        if fine(x):
            x = np.array([*x, *[0.0] * (width - len(x))])
            x = x / np.abs(x).max()
            unit.append(x / np.sqrt((x**2).sum()))
        else:
            unit.append(None)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and unit[i] @ unit[j] >= cosine] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), low, low is not None and rows[i][0] == low))
    return sorted(out, key=repr)


def run(spark, rows, kind="double", **options):
    df = spark.createDataFrame([(i, x, 0, 1, "k") for i, x in rows], SCHEMA.format(kind))
    return sorted((tuple(r) for r in near_vectors(df, **options).collect()), key=repr)


def clustered(rng, n, width, spread):
    centres = rng.normal(size=(12, width))
    m = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, width)) * spread
    return m * rng.exponential(size=(n, 1))


@pytest.mark.parametrize(("width", "spread"), [(2, 0.1), (5, 0.2), (16, 0.25), (40, 0.3)])
def test_matches_brute_force(spark, monkeypatch, width, spread):
    rng = np.random.default_rng(width)
    rows = [(i, x.tolist()) for i, x in enumerate(clustered(rng, 300, width, spread))]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]
    assert run(spark, rows, block=16) == brute(rows)


def test_single_precision(spark):
    m = clustered(np.random.default_rng(3), 200, 8, 0.2).astype(np.float32)
    rows = [(i, [float(e) for e in x]) for i, x in enumerate(m)]
    assert run(spark, rows, "float", block=32) == brute(rows)


def test_rows_out_of_the_ordinary(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (9, [1e300, 1e300]), (8, [1e-320, 1e-320]), (9, [1e300, 1e300]), (None, [2.0, 2.1]),
            (None, [-1.0, 0.0]), (11, [0.0, -1.0, 0.0]), (10, [-0.0, -2.0]), (12, [0.3, 0.0, 9.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, rows[:6]) == brute(rows[:6])


def test_distant_blocks_are_not_compared(spark):
    angles = np.linspace(0, math.tau, 640, endpoint=False)
    rows = [(float(i), math.cos(t), math.sin(t)) for i, t in enumerate(angles)]
    boxes = [(i // 10 // 2, (i // 20 << 32) + i // 10 % 2, *rows[i][1:], *rows[i][1:]) for i in range(0, 640, 10)]
    df = spark.createDataFrame(boxes, "parent long, node long, lo0 double, lo1 double, hi0 double, hi1 double")
    got = {tuple(r) for r in block_pairs(df, 32, 2, 0.316).collect()}
    want = {
        (a[1], b[1])
        for a in boxes
        for b in boxes
        if a[1] <= b[1] and (a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2 <= 0.316**2
    }
    assert got == want and len(want) < 64 * 65 / 2 / 4


def test_runs_inside_a_block(spark, monkeypatch):
    monkeypatch.setattr(grid_join, "RUN", 8)
    rng = np.random.default_rng(1)
    m = clustered(rng, 150, 6, 0.2)
    axes = grid_join.Axes(np.vstack([m.sum(axis=0), m.T @ m]), len(m))
    kind = np.dtype("<f8")
    order = np.lexsort(axes.turned(m)[:, :2].T[::-1])
    packed = [m[i].tobytes() for i in order]
    eps = math.sqrt(0.1)
    sides = [
        grid_join.Side(np.arange(s, e).tobytes(), np.full(e - s, 2).tobytes(), packed[s:e], kind, 6, axes)
        for s, e in ((0, 90), (90, 150))
    ]
    u = m[order] / np.linalg.norm(m[order], axis=1)[:, None]
    near = (u @ u.T >= 0.95) & ~np.eye(150, dtype=bool)
    total = np.zeros(150, int)
    for a, b in ((0, 0), (0, 1), (1, 1)):
        c, links, root = grid_join.join_blocks(sides[a], sides[b], a == b, 0.95, eps)
        total[c] += links
        assert (root <= c).all()
    assert (total == 2 * near.sum(axis=1)).all()
