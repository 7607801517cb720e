from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fieldpulse.llm import near_dedup as nd
from fieldpulse.llm.near_dedup import keep_one, near_groups
from fieldpulse.llm.setsketch import registers, similarity_bounds
from fieldpulse.llm.shingles import shingle_sets

SCHEMA = "doc_id long, text string, a string, c string, n string, cluster string"


def words(text):
    lower = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    return re.findall("[^\x20\x09-\x0d]+", lower)


def brute_set(text, k=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset({tuple(w)} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)})


def brute_components(rows, percent=85):
    sets = [brute_set(t) for _, t in rows]
    best = list(range(len(rows)))

    def root(i):
        while best[i] != i:
            i = best[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = root(i), root(j)
                best[max(x, y)] = min(x, y)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = {}
    for members in groups.values():
        low = min(rows[i][0] for i in members)
        out |= {rows[i][0]: (len(sets[i]), low) for i in members}
    return out


def corpus(seed=3, families=12, size=14):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)]
    rows, n = [], 0
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 5, 6, 30, 120, 300]))]
        for k in range(size):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 8])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                w = w[: max(1, int(len(w) * 0.93))]
            text = rng.choice([" ", "\n", "\t "]).join(w)
            rows.append((n * 7 % 1009, text.upper() if k % 3 == 0 else text))
            n += 1
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("many,block", [(64, 512), (3, 4)])
def test_matches_all_pairs(spark, many, block):
    """Through ordinary buckets alone, and with nearly all work in hot blocks."""
    rows = [*corpus(), (2000, None), (2001, ""), (2002, " \t\n"), (2003, "x y z"), (2004, "x y Z")]
    got = near_groups(frame(spark, rows), many=many, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_keep_one(spark):
    same = "one two three four five six"
    rows = [(5, same), (5, same), (7, same.upper()), (None, same), (None, "a b"), (None, "a b"), (8, ""), (9, None)]
    df = frame(spark, rows)
    out = keep_one(df)
    assert out.columns == df.columns
    got = sorted((r.doc_id or -1, r.text or "") for r in out.collect())
    assert got == [(-1, "a b"), (5, same), (8, ""), (9, "")]


def test_empty_table(spark):
    assert near_groups(frame(spark, [])).count() == 0
    assert keep_one(frame(spark, [])).count() == 0


def test_sets_of_long_texts():
    """Across the cuts of long texts, and with a word longer than a cut."""
    rng = random.Random(1)
    long = " ".join(str(rng.randrange(500)) for _ in range(900_000))
    texts = ["a b c d e f", long, "", "y" * 5_000_000 + " x", " lead", None, long]
    sets = shingle_sets(pa.array([None if t is None else t.encode() for t in texts], pa.binary()))
    assert [len(s) for s in sets] == [len(brute_set(t)) for t in texts]
    assert np.array_equal(sets[1], sets[6])


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    a, b = (np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (4000, 700))
    both = np.union1d(a, b)
    ra, rb, rab = registers([a, b, both])
    assert np.array_equal(np.maximum(ra, rb), rab)
    for share in (0.2, 0.5, 0.85, 0.95):
        n = 1500
        common = int(2 * n * share / (1 + share))
        pool = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        x, y = pool[:n], pool[n - common : 2 * n - common]
        r = registers([np.unique(x), np.unique(y)])
        best, high = similarity_bounds(r[:1], r[1:], np.array([n]), np.array([n]))
        true = common / (2 * n - common)
        assert abs(best[0] - true) < 0.1 and true <= high[0]


def test_many_elements_cost_no_more_than_needed():
    assert registers([np.empty(0, np.uint64)]).sum() == 0
    assert nd.BANDS * nd.ROWS <= 256
