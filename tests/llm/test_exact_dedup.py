from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldpulse.llm.exact_dedup import exact_groups, keep_one, name_texts

SCHEMA = "doc_id long, text string, name string, level string, row string, h string"
TEXTS = ["", None, "a", "a", "abcd", "abcdabcd", "abcdabcd", "abcdabcdx", "dcba" * 12, "dcba" * 12,
         "dcba" * 11 + "dcbb", "é" * 9, "é" * 9, "é" * 8]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "n", None, "r", "h") for i, t in rows], SCHEMA)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        out.append((i, max(ids, default=None), len(groups[t or ""])))
    return Counter(out)


@pytest.mark.parametrize("digest", [lambda c: F.xxhash64(c), lambda c: F.crc32(c) % 3])
def test_matches_brute_force(spark, digest):
    """Also where nearly all blocks share a digest."""
    rows = [*enumerate(TEXTS), (3, "a"), (None, "abcd"), (None, "lone"), (50, "lone2"), (50, "lone2")]
    df = frame(spark, rows)
    got = exact_groups(df, block=4, digest=digest).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == brute(rows)
    texts = {t or "" for _, t in rows}
    assert sum(r.kept for r in got) == len(texts)
    assert len({(r.level, r["name"]) for r in name_texts(df, block=4, digest=digest).collect()}) == len(texts)


def test_keep_one(spark):
    rows = [*enumerate(TEXTS), (3, "a"), (None, "lone"), (None, "lone")]
    df = frame(spark, rows)
    out = keep_one(df)
    assert out.columns == df.columns
    got = Counter((r.doc_id, r.text or "") for r in out.collect())
    best = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    assert got == Counter((None if i < 0 else i, t) for t, i in best.items())


def test_empty_table(spark):
    assert exact_groups(frame(spark, [])).count() == 0
    assert keep_one(frame(spark, [])).count() == 0
