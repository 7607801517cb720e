from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from fieldpulse.llm import quality
from fieldpulse.llm.gam import AdditiveModel
from fieldpulse.llm.queries import QUERIES
from fieldpulse.llm.tables import table

FOLDER = "/root/testdata/sf0.01"


def test_tables_and_pairs_are_learnt():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 4))
    y = ((np.abs(x[:, 0]) < 0.8) & ((x[:, 1] > 0) == (x[:, 2] > 0))).astype(float)
    m = AdditiveModel().fit(x[:4000], y[:4000])
    assert ((m.score(x[4000:]) >= 0.5) == y[4000:]).mean() > 0.9
    assert (1, 2) in [(a, b) for a, b, _ in m.pairs]
    s, by_hand = m.score(x[:5]), np.full(5, m.base)
    for f in range(4):
        by_hand += [m.tables[f][(m.cuts[f] <= v).sum()] for v in x[:5, f]]
    for a, b, t in m.pairs:
        by_hand += [t[(m.coarse[a] <= u).sum(), (m.coarse[b] <= v).sum()] for u, v in x[:5][:, [a, b]]]
    assert np.allclose(s, 1 / (1 + np.exp(-by_hand)))


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(n):
    m = AdditiveModel().fit(np.ones((n, 3)), np.ones(n))
    assert ((0 <= m.score(np.zeros((2, 3)))) & (m.score(np.zeros((2, 3))) <= 1)).all()


def test_features_of_odd_texts():
    texts = pa.array([b"", None, b" \n\t", b"a", b"\xff\xfe", b"x" * 3_000_000, b"a b " * 900_000], pa.binary())
    x = quality.features(texts)
    assert np.isfinite(x).all() and x.shape == (7, len(quality.FEATURES))
    assert (x[0] == x[1]).all()


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op5_additive_quality"](spark, FOLDER).collect()}
    labels = table(spark, FOLDER, "labels").collect()
    assert len(got) == table(spark, FOLDER, "documents").count()
    rows = [(got[r.doc_id], r.quality) for r in labels if r.doc_id in got and got[r.doc_id].held_out]
    assert len(rows) > 50 and np.mean([r.predicted == q for r, q in rows]) > 0.95
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_nulls_clashes_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, "Fine text here.", 3, "q"), (2, None, 3, "q"), (None, "x", 3, None), (2, "bad bad bad", 3, "q"), (4, "", 3, "q")],
        "doc_id long, text string, y int, quality string",
    )
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 0), (4, None, 0), (None, 1, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    out = quality.scored(docs, quality.fit(docs, labels))
    assert out.columns == [*docs.columns, "score"] and out.count() == 5
    none = quality.fit(docs.limit(0), labels.limit(0))
    assert quality.scored(docs.limit(0), none).count() == 0
    with pytest.raises(ValueError):
        quality.scored(docs, none, score="y")
