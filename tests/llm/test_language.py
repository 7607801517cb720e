from __future__ import annotations

import zlib

import numpy as np
import pytest

from fieldpulse.llm import language
from fieldpulse.llm.gru import ByteNetwork, packed
from fieldpulse.llm.queries import QUERIES
from fieldpulse.llm.tables import table

FOLDER = "/root/testdata/sf0.01"


def test_gradients_by_differences():
    net = ByteNetwork(3, hidden=4, seed=5)
    grid, lengths = packed([b"abc", b"z", b"hello", b"ab"], 5)
    labels = np.array([0, 1, 2, 1])
    _, g = net.gradients(grid, lengths, labels)
    for name, w in net.p.items():
        flat, got = w.reshape(-1), g[name].reshape(-1)
        for i in np.argsort(-np.abs(got))[:4].tolist() + [0]:
            old, e = flat[i], 1e-5
            flat[i] = old + e
            up = net.gradients(grid, lengths, labels)[0]
            flat[i] = old - e
            down = net.gradients(grid, lengths, labels)[0]
            flat[i] = old
            assert abs((up - down) / (2 * e) - got[i]) < 1e-6, name


def test_padding_does_not_matter():
    net = ByteNetwork(2, hidden=4)
    a = net.probabilities(*packed([b"abc"], 3))
    b = net.probabilities(*packed([b"abc", b"longer!"], 7))
    assert np.allclose(a[:3, 0], b[:3, 0])
    assert np.allclose(a.sum(axis=2), 1)


def test_whole_texts_are_pooled():
    net = ByteNetwork(2, hidden=4).single()
    model = language.LanguageModel(["x", "y"], net)
    text = ("word " * 3 + "é" * 40 + " end").encode()
    (name,), (score,) = model.predict([text])
    runs = language.runs_of(text)
    assert b"".join(runs) == text.replace(b" ", b"")
    total = sum(net.probabilities(*packed([r], len(r)))[:, 0].sum(0) for r in runs) / sum(map(len, runs))
    assert name == ["x", "y"][int(total.argmax())] and abs(score - total.max()) < 1e-5


def test_held_out_accuracy(spark):
    got = QUERIES["op3_recurrent_language"](spark, FOLDER).collect()
    lang = {r.doc_id: r.lang for r in table(spark, FOLDER, "documents").collect()}
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97


def test_nulls_clashes_and_empty_tables(spark):
    rows = [(i, f"{w} {w}ing {i}", x, "s") for i in range(40) for w, x in [("the", "en"), ("für", "de")]]
    rows += [(1, None, "en", "s"), (2, "", None, "s"), (None, "12 34!", "en", "s"), (3, "²³", "de", "s"), (4, "the", None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, runs string")
    model = language.fit(df, rounds=60)
    assert model.languages == ["de", "en"]
    out = language.identified(df, model).collect()
    by = {r.text: (r.lang_pred, r.lang_score) for r in out}
    assert len(out) == len(rows)
    assert by[None] == by[""] == by["12 34!"] == by["²³"] == ("und", 0.0) and by["the"][0] == "en"
    assert language.identified(df.limit(0), language.fit(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        language.identified(df, model, names=("lang", "score"))
