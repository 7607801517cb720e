from __future__ import annotations

import re

import corpus_pipeline as cp
import numpy as np
from test_near_dedup import brute_components
from tokenizers import Tokenizer

from fieldpulse.llm import quality
from fieldpulse.llm.tables import table
from fieldpulse.llm.word_tokens import default_path

SMALL = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    assert [n for n, _ in cp.STAGES] == ["quality", "exact_dedup", "near_dedup", "pseudonyms", "packing"]
    docs = table(spark, SMALL, "documents")
    good = cp.keep_good(spark, docs, SMALL)
    assert good.columns == docs.columns
    labels = {r.doc_id: r.quality for r in table(spark, SMALL, "labels").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    scores = quality.scored(docs, quality.fit(docs, table(spark, SMALL, "labels"))).collect()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert {i for i, _ in rows} == {r.doc_id for r in scores if r.score >= 0.5}
    known = [labels[i] for i, _ in rows if i in labels]
    assert sum(known) / len(known) > 0.97

    once = cp.drop_copies(spark, good, SMALL)
    best = {}
    for i, t in rows:
        best[t] = max(best.get(t, -1), i)
    rows = [(r.doc_id, r.text) for r in once.collect()]
    assert once.columns == docs.columns and sorted(rows) == sorted((i, t) for t, i in best.items())

    apart = cp.drop_near_copies(spark, once, SMALL)
    low = {c for _, c in brute_components(rows, 80).values()}
    rows = [(r.doc_id, r.text) for r in apart.collect()]
    assert apart.columns == docs.columns and {i for i, _ in rows} == low

    hidden = cp.hide_personal_data(spark, apart, SMALL)
    assert hidden.columns == docs.columns and hidden.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    out = hidden.collect()
    assert {r.doc_id for r in out} == low
    for r in out:
        assert r.n_chars == len(r.text)
        mails = re.findall(r"[\w.]+@mail\d\.example\.com", texts[r.doc_id])
        assert not any(m in r.text for m in mails)

    final = cp.run(spark, SMALL)
    assert {r.doc_id for r in final.collect()} == low


def test_result_decodes_to_the_pseudonymised_texts(spark, monkeypatch):
    stages, write = {}, cp.written
    monkeypatch.setattr(cp, "written", lambda df, name: stages.setdefault(name, write(df, name)))
    final = cp.run(spark, SMALL).orderBy("doc_id", "start").collect()
    texts = {r.doc_id: r.text or "" for r in stages["stage-pseudonyms"].collect()}
    library, got = Tokenizer.from_file(default_path()), {}
    for r in final:
        assert len(r.ids) == 2 * r.n_tokens
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, np.uint16).tolist())
    assert got.keys() == texts.keys() and any(texts.values())
    for i, text in texts.items():
        own = library.encode(text, add_special_tokens=False).ids
        assert got[i] == own


def test_empty_table(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.count() == 0
    assert cp.pack(spark, docs, SMALL).count() == 0


def test_clashing_names_and_rows_out_of_the_ordinary(spark):
    """Every filtering stage hands other columns through; nulls, repeats and long texts have results."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id string, _sha string, _th string, _text string, _score string, kept string, c long"
    long = "many words of one very long text, all alike. " * 20_000
    texts = [None, "", "one short text", "one short text", long, long, "plain words in a row that make a text"]
    ids = [1, 2, 3, 4, 5, 6, 7]
    rows = [(i, t, "en", "s", len(t or ""), "keep1", "keep2", "keep3", "keep4", "keep5", "keep6", i) for i, t in zip(ids, texts, strict=True)]
    rows += [(*rows[6],)] * 3 + [(None, "null id", *rows[0][2:])] * 2
    docs = spark.createDataFrame(rows, schema)
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got or name == "quality"
        assert all((r["_id"], r["_sha"], r["_th"], r["_text"], r["_score"], r["kept"]) == tuple(f"keep{k}" for k in range(1, 7)) for r in got), name
    once = [(r.doc_id, r.text) for r in cp.drop_copies(spark, docs, SMALL).collect()]
    assert sorted(once, key=repr) == sorted([(2, ""), (4, texts[2]), (6, long), (7, texts[6]), (None, "null id")], key=repr)
    apart = [(r.doc_id, r.text) for r in cp.drop_near_copies(spark, docs, SMALL).collect()]
    assert sorted(apart, key=repr) == sorted([(1, None), (2, ""), (3, texts[2]), (5, long), (7, texts[6]), (None, "null id")], key=repr)
