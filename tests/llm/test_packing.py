from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fieldpulse.llm import packing, word_tokens
from fieldpulse.llm.queries import QUERIES
from fieldpulse.llm.word_tokens import default_path

SMALL = "/root/testdata/sf0.001"


def padding(lengths, counts, ends):
    return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts, strict=True))


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("buckets", [1, 2, 3, 9])
def test_least_padding(seed, buckets):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(40, 9, replace=False) + 1)
    counts = rng.integers(1, 30, 9)
    ends = packing.optimal_lengths(lengths, counts, buckets)
    assert len(ends) <= buckets and ends[-1] == lengths[-1] and ends == sorted(set(ends))
    every = [
        [*c, int(lengths[-1])] for k in range(buckets) for c in itertools.combinations(lengths[:-1].tolist(), k)
    ]
    assert padding(lengths, counts, ends) == min(padding(lengths, counts, e) for e in every)


def test_many_lengths():
    lengths = np.arange(1, 2049)
    ends = packing.optimal_lengths(lengths, np.ones(2048, np.int64), 16)
    assert len(ends) == 16 and padding(lengths, np.ones(2048), ends) == 2048 * (128 - 1) / 2
    assert packing.optimal_lengths(np.array([], np.int64), np.array([], np.int64)) == []


def check(rows, texts, longest, budget):
    library = Tokenizer.from_file(default_path())
    want = {}
    for doc_id, text in texts:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        for chunk, start in enumerate(range(0, max(n, 1), longest)):
            key = (doc_id, chunk, start, min(longest, n - start))
            want[key] = want.get(key, 0) + 1
    got = {}
    batches = {}
    for r in rows:
        key = (r.doc_id, r.chunk, r.start, r.n_tokens)
        got[key] = got.get(key, 0) + 1
        if r.n_tokens:
            batches.setdefault((r.batch, r.bucket_length), []).append(r)
        else:
            assert r.batch is None and r.bucket_length is None
    assert got == want
    assert sorted(b for b, _ in batches) == list(range(len(batches)))
    ends = sorted({e for _, e in batches})
    for (_, end), members in batches.items():
        assert sorted(r.place for r in members) == list(range(len(members)))
        assert len(members) <= max(1, budget // end)
        assert all(r.bucket_length == min(e for e in ends if e >= r.n_tokens) for r in members)
    for end in ends:  # one short batch at most
        sizes = [len(m) for (_, e), m in batches.items() if e == end]
        assert sum(s < max(1, budget // end) for s in sizes) <= 1
    lengths, counts = np.unique([r.n_tokens for r in rows if r.n_tokens], return_counts=True)
    assert padding(lengths, counts, ends) == padding(lengths, counts, packing.optimal_lengths(lengths, counts, len(ends)))


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = QUERIES["op7_length_buckets"](spark, SMALL).collect()
    check(rows, [(d.doc_id, d.text) for d in docs], packing.LONGEST, packing.BUDGET)


def test_query_rows_hold_the_ids(spark):
    library = Tokenizer.from_file(default_path())
    texts = {d.doc_id: d.text or "" for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op7_length_buckets"](spark, SMALL).orderBy("doc_id", "start").collect()
    got = {}
    for r in rows:
        assert len(r.ids) == 2 * r.n_tokens
        got[r.doc_id] = got.get(r.doc_id, b"") + r.ids
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        assert np.frombuffer(got[i], np.uint16).tolist() == library.encode(text, add_special_tokens=False).ids


def test_small_budget_nulls_repeats_and_empty(spark):
    texts = [(i, "word " * (i * i % 23)) for i in range(60)] + [(1, "again"), (1, "again"), (None, "lone word"), (7, None), (8, "x " * 5000)]
    df = spark.createDataFrame([(i, t, 1, 2, "z") for i, t in texts], "doc_id long, text string, chunk int, batch int, ids string")
    out = packing.packed(df, default_path(), longest=16, buckets=3, budget=40, with_ids=True).collect()
    check(out, texts, 16, 40)
    assert all(len(r.ids) == 2 * r.n_tokens for r in out)
    assert packing.packed(df.limit(0), default_path()).count() == 0
    assert packing.packed(df.where("text IS NULL"), default_path()).collect()[0].batch is None


def test_blank_edges_after_many_words(spark, monkeypatch):
    """As the workers of ``sequences`` do, in one process: no text with an empty word while the words change twice."""
    monkeypatch.setattr(word_tokens, "_KEPT", 50)
    tokenizer = word_tokens.WordTokenizer(default_path())
    monkeypatch.setattr(packing, "tokenizer", lambda path: tokenizer)
    texts = [" ".join(f"w{i}y{k}" for i in range(80)) for k in range(4)] + ["", " a  b ", "\n", None]
    found = []

    class Docs:  # a frame of one row per batch, whose function runs here
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            kinds = pa.schema({"doc_id": pa.int64(), "digest": pa.int64(), "text": pa.binary()})
            rows = (pa.RecordBatch.from_pylist([{"doc_id": i, "digest": 0, "text": t and t.encode()}], kinds) for i, t in enumerate(texts))
            found.extend(r for batch in run(rows) for r in batch.to_pylist())

    packing.sequences(Docs(), default_path(), with_ids=True)
    library = Tokenizer.from_file(default_path())
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(r["ids"], np.uint16).tolist() for r in found] == want
