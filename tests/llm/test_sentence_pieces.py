from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece as spm

from fieldpulse.llm import sentence_pieces as sp
from fieldpulse.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
TEXTS = ["", " ", "   ", "a", "  Hello,  world!\n\n\tx ", "▁▁x ▁", "ééñ ß", "日本語 中文 🙂🙂", "é", "<s> </s> <unk> <0x41>",
         "\0a\x01", "x" * 200, "ab " * 700, " " * 90 + "q", "​﻿ ", "𐀀\U0010ffff", "the\r\nthe"]


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=PATH)


def fuzz(n, seed=4):
    rng = random.Random(seed)
    letters = "  ▁abcdeéñßtheing.,'\"0123\n\t日本🙂<>́"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(120))) for _ in range(n)]


def test_ids_and_texts_match_the_library(library):
    own = sp.model(PATH)
    for text in TEXTS + fuzz(600):
        ids, starts, ends = own.encode(text.encode())
        assert ids.tolist() == library.encode(text), text
        assert own.decode(ids) == library.decode(ids.tolist())
        if len(ids):
            assert starts[0] == 0 and ends[-1] == len(text.encode()) and (starts[1:] == ends[:-1]).all()
            for i, a, b in zip(ids[1:], starts[1:], ends[1:], strict=True):
                if own.kinds[i] == sp.NORMAL:
                    assert text.encode()[a:b].decode().replace(" ", sp.SPACE) == own.texts[i]


def test_decodes_any_ids(library):
    rng = random.Random(2)
    own = sp.model(PATH)
    for _ in range(500):
        low = rng.choice([0, 3])
        ids = [rng.randrange(low, rng.choice([259, 32000])) for _ in range(rng.randrange(12))]
        assert own.decode(np.array(ids, np.int32)) == library.decode(ids), ids


def test_long_texts_are_cut_between_units(library, monkeypatch):
    monkeypatch.setattr(sp, "SEGMENT", 50)
    own = sp.PieceModel(open(PATH, "rb").read())
    for text in fuzz(100, 9) + [" a" * 500, "b" * 500, "  c" * 300]:
        assert own.encode(text.encode())[0].tolist() == library.encode(text)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_compiled_character_maps(rule):
    """Longest prefixes and their source places, against the library's normaliser."""
    reference = spm.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True
    )
    fields = dict(sp._fields(reference.serialized_model_proto()))
    spec = dict(sp._fields(fields[3]))
    own = sp.PieceModel.__new__(sp.PieceModel)
    own.map = sp.CharacterMap(spec.get(2, b""))
    own.prefix = own.squeeze = True
    own.space = sp.SPACE
    for text in TEXTS + ["ＡＢＣ①②㍿ ﬁ ｶﾞ Å İ ẛ̣", "  １ ２　　３  "] + fuzz(300):
        body, origin = own.normalised(text.encode())
        want, offsets = reference.normalize(text, with_offsets=True)
        assert body.decode() == want, text
        chars = [len(text.encode()[:o].decode("utf-8", "ignore")) for o in origin]
        firsts = [i for i, b in enumerate(body) if b & 0xC0 != 0x80]
        assert [chars[i] for i in firsts] == list(offsets)[: len(firsts)], text


def test_query(spark, library):
    rows = {r.doc_id: r for r in QUERIES["op1_sentence_pieces"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "")
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids) and r.spans_tile and r.source_bytes == len((d.text or "").encode())
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_nulls_and_empty_tables(spark):
    schema = "doc_id long, text string, ids string, starts string"
    df = spark.createDataFrame([(1, None, "x", "y"), (None, "a b", "x", "y"), (1, "", None, None)], schema)
    out = sp.decoded(sp.encoded(df, PATH), PATH)
    got = sorted(((r.doc_id or -1), list(r.ids), r.decoded) for r in out.collect())
    assert [x[2] for x in got] == ["a b", "", ""] and got[1][1] == []
    assert sp.encoded(df.limit(0), PATH).count() == 0


def test_query_on_nulls_and_empty_texts(spark, tmp_path, library):
    texts = {1: None, 2: "", 3: "  ", 4: "plain words", 5: " a  b \n"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in QUERIES["op1_sentence_pieces"](spark, str(tmp_path)).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode(text or "")
        assert rows[i].n_tokens == len(ids) and rows[i].spans_tile
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert rows[1].source_bytes == rows[2].source_bytes == 0 and rows[4].source_bytes == 11


def test_decoding_goes_by_bounded_parts(spark):
    lists = pa.array([[1] * 4, None, [], [1] * 3, [1] * 9], pa.list_(pa.int32()))
    parts = sp.pieces([pa.RecordBatch.from_arrays([lists, lists], names=["ids", "x"])], 6, 0)
    assert [x.num_rows for x in parts] == [3, 1, 1]
    df = spark.createDataFrame([(i, [5, 6, 7] * i) for i in range(9)], "doc_id long, ids array<int>").coalesce(1)
    own = sp.model(PATH)
    assert [r.decoded for r in sp.decoded(df, PATH).collect()] == [own.decode(np.array([5, 6, 7] * i, np.int32)) for i in range(9)]
