from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from fieldpulse.llm import rans, token_files, word_tokens
from fieldpulse.llm.queries import QUERIES
from fieldpulse.llm.word_tokens import default_path, tokenizer

SMALL = "/root/testdata/sf0.001"


def test_words_match_the_library():
    library, own = Tokenizer.from_file(default_path()), tokenizer(default_path())
    rng = random.Random(3)
    letters = "  abcStté'ÉΣİ0123,.!<|endoftext|>\n\t\x0b\x1c\x85  日本́가🙂"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(800)]
    texts += ["it's  we'll", "End. end, END! x.. 3, 3.5 é. <|ENDOFTEXT|> Don't. 's, don'T", "<|endoftext|>. A.", "a<|startoftext|>b <|endoftext|>", "", " ", "́ x ́", "ΑΣ ΑΣ", "x" * 300, "e\ń"]
    assert own.direct and own.folds and own.splits and own.kind.itemsize == 2
    packed = own.packed([t.encode() for t in texts])
    for text, got in zip(texts, packed, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, own.kind).tolist() == want, repr(text)
    own.known.clear()
    assert own.packed([t.encode() for t in texts], span=7) == packed


def test_blank_edges_after_many_words(monkeypatch):
    """The empty word stays known when the words in memory change and no text had one meanwhile."""
    monkeypatch.setattr(word_tokens, "_KEPT", 50)
    library, own = Tokenizer.from_file(default_path()), word_tokens.WordTokenizer(default_path())
    texts = [" ".join(f"w{i}x{k}" for i in range(80)) for k in range(4)] + ["", " a  b ", "\n", "w1x0 w1x3"]
    for text in texts:  # each alone, so that the words change between them
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.packed([text.encode()])[0], own.kind).tolist() == want, repr(text)
    assert own.known.before and not own.known.before.before  # two sets of words at most


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 4095, 4096, 4097, 30_000])
@pytest.mark.parametrize("ids", [1, 3, 5000])
def test_frames_round_trip(n, ids):
    rng = np.random.default_rng(n + ids)
    tokens = (ids * rng.random(n) ** 4).astype(np.uint32)
    table = rans.Frequencies(np.bincount(tokens, minlength=ids))
    frame = rans.encode(tokens, table)
    assert np.array_equal(rans.decode(frame, table), tokens)
    blocks = -(-n // rans.BLOCK)
    for b in range(blocks):  # from any checkpoint
        assert np.array_equal(rans.decode(frame, table, b, b + 1), tokens[b * rans.BLOCK : (b + 1) * rans.BLOCK])
    if n:
        damaged = bytearray(frame)
        damaged[-3] ^= 1
        with pytest.raises(rans.Damaged):
            rans.decode(bytes(damaged), table)


def test_close_to_entropy():
    rng = np.random.default_rng(1)
    tokens = (20_000 * rng.random(200_000) ** 6).astype(np.uint32)
    counts = np.bincount(tokens)
    p = counts[counts > 0] / len(tokens)
    bits = -(p * np.log2(p)).sum() * len(tokens)
    assert len(rans.encode(tokens, rans.Frequencies(counts))) * 8 < 1.05 * bits + 200_000 / 4096 * 8 * 152


def test_unknown_id_is_an_error():
    with pytest.raises(ValueError):
        rans.encode(np.array([2]), rans.Frequencies(np.array([1, 1, 0])))


def brute(rows):
    library, out, start = Tokenizer.from_file(default_path()), {}, 0
    for doc_id, text in sorted(rows):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out[doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = QUERIES["op4_rans_token_files"](spark, SMALL).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == brute([(d.doc_id, d.text) for d in docs])


def test_small_parts_nulls_and_repeats(spark, tmp_path):
    rows = [(i * 7 % 40, f"word {i} " * (i % 5)) for i in range(40)] + [(3, "again"), (None, "lone"), (50, None)]
    df = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in rows], "doc_id long, text string, ids string, part string, start string")
    kind = tokenizer(default_path()).kind
    folder = token_files.write_tokens(token_files.token_ids(df, default_path()), str(tmp_path / "f"), kind, part=50, frame=16)
    got = token_files.read_tokens(spark, folder).collect()
    assert len(got) == len(rows)
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [0, *np.cumsum([len(r.ids) // 4 for r in got])[:-1]]
    keys = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys)
    empty = token_files.write_tokens(token_files.token_ids(df.limit(0), default_path()), str(tmp_path / "e"), kind)
    assert token_files.read_tokens(spark, empty).count() == 0
