from __future__ import annotations

from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldpulse.llm import alignment
from fieldpulse.llm.alignment import Aligner, aligned
from fieldpulse.llm.csr import Csr
from fieldpulse.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, chunk long, a string"


class Plain:
    """Whole texts through the libraries, pair by pair."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [x for x in range(256) if x not in shown]
        self.byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(rest)}

    def tokens(self, text):
        if not text:
            return [], []
        one = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.byte[c] for c in t)) for i, t in zip(one.ids, one.tokens)]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return [], []
        return a, b

    @staticmethod
    def spans(tokens):
        at, out = 0, []
        for i, x in tokens:
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    def run(self, rows):
        found, corpus = [], Counter()
        for i, text in rows:
            a, b = map(self.spans, self.tokens(text))
            links = []
            j = 0
            for x, s, e in a:
                while j and b[j - 1][2] > s:
                    j -= 1
                while j < len(b) and b[j][1] < e:
                    if b[j][2] > s:
                        links.append((x, b[j][0]))
                    j += 1
            ends = sorted({e for *_, e in a} & {e for *_, e in b})
            groups, shared, s = [], 0, 0
            for e in ends:
                one, two = ([str(x) for x, p, q in side if s <= p and q <= e] for side in (a, b))
                groups.append(",".join(one) + "|" + ",".join(two))
                shared += len(one) * len(two)
                s = e
            corpus.update(links)
            found.append((i, len(a), len(b), len(ends), links, ";".join(groups), shared))
        top = Counter()
        for (_, y), n in corpus.items():
            top[y] = max(top[y], n)
        return sorted(
            (
                (i, n_a, n_b, n, len(links), sum(corpus[x] == top[x[1]] for x in links), sum(corpus[x] for x in links),
                 sha256(g.encode()).hexdigest() if g else "", shared)
                for i, n_a, n_b, n, links, g, shared in found
            ),
            key=repr,
        )


PLAIN = Plain()


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "en", 1, "a") for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in aligned(df, A, B, **options).collect()), key=repr)


def test_rows_out_of_the_ordinary(spark):
    texts = [None, "", " ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\n\nb", "tab\tand \x1c \x85   　x", "\r\n;\r\n x",
             "don't we'll 12 345", "▁", "x ▁ y", "naïve Straße 東京タワー \U0001f600", "<|endoftext|> <s></s><unk> <0x0A>",
             "é ​ ﻿", "\0 \x01", "!" * 300, "aaaa" * 500, "word " * 20000, "  lead", "a\n b\n  c \n"]
    rows = [*enumerate(texts), (None, "a b"), (3, "a b"), (3, "a b"), (3, "a b")]
    want = PLAIN.run(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, size=64) == want
    assert run(spark, []) == []
    assert run(spark, rows[:2]) == PLAIN.run(rows[:2])


def test_query_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op11_token_alignment"](spark, folder).collect()), key=repr) == PLAIN.run(rows)


@pytest.fixture(scope="module")
def own():
    return Aligner(A, B)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab Z\n\t\r 1'!é▁ \x1c\x85東  .<>|s"), max_size=40))
def test_units_give_the_libraries_tokens(own, text):
    a, b = PLAIN.tokens(text)
    found = own.chunk([text])
    (_, n_a, n_b, n_groups, n_links, _, _, digest, shared) = PLAIN.run([(0, text)])[0]
    assert [found[k].tolist() for k in ("n_a", "n_b", "n_groups", "n_links", "n_shared")] == [
        [n_a], [n_b], [n_groups], [n_links], [shared]
    ]
    assert found["digests"] == [digest]
    pairs = dict(zip(zip(found["a"].tolist(), found["b"].tolist()), found["times"].tolist()))
    assert sum(pairs.values()) == n_links


def test_units_in_memory_are_bounded(own, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_UNITS", 10)
    texts = ["one two three", "four five six seven", "one eight " * 9]
    first = [own.chunk([t])["digests"] for t in texts]
    assert first == [own.chunk([t])["digests"] for t in texts]
    assert len(own.units.groups) < 20


def test_products():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 3, (7, 5)), rng.integers(0, 3, (5, 6))

    def sparse(m):
        r, c = np.nonzero(m)
        return Csr.of(r, c, m[r, c], m.shape)

    def dense(s):
        m = np.zeros((len(s), s.width), int)
        m[s.rows(), s.columns] = s.values
        return m

    assert (dense(sparse(x).times(sparse(y))) == x @ y).all()
    assert (dense(sparse(x).transposed()) == x.T).all()
    assert (dense(sparse(x).picked(np.array([3, 0, 3]))) == x[[3, 0, 3]]).all()
    assert (sparse(x).applied(np.arange(5)) == x @ np.arange(5)).all()


def test_groups_are_kept_as_bytes():
    """A unit's groups take their own bytes and not an object of Python's each."""
    own = Aligner(A, B)
    texts = ["one two, three", None, "", "four\n\n five é two", "x" * 50]
    found = own.chunk(texts)
    assert own.units.groups.dtype == np.int64 and own.units.groups.min() > 0
    again = own.chunk(texts[::-1])["digests"]
    assert again[::-1] == found["digests"] and found["digests"][1:3] == ["", ""]
