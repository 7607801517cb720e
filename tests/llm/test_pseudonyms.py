from __future__ import annotations

import re

import pytest

from fieldpulse.llm.feistel import Permutation, iban_value, luhn_sum
from fieldpulse.llm.pseudonyms import Pseudonyms, pseudonymised
from fieldpulse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
VALUES = {
    "email": ["idkbao.18@mail2.example.com", "A.b-C+tag@Sub.Example.org"],
    "card": ["4111111111111111", "5500 0000 0000 0004", "3782-822463-10005"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "ip": ["47.214.15.140", "8.8.8.8"],
    "date": ["2024-02-29", "31.12.1999", "12/25/2001", "1/2/2003", "25/12/2001"],
    "ssn": ["123-45-6789"],
    "nanp": ["+1 (524) 555-2896", "(212) 555-0100", "212-555-0100"],
    "phone": ["+49 30 901820", "+33 1 42 68 53 00", "+4915112345678"],
    "secret": ["18a0165473c0330cab"],
}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutations(n):
    p = Permutation(b"k", "c", n)
    image = [p.move(x) for x in range(n)]
    assert sorted(image) == list(range(n))
    assert n == 1 or all(x != y for x, y in enumerate(image))
    assert [p.move(y, -1) for y in image] == list(range(n))
    big = Permutation(b"k", "c", n * 10**25)
    assert big.move(big.move(12345), -1) == 12345
    assert n < 97 or image != [Permutation(b"other", "c", n).move(x) for x in range(n)]


def test_each_kind_keeps_its_format():
    own, back = Pseudonyms(b"key"), Pseudonyms(b"key", -1)
    for kind, values in VALUES.items():
        for value in values:
            text = f'See {"password=" if kind == "secret" else ""}{value}, twice: {"token: " if kind == "secret" else ""}{value}.'
            new, spans = own.replace(text)
            assert [s[2] for s in spans] == [kind, kind], (kind, value, spans)
            assert [text[a:b] for a, b, _ in spans] == [value, value]
            assert value not in new
            assert back.replace(new)[0] == text
            found = new.split(": ")[-1].removesuffix(".")
            if kind in ("card", "iban", "ssn", "nanp", "phone", "secret"):
                assert len(found) == len(value)
            if kind == "card":
                assert luhn_sum(re.sub(r"\D", "", found)) % 10 == 0 and found[0] == value[0]
            if kind == "iban":
                assert iban_value(found.replace(" ", "")) % 97 == 1


def test_neighbours_and_invalid_values():
    own = Pseudonyms(b"key")
    text = "ip 12.158.146.200 mail sgs.09@mail9.example.com +1 (578) 555-1234 4111111111111111 2020-01-02"
    assert [s[2] for s in own.replace(text)[1]] == ["ip", "email", "nanp", "card", "date"]
    clean = [
        "4111111111111112", "1111111111111111", "300.1.1.1", "1.2.3.4.5", "2023-02-29", "13/13/2020", "000-12-3456", "666-12-3456",
        "DE89370400440532013001", "a@b", "version 3.", "x = 12345678", "tokens: none", "1 234 567", "+1 23", "call 555-1234", "",
        "password=short", "the secret: everything", "0.1.2.3", "1850-01-01", "12345678901234567890123",
    ]
    for t in clean:
        assert own.replace(t) == (t, []), t


@pytest.mark.parametrize(
    "text, value",
    [
        ("password=P@ssw0rd!2024 next", "P@ssw0rd!2024"), ("password=Tr0ub4dor&3, next", "Tr0ub4dor&3"), ("pwd: hunterhunter", "hunterhunter"),
        ("passwd=abc1234", "abc1234"), ("pwd = hunters.", "hunters"), ("password: x1", "x1"), ("token='two words' next", "two words"),
        ('{"password": "a\\"b c9", "user": "bob"}', 'a\\"b c9'), ('"{\\"secret\\": \\"p q\\"}"', "p q"), ("api_key=abc,def", "abc,def"),
        ("password := Q#w", "Q#w"), ("token: ab$cd", "ab$cd"), ("password=me@mail.com!1", "me@mail.com!1"), ("pwd=x2020-01-02y", "x2020-01-02y"),
        ('secret="it', "it"), ('secret="a\\" b7" x', 'a\\" b7'), ("password=decade", "decade"), ("access-key=a1", "a1"), ("pwd=4111111111111111x", "4111111111111111x"), ("token=secret =x1", "secret"), ("password=" + "aB3$" * 400, "aB3$" * 399 + "aB3"),
    ],
)
def test_whole_secrets(text, value):
    new, spans = Pseudonyms(b"key").replace(text)
    assert [(text[a:b], kind) for a, b, kind in spans] == [(value, "secret")]
    at = text.index(value)
    moved = new[at : at + len(value)]
    assert new == text[:at] + moved + text[at + len(value) :] and moved != value
    assert all(a == b for a, b in zip(value, moved, strict=True) if not a.isalnum())
    assert Pseudonyms(b"key", -1).replace(new)[0] == text


def test_many_assignments_take_linear_time():
    for text in ("token:" * 5_000, "pwd=" * 5_000, "secret='" * 5_000, "password=\\\"" * 5_000):
        new, _ = Pseudonyms(b"key").replace(text)
        assert len(new) == len(text)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op2_feistel_pseudonyms"](spark, FOLDER).collect()
    assert len(got) == len(docs)
    shapes = [r"[\w.]+@mail\d\.example\.com", r"\+1 \(\d{3}\) \d{3}-\d{4}", r"(?:password=|token = \")[0-9a-f]+", r"(?<![\d.])\d+\.\d+\.\d+\.\d+(?![\d.])"]
    seen, linked = 0, {}
    for r in got:
        for shape in shapes:
            was, now = re.findall(shape, docs[r.doc_id]), re.findall(shape, r.text)
            assert len(was) == len(now) and not set(was) & set(now)
            for a, b in zip(was, now, strict=True):
                assert linked.setdefault(a, b) == b
            seen += len(was)
        if not r.n_replaced:
            assert r.text == docs[r.doc_id]
    assert seen > 50 and len(set(linked.values())) == len(linked)


def test_nulls_clashes_and_empty_tables(spark):
    rows = [(1, "mail a.b@c.de", "x", 1), (1, "mail a.b@c.de", "x", 1), (None, None, "x", 2), (3, "", None, None), (4, "+" * 100_000 + "1" * 200_000, "x", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string, start int")
    out = pseudonymised(df, b"k", spans="end")
    assert out.columns == [*df.columns, "end"] and out.count() == 5
    texts = [r.text for r in out.orderBy("doc_id").collect()]
    assert texts[0] is None and texts[1] == texts[2] != rows[0][1] and texts[3] == ""
    assert pseudonymised(df.limit(0), b"k").count() == 0
    with pytest.raises(ValueError):
        pseudonymised(df, b"k", spans="kind")
