from __future__ import annotations

import zlib
from hashlib import sha256

import pytest

from fieldpulse.llm.merkle import Log, checked, levels, place, subtree
from pyspark.sql import functions as F

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, at string, digest string"


def h(text):
    return sha256(text.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(row):
    return h("".join(map(field, row)))


def up(nodes):
    return [h("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]


def way(nodes, at):
    """(root, siblings, recomputed root as a function of the leaf)"""
    steps = []
    while len(nodes) > 1:
        run = nodes[at // 3 * 3 : at // 3 * 3 + 3]
        steps.append(("".join(run[: at % 3]), "".join(run[at % 3 + 1 :])))
        nodes, at = up(nodes), at // 3
    return nodes[0], steps


def brute(rows):
    trees = {}
    for row in rows:
        i, source, lang, n, text = row
        even = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        other = text.replace("\n", "") if even and text is not None else text
        trees.setdefault(source, []).append((i, leaf(row), leaf((i, source, lang, n, other)), other != text))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for own in trees.values():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[3], x[2]))
    tops = {s: way([x[1] for x in trees[s]], 0)[0] for s in names}
    out = []
    for k, s in enumerate(names):
        for at, (i, own, shown, _) in enumerate(trees[s]):
            _, low = way([x[1] for x in trees[s]], at)
            root, high = way([tops[x] for x in names], k)
            folded = shown
            for a, b in low + high:
                folded = h(a + folded + b)
            proof = h("".join(a + b for a, b in low + high))
            out.append((i, own, tops[s], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    even = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = checked(df, tampered, **options)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.select(*names).collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28, 80, 100])
def test_places_are_the_order_of_completion(n):
    log = Log(n, levels(n))
    names = [str(i) for i in range(n)]
    for x in names:
        log.append(x)
    assert len(log.nodes) == subtree(n, levels(n))
    level, nodes = 0, names
    while True:
        for i, x in enumerate(nodes):
            assert log.nodes[place(level, i, n, levels(n))] == x
        if len(nodes) == 1:
            break
        level, nodes = level + 1, up(nodes)


@pytest.mark.parametrize("depth", [1, 2, 7])
def test_matches_brute_force(spark, depth):
    """With builders of 3, 9 and 2187 leaves; trees of 1 to 100 leaves."""
    rows = [(i, "hot", "en", 3, f"a\n{i}") for i in range(100)]
    rows += [(1000 + i, f"s{i % 7}", None, i, "é\n\n" * i) for i in range(40)]
    rows += [(2000, "é", "de", None, None), (2001, "Z", "de", 0, ""), (2002, "", "", 0, "\n")]
    rows += [(3000 + i, None, "en", 1, "x") for i in range(4)]
    assert run(spark, rows, depth=depth) == brute(rows)


def test_rows_out_of_the_ordinary(spark):
    rows = [(None, "a", "en", 1, "x\n")] * 3 + [(None, "a", "en", 2, None)]
    rows += [(7, "a", None, None, "same\n")] * 4 + [(7, "a", "de", 5, "other\n"), (8, None, None, None, None)]
    rows += [(9, "long", "en", 1, "word\n" * 300_000)]
    got = run(spark, rows)
    assert got == brute(rows)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_one_row_and_no_row(spark):
    rows = [(5, "a", "en", 1, "x")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
