from __future__ import annotations

import glob

import duckdb
import pytest

from fieldpulse.llm import url_trust as ut

RULES = [("allow", "good.org", "/"), ("block", "bad.org", "/"), ("block", "example.com", "/en/"), ("allow", "x.example.com", "/en/")]
SCHEMA = "page_id long, url string, html string, host string, trust string"


def page(i, url, *links):
    html = "".join(f"<a class=x HREF = '{x}'>y</a>" for x in links)
    return (i, url, html, "clash", "clash")


ROWS = [
    page(1, "https://good.org/a", "https://friend.net/x", "/local", "//cdn.net/lib.js"),
    page(2, "https://GOOD.org", "http://friend.net"),
    page(3, "http://bad.org/?q=http://good.org/"),
    page(4, "http://linker.net/p", "http://bad.org/x", "http://bad.org/y"),
    page(5, "http://second.net/", "http://linker.net/"),
    page(6, "http://friend.net/#top", "http://friend.net/self"),
    page(7, "http://example.com/en/1"), page(8, "http://example.com/de/1"), page(15, "http://example.com/de/2"),
    page(9, "http://x.example.com/en/1"), page(10, "http://y.example.com/en"),
    page(11, None), page(12, "no scheme/here"), page(13, "http://"), page(14, "a://B.C:80?x://y"),
    page(4, "http://linker.net/p", "http://bad.org/x", "http://bad.org/y"),
]


def brute(rows, rules, rounds):
    import re

    def cut(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        return host.lower(), re.match("[^?#]*", rest[len(host) :])[0]

    def rule(host, path):
        fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        return max(fit, key=lambda r: (len(r[1] + r[2]), r[0] == "block"), default=None)

    at = [(r[0], *cut(r[1]), rule(*cut(r[1])), r[2] or "") for r in rows]
    hosts = {h for _, h, _, _, _ in at if h}
    edges = {}
    for _, h, _, _, html in at:
        for link in re.findall("HREF = '([^']*)'", html):
            to = cut(link)[0] if "://" in link else cut("x:" + link)[0] if link.startswith("//") else ""
            if h and to and to != h:
                edges[h, to] = edges.get((h, to), 0) + 1
    hosts |= {b for _, b in edges}
    seed = {k: {h: sum(r is not None and r[0] == k for _, g, _, r, _ in at if g == h) / max(1, sum(g == h for _, g, _, _, _ in at)) for h in hosts} for k in ("allow", "block")}
    trust, distrust = dict(seed["allow"]), dict(seed["block"])
    for _ in range(rounds):
        t, d = dict(seed["allow"]), dict(seed["block"])
        for (a, b), n in edges.items():
            t[b] += ut.DAMPING * trust[a] * n / sum(m for (x, _), m in edges.items() if x == a)
            d[a] += ut.DAMPING * distrust[b] * n / sum(m for (_, y), m in edges.items() if y == b)
        trust, distrust = t, d
    out = []
    for i, h, p, r, _ in at:
        bad = h in hosts and round(distrust[h], 9) >= ut.LIMIT and round(distrust[h], 9) > round(trust[h], 9)
        out.append((i, h, p, r and r[1] + r[2], r[0] if r else "block" if bad else "allow"))
    return sorted(out, key=repr)


def in_duckdb(rows, rules):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [r[:3] for r in rows])
    return sorted(con.execute(ut._sql(rules)).fetchall(), key=repr)


def test_matches_brute_force_and_sql(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = ut.judged(df, RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    got = sorted((tuple(r) for r in got), key=repr)
    assert got == brute(ROWS, RULES, 400)
    by = {r[0]: r[4] for r in got}
    assert by[4] == by[5] == "block" and by[6] == by[8] == by[11] == "allow"
    assert in_duckdb(ROWS, RULES) == got


RING = [page(i, f"http://one.ring/{'bad/' if i == 20 else ''}{i}", "http://two.ring/") for i in range(20, 26)]
RING += [page(30, "http://two.ring/", "http://one.ring/"), page(31, "http://two.ring/x")]


def test_a_ring_ends_just_above_the_limit(spark):
    """One page of six blocked: after 20 rounds the second host is still below the limit."""
    rules = [("block", "one.ring", "/bad/")]
    got = ut.judged(spark.createDataFrame(RING, SCHEMA), rules).select("page_id", "host", "path", "rule", "verdict")
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    assert got == brute(RING, rules, 400) == in_duckdb(RING, rules)
    assert {r[0]: r[4] for r in got}[31] == "block"
    assert {r[0]: r[4] for r in brute(RING, rules, 20)}[31] == "allow"


def test_rounds_already_read_are_dropped(spark):
    seeds = spark.createDataFrame([("a", 0.5, 0.25), ("b", 0.0, 0.0)], "host string, allowed double, blocked double")
    links = spark.createDataFrame([("a", "b", 1), ("b", "a", 3)], "src string, dst string, links long")
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    tables = lambda: {p for p in glob.glob(f"{root}/**/trust-*", recursive=True)}
    before = tables()
    ut.spread(seeds, links, damping=0.3).collect()
    assert len(tables() - before) == 1


def test_cycles_reach_the_fixed_point(spark):
    seeds = spark.createDataFrame([("a", 0.5, 0.25), ("b", 0.0, 0.0)], "host string, allowed double, blocked double")
    links = spark.createDataFrame([("a", "b", 1), ("b", "a", 3)], "src string, dst string, links long")
    got = {r.host: r for r in ut.spread(seeds, links, damping=0.4).collect()}
    for kind, seed in (("trust", 0.5), ("distrust", 0.25)):
        assert got["a"][kind] == pytest.approx(seed / 0.84, abs=1e-11)
        assert got["b"][kind] == pytest.approx(seed * 0.4 / 0.84, abs=1e-11)
    with pytest.raises(RuntimeError):
        ut.spread(seeds, links, rounds=3)


def test_empty_table(spark):
    assert ut.judged(spark.createDataFrame([], SCHEMA)).count() == 0
