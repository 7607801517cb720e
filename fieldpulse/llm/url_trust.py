"""URL verdicts from rules, and from trust that spreads over the link graph of hosts.

A rule names a host and the beginning of a path; the longest rule that fits an address decides.
Where none fits, its host does: the share of a host's pages that the rules allow is its seed of
trust, the share they block its seed of distrust. Trust follows the links (personalised
PageRank), distrust follows them backwards: a host that links to blocked ones becomes suspect.
A host is blocked when its distrust reaches ``LIMIT`` of a fully blocked seed and exceeds its
trust; all others are allowed.

DataFrame functions only. Links are counted per pair of hosts before any shuffle, so a host with
very many pages is one row per neighbour afterwards; joins by host are split by adaptive
execution.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm.tables import dropped, table, written

DAMPING = 0.85
MOST_ROUNDS = 2000  # far more than any graph takes: the change falls by the damping each round
LIMIT = 0.5
CLOSE = 1e-12

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

_LINK = r"""(?i)\b(?:href|src)[ \t\r\n\f]*=[ \t\r\n\f]*["']?([^"'<> \t\r\n\f]+)"""
_HOST, _PATH = "^[^/?#]*", "^[^?#]*"


def host_of(rest: Column) -> Column:
    """The host at the beginning of what follows the scheme."""
    return F.translate(F.regexp_extract(rest, _HOST, 0), string.ascii_uppercase, string.ascii_lowercase)


def located(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host and path; both are empty for a null or an address without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    tail = F.substring(rest, F.length(F.regexp_extract(rest, _HOST, 0)) + 1, F.length(rest))
    return pages.withColumns({"host": host_of(rest), "path": F.regexp_extract(tail, _PATH, 0)})


def ruled(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Located pages with rule and rule_verdict, null where no rule fits.

    Of rules of one length, a blocking one wins.
    """
    order = sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block"), reverse=True)
    rule = verdict = F.lit(None).cast("string")
    for kind, host, path in reversed(order):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return pages.withColumns({"rule": rule, "rule_verdict": verdict})


def host_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(src, dst, links) between different hosts, from the href and src attributes of the pages."""
    links = pages.select(
        F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(1))).alias("link")
    )
    at = F.instr("link", "://")
    rest = F.when(at > 0, F.substring(F.col("link"), at + 3, F.length("link"))).when(
        F.col("link").startswith("//"), F.substring(F.col("link"), F.lit(3), F.length("link"))
    )
    pairs = links.select("src", host_of(rest).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst")
    return pairs.groupBy("src", "dst").agg(F.count("*").alias("links"))


def spread(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = MOST_ROUNDS) -> DataFrame:
    """(host, trust, distrust) at their fixed point; 1 stands for a full seed alone.

    Ends when no value changes by more than ``CLOSE``, relative to it where it is above 1; an error
    if ``rounds`` rounds do not get there.

    ``seeds``: host, allowed, blocked (shares from 0 to 1). Hosts that are only linked to start
    with no seed.
    """
    out = links.groupBy("src").agg(F.sum("links").alias("of_src"))
    into = links.groupBy("dst").agg(F.sum("links").alias("of_dst"))
    edges = links.join(out, "src").join(into, "dst")
    edges = written(
        edges.select(
            "src",
            "dst",
            (F.col("links") / F.col("of_src")).alias("ahead"),
            (F.col("links") / F.col("of_dst")).alias("back"),
        ),
        "edges",
    )
    outside = edges.select(F.col("dst").alias("host")).distinct().join(seeds, "host", "left_anti")
    seeds = seeds.select("host", "allowed", "blocked").unionByName(
        outside.select("host", F.lit(0.0).alias("allowed"), F.lit(0.0).alias("blocked"))
    )
    seeds = written(seeds, "seeds")
    state = seeds.select("host", F.col("allowed").alias("trust"), F.col("blocked").alias("distrust"))
    if edges.isEmpty():
        return state
    read = None  # the table of the round before
    for _ in range(rounds):
        sent = (
            edges.join(state, edges.src == state.host)
            .select(F.col("dst").alias("host"), (F.col("trust") * F.col("ahead")).alias("t"), F.lit(0.0).alias("d"))
            .unionByName(
                edges.join(state, edges.dst == state.host).select(
                    F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("back")).alias("d")
                )
            )
        )
        got = sent.groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
        new = (
            seeds.join(got, "host", "left")
            .join(state, "host")
            .select(
                "host",
                (F.col("allowed") + damping * zero("t")).alias("trust"),
                (F.col("blocked") + damping * zero("d")).alias("distrust"),
                F.col("trust").alias("was_t"),
                F.col("distrust").alias("was_d"),
            )
        )
        new = written(new, "trust")
        if read is not None:
            dropped(read)  # only ``new`` still reads from here on
        change = F.expr("greatest(abs(trust - was_t) / greatest(trust, 1), abs(distrust - was_d) / greatest(distrust, 1))")
        moved = new.agg(F.max(change)).first()[0]
        read, state = new, new.select("host", "trust", "distrust")
        if moved is None or moved <= CLOSE:
            return state
    raise RuntimeError(f"trust still moves by {moved} after {rounds} rounds")


def judged(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    url: str = "url",
    html: str = "html",
    limit: float = LIMIT,
    rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict, trust and distrust of the host.

    Every row gets one verdict, repeated rows and null addresses too. Pages without a host have
    neither seeds nor links.
    """
    names = {"host", "path", "rule", "verdict", "rule_verdict", "trust", "distrust"}
    own = pages.drop(*[c for c in pages.columns if c in names and c not in (url, html)])
    marked = ruled(located(own, url), rules)
    share = lambda kind: F.avg(F.coalesce((F.col("rule_verdict") == kind).cast("double"), F.lit(0.0)))
    seeds = marked.where("host <> ''").groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked"))
    hosts = spread(seeds, host_links(marked, html), rounds=rounds)
    scored = marked.join(hosts, "host", "left")
    bad = (F.round("distrust", 9) >= limit) & (F.round("distrust", 9) > F.round("trust", 9))
    verdict = F.coalesce("rule_verdict", F.when(bad, "block").otherwise("allow"))
    return scored.withColumn("verdict", verdict).drop("rule_verdict")


def op8_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql(rules=RULES) -> str:
    """The statement goes on to the same fixed point, round by round, in a recursive table.

    A round carries the greatest change of all hosts with it, which ends the recursion."""
    order = sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block"), reverse=True)
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in order)
    kind = " ".join(f"WHEN {fits(h, p)} THEN '{k}'" for k, h, p in order)
    lower = lambda x: f"translate(regexp_extract({x}, '{_HOST}'), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    link = _LINK.replace("'", "''")
    return f"""
WITH RECURSIVE cut AS (SELECT page_id, html,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
placed AS (SELECT page_id, html, {lower("rest")} AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '{_HOST}')) + 1), '{_PATH}') AS path FROM cut),
m AS (SELECT *, CASE {rule} END AS rule, CASE {kind} END AS kind FROM placed),
refs AS (SELECT host AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM m),
goals AS (SELECT src, {lower('''CASE WHEN instr(link, '://') > 0 THEN substr(link, instr(link, '://') + 3)
    WHEN starts_with(link, '//') THEN substr(link, 3) END''')} AS dst FROM refs),
pairs AS (SELECT src, dst, count(*) AS links FROM goals WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
edges AS (SELECT src, dst, links::DOUBLE AS links, sum(links) OVER (PARTITION BY src) AS of_src,
    sum(links) OVER (PARTITION BY dst) AS of_dst FROM pairs),
own AS (SELECT host, avg(CASE kind WHEN 'allow' THEN 1.0::DOUBLE ELSE 0 END) AS allowed,
    avg(CASE kind WHEN 'block' THEN 1.0::DOUBLE ELSE 0 END) AS blocked FROM m WHERE host <> '' GROUP BY host),
nodes AS (SELECT * FROM own UNION ALL
    SELECT DISTINCT dst, 0.0::DOUBLE, 0.0::DOUBLE FROM edges WHERE dst NOT IN (SELECT host FROM own)),
spreads AS (
    SELECT 0 AS step, host, allowed AS trust, blocked AS distrust, 1.0::DOUBLE AS moved FROM nodes
    UNION ALL
    SELECT step + 1, host, trust, distrust, max(greatest(abs(trust - was_t) / greatest(trust, 1.0),
        abs(distrust - was_d) / greatest(distrust, 1.0))) OVER ()
    FROM (SELECT p.step, n.host, n.allowed + {DAMPING} * coalesce(a.t, 0) AS trust,
            n.blocked + {DAMPING} * coalesce(z.d, 0) AS distrust, p.trust AS was_t, p.distrust AS was_d
        FROM spreads p JOIN nodes n ON n.host = p.host
        LEFT JOIN (SELECT e.dst AS host, sum(s.trust * e.links / e.of_src) AS t
            FROM edges e JOIN spreads s ON s.host = e.src GROUP BY e.dst) a ON a.host = n.host
        LEFT JOIN (SELECT e.src AS host, sum(s.distrust * e.links / e.of_dst) AS d
            FROM edges e JOIN spreads s ON s.host = e.dst GROUP BY e.src) z ON z.host = n.host
        WHERE p.moved > {CLOSE})),
fixed AS (SELECT host, trust, distrust FROM spreads WHERE step = (SELECT max(step) FROM spreads))
SELECT m.page_id, m.host, m.path, m.rule, coalesce(m.kind, CASE WHEN round(s.distrust, 9) >= {LIMIT}
    AND round(s.distrust, 9) > round(s.trust, 9) THEN 'block' ELSE 'allow' END) AS verdict
FROM m LEFT JOIN fixed s ON s.host = m.host
"""


SQL = _sql()
