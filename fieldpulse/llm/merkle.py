"""Merkle manifest of a data set as logs of nodes in postorder.

Each source is a tree of runs of ``FAN`` consecutive nodes; the sources' roots are the leaves of
one more tree. A tree is built by aligned builders: a builder takes ``FAN ** DEPTH`` consecutive
nodes, starting at a multiple of that, and appends each node to its log when the last leaf below
it has come. Its log is a segment; the last entries of the segments are the leaves of the next
pass, until one node is left.

In such a log the place of a node needs no index: before it come all nodes that were complete
when its first leaf came (``begun``) and the rest of its own subtree (``subtree``). ``place`` is
that closed form, and proofs read siblings from the segments by it, top segments first, each
handing its path down to the segments below. The same form gives a node's place in the log of
its whole source.

Rows. Null fields are hashed as ``-``. Rows with a null doc_id come first in their source, those
with equal doc_ids follow the order of their leaves; repeated rows are leaves of their own. An
empty table has no nodes, no segments and no proofs. Other columns, whatever their names, are not
looked at. Texts are hashed whole by Spark itself; only digests move.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm.tables import table, written

FAN = 3
DEPTH = 7
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_SEGMENT = "tree string, block long, leaves long, nodes long, log string"
_PATH = "tree string, at long, subroot string, lefts array<string>, rights array<string>"
_PROOF = "doc_id long, tree string, at long, leaf string, subroot string, proof_sha256 string, folded_root string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# ---- closed forms


def levels(leaves: int) -> int:
    """Levels above the leaves of a tree: the least h with FAN ** h >= leaves."""
    h, reach = 0, 1
    while reach < leaves:
        h, reach = h + 1, reach * FAN
    return h


def subtree(leaves: int, level: int) -> int:
    """Nodes below and at a node of this level with so many leaves."""
    return sum(-(-leaves // FAN**i) for i in range(level + 1))


def begun(leaf: int, height: int) -> int:
    """Nodes of a tree that are complete before its leaf of this number comes."""
    return sum(leaf // FAN**i for i in range(height + 1))


@lru_cache(maxsize=1 << 16)
def place(level: int, number: int, leaves: int, height: int) -> int:
    """Postorder place of the node with this number in its level, in a tree of so many leaves."""
    first = number * FAN**level
    own = min(FAN**level, leaves - first)
    return begun(first, height) + subtree(own, level) - 1


@lru_cache(maxsize=1 << 14)
def siblings(leaf: int, leaves: int, height: int) -> list[tuple[list[int], list[int]]]:
    """For each level from a leaf to the root: the places of the siblings left and right."""
    found = []
    for level in range(height):
        node, count = leaf // FAN**level, -(-leaves // FAN**level)
        run = node // FAN * FAN
        at = lambda i, level=level: place(level, i, leaves, height)
        found.append(
            ([at(i) for i in range(run, node)], [at(i) for i in range(node + 1, min(run + FAN, count))])
        )
    return found


def segment_height(nodes: int, depth: int) -> int:
    """Levels that a segment adds, where its tree has so many nodes on the segment's lowest level."""
    return min(depth, levels(nodes))


# ---- building


def leaf_digest(replaced: dict[str, F.Column] | None = None) -> F.Column:
    """The digest of a row; ``replaced`` gives other values for some fields."""
    parts = []
    for name in FIELDS:
        value = (replaced or {}).get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


class Log:
    """Nodes of one segment in the order of their completion."""

    def __init__(self, leaves: int, height: int):
        self.leaves, self.height = leaves, height
        self.open: list[list[str]] = [[] for _ in range(self.height + 1)]
        self.nodes: list[str] = []
        self.seen = 0

    def append(self, leaf: str) -> None:
        self.seen += 1
        level, node, last = 0, leaf, self.seen == self.leaves
        self.nodes.append(node)
        while level < self.height:
            run = self.open[level]
            run.append(node)
            if len(run) < FAN and not last:
                return
            node = digest("".join(run))
            run.clear()
            self.nodes.append(node)
            level += 1


def _segments(depth: int):
    """Rows (tree, at, leaves of the tree, digest) in order of (tree, at), as segments."""
    width = FAN**depth

    def done(key, log):
        return pa.RecordBatch.from_arrays(
            [
                pa.array([key[0]], pa.string()),
                pa.array([key[1]], pa.int64()),
                pa.array([log.leaves], pa.int64()),
                pa.array([key[2]], pa.int64()),
                pa.array(["".join(log.nodes)], pa.string()),
            ],
            names=["tree", "block", "leaves", "nodes", "log"],
        )

    def run(batches):
        log = key = None
        for batch in batches:
            for tree, at, n, node in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = (tree, at // width, n)
                if own != key:
                    key, log = own, Log(min(width, n - at // width * width), segment_height(n, depth))
                log.append(node)
                if log.seen == log.leaves:
                    yield done(key, log)

    return run


def built(leaves: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """The passes over trees (tree, at, leaves, digest): tables of segments, the lowest first.

    Columns: tree, block, leaves of the segment, nodes that the tree has on the segment's lowest
    level, and the log: 64 hexadecimal digits for each node. The last pass has one segment for
    each tree; a tree that is complete earlier is handed on by segments of one leaf.
    """
    width = FAN**depth
    passes = []
    while True:
        order = ["tree", "at"]
        dealt = leaves.repartition("tree", F.expr(f"at div {width}")).sortWithinPartitions(*order)
        own = written(dealt.select(*order, "leaves", "digest").mapInArrow(_segments(depth), _SEGMENT), "segments")
        passes.append(own)
        if own.where("block > 0").isEmpty():
            return passes
        leaves = own.select(
            "tree",
            F.col("block").alias("at"),
            F.expr(f"(nodes + {width - 1}) div {width}").alias("leaves"),
            F.right("log", F.lit(HEX)).alias("digest"),
        )


def roots(passes: list[DataFrame]) -> DataFrame:
    """(tree, digest)"""
    return passes[-1].select("tree", F.right("log", F.lit(HEX)).alias("digest"))


def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """``rows`` with ``at``, their number in their tree by ``order``, and ``leaves``, its size.

    Rows are sorted over ranges, so a tree of any size is spread; a tree's offset in each range
    comes from the ranges' counts.
    """
    placed = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    placed = placed.withColumn("place", F.monotonically_increasing_id())
    placed = written(placed.withColumn("part", F.spark_partition_id()), "placed")
    counts = placed.groupBy(tree, "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    counts = counts.selectExpr(
        tree,
        "part",
        f"coalesce(sum(n) OVER (PARTITION BY {tree} ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - first AS shift",
        f"sum(n) OVER (PARTITION BY {tree}) AS leaves",
    )
    found = placed.join(counts, [tree, "part"])
    return found.withColumn("at", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def manifest(rows: DataFrame, depth: int = DEPTH) -> tuple[list[DataFrame], list[DataFrame]]:
    """(passes of the sources' trees, passes of the tree of their roots) of ``numbered`` leaves.

    ``rows``: tree (see ``tree_of``), at, leaves, digest.
    """
    lower = built(rows.select("tree", "at", "leaves", "digest"), depth)
    tops = roots(lower).select(F.lit("").alias("all"), F.col("tree").alias("name"), "digest")
    tops = written(numbered(tops, "all", "name").select("name", "at", "leaves", "digest"), "subroots")
    upper = built(tops.select(F.lit("").alias("tree"), "at", "leaves", "digest"), depth)
    return [*lower, tops], upper


def tree_of(source: str = "source") -> F.Column:
    """A source as the name of its tree: the null source first, then by bytes of UTF-8."""
    name = F.col(source).cast("string")
    return F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), name))


# ---- proofs


def _siblings_of(log: str, leaf: int, leaves: int, height: int) -> tuple[list[str], list[str]]:
    """Digests left and right of a leaf's way through its segment."""
    read = lambda places: "".join(log[p * HEX : p * HEX + HEX] for p in places)
    own = siblings(leaf, leaves, height)
    return [read(x) for x, _ in own], [read(y) for _, y in own]


def _paths(depth: int):
    """Rows (tree, block, leaves, nodes, log, subroot, lefts, rights): a row per leaf."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                left, right, n = [], [], row["leaves"]
                for leaf in range(n):
                    x, y = _siblings_of(row["log"], leaf, n, segment_height(row["nodes"], depth))
                    left.append(x + row["lefts"])
                    right.append(y + row["rights"])
                first = row["block"] * FAN**depth
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * n, pa.string()),
                        pa.array(range(first, first + n), pa.int64()),
                        pa.array([row["subroot"]] * n, pa.string()),
                        pa.array(left, pa.list_(pa.string())),
                        pa.array(right, pa.list_(pa.string())),
                    ],
                    names=["tree", "at", "subroot", "lefts", "rights"],
                )

    return run


def _with_way(own: DataFrame, above: DataFrame) -> DataFrame:
    """Segments with the way from their last node to the root."""
    up = above.select("tree", F.col("at").alias("block"), "subroot", "lefts", "rights")
    return own.join(up, ["tree", "block"])


def paths(passes: list[DataFrame], above: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(tree, at, subroot, lefts, rights) for each leaf of the lowest of these passes: digests
    beside its way, level by level.

    ``above``: the same for the trees' roots (at 0), what follows them.
    """
    for own in reversed(passes):
        above = _with_way(own, above).mapInArrow(_paths(depth), _PATH)
    return above


def fold(leaf: str, lefts: list[str], rights: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in zip(lefts, rights, strict=True):
        leaf = digest(left + leaf + right)
    return leaf


def _proved(depth: int):
    """Lowest segments with their rows and the way up: a row per leaf with its proof."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out, first = [], row["block"] * FAN**depth
                height = segment_height(row["nodes"], depth)
                for item in row["rows"]:
                    x, y = _siblings_of(row["log"], item["at"] - first, row["leaves"], height)
                    left, right = x + row["lefts"], y + row["rights"]
                    proof = digest("".join(a + b for a, b in zip(left, right, strict=True)))
                    folded = fold(item["shown"] or item["digest"], left, right)
                    out.append((item["doc_id"], row["tree"], item["at"], item["digest"], row["subroot"], proof, folded))
                kinds = [pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["doc_id", "tree", "at", "leaf", "subroot", "proof_sha256", "folded_root"],
                )

    return run


def checked(docs: DataFrame, tampered: F.Column | None = None, depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs``: its leaf, subroot, root and proof, and the root that its leaf
    gives when ``tampered`` replaces the text.

    Columns: doc_id, tree, at, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    shown = F.lit(None).cast("string")
    if tampered is not None:
        shown = F.when(~tampered.eqNullSafe(F.col("text")), leaf_digest({"text": tampered}))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        tree_of().alias("tree"),
        leaf_digest().alias("digest"),
        shown.alias("shown"),
        F.monotonically_increasing_id().alias("row"),  # spreads repeated rows
    )
    rows = written(rows, "leaves")
    rows = numbered(rows, "tree", "doc_id", "digest", "shown", "row").drop("row")
    rows = written(rows, "numbered")
    (*lower, tops), upper = manifest(rows, depth)
    # The root is one digest; an empty table has none.
    top = roots(upper).first()
    root = F.lit(top and top.digest).cast("string")
    none = F.array().cast("array<string>")
    start = roots(upper).select(
        "tree", F.lit(0).cast("long").alias("at"), root.alias("subroot"), none.alias("lefts"), none.alias("rights")
    )
    over = paths(upper, start, depth).join(tops.select("at", "name", "digest"), "at")
    over = over.select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("at"), F.col("digest").alias("subroot"), "lefts", "rights"
    )
    over = written(paths(lower[1:], written(over, "over"), depth), "ways")
    items = rows.groupBy("tree", F.expr(f"at div {FAN**depth}").alias("block")).agg(
        F.collect_list(F.struct("at", "doc_id", "digest", "shown")).alias("rows")  # a segment's leaves at most
    )
    found = _with_way(lower[0], over).join(items, ["tree", "block"]).mapInArrow(_proved(depth), _PROOF)
    return found.withColumns({"root": root, "verified": F.col("folded_root") == root})


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return checked(table(spark, sf_dir, "documents"), tampered).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


#: The same tree by recursion over its levels, for tables of any number of sources.
SQL = """
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree,
        CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END AS f1,
        CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END AS f2,
        CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS f3,
        CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS f4,
        CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS f5,
        replace(text, chr(10), '') AS bare,
        list_reduce(flatten([[4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
            lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))]),
            lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END) AS crc
    FROM documents),
l AS (
    SELECT doc_id, tree, sha256(f1 || f2 || f3 || f4 || f5) AS leaf,
        CASE WHEN crc & 1 = 1 AND text_there THEN sha256(f1 || f2 || f3 || f4 || strlen(bare) || ':' || bare)
        END AS other
    FROM (SELECT *, bare IS NOT NULL AS text_there FROM d)),
n AS (
    SELECT doc_id, tree, leaf, coalesce(other, leaf) AS shown,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, other NULLS FIRST) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS size
    FROM l),
t AS (
    SELECT tree, 0 AS level, pos, leaf AS h, size FROM n
    UNION ALL
    SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (size + 2) // 3
    FROM t WHERE size > 1 GROUP BY tree, level, pos // 3, size),
s AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS size FROM t WHERE size = 1),
u AS (
    SELECT 0 AS level, pos, h, size FROM s
    UNION ALL
    SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (size + 2) // 3
    FROM u WHERE size > 1 GROUP BY level, pos // 3, size),
tb AS (
    SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lefts,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS rights
    FROM t a JOIN t b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
    WHERE a.size > 1 GROUP BY a.tree, a.level, a.pos),
ub AS (
    SELECT a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lefts,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS rights
    FROM u a JOIN u b ON a.level = b.level AND a.pos // 3 = b.pos // 3
    WHERE a.size > 1 GROUP BY a.level, a.pos),
c AS (
    SELECT tree, pos AS leaf_pos, 0 AS level, pos, size, '' AS proof, shown AS h FROM n
    UNION ALL
    SELECT c.tree, leaf_pos, c.level + 1, c.pos // 3, (size + 2) // 3, proof || lefts || rights,
        sha256(lefts || h || rights)
    FROM c JOIN tb ON c.tree = tb.tree AND c.level = tb.level AND c.pos = tb.pos WHERE size > 1),
e AS (
    SELECT c.tree, leaf_pos, 0 AS level, s.pos, s.size, proof, c.h FROM c JOIN s ON c.tree = s.tree WHERE c.size = 1
    UNION ALL
    SELECT tree, leaf_pos, e.level + 1, e.pos // 3, (size + 2) // 3, proof || lefts || rights, sha256(lefts || h || rights)
    FROM e JOIN ub ON e.level = ub.level AND e.pos = ub.pos WHERE size > 1)
SELECT n.doc_id, n.leaf, s.h AS subroot, r.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root,
    e.h = r.h AS verified
FROM n JOIN e ON n.tree = e.tree AND n.pos = e.leaf_pos AND e.size = 1 JOIN s ON n.tree = s.tree
JOIN u r ON r.size = 1
"""
