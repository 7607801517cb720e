"""Near-duplicate documents by SetSketch registers.

1. Each text becomes its set of word shingles and the set's registers (``setsketch``). Texts
   with equal sets form one class; the search runs on classes.
2. Bands of register values are bucket keys; classes that meet in a bucket are candidates.
3. Pairs from ordinary buckets are judged by the joint likelihood of their registers; those
   that can plausibly reach the threshold are compared exactly, on full sets.
4. Buckets with more classes than ``MANY`` are merged where they overlap and compared exactly
   in blocks of bounded size, between neighbouring set sizes only. A block returns connections
   (at most one per class), never pairs, so no group is written out as all of its pairs.
5. Components of the links, by joins.

Only step 2 leaves anything to chance: at the threshold of 0.85 a pair agrees in one of 40
bands of 6 registers except once in 10^9 cases.
"""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm import setsketch
from fieldpulse.llm.components import components
from fieldpulse.llm.shingles import mixed, shingle_sets
from fieldpulse.llm.tables import pieces, table, unused, written

BANDS, ROWS = 40, 6
MANY = 64
BLOCK = 512
PIECE = 1 << 21
NO_ID = (1 << 63) - 1  # a null id, which sorts behind all others

_SKETCH = "id long, th long, n long, f1 long, f2 long, regs binary"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _binary(texts: pa.Array) -> pa.Array:
    return texts if pa.types.is_binary(texts.type) else texts.cast(pa.binary())


def _sketch(batches):
    for batch in pieces(batches, PIECE):
        sets = shingle_sets(_binary(batch.column(2)))
        regs = setsketch.registers(sets)
        f1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
        f2 = np.array([mixed(s).sum(dtype=np.uint64) for s in sets], np.uint64)
        n = pa.array([len(s) for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), n, _signed(f1), _signed(f2),
             pa.array([r.tobytes() for r in regs], pa.binary())],
            names=["id", "th", "n", "f1", "f2", "regs"],
        )


def _located(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    """id, a digest that finds the row again, and the text's bytes."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(body).alias("th"),
        body.cast("binary").alias("text"),
    )


def sketches(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per row: id, text digest, set size, set fingerprint, registers."""
    return _located(docs, text, id_column).mapInArrow(_sketch, _SKETCH)


def _classes(sketched: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: c, n, f1, f2, regs, and one document that has it."""
    return (
        sketched.where("n > 0")
        .groupBy("n", "f1", "f2", "regs")
        .agg(F.min("id").alias("id"), F.min_by("th", "id").alias("th"))
        .withColumn("c", F.monotonically_increasing_id())
    )


def _buckets(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, c, size) for the buckets that hold at least two classes."""
    keys = classes.select(
        "c",
        F.explode(
            F.expr(f"transform(sequence(0, {bands - 1}), i -> xxhash64(i, substring(regs, i * {rows} + 1, {rows})))")
        ).alias("key"),
    )
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return keys.join(sizes, "key")


def _plausible(percent: float):
    def judge(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, na, nb = (batch.column(i).to_numpy() for i in range(4))
            ra, rb = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, setsketch.M)
                for i in (4, 5)
            )
            keep = np.zeros(len(a), bool)
            for s in range(0, len(a), 2000):
                at = slice(s, s + 2000)
                _, high = setsketch.similarity_bounds(ra[at], rb[at], na[at], nb[at])
                keep[at] = high * 100 >= percent - 1e-6
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return judge


def _sets(batches):
    for batch in pieces(batches, PIECE):
        sets = shingle_sets(_binary(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["c", "text"]
        )


def _alike(shared, na, nb, percent: float):
    return 100 * shared >= percent * (na + nb - shared)


def _verified(percent: float):
    def verify(batches):
        for batch in pieces(batches, PIECE, "sb"):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            known: OrderedDict[int, np.ndarray] = OrderedDict()
            keep = []
            for i, (x, y) in enumerate(zip(a, b, strict=True)):
                if x not in known:
                    known.clear()
                    known[x] = np.frombuffer(batch.column(2)[i].as_py(), np.uint64)
                one, two = known[x], np.frombuffer(batch.column(3)[i].as_py(), np.uint64)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(_alike(shared, len(one), len(two), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray], span: int = 4096) -> np.ndarray:
    """Sizes of all intersections, as products of membership matrices, some elements at a time."""
    both = [*left, *right]
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    elements, place, times = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    use = times[place] > 1
    owner, place = owner[use], number[place[use]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    found = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int((times > 1).sum()), span):
        i, j = np.searchsorted(place, [start, start + span])
        member = np.zeros((len(both), span), np.float32)
        member[owner[i:j], place[i:j] - start] = 1
        found += member[: len(left)] @ member[len(left) :].T
    return found.astype(np.int64)


def _connected(links: np.ndarray, n: int) -> np.ndarray:
    """The smallest node of each node's component; ``links`` are pairs of node numbers."""
    label = np.arange(n)
    while len(links):
        low = np.minimum(label[links[:, 0]], label[links[:, 1]])
        new = label.copy()
        np.minimum.at(new, links[:, 0], low)
        np.minimum.at(new, links[:, 1], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _compare_block(percent: float):
    def compare(group: pa.Table) -> pa.Table:
        side = group["side"].to_numpy()
        c = group["c"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group["text"].to_pylist()]
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(second):
            second = first
        n = np.array([len(s) for s in sets])
        if len(first) and len(second):
            shared = _shared_counts([sets[i] for i in first], [sets[i] for i in second])
            i, j = np.nonzero(_alike(shared, n[first][:, None], n[second][None, :], percent))
            links = np.stack([first[i], second[j]], axis=1)
        else:
            links = np.empty((0, 2), np.int64)
        label = _connected(links, len(c))
        own = label != np.arange(len(c))
        return pa.table({"a": c[own], "b": c[label[own]]})

    return compare


def _hot_links(hot: DataFrame, sets: DataFrame, percent: float, block: int) -> DataFrame:
    """Connections within the clusters (c, n, cluster), compared block by block."""
    ratio = -math.log(percent / 100.0)
    placed = hot.withColumn("level", F.floor(F.log(F.col("n").cast("double")) / F.lit(ratio * 1.0000001)))
    counts = written(
        placed.groupBy("cluster", "level").agg(F.ceil(F.count("*") / block).alias("parts")), "levels"
    )
    near = (
        counts.join(counts.selectExpr("cluster", "level - 1 AS level", "parts AS above"), ["cluster", "level"], "left")
        .join(counts.selectExpr("cluster", "level + 1 AS level", "parts AS below"), ["cluster", "level"], "left")
    )
    # A class meets its own level and the next one above and below; each pair of blocks once.
    tasks = F.expr(
        """concat(
            transform(sequence(0, parts - 1), j ->
                struct(level AS la, level AS lb, least(i, j) AS i, greatest(i, j) AS j, CAST(i > j AS INT) AS side)),
            CASE WHEN above IS NULL THEN array() ELSE transform(sequence(0, above - 1), j ->
                struct(level AS la, level + 1 AS lb, i AS i, j AS j, 0 AS side)) END,
            CASE WHEN below IS NULL THEN array() ELSE transform(sequence(0, below - 1), j ->
                struct(level - 1 AS la, level AS lb, j AS i, i AS j, 1 AS side)) END)"""
    )
    spread = (
        placed.join(near, ["cluster", "level"])
        .withColumn("i", F.pmod(F.xxhash64("c"), F.col("parts")))
        .select("cluster", "c", F.explode(tasks).alias("t"))
        .select("cluster", "c", "t.*")
    )
    blocks = spread.join(sets, "c").groupBy("cluster", "la", "lb", "i", "j")
    return blocks.applyInArrow(_compare_block(percent), "a long, b long")


def class_links(
    docs: DataFrame,
    classes: DataFrame,
    percent: float = 85,
    text: str = "text",
    id_column: str = "doc_id",
    bands: int = BANDS,
    rows: int = ROWS,
    many: int = MANY,
    block: int = BLOCK,
) -> DataFrame:
    """(a, b): classes whose exact similarity reaches ``percent``, or that such links connect."""
    buckets = written(_buckets(classes, bands, rows), "buckets")
    stars = buckets.where(F.col("size") > many)
    pivots = stars.groupBy("key").agg(F.min("c").alias("b"))
    hot = components(stars.join(pivots, "key").select(F.col("c").alias("a"), "b"))
    hot = written(
        hot.select(F.col("node").alias("c"), F.col("component").alias("cluster"))
        .join(classes.select("c", "n"), "c"),
        "clusters",
    )
    few = buckets.where(F.col("size") <= many).join(hot.select("c", "cluster"), "c", "left")
    few = written(few.select("key", "c", "cluster"), "few")
    pairs = (
        few.toDF("key", "a", "ca")
        .join(few.toDF("key", "b", "cb"), "key")
        .where("a < b AND NOT coalesce(ca = cb, false)")  # a cluster's blocks compare all of its pairs
        .select("a", "b")
        .distinct()
    )
    own = classes.select("c", "n", "regs")
    pairs = pairs.join(own.toDF("a", "na", "ra"), "a").join(own.toDF("b", "nb", "rb"), "b")
    pairs = pairs.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    pairs = pairs.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_plausible(percent), "a long, b long")
    pairs = written(pairs, "plausible")
    needed = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c")))
    needed = needed.unionByName(hot.select("c")).distinct()
    needed = classes.select("c", "id", "th").join(needed, "c")
    found = _located(docs, text, id_column).join(needed, ["id", "th"]).select("c", "text")
    sets = written(found.mapInArrow(_sets, "c long, text binary"), "sets")
    one = sets.select(F.col("c").alias("a"), F.col("text").alias("sa"))
    two = sets.select(F.col("c").alias("b"), F.col("text").alias("sb"))
    exact = pairs.join(two, "b").join(one, "a").select("a", "b", "sa", "sb")
    exact = exact.mapInArrow(_verified(percent), "a long, b long")
    return exact.unionByName(_hot_links(hot, sets, percent, block))


def near_groups(
    docs: DataFrame, percent: float = 85, text: str = "text", id_column: str = "doc_id", **options
) -> DataFrame:
    """One row per row of ``docs``: doc_id, th, n_shingles, component_id, keep_th.

    ``component_id`` is the smallest doc_id that links reach, the row's own included. A null or
    wordless text has no shingles and no links. Rows with a null id take part; a component of
    such rows alone has a null component_id. ``th`` is a digest of the text; with
    ``component_id``, ``keep_th`` names one text of the component, also where an id is repeated.
    """
    sketched = written(sketches(docs, text, id_column), "sketches")
    classes = written(_classes(sketched), "classes")
    links = written(class_links(docs, classes, percent, text, id_column, **options), "links")
    linked = components(links)
    labelled = classes.join(linked.toDF("c", "component"), "c", "left").select(
        "n", "f1", "f2", "id", "th", F.coalesce("component", "c").alias("component")
    )
    lowest = labelled.groupBy("component").agg(
        F.min("id").alias("component_id"), F.min_by("th", "id").alias("keep_th")
    )
    labelled = labelled.join(lowest, "component").select("n", "f1", "f2", "component_id", "keep_th")
    found = sketched.join(labelled, ["n", "f1", "f2"], "left")
    null = lambda c: F.when(c != NO_ID, c)
    return found.select(
        null(F.col("id")).alias("doc_id"),
        "th",
        F.col("n").alias("n_shingles"),
        null(F.coalesce("component_id", "id")).alias("component_id"),
        F.coalesce("keep_th", "th").alias("keep_th"),
    )


def keep_one(docs: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each group of near copies; wordless texts all stay."""
    groups = near_groups(docs, text=text, id_column=id_column, **options).where("n_shingles > 0")
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NO_ID))
    own = [unused(docs.columns, c) for c in ("_id", "_th")]
    marked = groups.select(
        number("doc_id").alias(own[0]),
        F.col("th").alias(own[1]),
        ((number("doc_id") == number("component_id")) & (F.col("th") == F.col("keep_th"))).alias("kept"),
    )
    marked = written(marked.groupBy(*own, "kept").agg(F.count("*").alias("times")), "kept")
    mine = docs.withColumns({own[0]: number(id_column), own[1]: F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    left = mine.join(marked.where("NOT kept").select(*own), own, "left_anti")
    again = marked.where("kept AND times > 1").select(*own)
    if not again.isEmpty():  # rows that repeat the kept row
        once = left.join(again, own, "left_semi").dropDuplicates(own)
        left = left.join(again, own, "left_anti").unionByName(once.select(*left.columns))
    return left.select(*docs.columns)


def op9_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
