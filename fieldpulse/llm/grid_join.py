"""Near copies among vectors by an epsilon grid order join.

Unit vectors with a cosine of at least s lie within eps = sqrt(2 - 2s). Their coordinates on the
leading principal axes, in steps of eps, are cells of a grid; all vectors are sorted by cells,
the first axis first, and cut into intervals. The sorted sequence is joined with itself: a pair
of intervals whose boxes are farther apart than eps is dropped, any other is replaced by the
pairs of their parts. Spark descends a tree of intervals to pairs of blocks, by joins on the
parent only; a task goes on inside its pair of blocks down to runs of ``RUN`` vectors. There the
leading coordinates and the lengths of the rest bound each cosine, and what may reach s is
computed in double precision.

Copies of a vector are one class; runs return the number of links and one connection for each
class, never pairs, so groups of any size stay small. Boxes drop what principal axes tell apart;
vectors spread alike over all axes still meet all others, in matrix products.

Rows. Vectors that are null, zero, empty or hold null or non-finite components link with nothing;
shorter vectors count as padded with zeros. Repeated rows are rows of their own and link with
each other. A null id takes part in links; its component is the smallest id that is not null, and
null where there is none. An empty table gives no rows. Other columns are not looked at. The
covariance of the axes, width squared numbers, goes through the driver; the principal axes go to
the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.llm.components import components
from fieldpulse.llm.tables import matched, table, written

COSINE = 0.95
AXES = 8  # sort the vectors
HEAD = 16  # bound the cosines
BLOCK, BLOCK_BYTES = 8192, 1 << 22
RUN = 1024
FAN = 8
DENSE = 0.02
NO_ID = (1 << 63) - 1

_ROWS = "id long, width int, bytes binary"
_FOUND = "c long, links long, root long"


# ---- vectors


def _usable(kind: np.dtype):
    """(id, width, bytes) of each row; bytes are null where the vector takes no part."""

    def run(batches):
        for batch in batches:
            out, sizes = [], []
            for vector in batch.column(1):
                packed = None
                if vector.is_valid and not vector.values.null_count and len(vector.values):
                    x = vector.values.to_numpy(zero_copy_only=False).astype(kind)
                    if np.isfinite(x).all() and x.any():
                        packed = (x + kind.type(0)).tobytes()  # makes -0.0 a 0.0
                out.append(packed)
                sizes.append(0 if packed is None else len(packed) // kind.itemsize)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())],
                names=["id", "width", "bytes"],
            )

    return run


def unit(rows: list[bytes], kind: np.dtype, width: int) -> np.ndarray:
    """Vectors of length one, in double precision; powers of two keep the squares in range."""
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        x = np.frombuffer(row, kind).astype(np.float64)
        out[i, : len(x)] = x
    _, e = np.frexp(np.abs(out).max(axis=1, initial=0))
    out = np.ldexp(out, -e[:, None])
    return out / np.sqrt((out**2).sum(axis=1))[:, None]


def _moments(kind: np.dtype, width: int):
    def run(batches):
        total = np.zeros((width + 1, width))
        for batch in batches:
            u = unit(batch.column(0).to_pylist(), kind, width)
            total[0] += u.sum(axis=0)
            total[1:] += u.T @ u
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "value"]
        )

    return run


class Axes:
    """Principal axes of unit vectors around their mean; distances stay what they are."""

    def __init__(self, moments: np.ndarray, n: int):
        self.mean = moments[0] / n
        energy, axes = np.linalg.eigh(moments[1:] / n - np.outer(self.mean, self.mean))
        self.axes = axes[:, np.argsort(-energy, kind="stable")]

    def turned(self, u: np.ndarray) -> np.ndarray:
        return (u - self.mean) @ self.axes


def principal(classes: DataFrame, kind: np.dtype, width: int, n: int) -> Axes:
    sums = classes.select("bytes").mapInArrow(_moments(kind, width), "cell long, value double")
    moments = np.zeros((width + 1) * width)
    for row in sums.groupBy("cell").agg(F.sum("value").alias("value")).collect():  # width squared numbers
        moments[row.cell] = row.value
    return Axes(moments.reshape(width + 1, width), n)


# ---- intervals


def _celled(kind: np.dtype, width: int, axes: Axes, eps: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            y = axes.turned(unit(batch.column("bytes").to_pylist(), kind, width))[:, :AXES]
            cells = np.floor(y / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(cells[:, d].copy()) for d in range(cells.shape[1]))],
                names=[*batch.schema.names, *(f"g{d}" for d in range(cells.shape[1]))],
            )

    return run


def _blocked(kind: np.dtype, width: int, axes: Axes, most: int):
    """Blocks of a sorted partition: its number, the block's, the box, and what is in it."""
    n_axes = min(AXES, width)

    def run(batches):
        part = TaskContext.get().partitionId()
        number, c, m, body = 0, [], [], []

        def block():
            y = axes.turned(unit(body, kind, width))[:, :n_axes]
            box = [*y.min(axis=0), *y.max(axis=0)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int64()),
                    pa.array([(part << 32) + number], pa.int64()),
                    *(pa.array([x], pa.float64()) for x in box),
                    pa.array([np.array(c, np.int64).tobytes()], pa.binary()),
                    pa.array([np.array(m, np.int64).tobytes()], pa.binary()),
                    pa.array([body], pa.list_(pa.binary())),
                ],
                names=["parent", "node", *_box(n_axes), "c", "m", "rows"],
            )

        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("c", "m", "bytes")), strict=True):
                for into, x in zip((c, m, body), row, strict=True):
                    into.append(x)
                if len(c) == most:
                    yield block()
                    number, c, m, body = number + 1, [], [], []
        if c:
            yield block()

    return run


def _box(n_axes: int) -> list[str]:
    return [f"lo{d}" for d in range(n_axes)] + [f"hi{d}" for d in range(n_axes)]


def _near(n_axes: int, eps: float) -> str:
    """The boxes of a and b are no farther apart than eps."""
    gap = "greatest(0D, a.lo{0} - b.hi{0}, b.lo{0} - a.hi{0})"
    return " + ".join(f"pow({gap.format(d)}, 2)" for d in range(n_axes)) + f" <= {eps**2 + 1e-9}"


def block_pairs(blocks: DataFrame, parts: int, n_axes: int, eps: float) -> DataFrame:
    """(a, b), a <= b: pairs of blocks whose boxes, and those of all intervals above, are near."""
    box = _box(n_axes)
    level = blocks.select("parent", "node", *box)
    tree = [level]
    while parts > 0:
        ends = [(F.min if x.startswith("lo") else F.max)(x).alias(x) for x in box]
        level = level.groupBy(F.col("parent").alias("node")).agg(*ends)
        level = level.withColumn("parent", F.expr(f"node div {FAN}"))
        tree.append(level)
        parts = 0 if parts == 1 else -(-parts // FAN)
    pairs = tree.pop().select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(tree):
        one, two = level.alias("a"), level.alias("b")
        pairs = pairs.alias("p").join(one, F.expr("p.a = a.parent")).join(two, F.expr("p.b = b.parent"))
        pairs = pairs.where(F.expr("a.node <= b.node")).where(_near(n_axes, eps))
        pairs = pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    return pairs


# ---- inside a pair of blocks


class Side:
    """A block unpacked, with the boxes of its runs."""

    def __init__(self, c: bytes, m: bytes, rows: list[bytes], kind: np.dtype, width: int, axes: Axes):
        self.c, self.m = np.frombuffer(c, np.int64), np.frombuffer(m, np.int64)
        self.u = unit(rows, kind, width)
        y = axes.turned(self.u)
        self.head = y[:, :HEAD]
        self.rest = np.sqrt((y[:, HEAD:] ** 2).sum(axis=1))
        self.half = (y**2).sum(axis=1) / 2
        starts = range(0, len(self.c), RUN)
        self.low = np.array([y[s : s + RUN, :AXES].min(axis=0) for s in starts])
        self.high = np.array([y[s : s + RUN, :AXES].max(axis=0) for s in starts])

    def run(self, i: int) -> slice:
        return slice(i * RUN, min((i + 1) * RUN, len(self.c)))


def _linked(a: Side, i: slice, b: Side, j: slice, cosine: float) -> np.ndarray:
    """Which vectors of two runs are linked."""
    upper = a.head[i] @ b.head[j].T
    upper += np.outer(a.rest[i], b.rest[j])
    upper -= a.half[i][:, None]
    upper -= b.half[j][None, :]
    may = upper >= cosine - 1 - 1e-9
    x, y = np.nonzero(may)
    if len(x) > DENSE * may.size:
        return a.u[i] @ b.u[j].T >= cosine
    found = np.zeros(may.shape, bool)
    if len(x):
        found[x, y] = np.einsum("ij,ij->i", a.u[i][x], b.u[j][y]) >= cosine
    return found


def _joined(found: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest labels that links spread over both sides."""
    top = np.iinfo(np.int64).max
    while True:
        new = np.minimum(left, np.where(found, right[None, :], top).min(axis=1))
        out = np.minimum(right, np.where(found, new[:, None], top).min(axis=0))
        if (new == left).all() and (out == right).all():
            return left, right
        left, right = new, out


def join_blocks(a: Side, b: Side, same: bool, cosine: float, eps: float):
    """(c, links, root) of the classes with links between two blocks, or within one."""
    links = [np.zeros(len(a.c), np.int64), np.zeros(len(b.c), np.int64)]
    edges: list[np.ndarray] = []
    place = np.arange(len(a.c)), np.arange(len(b.c)) + (0 if same else len(a.c))

    def meet(i: range, j: range) -> None:
        if same and j.stop <= i.start:
            return
        low, high = a.low[i.start : i.stop].min(axis=0), a.high[i.start : i.stop].max(axis=0)
        gap = np.maximum(low - b.high[j.start : j.stop].max(axis=0), b.low[j.start : j.stop].min(axis=0) - high)
        if (np.maximum(gap, 0) ** 2).sum() > eps**2 + 1e-9:
            return
        if len(i) == len(j) == 1:
            touch(i.start, j.start)
        elif len(i) >= len(j):
            middle = (i.start + i.stop) // 2
            meet(range(i.start, middle), j)
            meet(range(middle, i.stop), j)
        else:
            middle = (j.start + j.stop) // 2
            meet(i, range(j.start, middle))
            meet(i, range(middle, j.stop))

    def touch(i: int, j: int) -> None:
        if same and j < i:
            return
        x, y = a.run(i), b.run(j)
        found = _linked(a, x, b, y, cosine)
        if same and i == j:
            np.fill_diagonal(found, False)
        rows, columns = np.flatnonzero(found.any(axis=1)), np.flatnonzero(found.any(axis=0))
        if not len(rows):
            return
        found = found[np.ix_(rows, columns)]
        links[0][x.start + rows] += found @ b.m[y][columns]
        if not (same and i == j):  # a run that meets itself has both directions already
            links[0 if same else 1][y.start + columns] += a.m[x][rows] @ found
        left, right = place[0][x][rows], place[1][y][columns]
        for own, root in zip((left, right), _joined(found, left, right), strict=True):
            edges.append(np.stack([own, root], axis=1))

    meet(range(len(a.low)), range(len(b.low)))
    c = a.c if same else np.concatenate((a.c, b.c))
    count = links[0] if same else np.concatenate(links)
    label = np.arange(len(c))
    pairs = np.concatenate(edges) if edges else np.empty((0, 2), np.int64)
    while True:
        low = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        new = label.copy()
        np.minimum.at(new, pairs[:, 0], low)
        np.minimum.at(new, pairs[:, 1], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(count)
    return c[own], count[own], c[label[own]]


def _work(kind: np.dtype, width: int, axes: Axes, cosine: float, eps: float):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}
                same = row["a"] == row["b"]
                a = Side(row["ca"], row["ma"], row["ra"], kind, width, axes)
                b = a if same else Side(row["cb"], row["mb"], row["rb"], kind, width, axes)
                found = join_blocks(a, b, same, cosine, eps)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["c", "links", "root"])

    return run


def class_links(classes: DataFrame, kind: np.dtype, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(c, links, root) for ``classes`` (c, m, width, bytes): by pair of blocks, the vectors that a
    class is linked with, copies counted, and a class that its links lead to."""
    spark = classes.sparkSession
    total, width = classes.agg(F.count("*"), F.max("width")).first()
    if not total:
        return spark.createDataFrame([], T.StructType.fromDDL(_FOUND))
    eps = float(np.sqrt(2 - 2 * cosine))
    axes = principal(classes, kind, width, total)
    block = max(1, min(block, BLOCK_BYTES // (width * kind.itemsize)))
    parts = max(1, -(-total // (2 * block)))
    n_axes = min(AXES, width)
    cells = [f"g{d}" for d in range(n_axes)]
    schema = "c long, m long, bytes binary, " + ", ".join(f"{g} int" for g in cells)
    order = [*cells, "c"]
    celled = classes.select("c", "m", "bytes").mapInArrow(_celled(kind, width, axes, eps), schema)
    ordered = celled.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = "parent long, node long, " + ", ".join(f"{x} double" for x in _box(n_axes))
    schema += ", c binary, m binary, rows array<binary>"
    blocks = ordered.select("c", "m", "bytes").mapInArrow(_blocked(kind, width, axes, block), schema)
    blocks = written(blocks, "blocks")
    highest = blocks.agg(F.max("parent")).first()[0]
    pairs = written(block_pairs(blocks, highest + 1, n_axes, eps), "block-pairs")
    one = blocks.selectExpr("node AS a", "c AS ca", "m AS ma", "rows AS ra")
    two = blocks.selectExpr("node AS b", "c AS cb", "m AS mb", "rows AS rb")
    # A block that meets itself is sent once.
    own = pairs.where("a = b").join(one, "a")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("cb", "binary"), ("mb", "binary"), ("rb", "array<binary>"))]
    names = ["a", "b", "ca", "ma", "ra", "cb", "mb", "rb"]
    other = pairs.where("a < b").join(one, "a").join(two, "b")
    run = _work(kind, width, axes, cosine, eps)
    return own.select(*names[:5], *none).mapInArrow(run, _FOUND).unionByName(other.select(*names).mapInArrow(run, _FOUND))


def near_vectors(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``df``: id, n_links, component_id, kept."""
    single = isinstance(df.schema[vector].dataType.elementType, T.FloatType)
    kind = np.dtype("<f4" if single else "<f8")
    plain = df.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(vector).cast("array<float>" if single else "array<double>").alias("v"),
    )
    # Padding does not make another vector: the class key leaves zeros at the end out.
    rows = plain.mapInArrow(_usable(kind), _ROWS)
    rows = written(rows.withColumn("key", F.unhex(F.sha2("bytes", 256))), "vectors")
    classes = rows.where("bytes IS NOT NULL").groupBy("key", "width", "bytes")
    classes = classes.agg(F.count("*").alias("m"), F.min("id").alias("id"))
    classes = written(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    found = written(class_links(classes, kind, cosine, block), "links")
    counts = found.groupBy("c").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("c").alias("a"), F.col("root").alias("b")))
    named = classes.select("c", "key", "m", "id").join(counts, "c", "left")
    named = named.join(linked.toDF("c", "component"), "c", "left")
    named = written(named.withColumn("component", F.coalesce("component", "c")), "named")
    lowest = named.groupBy("component").agg(F.min("id").alias("low"), F.count("*").alias("times"))
    named = matched(named, lowest, "component", "times")
    named = named.select("key", "m", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "low")
    good = matched(rows.where("key IS NOT NULL").select("id", "key"), written(named, "results"), "key", "m")
    bad = rows.where("key IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("low"))
    null = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    result = good.select("id", "n_links", "low").unionByName(bad)
    result = result.select(null("id").alias(id_column), "n_links", null("low").alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(False)))


def op12_grid_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
g AS (
    SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM v
    WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
e AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id
    WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.95),
r AS (SELECT a AS start, b AS reached FROM e UNION SELECT r.start, e.b FROM r JOIN e ON r.reached = e.a),
l AS (SELECT start, min(reached) AS low FROM r GROUP BY start),
k AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT v.vec_id, coalesce(k.n, 0) AS n_links, least(v.vec_id, coalesce(l.low, v.vec_id)) AS component_id,
    v.vec_id = least(v.vec_id, coalesce(l.low, v.vec_id)) AS kept
FROM v LEFT JOIN k ON k.a = v.vec_id LEFT JOIN l ON l.start = v.vec_id
"""
