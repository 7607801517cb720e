"""Exact top-k inner products by norm order and rotated partial sums.

Vectors are packed into blocks by descending length. The singular vectors of all data rotate
them, so that the first few coordinates hold most of each product. A query keeps its k-th best
score so far; by Cauchy-Schwarz a block, a run of vectors or a single vector is skipped when
its length, or its partial sum plus the product of the residual lengths, cannot reach that
score. What is left is scored with whole numbers, so bounds only ever save work.

A first pass over the block of the longest vectors gives each query its first k-th score; block
pairs that may still beat one are then worked off in parallel, and a window merges their lists.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.llm.tables import table, written

K = 20
SCALE = 64
CANDIDATES = 8192
QUERIES = 1024
RUN = 1024
HEAD_SHARE = 0.8
LEVELS = 32  # steps of block lengths per factor of two

_BLOCK = "block long, longest double, ids binary, times binary, values binary"
_SCORED = "query_id long, vec_id long, score long, times int"
BLOCK_BYTES = 1 << 23


def whole_vectors(df: DataFrame, id_column: str, vector: str, scale: int = SCALE) -> DataFrame:
    """Distinct (id, v, times, norm2) with v = floor(scale * x) and the number of rows that are
    alike; others than finite vectors take no part.

    Rows with a null id take no part either. Shorter vectors count as padded with zeros.
    """
    x = F.col(vector)
    fine = F.coalesce(
        F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf"))), F.lit(False)
    )
    v = F.transform(x, lambda e: F.floor(e.cast("double") * scale))
    rows = df.where(F.col(id_column).isNotNull() & fine).select(F.col(id_column).cast("long").alias("id"), v.alias("v"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e)
    return rows.groupBy("id", "v").agg(F.count("*").alias("times")).withColumn("norm2", norm2)


def _matrix(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _gram(width: int):
    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0).to_pylist(), width).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width * width)), pa.array(total.ravel())], names=["cell", "value"]
        )

    return run


def rotation(vectors: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """(singular vectors as columns, how many leading ones hold ``HEAD_SHARE`` of the energy)."""
    sums = vectors.select("v").mapInArrow(_gram(width), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    gram = np.zeros(width * width)
    for row in sums.collect():  # width squared numbers
        gram[row.cell] = row.value
    energy, axes = np.linalg.eigh(gram.reshape(width, width))
    order = np.argsort(-energy)
    share = np.cumsum(np.maximum(energy[order], 0))
    head = int(np.searchsorted(share, HEAD_SHARE * share[-1]) + 1) if share[-1] > 0 else 1
    return axes[:, order], min(head, width)


def _packed(width: int, size: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        number, ids, times, rows = 0, [], [], []

        def block():
            m = _matrix(rows, width)
            longest = float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max()))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + number], pa.int64()),
                    pa.array([longest]),
                    pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                    pa.array([np.array(times, np.int64).tobytes()], pa.binary()),
                    pa.array([m.tobytes()], pa.binary()),
                ],
                names=["block", "longest", "ids", "times", "values"],
            )

        for batch in batches:
            for i, n, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(i)
                times.append(n)
                rows.append(v)
                if len(ids) == size:
                    yield block()
                    number, ids, times, rows = number + 1, [], [], []
        if ids:
            yield block()

    return run


def _blocks(vectors: DataFrame, width: int, size: int, total: int) -> DataFrame:
    parts = max(1, -(-total // (2 * size)))
    order = [F.col("norm2").desc(), F.col("id")]
    return (
        vectors.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("id", "times", "v")
        .mapInArrow(_packed(width, size), _BLOCK)
    )


class _Side:
    """A block unpacked: ids, whole values, lengths, rotated heads and residual lengths."""

    def __init__(self, ids: bytes, values: bytes, axes: np.ndarray, head: int):
        self.ids = np.frombuffer(ids, np.int64)
        self.whole = np.frombuffer(values, np.int64).reshape(len(self.ids), -1)
        self.real = self.whole.astype(np.float64)
        turned = self.real @ axes
        self.head = turned[:, :head]
        self.rest = np.sqrt((turned[:, head:] ** 2).sum(axis=1))
        self.length = np.sqrt((self.real**2).sum(axis=1))


def _scores(q: _Side, qi: np.ndarray, c: _Side, ci: np.ndarray) -> np.ndarray:
    """Exact products of chosen pairs; doubles are exact below 2^53, 64-bit numbers above."""
    bound = q.length.max() * c.length.max()
    if bound < 2.0**52:
        return np.einsum("ij,ij->i", q.real[qi], c.real[ci]).astype(np.int64)
    return (q.whole[qi] * c.whole[ci]).sum(axis=1)


def best_of_block(q: _Side, c: _Side, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score): the pairs of the block that may be among the top k.

    ``floor``: scores that the k-th result of each query is known to reach.
    """
    floor = floor.astype(np.float64)
    kept: tuple = (np.empty(0, np.int64),) * 3
    slack = 1e-9 * (q.length.max(initial=0) * c.length.max(initial=0)) + 1e-6
    for start in range(0, len(c.ids), RUN):
        run = slice(start, start + RUN)
        live = np.flatnonzero(q.length * c.length[run].max() + slack >= floor)
        if not len(live):
            if (c.length[start:].max() * q.length + slack < floor).all():
                break
            continue
        upper = q.head[live] @ c.head[run].T + q.rest[live][:, None] * c.rest[run][None, :]
        i, j = np.nonzero((upper + slack >= floor[live][:, None]) & (q.ids[live][:, None] != c.ids[run][None, :]))
        i, j = live[i], j + start
        if not len(i):
            continue
        exact = np.concatenate([_scores(q, i[s : s + 65536], c, j[s : s + 65536]) for s in range(0, len(i), 65536)])
        good = exact >= floor[i]
        i, j, exact = (np.concatenate((a, b[good])) for a, b in zip(kept, (i, j, exact), strict=True))
        order = np.lexsort((c.ids[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        begin = np.searchsorted(i, i)
        top = np.arange(len(i)) - begin < k
        kept = i[top], j[top], exact[top]
        last = np.flatnonzero((np.arange(len(i)) - begin)[top] == k - 1)
        floor[kept[0][last]] = np.maximum(floor[kept[0][last]], kept[2][last])
    return kept


def _floors(axes, head: int, k: int, ids: bytes, values: bytes):
    """Adds to each query block the k-th scores that the block of the longest vectors gives."""

    def run(batches):
        c = _Side(ids, values, axes, head)
        for batch in batches:
            out = []
            for row in batch.select(["ids", "values"]).to_pylist():
                q = _Side(row["ids"], row["values"], axes, head)
                floor = np.full(len(q.ids), -np.inf)
                i, _, score = best_of_block(q, c, floor, k)
                full = np.bincount(i, minlength=len(q.ids)) >= k
                low = np.full(len(q.ids), np.inf)
                np.minimum.at(low, i, score)
                floor[full] = low[full]
                need = np.where(q.length > 0, floor / np.maximum(q.length, 1e-300), np.where(floor > 0, np.inf, -np.inf))
                out.append((floor.tobytes(), float(need.min())))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("block"),
                    batch.column("ids"),
                    batch.column("times"),
                    batch.column("values"),
                    pa.array([x[0] for x in out], pa.binary()),
                    pa.array([x[1] for x in out], pa.float64()),
                ],
                names=["qb", "q_ids", "q_times", "q_values", "floor", "need"],
            )

    return run


def _search(axes, head: int, k: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q, c = _Side(row["q_ids"], row["q_values"], axes, head), _Side(row["ids"], row["values"], axes, head)
                i, j, score = best_of_block(q, c, np.frombuffer(row["floor"]), k)
                rows, copies = (np.frombuffer(row[x], np.int64) for x in ("q_times", "times"))
                times = np.minimum(np.minimum(rows[i], k) * np.minimum(copies[j], k), k).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.ids[i]), pa.array(c.ids[j]), pa.array(score), pa.array(times)],
                    names=["query_id", "vec_id", "score", "times"],
                )

    return run


def _level(x) -> F.Column:
    """Lengths in steps; every length of at least x has a level of at least that of x."""
    return F.when(x <= 1e-9, F.lit(-1000)).otherwise(F.floor(F.log2(x) * LEVELS).cast("int"))


def top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = K,
    queries_per_block: int = QUERIES,
    vectors_per_block: int = CANDIDATES,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest products, ties to the smaller vec_id.

    Both sides come from ``whole_vectors``; a query's own id is never its candidate. Repeated rows
    are candidates of their own, and a query that is repeated is asked as often. Scores must fit a
    64-bit number.
    """
    spark = vectors.sparkSession
    vectors = written(vectors, "vectors")
    total, width = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    vectors_per_block = max(1, min(vectors_per_block, BLOCK_BYTES // (8 * (width or 1))))
    empty = spark.createDataFrame([], T.StructType.fromDDL("query_id long, rank int, vec_id long, score long"))
    if not total or not width:
        return empty
    asked = queries.count()
    if not asked:
        return empty
    axes, head = rotation(vectors, width)
    blocks = written(_blocks(vectors, width, vectors_per_block, total), "blocks")
    longest = blocks.orderBy("block").limit(1).first()  # one block, of bounded size
    asking = _blocks(queries, width, queries_per_block, asked).mapInArrow(
        _floors(axes, head, k, bytes(longest.ids), bytes(longest["values"])),
        "qb long, q_ids binary, q_times binary, q_values binary, floor binary, need double",
    )
    asking = written(asking, "queries")
    # Block pairs by length: a query block meets the levels that can still reach one of its floors.
    levels = blocks.select("block", _level(F.col("longest")).alias("level"))
    highest = levels.agg(F.max("level")).first()[0]
    wanted = asking.select(
        "qb", F.when(F.col("need") > 0, _level(F.col("need") * (1 - 1e-9))).otherwise(-1000).alias("low")
    ).where(F.col("low") <= highest)
    lengths = F.when(F.col("low") <= -1000, F.concat(F.array(F.lit(-1000)), F.sequence(F.lit(-999), F.lit(highest)))).otherwise(
        F.sequence("low", F.lit(highest))
    ) if highest > -1000 else F.array(F.lit(-1000))
    pairs = wanted.select("qb", F.explode(lengths).alias("level")).join(levels, "level").select("qb", "block")
    work = pairs.repartition("qb", "block").join(asking, "qb").join(blocks.select("block", "ids", "times", "values"), "block")
    names = ["q_ids", "q_times", "q_values", "floor", "ids", "times", "values"]
    found = work.select(*names).mapInArrow(_search(axes, head, k), _SCORED)
    found = found.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("times"))))  # k at most
    ranked = found.selectExpr(
        "query_id", "CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank", "vec_id", "score"
    )
    return ranked.where(F.col("rank") <= k)


def op6_norm_sorted_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = written(whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "whole")
    return top_k(vectors.where("id % 20 = 0"), vectors)


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
    vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
