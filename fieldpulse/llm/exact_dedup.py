"""Exact de-duplication by naming blocks.

Each text is cut into blocks of a fixed number of bytes. Equal blocks get one integer name, by
sorting the distinct blocks. Then adjacent pairs of names are named in the same way, again and
again, until one name is left for each text. Names never come from a digest alone, so two
texts have one identity exactly when they are equal.

A digest only routes a block to its name: where two different blocks share one, the rank of the
contents decides. So the text is shuffled once, as its distinct blocks; all later rounds move
integers, and each round halves what is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm.tables import table, unused, written

BLOCK = 4096
LOWEST = -(1 << 63)  # stands for a null id in joins and comparisons


def _cut(body: str, block: int) -> str:
    """SQL: the blocks of a binary column; an empty one has one empty block."""
    return (
        f"transform(sequence(0L, greatest(CAST(ceil(length({body}) / {block}.0D) AS BIGINT), 1L) - 1L), "
        f"i -> substring({body}, CAST(i * {block} + 1 AS INT), {block}))"
    )


def _block_names(plain: DataFrame, rows: DataFrame, block: int, digest) -> DataFrame:
    """(row, n, pos, name): the names of the n blocks of each row."""
    blocks = plain.select(F.explode(F.expr(_cut("body", block))).alias("block")).select(
        digest(F.col("block")).alias("h"), "block"
    )
    sorted_blocks = blocks.select("h", "block").distinct().sortWithinPartitions("block")
    names = written(
        sorted_blocks.select("h", F.monotonically_increasing_id().alias("name")), "block-names"
    )
    of_digest = names.groupBy("h").agg(F.min("name").alias("name"), F.count("*").alias("times"))
    places = rows.select("row", F.size("hs").alias("n"), F.posexplode("hs").alias("pos", "h"))
    named = places.join(of_digest.where("times = 1").select("h", "name"), "h")
    named = named.select("row", "n", "pos", "name")
    shared = written(of_digest.where("times > 1").select("h"), "shared-digests")
    if shared.isEmpty():
        return named
    # Different blocks with one digest: the k-th content in order takes the k-th name.
    alike = (
        plain.select(
            "doc_id", "text_sha256", F.posexplode(F.expr(_cut("body", block))).alias("pos", "block")
        )
        .withColumn("h", digest(F.col("block")))
        .join(shared, "h", "left_semi")
        .distinct()
    )
    ranked = alike.select("h", "block").distinct().selectExpr(
        "h", "block", "row_number() OVER (PARTITION BY h ORDER BY block) AS k"
    )
    kth = names.join(shared, "h", "left_semi").selectExpr(
        "h", "name", "row_number() OVER (PARTITION BY h ORDER BY name) AS k"
    )
    by_content = ranked.join(kth, ["h", "k"]).select("h", "block", "name")
    at = alike.join(by_content, ["h", "block"]).select(
        F.coalesce("doc_id", F.lit(LOWEST)).alias("doc"), "text_sha256", "pos", "name"
    )
    wide = rows.select("row", F.coalesce("doc_id", F.lit(LOWEST)).alias("doc"), "text_sha256", F.size("hs").alias("n"))
    same = at.join(wide, ["doc", "text_sha256"])
    return named.unionByName(same.select("row", "n", "pos", "name"))


def _in_order(named: DataFrame) -> DataFrame:
    """(row, names) from (row, pos, name); a row's list is as long as its own text allows."""
    lists = named.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("l"))
    return lists.select("row", F.expr("l.name").alias("names"))


def name_texts(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    block: int = BLOCK,
    digest: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, text_sha256, level, name.

    Rows have equal texts exactly when ``level`` and ``name`` are equal. A null text is an
    empty one; repeated rows stay apart by ``row``; other columns are not read.
    """
    plain = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"),
    ).withColumn("text_sha256", F.sha2("body", 256))
    rows = written(
        plain.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "text_sha256",
            F.transform(F.expr(_cut("body", block)), lambda b: digest(b)).alias("hs"),
        ),
        "rows",
    )
    longest = rows.agg(F.max(F.size("hs"))).first()[0] or 1
    level = 0
    named = written(_block_names(plain, rows, block, digest), "block-places")
    done = [named.where("n = 1").select("row", F.lit(0).alias("level"), "name")]
    if longest > 1:
        lists = written(_in_order(named.where("n > 1")), "names-0")
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        places = lists.select(
            "row",
            F.posexplode(
                F.expr(
                    "transform(sequence(0, CAST((size(names) + 1) DIV 2 AS INT) - 1), "
                    "i -> struct(names[2 * i] AS l, coalesce(get(names, 2 * i + 1), -1L) AS r))"
                )
            ).alias("pos", "pair"),
        ).select("row", "pos", "pair.l", "pair.r")
        pairs = written(
            places.select("l", "r")
            .distinct()
            .sortWithinPartitions("l", "r")
            .select("l", "r", F.monotonically_increasing_id().alias("name")),
            f"pairs-{level}",
        )
        lists = written(_in_order(places.join(pairs, ["l", "r"])), f"names-{level}")
        last = lists.where(F.size("names") == 1)
        done.append(last.select("row", F.lit(level).alias("level"), F.col("names")[0].alias("name")))
        lists = lists.where(F.size("names") > 1)
    identity = done[0]
    for more in done[1:]:
        identity = identity.unionByName(more)
    return rows.select("row", "doc_id", "text_sha256").join(identity, "row")


def exact_groups(docs: DataFrame, **options) -> DataFrame:
    """Groups of equal texts, one row per row of ``docs``.

    doc_id, keep_id (the largest doc_id of the group), group_size, kept, text_sha256. Exactly
    one row of each group is kept, also where a doc_id is repeated or null; a null doc_id
    loses against any other.
    """
    named = written(name_texts(docs, **options), "identities")
    groups = named.groupBy("level", "name").agg(
        F.max("doc_id").alias("keep_id"),
        F.max_by("row", F.coalesce(F.col("doc_id"), F.lit(LOWEST))).alias("keep_row"),
        F.count("*").alias("group_size"),
    )
    # As a table, so that adaptive execution can split the join's rows of a large group.
    groups = written(groups, "groups")
    return named.join(groups, ["level", "name"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256",
    )


def keep_one(docs: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that with the largest id."""
    groups = exact_groups(docs, text=text, id_column=id_column, **options)
    gone = written(groups.where("NOT kept").select("doc_id", "keep_id", "text_sha256"), "copies")
    sha, own = unused(docs.columns, "_sha"), unused(docs.columns, "_id")
    mark = docs.withColumns(
        {
            sha: F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256),
            own: F.coalesce(F.col(id_column).cast("long"), F.lit(LOWEST)),
        }
    )
    other = gone.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(
        F.coalesce("doc_id", F.lit(LOWEST)).alias(own), F.col("text_sha256").alias(sha)
    )
    left = mark.join(other.distinct(), [own, sha], "left_anti")
    again = gone.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    if not again.isEmpty():  # rows that repeat the kept row's id
        left = left.dropDuplicates([own, sha])
    return left.select(*docs.columns)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""
