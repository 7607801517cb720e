"""Sources: JSON documents, JSON batches, CSV back-fill, topic records, evolved tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.sources.contracts import READING, Contract, fill_defaults

# The eight columns of a back-fill file.
CSV_SCHEMA = (
    "reading_id string, platform_id string, sensor_id string, sensor_type string, "
    "value double, unit string, timestamp bigint, quality_flag string"
)


def read_readings(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """JSON readings as raw text, one document per line, in the column ``body``.

    As a stream, ``max_files``/``max_bytes`` bound what one micro-batch takes in.
    """
    if not streaming:
        return spark.read.text(path).select(F.col("value").alias("body"))
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.text(path).select(F.col("value").alias("body"))


def explode_batch(df: DataFrame, col: str = "body") -> DataFrame:
    """One row per reading where a body may hold an array of readings or a single one.

    A body that looks like an array but does not parse stays whole, for the parser to reject.
    """
    single = F.array(F.col(col))
    items = F.from_json(F.col(col), "array<string>")
    is_array = F.startswith(F.ltrim(F.col(col)), F.lit("["))
    others = [c for c in df.columns if c != col]
    return df.select(
        *others,
        F.explode(F.when(is_array, F.coalesce(items, single)).otherwise(single)).alias(col),
    )


def read_csv_readings(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(CSV_SCHEMA).option("header", True).csv(path)


def topic_regex(pattern: str) -> str:
    """Anchored regular expression of a topic filter: ``+`` one level, ``#`` all the rest."""
    levels = pattern.split("/")
    if "#" in levels[:-1] or any(len(x) > 1 and ("+" in x or "#" in x) for x in levels):
        raise ValueError(f"bad topic filter: {pattern!r}")
    quoted = [r"[^/]*" if x == "+" else x if x == "#" else rf"\Q{x}\E" for x in levels]
    if quoted[-1] == "#":
        head = "/".join(quoted[:-1])
        return f"^{head}(/.*)?$" if head else "^.*$"
    return f"^{'/'.join(quoted)}$"


def filter_topic(
    df: DataFrame,
    pattern: str = "sensors/+/+/data",
    col: str = "topic",
    levels: dict[str, int] | None = None,
) -> DataFrame:
    """Rows whose topic matches, with the platform and sensor levels as columns."""
    levels = levels or {"topic_platform": 1, "topic_sensor": 2}
    parts = F.split(F.col(col), "/")
    return df.filter(F.col(col).rlike(topic_regex(pattern))).withColumns(
        {name: F.get(parts, F.lit(i)) for name, i in levels.items()}
    )


def extract_fields(df: DataFrame, paths: dict[str, str], col: str = "body") -> DataFrame:
    """Text columns lifted out of JSON documents; ``body_ok`` is false for unreadable ones.

    A path that leads nowhere gives empty text and the record goes on. Top-level paths share
    one parse of the document, deeper ones are looked up singly.
    """
    flat = {name: p[2:] for name, p in paths.items() if _is_flat(p)}
    parsed = with_document(df, sorted(set(flat.values())), col)
    found: dict[str, Column] = {}
    for name, path in paths.items():
        value = F.col("_doc")[flat[name]] if name in flat else F.get_json_object(col, path)
        found[name] = F.coalesce(value, F.lit(""))
    return parsed.withColumns({**found, "body_ok": F.col("_doc").isNotNull()}).drop("_doc")


def _is_flat(path: str) -> bool:
    return path.startswith("$.") and path[2:].isidentifier()


def with_document(
    df: DataFrame, keys: Sequence[str], col: str = "body", target: str = "_doc"
) -> DataFrame:
    """Add named top-level fields of a JSON object as a struct of texts, parsed once per row.

    The struct is null when the text is not one whole JSON object. As a plain column the parse
    would be copied into every filter and field that uses it; a one-element ``explode`` keeps
    it where it is, and does not multiply rows.
    """
    fields = ", ".join(f"`{k}` string" for k in [*keys, "_corrupt"])
    doc = F.from_json(F.col(col), fields, {"columnNameOfCorruptRecord": "_corrupt"})
    text = F.trim(F.col(col))
    whole = F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))
    parsed = df.select("*", F.explode(F.array(doc)).alias(target))
    good = F.when(whole & F.col(target)["_corrupt"].isNull(), F.col(target))
    return parsed.withColumn(target, good)


def read_evolved(
    spark: SparkSession, paths: Sequence[str], contract: Contract = READING
) -> DataFrame:
    """Files written under older and newer versions of a contract, as the current version."""
    return fill_defaults(spark.read.option("mergeSchema", True).parquet(*paths), contract)
