"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

_SCRATCH: list[str] = []


def build_session(app: str = "fieldpulse", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every plan here relies on.

    Only semantics are fixed (UTC, adaptive execution with skew handling); sizes such as
    the shuffle partition count stay with the cluster unless passed in ``conf``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone; all timestamps in this package are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, shared by all executors.

    Where the setting is absent, as in tests, the folder lies in the warehouse, which executors
    share as well; a machine's own temporary folder is never used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the store that Spark reaches under this path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def drop_scratch(spark: SparkSession) -> int:
    """Deletes the folders handed out so far; results that still read them must be done with."""
    n = 0
    while _SCRATCH:
        store, path = file_system(spark, _SCRATCH.pop())
        n += store.delete(path, True)
    return n
