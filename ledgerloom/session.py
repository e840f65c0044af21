"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may have at most to be broadcast. Larger sides are joined by shuffle.
BROADCAST_ROWS = 100_000

# What every job relies on, also in a session it did not build. The JVM does not compile methods
# over 8000 bytes, so a wide projection must not be fused into one.
SESSION = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A frame that repeats a key is still a frame: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A task that writes to few folders keeps their files open side by side and sorts nothing.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    # Logs compress tenfold and are costly to decode, and rows are sorted before they are combined:
    # tasks of the usual 64 and 128 MiB take minutes and gigabytes.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
    "spark.sql.files.maxPartitionBytes": "32m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings of ``SESSION`` to a running session."""
    for key, value in SESSION.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs are written for; ``conf`` overrides any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # Keyed state of streams lies on disk, not in the executors' heap.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **SESSION,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerloom-")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only where that is unset and driver and executors are one process, a private folder serves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _own_folder()
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return posixpath.join(scratch_root(spark), "ledgerloom", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def materialized(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``materialize`` for a job that is done with the table at the end: it is removed then."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only when it is counted to be within ``max_rows``."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when the input has fewer splits than that (unsplittable or small files)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
