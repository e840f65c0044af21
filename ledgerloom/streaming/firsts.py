"""Which keys a stream brings for the first time, told next to the rows that bring them.

A micro-batch carries its rows and, from keyed state on disk, one row for each key no earlier batch
had. State is looked up by the batch's own keys only, so what a batch reads does not grow with the
stream's history; which of the batch's copies is the first is then decided among its rows alone. A
batch that is retried gets the same keys again: state and offsets commit together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.session import materialized

# Keys of a kind are told apart from those of other kinds.
_KIND, _KEY, _ROW = "_kind", "_key", "_row"

_PARTITIONS = "spark.sql.shuffle.partitions"
_STATE_PARTITIONS = 2  # partitions of keyed state for each core
_ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}
_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}


def keys_of(df: DataFrame, kinds: dict[str, list[str | Column]]) -> DataFrame:
    """Rows (kind, key) of a frame: for each kind the named columns, as text."""
    each = [
        F.struct(
            F.lit(kind).alias(_KIND),
            F.array(*[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]).alias(_KEY),
        )
        for kind, columns in kinds.items()
    ]
    return df.select(F.explode(F.array(*each)).alias("k")).select("k.*")


def with_new_keys(rows: DataFrame, keyed: DataFrame) -> DataFrame:
    """One stream of the rows and of the keys (``keys_of``) that are new with this micro-batch.

    Both frames must stem from the same source of the same stream.
    """
    carried = rows.select(
        F.lit(None).cast("string").alias(_KIND),
        F.lit(None).cast("array<string>").alias(_KEY),
        F.struct(*rows.columns).alias(_ROW),
    )
    row_type = carried.schema[_ROW].dataType
    fresh = keyed.dropDuplicates([_KIND, _KEY]).select(_KIND, _KEY, F.lit(None).cast(row_type).alias(_ROW))
    return carried.unionByName(fresh)


def rows_of(batch: DataFrame) -> DataFrame:
    """The rows of a micro-batch."""
    return batch.filter(F.col(_KIND).isNull()).select(f"{_ROW}.*")


def new_keys(batch: DataFrame, kind: str, *names: str) -> DataFrame:
    """The keys of one kind that are new with this micro-batch, as text columns."""
    return batch.filter(F.col(_KIND) == kind).select(*[F.col(_KEY)[i].alias(n) for i, n in enumerate(names)])


def run(
    stream: DataFrame, process: Callable[[DataFrame, int, DataFrame], None], offsets: str, **trigger
) -> StreamingQuery:
    """Start a stream of ``with_new_keys``: ``process`` gets the rows, the batch's number, the batch.

    ``trigger`` is as in ``DataStreamWriter.trigger``; all files that are there by default.
    """
    spark = stream.sparkSession
    # A stream's session plans without adaptive execution, and then ``rebalance`` is ignored and every
    # task writes a file to every folder. What is made of a batch is an ordinary job.
    ordinary = {_PARTITIONS: spark.conf.get(_PARTITIONS), **_ADAPTIVE}

    def each(batch: DataFrame, batch_id: int) -> None:
        # State is looked up once. Frames compress well in files; as a cached table they are kept whole.
        with materialized(batch, "batch") as held, _settings(batch.sparkSession, ordinary):
            process(rows_of(held), batch_id, held)
        # Shuffled files go once the driver has collected what refers to them; left alone, it may not
        # do so before the next batches have filled the disks.
        spark._jvm.System.gc()

    # Each partition of keyed state is opened and committed in every batch, however few its rows.
    keyed = {_PARTITIONS: str(_STATE_PARTITIONS * spark.sparkContext.defaultParallelism), **_ON_DISK}
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", offsets)
    with _settings(spark, keyed):
        return writer.foreachBatch(each).trigger(**(trigger or {"availableNow": True})).start()


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of a session that hold for a while."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
