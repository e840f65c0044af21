"""Keyed streaming state: dedupe, checkpoints, arrival windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.dedupe import (
    checkpoints,
    merge_checkpoints,
    new_observations,
    observations,
)
from ledgerloom.operators.metrics import BacklogOverflow, arrival_counters, backlog
from ledgerloom.schemas import CHECKPOINTS, OBSERVATIONS
from ledgerloom.sources.derived import batch_numbers
from ledgerloom.streaming.firsts import keys_of, new_keys, run, with_new_keys


def stream_dedupe(
    stream: DataFrame, key: str = "signature", event_time: str | None = None,
    horizon: str | None = None,
) -> DataFrame:
    """One row per key. With a horizon, state older than it is dropped; without, it is kept.

    Which copy of one micro-batch survives is not defined; ``collect`` keeps the first exactly.
    """
    if horizon is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([key])


@dataclass(frozen=True)
class CheckpointState:
    """Checkpoints per program over first observations, kept in two tables under ``root``.

    A repeated observation of a signature through the same program moves nothing, whichever batch it
    comes in. Each batch adds its first observations and a new snapshot of the checkpoints, which has
    one row per program; a batch that is retried overwrites its own. ``start`` keeps the observed
    pairs in keyed state and reads back nothing but the last snapshot.
    """

    root: str

    def _before(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        schema = {"observations": OBSERVATIONS, "checkpoints": CHECKPOINTS}[name]
        folder = f"{self.root}/{name}"
        done = [b for b in batch_numbers(spark, folder) if b < batch_id]
        if name == "checkpoints":
            done = [max(done)] if done else []
        if not done:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{folder}/batch={b}" for b in done])

    def process(self, envelopes: DataFrame, batch_id: int, batch: DataFrame | None = None) -> None:
        """One micro-batch of envelopes; without ``batch``, which knows the pairs that are new, the
        pairs of all earlier batches are read."""
        spark = envelopes.sparkSession
        sightings = observations(envelopes)
        if batch is None:
            fresh = new_observations(sightings, self._before(spark, "observations", batch_id))
        else:
            pair = ["signature", "program_id"]
            fresh = sightings.join(new_keys(batch, "observation", *pair), pair, "left_semi")
        path = f"{self.root}/{{}}/batch={batch_id}"
        fresh.write.mode("overwrite").parquet(path.format("observations"))
        written = spark.read.schema(fresh.schema).parquet(path.format("observations"))
        moved = merge_checkpoints(
            self._before(spark, "checkpoints", batch_id), checkpoints(written)
        )
        moved.write.mode("overwrite").parquet(path.format("checkpoints"))

    def start(self, envelopes: DataFrame, **trigger):
        """Run over a stream of envelopes (signature, source_program, slot, received_at, replay_order)."""
        keyed = keys_of(envelopes, {"observation": ["signature", "source_program"]})
        return run(with_new_keys(envelopes, keyed), self.process, f"{self.root}/offsets", **trigger)

    def latest(self, spark: SparkSession) -> DataFrame:
        return self._before(spark, "checkpoints", 1 << 62)


@dataclass(frozen=True)
class QueueState:
    """The size of a bounded queue after each change, carried over micro-batches.

    Changes have a unique integer ``order`` that rises from batch to batch, and ``change`` (+1 for a
    message that enters, -1 for one that is taken). Each batch writes its sized rows and one row of
    state (size, highest size, last order) under ``batch=<id>``; a retried batch overwrites both. Only
    the last row of state is read back. A batch fails, with nothing written, when the queue would
    outgrow ``capacity`` or when an order comes that is not above those before it.
    """

    root: str
    order: str
    capacity: int | None = None

    def _path(self, name: str, batch_id: int) -> str:
        return f"{self.root}/{name}/batch={batch_id}"

    def _last(self, spark: SparkSession, batch_id: int) -> tuple[int, int, int | None]:
        done = [b for b in batch_numbers(spark, f"{self.root}/state") if b < batch_id]
        if not done:
            return 0, 0, None
        row = spark.read.parquet(self._path("state", max(done))).first()
        return row["size"], row["highest"], row["last"]

    def process(self, changes: DataFrame, batch_id: int) -> None:
        spark = changes.sparkSession
        size, highest, last = self._last(spark, batch_id)
        sized = backlog(changes, self.order).withColumn("backlog", F.col("backlog") + F.lit(size))
        sized = sized.persist()
        try:
            top = sized.agg(
                F.max("backlog").alias("highest"),
                F.max_by("backlog", self.order).alias("size"),
                F.min(self.order).alias("first"),
                F.max(self.order).alias("last"),
            ).first()
            if top["last"] is not None:
                if last is not None and top["first"] <= last:
                    raise ValueError(f"{self.order} {top['first']} comes after {last}; stopped")
                size, highest, last = top["size"], max(highest, top["highest"]), top["last"]
            if self.capacity is not None and highest > self.capacity:
                raise BacklogOverflow(f"queue reached {highest} of {self.capacity} messages; stopped")
            sized.write.mode("overwrite").parquet(self._path("sized", batch_id))
            state = spark.range(1).select(
                F.lit(size).cast("long").alias("size"),
                F.lit(highest).cast("long").alias("highest"),
                F.lit(last).cast("long").alias("last"),
            )
            state.coalesce(1).write.mode("overwrite").parquet(self._path("state", batch_id))
        finally:
            sized.unpersist()

    def start(self, changes: DataFrame, **trigger):
        """Run over a stream of changes."""
        writer = changes.writeStream.option("checkpointLocation", f"{self.root}/offsets")
        return writer.foreachBatch(self.process).trigger(**(trigger or {"availableNow": True})).start()

    def sized(self, spark: SparkSession) -> DataFrame:
        """All changes of completed batches with the queue's size after each."""
        done = batch_numbers(spark, f"{self.root}/state")
        return spark.read.parquet(*[self._path("sized", b) for b in done])

    def watermark(self, spark: SparkSession) -> DataFrame:
        """Highest and latest size, of the last completed batch."""
        size, highest, _ = self._last(spark, 1 << 62)
        return spark.range(1).select(
            F.lit(highest).cast("long").alias("ws_queue_high_watermark"),
            F.lit(size).cast("long").alias("ws_queue_current_size"),
        )


def arrival_windows(classified: DataFrame, width: str, late: str):
    """Arrival counters per tumbling window of the arrival time.

    Update and append mode leave out frames that come more than ``late`` after the newest one.
    """
    marked = classified.withWatermark("received_at", late)
    return arrival_counters(marked, F.window("received_at", width).alias("window"))


def backlog_windows(changes: DataFrame, width: str, late: str):
    """Net queue change per tumbling window; a running sum of it is the backlog.

    Update and append mode leave out changes that come more than ``late`` after the newest one.
    """
    marked = changes.withWatermark("received_at", late)
    return marked.groupBy(F.window("received_at", width).alias("window")).agg(
        F.sum("change").alias("net")
    )
