"""Summaries, counters, file statistics and arrival telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.scan import BLOCK, with_row_index, with_running_sum
from ledgerloom.schemas import COUNTERS, DATASETS
from ledgerloom.sources.derived import path_exists, read_dataset

# Telemetry flush size and smoothing weight of the newest rate.
FLUSH = 100
ALPHA = 0.2
DECAY = 0.8
# Flushes per EMA block: 0.8**1024 is below 1e-99, under the resolution of a double.
EMA_BLOCK = 1024

# Counter names by dataset.
DATASET_COUNTERS = {
    "events": "events_decoded",
    "tokens": "tokens_created",
    "trades": "trades",
    "completions": "completions",
    "migrations": "migrations",
    "pools": "pools_created",
    "unknown_program_data": "unknown_program_data",
}


class BacklogOverflow(RuntimeError):
    """The backlog would exceed its capacity."""


def rebuild_summary(first: DataFrame, event_ids: DataFrame) -> DataFrame:
    """Row counts of a rebuild, from the first copies and the written ids.

    ``events`` counts event and quarantine ids together; first-wins makes both unique.
    """
    names = ("raw_rows", "raw_log_rows", "raw_transaction_rows", "unique_transactions", "events")
    logs = F.col("log_copies")
    left = first.select("copies", logs, F.col("copies") - logs, F.lit(1), F.lit(0)).toDF(*names)
    right = event_ids.select(*[F.lit(0)] * 4, F.lit(1)).toDF(*names)
    return left.unionByName(right).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names]
    )


def ingestion_counters(raw: DataFrame, deduped: DataFrame, datasets: DataFrame) -> DataFrame:
    """Counters of one ingestion: outcomes by transaction, rows by dataset; zeros left out.

    ``datasets`` holds (dataset, rows).
    """
    named = F.create_map(*[F.lit(x) for pair in DATASET_COUNTERS.items() for x in pair])
    seen = deduped.agg(
        F.count("*").alias("transactions"), F.count_if("failed").alias("failed_transactions")
    ).select(
        F.expr(
            "stack(3, 'transactions', transactions, 'failed_transactions', failed_transactions, "
            "'duplicate_transactions', -transactions) AS (key, value)"
        )
    )
    total = raw.agg(F.count("*").alias("value")).select(
        F.lit("duplicate_transactions").alias("key"), "value"
    )
    rows = datasets.select(named[F.col("dataset")].alias("key"), F.col("rows").alias("value"))
    return (
        seen.unionByName(total)
        .unionByName(rows)
        .groupBy("key")
        .agg(F.sum("value").cast("bigint").alias("value"))
        .filter("value > 0")
        .select("key", F.lit("increment").alias("rule"), "value")
    )


def merge_counters(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply counter updates by rule: increments add, gauges keep the last, maxima keep the most.

    ``updates`` has (key, rule, value, version); stored values are version -1. Zero increments
    create no counter.
    """
    current = stored.select(*COUNTERS.fieldNames(), F.lit(-1).cast("bigint").alias("version"))
    fresh = updates.select(*COUNTERS.fieldNames(), F.col("version").cast("bigint")).filter(
        "NOT (rule = 'increment' AND value = 0)"
    )
    value = (
        F.when(F.col("rule") == "increment", F.col("total"))
        .when(F.col("rule") == "gauge", F.col("last"))
        .otherwise(F.col("top"))
    )
    return (
        current.unionByName(fresh)
        .groupBy("key")
        .agg(
            F.max_by("rule", "version").alias("rule"),
            F.sum("value").alias("total"),
            F.max_by("value", "version").alias("last"),
            F.max("value").alias("top"),
        )
        .select("key", "rule", value.alias("value"))
    )


def state_summary(
    transactions: DataFrame,
    observed: DataFrame,
    event_ids: DataFrame,
    counters: DataFrame,
    checkpoints: DataFrame,
) -> DataFrame:
    """All state facts as (section, key, value, detail) rows."""

    def total(df: DataFrame, key: str) -> DataFrame:
        return df.agg(F.count("*").alias("value")).select(
            F.lit("table").alias("section"), F.lit(key).alias("key"), "value",
            F.lit(None).cast("string").alias("detail"),
        )

    rows = total(transactions, "transactions")
    rows = rows.unionByName(total(observed, "observations"))
    rows = rows.unionByName(total(event_ids.select("event_id").distinct(), "events"))
    rows = rows.unionByName(
        counters.select(
            F.lit("counter").alias("section"), "key", "value",
            F.lit(None).cast("string").alias("detail"),
        )
    )
    return rows.unionByName(
        checkpoints.select(
            F.lit("checkpoint").alias("section"),
            F.col("program_id").alias("key"),
            F.col("last_slot").alias("value"),
            F.col("last_signature").alias("detail"),
        )
    )


def file_statistics(spark: SparkSession, patterns: dict[str, str]) -> DataFrame:
    """Files and bytes per name; reads file listings only, never content."""
    frames = [
        spark.read.format("binaryFile")
        .load(pattern)
        .agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        .select(F.lit(name).alias("name"), "files", "bytes")
        for name, pattern in patterns.items()
    ]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged


def dataset_counts(spark: SparkSession, version: str) -> DataFrame:
    """Rows per dataset of a version; datasets never written are skipped."""
    frames = [
        read_dataset(spark, version, name)
        .agg(F.count("*").alias("rows"))
        .select(F.lit(name).alias("dataset"), "rows")
        for name in DATASETS
        if path_exists(spark, f"{version}/dataset={name}")
    ]
    if not frames:
        return spark.createDataFrame([], "dataset string, rows bigint")
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged


def volume(trades: DataFrame) -> DataFrame:
    """Trades and quote volume by protocol and side, exact."""
    return trades.groupBy("protocol", "side").agg(
        F.count("*").alias("n"), F.sum("quote_amount_raw").alias("quote_raw")
    )


def arrival_counters(classified: DataFrame, *keys: Column, text: str = "value") -> DataFrame:
    """Messages, bytes and outcomes of received frames; ``keys`` may hold a time window."""
    notice = F.col("is_notification")
    ok = F.col("log_ok")
    return classified.groupBy(*keys).agg(
        F.count("*").alias("ws_messages_received"),
        F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("ws_bytes_received"),
        F.count_if(notice).alias("ws_notifications_received"),
        F.count_if(~notice).alias("ws_non_notification_messages_received"),
        F.count_if(notice & F.coalesce(ok, F.lit(True))).alias("ws_notifications_enqueued"),
        F.count_if(ok).alias("successful_log_notifications"),
        F.count_if(~ok).alias("failed_log_notifications"),
        F.count_if(~ok).alias("failed_log_notifications_skipped"),
    )


def flush_rates(
    messages: DataFrame, order: str, at_us: str, ok: str, started_us: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Successful logs and elapsed seconds per flush of 100 messages.

    The first flush runs from ``started_us``, or from its own first message.
    """
    indexed = with_row_index(messages, order, "_i", block).withColumn(
        "flush", F.floor(F.col("_i") / F.lit(FLUSH))
    )
    flushes = indexed.groupBy("flush").agg(
        F.count_if(ok).alias("successes"),
        F.min(at_us).alias("first_us"),
        F.max(at_us).alias("last_us"),
    )
    previous = flushes.select(
        (F.col("flush") + 1).alias("flush"), F.col("last_us").alias("from_us")
    )
    origin = F.lit(started_us).cast("bigint") if started_us is not None else F.col("first_us")
    elapsed = (F.col("last_us") - F.coalesce("from_us", origin)) / F.lit(1e6)
    return flushes.join(previous, "flush", "left").select(
        "flush",
        "successes",
        F.greatest(elapsed, F.lit(1e-9)).alias("seconds"),
        (F.col("successes") / F.greatest(elapsed, F.lit(1e-9))).alias("rate"),
    )


def ema_rates(flushes: DataFrame) -> DataFrame:
    """Smoothed rate after each flush, seeded with the first; in millirps, rounded half to even.

    Inside a block of flushes the recurrence is a weighted running sum. What blocks before it carry
    into a block is the sum of their ends, each decayed over the blocks between; four blocks back
    that factor is zero in doubles.
    """
    blocked = flushes.withColumn("_b", F.floor(F.col("flush") / F.lit(EMA_BLOCK))).withColumn(
        "_i", F.col("flush") % F.lit(EMA_BLOCK)
    )
    weight = F.when(F.col("flush") == 0, F.lit(1.0)).otherwise(F.lit(ALPHA))
    term = F.col("rate") * weight * F.pow(F.lit(DECAY), -F.col("_i"))
    inside = Window.partitionBy("_b").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    partial = blocked.withColumn("_own", F.sum(term).over(inside) * F.pow(F.lit(DECAY), "_i"))
    later = F.explode(
        F.array(
            *[
                F.struct(
                    (F.col("_b") + 1 + k).alias("_b"),
                    (F.col("_own") * F.lit(DECAY ** (EMA_BLOCK * k))).alias("_carry"),
                )
                for k in range(4)
            ]
        )
    )
    ends = partial.filter(F.col("_i") == EMA_BLOCK - 1).select(later.alias("c"))
    ends = ends.groupBy("c._b").agg(F.sum("c._carry").alias("_carry"))
    ema = F.col("_own") + F.coalesce("_carry", F.lit(0.0)) * F.pow(F.lit(DECAY), F.col("_i") + 1)
    return partial.join(ends, "_b", "left").select(
        "flush",
        "successes",
        "seconds",
        F.bround(F.lit(1000) * ema).cast("bigint").alias("ema_millirps"),
    )


def average_rate(flushes: DataFrame) -> DataFrame:
    """All successes over all elapsed time, in millirps, rounded half to even."""
    total = F.sum("successes") / F.greatest(F.sum("seconds"), F.lit(1e-9))
    return flushes.agg(F.bround(F.lit(1000) * total).cast("bigint").alias("avg_millirps"))


def backlog(changes: DataFrame, order: str, change: str = "change", block: int = BLOCK):
    """Queue size after each enqueue (+1) or take (-1), in a unique integer order."""
    return with_running_sum(changes, F.col(change), order, "backlog", block)


def high_watermark(sized: DataFrame, order: str) -> DataFrame:
    """Largest and latest queue size."""
    return sized.agg(
        F.max("backlog").alias("ws_queue_high_watermark"),
        F.max_by("backlog", order).alias("ws_queue_current_size"),
    )


def check_capacity(sized: DataFrame, capacity: int) -> None:
    """Fail when the backlog went over ``capacity``."""
    top = sized.agg(F.max("backlog").alias("top")).first().top
    if top is not None and top > capacity:
        raise BacklogOverflow(f"recovery buffer reached {capacity} messages; stopped")
