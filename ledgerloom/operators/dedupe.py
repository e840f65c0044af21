"""First-wins deduplication, observations and monotone checkpoints.

All of it is ``min_by``/``max_by``: Spark combines on the map side, so a key that holds a third of
the rows reaches the shuffle as one row per task, where a window would send it to one task whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.schemas import CHECKPOINTS


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key by ``order``, columns unchanged."""
    row = F.min_by(_rest(df, keys), F.struct(*order)).alias("row")
    return df.groupBy(*keys).agg(row).select(*_whole(df, keys))


def _rest(df: DataFrame, keys: list[str]) -> Column:
    """The columns that are not keys: these travel beside the row and need not be in it twice."""
    return F.struct(*[F.col(c) for c in df.columns if c not in keys])


def _whole(df: DataFrame, keys: list[str]) -> list[Column]:
    return [F.col(c) if c in keys else F.col("row")[c].alias(c) for c in df.columns]


def dedupe_transactions(envelopes: DataFrame, order: str = "replay_order") -> DataFrame:
    """First copy per signature. Runs before the failed filter: a failed first copy hides later
    good ones."""
    return first_by(envelopes, ["signature"], [order])


def first_copies(envelopes: DataFrame, order: str = "replay_order") -> DataFrame:
    """``dedupe_transactions`` plus how many copies, and log copies, each signature had."""
    logs = F.count_if(F.col(order)["kind"] == 0)
    return (
        envelopes.groupBy("signature")
        .agg(
            F.min_by(_rest(envelopes, ["signature"]), order).alias("row"),
            F.count("*").alias("copies"),
            logs.alias("log_copies"),
        )
        .select(*_whole(envelopes, ["signature"]), "copies", "log_copies")
    )


def dedupe_events(events: DataFrame, order: list[str] | None = None) -> DataFrame:
    """First row per event id."""
    return first_by(events, ["event_id"], order or ["slot", "received_at", "signature"])


def duplicate_count(df: DataFrame, key: str = "signature") -> DataFrame:
    """Rows, distinct keys and the difference."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("unique_rows"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("*")).alias("duplicates"),
    )


def observations(envelopes: DataFrame, order: str = "replay_order") -> DataFrame:
    """First sighting per (signature, program), with its position."""
    first = F.min_by(F.struct("slot", "received_at"), order)
    return (
        envelopes.groupBy("signature", F.col("source_program").alias("program_id"))
        .agg(first.alias("f"), F.min(order).alias(order))
        .select(
            "signature",
            "program_id",
            F.col("f.slot").alias("slot"),
            F.col("f.received_at").alias("observed_at"),
            order,
        )
    )


def transactions_index(deduped: DataFrame) -> DataFrame:
    """Signature to slot, program and first sighting."""
    return deduped.select(
        "signature",
        "slot",
        F.col("source_program").alias("source_program"),
        F.col("received_at").alias("first_seen_at"),
    )


def new_observations(observed: DataFrame, stored: DataFrame) -> DataFrame:
    """Observations not in the stored set."""
    return observed.join(stored.select("signature", "program_id"), ["signature", "program_id"],
                         "left_anti")


def checkpoints(first_seen: DataFrame, order: str = "replay_order") -> DataFrame:
    """Highest slot per program over first observations; equal slots go to the later arrival."""
    best = F.max_by(
        F.struct("signature", "slot", "observed_at"), F.struct("slot", F.col(order))
    )
    return (
        first_seen.groupBy("program_id")
        .agg(best.alias("c"))
        .select(
            "program_id",
            F.col("c.signature").alias("last_signature"),
            F.col("c.slot").alias("last_slot"),
            F.col("c.observed_at").alias("updated_at"),
        )
    )


def merge_checkpoints(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Fresh wins unless its slot is lower than the stored one."""
    columns = CHECKPOINTS.fieldNames()[1:]
    old = stored.select("program_id", F.struct(*columns).alias("old"))
    new = fresh.select("program_id", F.struct(*columns).alias("new"))
    keep_old = F.col("new").isNull() | (F.col("new.last_slot") < F.col("old.last_slot"))
    merged = F.when(keep_old & F.col("old").isNotNull(), F.col("old")).otherwise(F.col("new"))
    return (
        old.join(new, "program_id", "full_outer")
        .withColumn("c", merged)
        .select("program_id", "c.*")
    )


def cross_program(envelopes: DataFrame) -> DataFrame:
    """Signatures seen through more than one program: decoded once, observed per program."""
    pairs = envelopes.groupBy("signature", "source_program").agg(F.count("*").alias("n"))
    return (
        pairs.groupBy("signature")
        .agg(F.count("*").alias("programs"), F.sum("n").alias("copies"))
        .filter("programs > 1")
    )
