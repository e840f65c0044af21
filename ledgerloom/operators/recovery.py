"""Gap recovery over two input tables: the signature listing and the fetched results.

A listing row is (program_id, position, signature, slot, err) with position 0 the newest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.dedupe import dedupe_transactions
from ledgerloom.session import broadcast_if_small


class RecoveryLimitExceeded(RuntimeError):
    """More signatures are missing than the cap allows."""


class TransactionUnavailable(RuntimeError):
    """A listed signature has no fetched transaction."""


def start_boundary(listing: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Newest listed signature of each program that has no checkpoint yet; no backfill."""
    fresh = listing.join(
        broadcast_if_small(checkpoints.select("program_id")), "program_id", "left_anti"
    )
    newest = F.min_by(F.struct("signature", "slot"), "position")
    return (
        fresh.groupBy("program_id")
        .agg(newest.alias("n"))
        .select(
            "program_id",
            F.col("n.signature").alias("last_signature"),
            F.col("n.slot").alias("last_slot"),
        )
    )


def newer_than_checkpoint(listing: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Listed rows above the checkpoint signature (exclusive).

    All rows count when that signature is not listed; programs without a checkpoint have none.
    """
    marks = broadcast_if_small(checkpoints.select("program_id", "last_signature"))
    marked = listing.join(marks, "program_id").filter("last_signature IS NOT NULL")
    found = F.min(F.when(F.col("signature") == F.col("last_signature"), F.col("position")))
    until = broadcast_if_small(marked.groupBy("program_id").agg(found.alias("until")))
    return (
        marked.join(until, "program_id")
        .filter(F.col("until").isNull() | (F.col("position") < F.col("until")))
        .drop("last_signature", "until")
    )


def listed_counts(listing: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Per program: rows above the checkpoint, and how many of them failed."""
    return (
        newer_than_checkpoint(listing, checkpoints)
        .groupBy("program_id")
        .agg(F.count("*").alias("listed"), F.count("err").alias("failed_skipped"))
    )


def check_cap(listing: DataFrame, checkpoints: DataFrame, cap: int) -> None:
    """Fail before anything is written when a program lists more than ``cap`` rows.

    Failed signatures count towards the cap.
    """
    over = (
        listed_counts(listing, checkpoints)
        .filter(F.col("listed") > cap)
        .agg(F.min("program_id").alias("program_id"), F.max("listed").alias("listed"))
        .first()
    )
    if over.program_id is not None:
        raise RecoveryLimitExceeded(
            f"more than {cap} signatures are missing for {over.program_id}; checkpoint not moved"
        )


def missing_signatures(
    listing: DataFrame, checkpoints: DataFrame, observed: DataFrame, cap: int
) -> DataFrame:
    """What to fetch: newer than the checkpoint, not failed, not observed for that program.

    ``replay_rank`` rises from oldest to newest. A cap of 0 turns recovery off.
    """
    if cap == 0:
        return listing.limit(0).withColumn("replay_rank", -F.col("position"))
    check_cap(listing, checkpoints, cap)
    return (
        newer_than_checkpoint(listing, checkpoints)
        .filter("err IS NULL")
        .join(observed.select("signature", "program_id"), ["signature", "program_id"], "left_anti")
        .withColumn("replay_rank", -F.col("position"))
    )


def unavailable(missing: DataFrame, fetched: DataFrame) -> DataFrame:
    """Missing signatures without a fetched result."""
    have = fetched.filter("result IS NOT NULL").select("signature")
    return missing.join(have, "signature", "left_anti")


def check_available(missing: DataFrame, fetched: DataFrame) -> None:
    """Fail before the checkpoint moves when a listed transaction was not fetched."""
    hole = unavailable(missing, fetched).agg(F.min("signature").alias("signature")).first()
    if hole.signature is not None:
        raise TransactionUnavailable(
            f"signature {hole.signature} was listed but is unavailable; recovery stopped"
        )


def merge_recovered(recovered: DataFrame, live: DataFrame) -> DataFrame:
    """Recovered envelopes, then live overlap, first copy per signature."""
    ranked = recovered.withColumn("arrival", F.struct(F.lit(0).alias("path"), "replay_order"))
    overlap = live.withColumn("arrival", F.struct(F.lit(1).alias("path"), "replay_order"))
    return dedupe_transactions(ranked.unionByName(overlap), "arrival").drop("arrival")
