"""Recover a gap: listing and fetched results in, archived and decoded rows and checkpoints out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.decode import decode, decoded_rows
from ledgerloom.operators.dedupe import checkpoints as latest_checkpoints
from ledgerloom.operators.dedupe import merge_checkpoints, new_observations, observations, transactions_index
from ledgerloom.operators.frames import transactions_of_results
from ledgerloom.operators.metrics import dataset_counts, ingestion_counters
from ledgerloom.operators.recovery import (
    check_available,
    listed_counts,
    merge_recovered,
    missing_signatures,
    start_boundary,
)
from ledgerloom.operators.sinks import append_raw, unarchived
from ledgerloom.plans.rebuild import write_version
from ledgerloom.schemas import CHECKPOINTS, COUNTERS, OBSERVATIONS, RAW_TRANSACTION, TRANSACTIONS
from ledgerloom.session import materialize
from ledgerloom.sources.catalog import Catalog
from ledgerloom.sources.derived import path_exists
from ledgerloom.sources.raw import as_envelopes

# Fixed value: the counter of listed signatures that failed on the ledger.
FAILED_SKIPPED = "reconcile_failed_signatures_skipped"


def _answers(fetched: DataFrame) -> DataFrame:
    """Of several results of a signature the earliest; null ones do not count."""
    answer = F.min_by(F.struct("received_at", "result"), F.struct("received_at", "result"))
    usable = fetched.filter("result IS NOT NULL").groupBy("signature")
    return usable.agg(answer.alias("a")).select("signature", "a.*")


def _replayed(raw: DataFrame) -> DataFrame:
    """Recovered RAW rows with ``replay_rank`` as envelopes, oldest first."""
    ranks = raw.select("signature", "source_program", "replay_rank")
    ordered = as_envelopes(raw.drop("replay_rank")).drop("replay_order").join(ranks, ["signature", "source_program"])
    zero = F.lit(0)
    return ordered.withColumn(
        "replay_order",
        F.struct(
            F.lit("").alias("date"),
            F.lit("").alias("hour"),
            zero.alias("kind"),
            zero.cast("bigint").alias("received_us"),
            F.col("replay_rank").cast("bigint").alias("seq"),
        ),
    ).drop("replay_rank")


def _recovered(missing: DataFrame, fetched: DataFrame, provider: str) -> DataFrame:
    """RAW rows of the missing signatures, with their ``replay_rank``."""
    results = missing.select("signature", "program_id", "replay_rank").join(_answers(fetched), "signature")
    ranks = missing.select("signature", F.col("program_id").alias("source_program"), "replay_rank")
    return transactions_of_results(results, provider).join(ranks, ["signature", "source_program"])


def recover(
    listing: DataFrame,
    fetched: DataFrame,
    checkpoints: DataFrame,
    observed: DataFrame,
    provider: str,
    cap: int = 2000,
) -> tuple[DataFrame, DataFrame]:
    """(recovered envelopes, new checkpoints). Both guards run before anything is returned, so a
    failed recovery leaves the stored checkpoints as they are.

    ``fetched`` has (signature, received_at, result); of several results the earliest counts, and
    null ones do not. Replay order is oldest first.
    """
    missing = materialize(
        missing_signatures(listing, checkpoints, observed, cap), "missing-signatures"
    )
    check_available(missing, fetched)
    envelopes = _replayed(_recovered(missing, fetched, provider))
    moved = merge_checkpoints(checkpoints, latest_checkpoints(observations(envelopes)))
    return envelopes, moved


@dataclass(frozen=True)
class State:
    """What a recovery starts from; ``empty`` gives a ledger that was never collected."""

    checkpoints: DataFrame
    observations: DataFrame
    transactions: DataFrame
    counters: DataFrame

    @staticmethod
    def empty(spark: SparkSession) -> State:
        return State(*[spark.createDataFrame([], t) for t in (CHECKPOINTS, OBSERVATIONS, TRANSACTIONS, COUNTERS)])


@dataclass(frozen=True)
class Recovery:
    """One gap recovery as a resumable job under ``root``.

    Its steps are tables: missing, recovered, raw, first, derived, transactions, observations,
    counters, checkpoints. A step is done when its table is complete, and is then never done again: a
    job that was killed goes on after the last complete step, from what the steps before it have
    written, whatever has become of its inputs since. Both guards (cap and unavailable transactions)
    run before anything of the first two steps is written. Checkpoints come last: until they are
    there, the stored ones are as they were, and ``done`` is false.
    """

    root: str
    catalog: Catalog
    provider: str
    cap: int = 2000

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def complete(self, spark: SparkSession, name: str) -> bool:
        return path_exists(spark, f"{self.path(name)}/_SUCCESS")

    def done(self, spark: SparkSession) -> bool:
        return self.complete(spark, "checkpoints")

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))

    def _step(self, spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if not self.complete(spark, name):
            make().write.mode("overwrite").parquet(self.path(name))
        return self.table(spark, name)

    def _effect(self, spark: SparkSession, name: str, write: Callable[[str], None]) -> str:
        """A step that writes files of other kinds: in full, then its mark."""
        folder = self.path(name)
        if not self.complete(spark, f"{name}-mark"):
            write(folder)
            spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{folder}-mark")
        return folder

    def run(self, listing: DataFrame, fetched: DataFrame, state: State, live: DataFrame | None = None) -> DataFrame:
        """Recover and return the new checkpoints.

        ``live`` holds envelopes that arrived while the gap was open: they come after the recovered
        rows. Programs without a checkpoint start at their newest listed signature, with no backfill.
        """
        spark = listing.sparkSession

        def missing() -> DataFrame:
            rows = materialize(missing_signatures(listing, state.checkpoints, state.observations, self.cap), "missing")
            check_available(rows, fetched)
            return rows

        gap = self._step(spark, "missing", missing)
        recovered = self._step(spark, "recovered", lambda: _recovered(gap, fetched, self.provider))

        def archive(folder: str) -> None:
            # A transaction that is known through another program is not archived again.
            once = recovered.groupBy("signature").agg(F.min_by(F.struct(*recovered.columns), "replay_rank").alias("r"))
            rows = unarchived(once.select("r.*"), state.transactions).select(*RAW_TRANSACTION.fieldNames())
            append_raw(rows, folder, "transactions", 0)

        self._effect(spark, "raw", archive)
        replayed = _replayed(recovered)
        arrived = replayed if live is None else replayed.unionByName(live.select(*replayed.columns))

        def first() -> DataFrame:
            overlap = replayed.limit(0) if live is None else live.select(*replayed.columns)
            return unarchived(merge_recovered(replayed, overlap), state.transactions)

        fresh = self._step(spark, "first", first)
        rows = decoded_rows(decode(fresh, self.catalog))
        derived = self._effect(spark, "derived", lambda folder: write_version(spark, rows, folder, "overwrite"))
        self._step(spark, "transactions", lambda: transactions_index(fresh))
        seen = self._step(spark, "observations", lambda: new_observations(observations(arrived), state.observations))
        self._step(spark, "counters", lambda: self._counters(arrived, fresh, derived, listing, state))

        def moved() -> DataFrame:
            begun = start_boundary(listing, state.checkpoints).select(
                "program_id", "last_signature", "last_slot", F.current_timestamp().alias("updated_at")
            )
            stored = merge_checkpoints(state.checkpoints, begun)
            return merge_checkpoints(stored, latest_checkpoints(seen))

        return self._step(spark, "checkpoints", moved)

    def _counters(
        self, arrived: DataFrame, fresh: DataFrame, derived: str, listing: DataFrame, state: State
    ) -> DataFrame:
        """This run's increments: outcomes, rows by dataset, failed signatures left out."""
        spark = arrived.sparkSession
        counted = ingestion_counters(arrived, fresh, dataset_counts(spark, derived))
        skipped = listed_counts(listing, state.checkpoints).agg(F.coalesce(F.sum("failed_skipped"), F.lit(0)).alias("value"))
        failed = skipped.filter("value > 0").select(F.lit(FAILED_SKIPPED).alias("key"), F.lit("increment").alias("rule"), "value")
        return counted.unionByName(failed)
