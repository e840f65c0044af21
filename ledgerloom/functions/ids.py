"""Identities, byte order, and epoch helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_id(signature: Column, program: Column, log_index: Column, kind: Column) -> Column:
    """SHA-256 hex of ``signature|program|log_index|kind``; null when any part is null."""
    parts = [signature, program, log_index.cast("string"), kind]
    known = signature.isNotNull() & program.isNotNull() & log_index.isNotNull() & kind.isNotNull()
    return F.when(known, F.sha2(F.concat_ws("|", *parts), 256))


def utc_date(epoch_seconds: Column) -> Column:
    """UTC calendar date of unix seconds."""
    return F.date_from_unix_date(F.floor(epoch_seconds / F.lit(86400)).cast("int"))


def received_date(received_at: Column) -> Column:
    return utc_date(F.unix_micros(received_at) / F.lit(1_000_000))


def partition_date(block_time: Column, received_at: Column) -> Column:
    """Date of the block when known, else of the arrival."""
    return F.coalesce(utc_date(block_time), received_date(received_at))


def received_hour(received_at: Column) -> Column:
    """Two-digit UTC hour."""
    hours = F.floor(F.unix_micros(received_at) / F.lit(3_600_000_000)) % F.lit(24)
    return F.lpad(hours.cast("string"), 2, "0")


def swap_bytes(value: Column) -> Column:
    """A BIGINT with its eight bytes in the opposite order; plain arithmetic, no text."""
    pairs, words = F.lit(0x00FF00FF00FF00FF), F.lit(0x0000FFFF0000FFFF)

    def swap(x: Column, mask: Column, bits: int) -> Column:
        low = F.shiftleft(x.bitwiseAND(mask), bits)
        return low.bitwiseOR(F.shiftrightunsigned(x, bits).bitwiseAND(mask))

    halves = swap(swap(value, pairs, 8), words, 16)
    return F.shiftleft(halves, 32).bitwiseOR(F.shiftrightunsigned(halves, 32))
