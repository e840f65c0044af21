"""Which program emitted each ``Program data:`` line of a transaction's nested log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.loglines import data_reader


def attribute(envelopes: DataFrame, logs: str = "logs", reader: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per attributed data line: the input columns but ``logs``, plus the hit.

    An invoke pushes. An exit pops down to the last matching program and is ignored when there is
    none. A data line with an empty stack, or with malformed base64, is dropped. ``reader`` is a
    ``data_reader`` that decodes payloads on the way.
    """
    keep = [c for c in envelopes.columns if c != logs]
    read = envelopes.withColumn("_hits", (reader or data_reader())(F.col(logs)))
    return read.select(*keep, F.inline("_hits"))


def match_events(hits: DataFrame, events: DataFrame, programs: DataFrame) -> DataFrame:
    """Keep known programs and name the event by the first eight bytes.

    ``event_type`` is null for short payloads and unknown discriminators. Both catalog sides are
    size-checked when the catalog is built, so they are broadcast.
    """
    known = hits.join(F.broadcast(programs), "program_id")
    by_bytes = events.select("program_id", "event_type", "discriminator")
    return (
        known.withColumn("discriminator", F.substring("raw", 1, 8))
        .join(F.broadcast(by_bytes), ["program_id", "discriminator"], "left")
    )
