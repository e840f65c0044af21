"""Decode attributed payloads; everything that does not fit the catalog exactly is quarantined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.base58 import b58encode
from ledgerloom.functions.borsh import DECODED, payload_decoder
from ledgerloom.functions.ids import event_id, swap_bytes
from ledgerloom.functions.loglines import data_reader
from ledgerloom.functions.pin import pin
from ledgerloom.functions.wire import typed_payload
from ledgerloom.operators.attribution import attribute, match_events
from ledgerloom.schemas import EVENTS, UNKNOWN
from ledgerloom.sources.catalog import Catalog

# Fixed value: event type used in the id of quarantined rows.
QUARANTINE_KIND = "program-data"


def decode(envelopes: DataFrame, catalog: Catalog) -> DataFrame:
    """Envelopes to decoded rows; ``reason`` is null for events, set for quarantined rows.

    Failed transactions yield nothing. One Arrow hop reads the logs and decodes the payloads in them;
    only the logs go there.
    """
    reader = data_reader(payload_decoder(catalog.layouts, catalog.names), DECODED)
    hits = attribute(envelopes.filter(~F.col("failed")), reader=reader)
    decoded = match_events(hits, catalog.events, catalog.programs)
    reason = (
        F.when(F.col("event_type").isNull(), "unknown-discriminator")
        .when(
            F.col("decoded.error").isNotNull(),
            F.concat(F.lit("decode-error: "), F.col("decoded.error")),
        )
        .when(
            F.col("decoded.trailing_bytes") > 0,
            F.concat(
                F.lit("schema-drift-trailing-bytes:"),
                F.col("decoded.trailing_bytes").cast("string"),
            ),
        )
    )
    return decoded.withColumn("reason", reason).withColumn(
        "event_id",
        event_id(
            F.col("signature"),
            F.col("program_id"),
            F.col("log_index"),
            F.when(F.col("reason").isNull(), F.col("event_type")).otherwise(QUARANTINE_KIND),
        ),
    )


def _dataset_columns() -> dict[str, Column]:
    """Every column of the two decode outputs, null where the row belongs to the other one."""
    event = F.col("reason").isNull()
    return {
        "event_type": F.when(event, F.col("event_type")),
        "trailing_bytes": F.when(event, F.col("decoded.trailing_bytes")),
        "payload_json": F.when(event, F.col("decoded.payload_json")),
        "discriminator_hex": F.when(~event, F.lower(F.hex("discriminator"))),
        "payload_size": F.when(~event, F.octet_length("raw")),
    }


def decoded_rows(decoded: DataFrame) -> DataFrame:
    """Events and quarantined rows in one frame, told apart by ``dataset``.

    One pass feeds both outputs, so the pipeline above it runs once.
    """
    columns = _dataset_columns()
    names = list(dict.fromkeys([*EVENTS.fieldNames(), *UNKNOWN.fieldNames()]))
    dataset = F.when(F.col("reason").isNull(), "events").otherwise("unknown_program_data")
    return decoded.select(
        dataset.alias("dataset"),
        *[columns[n].alias(n) if n in columns else F.col(n) for n in names],
    )


def events_of(decoded: DataFrame) -> DataFrame:
    return decoded_rows(decoded).filter("dataset = 'events'").select(*EVENTS.fieldNames())


def quarantine_of(decoded: DataFrame) -> DataFrame:
    return (
        decoded_rows(decoded)
        .filter("dataset = 'unknown_program_data'")
        .select(*UNKNOWN.fieldNames())
    )


def encode_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Replace binary key columns by their base58 text."""
    for name in columns:
        df = df.withColumn(name, b58encode(F.col(name)))
    return df


# Widths and signedness the built-in integer path covers.
_FIXED = {
    "u8": (1, False),
    "u16": (2, False),
    "u32": (4, False),
    "u64": (8, False),
    "i8": (1, True),
    "i16": (2, True),
    "i32": (4, True),
    "i64": (8, True),
    "bool": (1, False),
}


def stored_integer(raw: Column, offset: int, kind: str) -> Column:
    """The bytes of an integer as they lie, left-aligned in a BIGINT."""
    size, _ = _FIXED[kind]
    value = F.conv(F.hex(F.substring(raw, offset + 1, size)), 16, -10).cast("bigint")
    return F.shiftleft(value, 64 - 8 * size)


def little_endian(stored: Column, kind: str) -> Column:
    """The integer in ``stored_integer`` bytes with built-ins only, as DECIMAL(20,0)."""
    size, signed = _FIXED[kind]
    value = swap_bytes(stored)
    if signed:
        unused = 64 - 8 * size
        return F.shiftright(F.shiftleft(value, unused), unused).cast("decimal(20,0)")
    if size < 8:
        return value.cast("decimal(20,0)")
    # A negative BIGINT stands for the upper half of the unsigned range.
    wrap = F.when(stored.bitwiseAND(F.lit(0x80)) != 0, F.lit(str(1 << 64))).otherwise("0")
    return (value.cast("decimal(20,0)") + wrap.cast("decimal(20,0)")).cast("decimal(20,0)")


def decode_fixed(df: DataFrame, layout: list[tuple[str, str]], raw: str = "raw") -> DataFrame:
    """Decode fixed-width integer layouts without leaving the JVM.

    ``layout`` lists (column, wire type) after the eight discriminator bytes. Payloads of any
    other length than the layout's give null columns, never a partial row.
    """
    offset = 8
    fields = []
    for name, kind in layout:
        fields.append((name, kind, offset))
        offset += _FIXED[kind][0]
    whole = F.when(F.octet_length(raw) == offset, F.col(raw))
    stored = F.struct(*[stored_integer(whole, at, kind).alias(n) for n, kind, at in fields])
    return pin(df, "_stored", stored).select(
        *df.columns, *[little_endian(F.col(f"_stored.{n}"), kind).alias(n) for n, kind, _ in fields]
    )


def decode_typed(df: DataFrame, event_type: str, types: dict, raw: str = "raw") -> DataFrame:
    """Decode payloads of one event of any layout without leaving the JVM.

    Adds one typed column for each field, ``reason`` as in ``decode`` (null for a whole event) and
    nothing else. Fields of a row with a reason are null, those of a null payload likewise. Keys stay
    binary; ``encode_keys`` turns them into base58. Layouts that hold themselves are refused.
    """
    read = pin(df, "_read", typed_payload(F.col(raw), event_type, types))
    left = F.col("_read.trailing_bytes")
    reason = F.when(
        F.col("_read.error").isNotNull(), F.concat(F.lit("decode-error: "), F.col("_read.error"))
    ).when(left > 0, F.concat(F.lit("schema-drift-trailing-bytes:"), left.cast("string")))
    names = [name or f"_{i}" for i, (name, _) in enumerate(types[event_type][1])]
    return read.select(
        *df.columns,
        *[F.when(reason.isNull(), F.col("_read.value").getField(n)).alias(n) for n in names],
        reason.alias("reason"),
    )
