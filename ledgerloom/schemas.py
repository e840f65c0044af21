"""Table schemas. Amounts are unsigned 64-bit on the wire, hence DECIMAL(20,0)."""

from __future__ import annotations

from pyspark.sql import types as T

U64 = T.DecimalType(20, 0)

# Protocol names, source modes and the datasets of the derived layer.
PROTOCOLS = ("pump", "pumpswap")
SOURCE_MODES = ("block", "logs", "reconcile", "replay")
TYPED_DATASETS = ("tokens", "trades", "completions", "migrations", "pools")
DATASETS = ("events", *TYPED_DATASETS, "unknown_program_data")


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "u64": U64,
    "strings": T.ArrayType(T.StringType()),
}


def _schema(fields: str) -> T.StructType:
    """``"name type, name type"`` with the type words above."""
    struct = T.StructType()
    for field in fields.split(","):
        name, word = field.split()
        struct.add(name, _TYPES[word])
    return struct


RAW_TRANSACTION = _schema(
    "source_provider string, source_mode string, source_program string, slot bigint, "
    "block_time bigint, received_at timestamp, signature string, transaction_index int, "
    "rpc_transaction string"
)

RAW_LOG = _schema(
    "source_provider string, source_mode string, source_program string, slot bigint, "
    "received_at timestamp, signature string, err string, logs strings, "
    "subscription_id bigint, rpc_context string"
)

# Replay position of a RAW row: hour directory, logs before transactions, then line order.
REPLAY_ORDER = (
    T.StructType()
    .add("date", T.StringType())
    .add("hour", T.StringType())
    .add("kind", T.IntegerType())
    .add("received_us", T.LongType())
    .add("seq", T.LongType())
)

# Both RAW shapes in one: what the decode pipeline reads.
ENVELOPE = _schema(
    "source_provider string, source_mode string, source_program string, slot bigint, "
    "block_time bigint, received_at timestamp, signature string, transaction_index int, "
    "failed boolean, logs strings"
).add("replay_order", REPLAY_ORDER)

EVENTS = _schema(
    "event_id string, protocol string, program_id string, event_type string, signature string, "
    "slot bigint, block_time bigint, received_at timestamp, transaction_index int, log_index int, "
    "trailing_bytes int, payload_json string"
)

UNKNOWN = _schema(
    "event_id string, protocol string, program_id string, signature string, slot bigint, "
    "block_time bigint, received_at timestamp, transaction_index int, log_index int, "
    "discriminator_hex string, payload_size int, reason string"
)

TOKENS = _schema(
    "event_id string, mint string, creator string, user string, name string, symbol string, "
    "uri string, bonding_curve string, token_program string, quote_mint string, "
    "event_timestamp bigint, slot bigint, block_time bigint, received_at timestamp, "
    "signature string, virtual_token_reserves u64, virtual_sol_reserves u64, "
    "virtual_quote_reserves u64, real_token_reserves u64, "
    "token_total_supply u64, is_mayhem_mode boolean, is_cashback_enabled boolean"
)

TRADES = _schema(
    "event_id string, protocol string, side string, mint string, pool string, user string, "
    "quote_mint string, base_amount_raw u64, quote_amount_raw u64, "
    "slot bigint, block_time bigint, event_timestamp bigint, received_at timestamp, "
    "signature string, virtual_base_reserves u64, virtual_quote_reserves u64, "
    "real_base_reserves u64, real_quote_reserves u64, "
    "protocol_fee_raw u64, creator_fee_raw u64, lp_fee_raw u64, "
    "cashback_raw u64, buyback_fee_raw u64, ix_name string"
)

COMPLETIONS = _schema(
    "event_id string, mint string, user string, bonding_curve string, quote_mint string, "
    "event_timestamp bigint, slot bigint, block_time bigint, received_at timestamp, "
    "signature string"
)

MIGRATIONS = _schema(
    "event_id string, mint string, user string, bonding_curve string, pool string, "
    "quote_mint string, mint_amount_raw u64, quote_amount_raw u64, "
    "migration_fee_raw u64, event_timestamp bigint, slot bigint, block_time bigint, "
    "received_at timestamp, signature string"
)

POOLS = _schema(
    "event_id string, pool string, creator string, base_mint string, quote_mint string, "
    "base_mint_decimals int, quote_mint_decimals int, event_timestamp bigint, slot bigint, "
    "block_time bigint, received_at timestamp, signature string, base_amount_in u64, "
    "quote_amount_in u64, is_mayhem_mode boolean"
)

DERIVED = {
    "events": EVENTS,
    "tokens": TOKENS,
    "trades": TRADES,
    "completions": COMPLETIONS,
    "migrations": MIGRATIONS,
    "pools": POOLS,
    "unknown_program_data": UNKNOWN,
}

# State tables.
TRANSACTIONS = _schema(
    "signature string, slot bigint, source_program string, first_seen_at timestamp"
)
OBSERVATIONS = _schema(
    "signature string, program_id string, slot bigint, observed_at timestamp"
)
CHECKPOINTS = _schema(
    "program_id string, last_signature string, last_slot bigint, updated_at timestamp"
)
COUNTERS = _schema("key string, rule string, value bigint")

# Schema catalog.
EVENT_CATALOG = _schema(
    "protocol string, program_id string, event_type string, discriminator binary"
)
FIELD_CATALOG = _schema(
    "program_id string, type_name string, kind string, position int, field_name string, "
    "field_type string"
)
