"""Ledger-shaped inputs derived from the test tables.

Text that both engines can run is written once as SQL (``*_SQL``) and used by the Spark views here
and by the comparison queries in ``oracle``. ``{us}`` and ``{b64:...}`` stand for the two functions
the engines name differently.
"""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.ids import swap_bytes
from ledgerloom.session import prepare, spread
from ledgerloom.sources.catalog import Catalog, catalog_of

# Invented program names of the derived ledger.
CURVE = "CurveProgram1111"
POOL = "PooLProgram1111"

_DIALECT = {
    "spark": {"us": "unix_micros(CAST(ts AS TIMESTAMP))", "b64": "base64(CAST({} AS BINARY))"},
    "duckdb": {"us": "epoch_us(ts)", "b64": "base64(encode({}))"},
}


def sql_text(template: str, engine: str) -> str:
    """Fill the engine-specific functions into shared SQL."""
    words = _DIALECT[engine]
    text = template.replace("{us}", words["us"])
    return re.sub(r"\{b64:([^{}]*)\}", lambda m: words["b64"].format(m.group(1)), text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; the session works in UTC, as the tables do."""
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def select(df: DataFrame, template: str) -> DataFrame:
    """Project shared ``name: expression`` lines."""
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns(template, "spark")])


def columns(template: str, engine: str) -> list[tuple[str, str]]:
    pairs = []
    for line in template.strip().split(";\n"):
        name, expression = line.strip().rstrip(";").split(": ", 1)
        pairs.append((name, sql_text(" ".join(expression.split()), engine)))
    return pairs


# Transactions: three copies per signature, arriving in event_id order within hour and kind.
OBS_SQL = f"""
event_id: event_id;
signature: 'sig' || CAST(CAST(floor(event_id / 3) AS BIGINT) AS STRING);
source_program: CASE WHEN event_id % 2 = 0 THEN '{CURVE}' ELSE '{POOL}' END;
slot: CAST(floor({{us}} / 60000000.0) AS BIGINT);
arrival_us: {{us}};
hours: CAST(floor({{us}} / 3600000000.0) AS BIGINT);
kind: CAST(event_id % 2 AS INT);
failed: event_type = 'error';
event_type: event_type;
amount: CAST(round(value * 100) AS BIGINT)
"""


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed transactions with their replay order."""
    rows = select(table(spark, sf_dir, "events"), OBS_SQL)
    order = F.struct(
        F.lit("").alias("date"),
        F.lpad(F.col("hours").cast("string"), 10, "0").alias("hour"),
        F.col("kind"),
        F.lit(0).cast("bigint").alias("received_us"),
        F.col("event_id").alias("seq"),
    )
    return rows.withColumn("received_at", F.timestamp_micros("arrival_us")).withColumn(
        "replay_order", order
    )


# Sixteen lines per transaction: nested, malformed, noisy and undecodable ones among them.
LINES_SQL = """
tx: CAST(floor(event_id / 16) AS BIGINT);
i: CAST(event_id % 16 AS INT);
line: CASE
  WHEN event_id % 11 = 0 THEN 'Program log: step ' || CAST(event_id AS STRING)
  WHEN event_type = 'signup' THEN 'Program AAA invoke [' || CAST(event_id % 4 + 1 AS STRING) || ']'
  WHEN event_type = 'click' THEN 'Program BBB invoke [2]'
  WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN 'Program data: Y' || CAST(event_id AS STRING) || '!'
  WHEN event_type = 'purchase' THEN 'Program data: ' || {b64:'v' || CAST(event_id AS STRING)}
  WHEN event_type = 'view' THEN 'Program AAA success'
  WHEN event_id % 3 = 0 THEN 'Program BBB failed: '
  ELSE 'Program BBB failed: x' END
"""


def log_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tx, logs). A transaction is sixteen consecutive unique ids, so a group is never larger."""
    lines = select(table(spark, sf_dir, "events"), LINES_SQL)
    gathered = F.array_sort(F.collect_list(F.struct("i", "line")))
    return lines.groupBy("tx").agg(F.transform(gathered, lambda x: x["line"]).alias("logs"))


# Frame text of every kind the classifier tells apart.
FRAMES_SQL = """
event_id: event_id;
arrival_us: {us};
subscription: CASE WHEN event_id % 10 = 3 THEN 99 ELSE 1 + event_id % 2 END;
frame: CASE
  WHEN event_type = 'signup' THEN '{"jsonrpc":"2.0","method":"blockNotification","params":{"subscription":'
    || CAST(CASE WHEN event_id % 10 = 3 THEN 99 ELSE 1 + event_id % 2 END AS STRING)
    || ',"result":{"context":{"slot":' || CAST(event_id AS STRING) || '},"value":{"slot":'
    || CASE WHEN event_id % 3 = 0 THEN '0' ELSE CAST(event_id + 7 AS STRING) END
    || CASE WHEN event_id % 13 = 0 THEN ',"err":"boom"' ELSE ',"err":null' END
    || CASE WHEN event_id % 17 = 0 THEN ',"block":null' ELSE ',"block":{"blockTime":'
       || CASE WHEN event_id % 4 = 0 THEN 'null' ELSE CAST(1700000000 + event_id AS STRING) END
       || ',"transactions":[{"transaction":{"signatures":["t' || CAST(event_id AS STRING)
       || 'a","x"]},"meta":{"err":{"x":1}},"version":"legacy"},{"transaction":{"signatures":[]},"meta":null},'
       || '{"transaction":{"signatures":["t' || CAST(event_id AS STRING)
       || 'b"]},"meta":{"err":null,"logMessages":["Program AAA invoke [1]"]},"version":0}]}' END
    || '}}}}'
  WHEN event_type IN ('click', 'view') THEN '{"jsonrpc":"2.0","method":"logsNotification","params":{"subscription":'
    || CAST(1 + event_id % 2 AS STRING) || ',"result":{"context":{"slot":' || CAST(event_id AS STRING)
    || '},"value":{"signature":"s' || CAST(CAST(floor(event_id / 2) AS BIGINT) AS STRING)
    || '","err":null,"logs":["Program AAA invoke [1]","Program data: YQ=="]}}}}'
  WHEN event_type = 'error' THEN '{"jsonrpc":"2.0","method":"logsNotification","params":{"subscription":1,"result":'
    || '{"context":{"slot":1},"value":{"signature":"f' || CAST(event_id AS STRING)
    || '","err":{"code":' || CAST(event_id % 5 AS STRING) || '},"logs":[]}}}}'
  WHEN event_id % 4 = 0 THEN '{"jsonrpc":"2.0","id":' || CAST(event_id AS STRING) || ',"result":77}'
  WHEN event_id % 4 = 1 THEN '{"jsonrpc":"2.0","method":"logsNotification","params":{"subscription":1,"result":'
    || '{"context":{"slot":1},"value":{"signature":"n' || CAST(event_id AS STRING) || '","logs":[1]}}}}'
  WHEN event_id % 4 = 2 THEN '{"broken' || CAST(event_id AS STRING)
  ELSE '["logsNotification"]' END
"""

SUBSCRIPTIONS = [(1, CURVE), (2, POOL)]


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, received_at, value) wire frames."""
    rows = select(table(spark, sf_dir, "events"), FRAMES_SQL)
    return rows.withColumn("received_at", F.timestamp_micros("arrival_us")).withColumnRenamed(
        "frame", "value"
    )


def subscriptions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SUBSCRIPTIONS, "subscription_id bigint, program_id string")


# JSON documents with optional, nested and mixed-type members.
PAYLOADS_SQL = """
event_id: event_id;
payload: CASE
  WHEN event_id % 29 = 0 THEN '[' || CAST(event_id AS STRING) || ',{"k":null}]'
  WHEN event_id % 31 = 0 THEN '"text"'
  WHEN event_id % 37 = 0 THEN 'not json ' || CAST(event_id AS STRING)
  ELSE '{"event":"' || event_type || '","Mint":"m' || CAST(user_id AS STRING) || '"'
    || CASE WHEN event_id % 2 = 0 THEN ',"creator":null' ELSE '' END
    || CASE WHEN event_id % 3 = 0 THEN ',"a/b":' || CAST(event_id AS STRING) ELSE ',"a/b":1.0' END
    || CASE WHEN event_id % 5 = 0 THEN ',"extra":{"open":true,"user":"u"}'
            WHEN event_id % 5 = 1 THEN ',"extra":{"open":null}'
            WHEN event_id % 5 = 2 THEN ',"extra":[{"x":1},{"x":"1"},2]'
            ELSE '' END
    || ',"props":' || props || '}' END
"""


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, payload) JSON texts, a few of them invalid."""
    return select(table(spark, sf_dir, "events"), PAYLOADS_SQL)


# Signature listing per program, newest first, a tenth of it failed.
LISTING_SQL = f"""
program_id: CASE WHEN event_id % 2 = 0 THEN '{CURVE}' ELSE '{POOL}' END;
position: -event_id;
signature: 'sig' || CAST(event_id AS STRING);
slot: CAST(floor({{us}} / 60000000.0) AS BIGINT);
err: CASE WHEN event_id % 10 = 9 THEN '{{"x":1}}' END;
event_id: event_id
"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(table(spark, sf_dir, "events"), LISTING_SQL)


# --- a whole ledger out of lineitem and orders --------------------------------------------------

# Invented layouts, in the catalog's own form.
_LAYOUTS = {
    CURVE: {
        "TradeEvent": [
            ("mint", "pubkey"), ("user", "pubkey"), ("is_buy", "bool"), ("token_amount", "u64"),
            ("sol_amount", "u64"), ("quote_amount", "u64"), ("timestamp", "i64"), ("fee", "u64"),
            ("ix_name", "string"),
        ],
        "CompleteEvent": [
            ("user", "pubkey"), ("mint", "pubkey"), ("bonding_curve", "pubkey"),
            ("timestamp", "i64"),
        ],
        "CompletePumpAmmMigrationEvent": [
            ("user", "pubkey"), ("mint", "pubkey"), ("mint_amount", "u64"), ("sol_amount", "u64"),
            ("pool_migration_fee", "u64"), ("bonding_curve", "pubkey"), ("timestamp", "i64"),
            ("pool", "pubkey"), ("quote_mint", "pubkey"),
        ],
        "CreateEvent": [
            ("name", "string"), ("symbol", "string"), ("uri", "string"), ("mint", "pubkey"),
            ("bonding_curve", "pubkey"), ("user", "pubkey"), ("creator", "pubkey"),
            ("timestamp", "i64"), ("virtual_token_reserves", "u64"),
            ("virtual_sol_reserves", "u64"), ("real_token_reserves", "u64"),
            ("token_total_supply", "u64"), ("token_program", "pubkey"),
            ("is_mayhem_mode", "bool"),
        ],
        "Note": [("text", "string")],
    },
    POOL: {
        "BuyEvent": [
            ("pool", "pubkey"), ("user", "pubkey"), ("base_amount_out", "u64"),
            ("quote_amount_in", "u64"), ("timestamp", "i64"), ("lp_fee", "u64"),
        ],
        "SellEvent": [
            ("pool", "pubkey"), ("user", "pubkey"), ("base_amount_in", "u64"),
            ("quote_amount_out", "u64"), ("timestamp", "i64"), ("lp_fee", "u64"),
        ],
        "CreatePoolEvent": [
            ("pool", "pubkey"), ("creator", "pubkey"), ("base_mint", "pubkey"),
            ("quote_mint", "pubkey"), ("base_mint_decimals", "u8"),
            ("quote_mint_decimals", "u8"), ("base_amount_in", "u64"),
            ("quote_amount_in", "u64"), ("timestamp", "i64"),
        ],
    },
}
PROTOCOL_OF = {CURVE: "pump", POOL: "pumpswap"}


def discriminator(event: str) -> bytes:
    """Invented rule: the first eight bytes of a digest of the name."""
    return hashlib.sha256(f"derived:{event}".encode()).digest()[:8]


def ledger_catalog(spark: SparkSession) -> Catalog:
    events = [
        (PROTOCOL_OF[p], p, e, bytearray(discriminator(e)))
        for p, layouts in _LAYOUTS.items()
        for e in layouts
    ]
    fields = [
        (p, e, "struct", i, name, f'"{kind}"')
        for p, layouts in _LAYOUTS.items()
        for e, layout in layouts.items()
        for i, (name, kind) in enumerate(layout)
    ]
    return catalog_of(spark, events, fields)


def little_endian_hex(value: Column, size: int) -> Column:
    """Little-endian hex of a BIGINT, two's complement."""
    text = F.lpad(F.hex(swap_bytes(value.cast("bigint"))), 16, "0")
    return F.substring(text, 1, 2 * size)


def _encode(kind: str, value: Column) -> Column:
    """Hex of one value on the wire. Keys are 32 bytes with a BIGINT in the last eight."""
    if kind == "pubkey":
        return F.lpad(F.hex(value.cast("bigint")), 64, "0")
    if kind == "bool":
        return F.when(value, "01").otherwise("00")
    if kind == "string":
        return F.concat(little_endian_hex(F.octet_length(value), 4), F.hex(F.encode(value, "UTF-8")))
    return little_endian_hex(value, int(kind[1:]) // 8)


def payload_hex(program: str, event: str, values: dict[str, Column]) -> Column:
    """Hex of a whole event payload."""
    body = [_encode(kind, values[name]) for name, kind in _LAYOUTS[program][event]]
    return F.concat(F.lit(discriminator(event).hex().upper()), *body)


def data_line(payload: Column) -> Column:
    # Spark breaks long base64 into lines; the wire format does not.
    text = F.replace(F.base64(F.unhex(payload)), F.lit("\r\n"), F.lit(""))
    return F.concat(F.lit("Program data: "), text)


# One trade per line item. Duplicated (order, line) pairs are repeated observations.
TRADES_SQL = """
signature: 'L' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING);
on_curve: l_linestatus = 'F';
is_buy: l_returnflag = 'A';
failed: l_discount = 0.1;
mint_key: l_partkey * 1000003 + 17;
user_key: l_suppkey * 7919 + 3;
base: CAST(l_quantity AS BIGINT) * 1000000;
quote: CAST(round(l_extendedprice * 100) AS BIGINT);
quote_field: CASE WHEN l_linenumber = 1 THEN 0 ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END;
fee: CAST(round(l_tax * 10000) AS BIGINT);
slot: l_orderkey + l_linenumber;
seconds: 1700000000 + l_orderkey % 400000;
l_orderkey: l_orderkey;
l_linenumber: l_linenumber;
l_partkey: l_partkey;
l_suppkey: l_suppkey;
l_shipdate: l_shipdate
"""


# What of a line item a trade is made of besides its replay order. Everything else is derived after
# the first copies are chosen, so that only these few columns are sorted and shuffled.
TRADE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)


def _signature(template: str) -> Column:
    return F.expr(dict(columns(template, "spark"))["signature"]).alias("signature")


def _derived(rows: DataFrame, template: str, **ordered: str) -> DataFrame:
    """Observed rows with the columns of ``template``; ``ordered`` columns come from the replay order."""
    whole = rows.withColumns({name: F.col(f"replay_order.{part}") for name, part in ordered.items()})
    return whole.selectExpr(*[f"{e} AS {n}" for n, e in columns(template, "spark")], "replay_order")


def trade_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as observed trades with their replay order, before their logs are written out."""
    order = F.struct(
        F.col("l_shipdate").alias("at"), F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")
    )
    rows = spread(table(spark, sf_dir, "lineitem"))
    return rows.select(_signature(TRADES_SQL), *TRADE_COLUMNS, order.alias("replay_order"))


def trade_envelopes(rows: DataFrame) -> DataFrame:
    """RAW envelopes with encoded trades in their logs.

    Line 6 carries a trailing byte, line 7 an unknown discriminator; both must be quarantined.
    """
    rows = _derived(rows, TRADES_SQL, l_shipdate="at", l_partkey="a", l_suppkey="b")
    when = F.col("seconds")
    curve = payload_hex(
        CURVE, "TradeEvent",
        {
            "mint": F.col("mint_key"), "user": F.col("user_key"), "is_buy": F.col("is_buy"),
            "token_amount": F.col("base"), "sol_amount": F.col("quote") + 1,
            "quote_amount": F.col("quote_field"), "timestamp": when, "fee": F.col("fee"),
            "ix_name": F.when(F.col("is_buy"), "buy").otherwise("sell"),
        },
    )
    shared = {
        "pool": F.col("mint_key"), "user": F.col("user_key"), "timestamp": when,
        "lp_fee": F.col("fee"),
    }
    buy = payload_hex(
        POOL, "BuyEvent",
        {**shared, "base_amount_out": F.col("base"), "quote_amount_in": F.col("quote")},
    )
    sell = payload_hex(
        POOL, "SellEvent",
        {**shared, "base_amount_in": F.col("base"), "quote_amount_out": F.col("quote")},
    )
    whole = F.when(F.col("on_curve"), curve).when(F.col("is_buy"), buy).otherwise(sell)
    stored = (
        F.when(F.col("l_linenumber") == 6, F.concat(whole, F.lit("00")))
        .when(F.col("l_linenumber") == 7, F.concat(F.lit("0000000000000000"), whole))
        .otherwise(whole)
    )
    program = F.when(F.col("on_curve"), CURVE).otherwise(POOL)
    logs = F.array(
        F.lit("Program RouterAAAA invoke [1]"),
        F.concat(F.lit("Program "), program, F.lit(" invoke [2]")),
        F.lit("Program log: trade"),
        data_line(stored),
        F.concat(F.lit("Program "), program, F.lit(" success")),
        F.lit("Program RouterAAAA success"),
    )
    return rows.select(
        F.lit("derived").alias("source_provider"),
        F.lit("block").alias("source_mode"),
        program.alias("source_program"),
        "slot",
        when.alias("block_time"),
        F.timestamp_seconds(when + 1).alias("received_at"),
        "signature",
        F.col("l_linenumber").cast("int").alias("transaction_index"),
        "failed",
        logs.alias("logs"),
        "replay_order",
    )


ORDERS_SQL = """
signature: 'O' || CAST(o_orderkey AS STRING);
user_key: o_custkey * 31 + 5;
mint_key: o_orderkey * 1000003 + 17;
pool_key: o_orderkey * 15485863 + 1;
quote_key: CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 255 END;
amount: CAST(round(o_totalprice * 100) AS BIGINT);
failed: o_orderpriority = '5-LOW';
slot: o_orderkey;
seconds: 1700000000 + o_orderkey % 200000;
o_orderkey: o_orderkey;
o_orderdate: o_orderdate
"""


ORDER_COLUMNS = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def lifecycle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observed transactions with their replay order, before their logs are written out."""
    order = F.struct(
        F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("a"), F.lit(0).cast("bigint").alias("b")
    )
    rows = spread(table(spark, sf_dir, "orders"))
    return rows.select(_signature(ORDERS_SQL), *ORDER_COLUMNS, order.alias("replay_order"))


def lifecycle_envelopes(rows: DataFrame) -> DataFrame:
    """One transaction per order: a curve completes, and inside it a pool is created, then the
    curve migrates. Both programs speak in the same log."""
    rows = _derived(rows, ORDERS_SQL, o_orderdate="at", o_orderkey="a")
    when = F.col("seconds")
    keys = {
        "user": F.col("user_key"), "creator": F.col("user_key"), "mint": F.col("mint_key"),
        "base_mint": F.col("mint_key"), "bonding_curve": F.col("mint_key") + 1,
        "pool": F.col("pool_key"), "quote_mint": F.col("quote_key"), "timestamp": when,
        "token_program": F.lit(6),
    }
    created = payload_hex(
        CURVE, "CreateEvent",
        {
            **keys, "name": F.concat(F.lit("né "), F.col("signature")), "symbol": F.lit("S"),
            "uri": F.concat(F.lit("u/\""), F.col("signature")),
            "virtual_token_reserves": F.col("amount"), "virtual_sol_reserves": F.lit(0),
            "real_token_reserves": F.col("amount") * 2,
            "token_total_supply": F.lit(10**15), "is_mayhem_mode": F.col("o_orderkey") % 2 == 1,
        },
    )
    complete = payload_hex(CURVE, "CompleteEvent", keys)
    migrate = payload_hex(
        CURVE, "CompletePumpAmmMigrationEvent",
        {
            **keys, "mint_amount": F.col("amount") * 3, "sol_amount": F.col("amount"),
            "pool_migration_fee": F.lit(15),
        },
    )
    pool = payload_hex(
        POOL, "CreatePoolEvent",
        {
            **keys, "base_mint_decimals": F.lit(6), "quote_mint_decimals": F.lit(9),
            "base_amount_in": F.col("amount") * 3, "quote_amount_in": F.col("amount"),
        },
    )
    note = payload_hex(CURVE, "Note", {"text": F.col("signature")})
    logs = F.array(
        F.lit(f"Program {CURVE} invoke [1]"),
        data_line(created),
        data_line(complete),
        F.lit(f"Program {POOL} invoke [2]"),
        data_line(pool),
        F.lit(f"Program {POOL} success"),
        data_line(migrate),
        data_line(note),
        F.lit(f"Program {CURVE} success"),
    )
    return rows.select(
        F.lit("derived").alias("source_provider"),
        F.lit("logs").alias("source_mode"),
        F.lit(CURVE).alias("source_program"),
        "slot",
        F.lit(None).cast("bigint").alias("block_time"),
        F.timestamp_seconds(when).alias("received_at"),
        "signature",
        F.lit(None).cast("int").alias("transaction_index"),
        "failed",
        logs.alias("logs"),
        "replay_order",
    )


# A layout with every kind of wire type, under a program of its own.
SAMPLER = "SampLerProgram1111"
SAMPLE_TYPES = {
    "Sample": ("struct", [
        ("id", "u64"), ("note", {"option": "string"}), ("tags", {"vec": "string"}), ("counts", {"vec": "u32"}),
        ("triple", {"array": ["u16", 3]}), ("pair", {"tuple": ["i32", "bool"]}), ("share", {"defined": "Share"}),
        ("choice", {"defined": "Choice"}), ("big", "u128"), ("low", "i128"),
    ]),
    "Share": ("struct", [("bps", "i16"), ("owner", "bytes")]),
    "Choice": ("enum", [("None", []), ("Named", [("a", "i64")]), ("Pair", [(None, "u8"), (None, "string")])]),
}


def sampler_catalog(spark: SparkSession) -> Catalog:
    fields = []
    for name, (kind, members) in SAMPLE_TYPES.items():
        for i, (member, spec) in enumerate(members):
            if kind == "enum":
                spec = [{"name": n, "type": t} if n else t for n, t in spec]
            fields.append((SAMPLER, name, kind, i, member, json.dumps(spec)))
    return catalog_of(spark, [("sampler", SAMPLER, "Sample", bytearray(discriminator("Sample")))], fields)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, raw) per order; the key modulo 13 breaks one rule of the layout in 1 to 8."""
    key, cust, status, priority = (F.col(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))

    def broken(n: int, bad: str, good: Column) -> Column:
        return F.when(key % 13 == n, bad).otherwise(good)

    def vector(count: Column, item) -> Column:
        numbers = F.filter(F.sequence(F.lit(0), F.lit(3)), lambda i: i < count)
        return F.concat(little_endian_hex(count, 4), F.array_join(F.transform(numbers, item), ""))

    text = F.concat(priority, F.lit("é"))
    note = F.when(key % 3 == 0, "00").otherwise(F.concat(F.lit("01"), _encode("string", text)))
    choice = (
        F.when(key % 3 == 0, "00")
        .when(key % 3 == 1, F.concat(F.lit("01"), little_endian_hex(-key, 8)))
        .otherwise(F.concat(F.lit("02"), little_endian_hex(key % 256, 1), _encode("string", status)))
    )
    body = F.concat(
        F.lit(discriminator("Sample").hex()),
        little_endian_hex(key * 1000003, 8),
        broken(3, "02", broken(7, "019F860100", broken(8, "0102000000FFFE", note))),
        vector(key % 4, lambda i: _encode("string", F.concat(status, i.cast("string")))),
        broken(6, "41420F00", vector(key % 3, lambda i: little_endian_hex(cust + i, 4))),
        little_endian_hex(cust % 65536, 2), F.lit("0100FFFF"),
        little_endian_hex(-cust, 4), broken(4, "07", _encode("bool", key % 2 == 0)),
        little_endian_hex(-(key % 100), 2), _encode("string", priority),
        broken(5, "09", choice),
        little_endian_hex(cust, 8), little_endian_hex(key, 8),
        little_endian_hex(cust, 8), little_endian_hex(-key - 1, 8),
        broken(2, "00", F.lit("")),
    )
    cut = F.when(key % 13 == 1, F.substring(body, F.lit(1), F.length(body) - 2)).otherwise(body)
    return spread(table(spark, sf_dir, "orders")).select("o_orderkey", F.unhex(cut).alias("raw"))
