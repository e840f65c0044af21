"""The same results as plain SQL over the test tables, for comparison in DuckDB."""

from __future__ import annotations

from ledgerloom.functions.base58 import ALPHABET
from ledgerloom.plans import views

ORACLE: dict[str, str] = {}


def _cte(name: str, template: str, source: str) -> str:
    body = ", ".join(f"{e} AS {n}" for n, e in views.columns(template, "duckdb"))
    return f"{name} AS (SELECT {body} FROM {source})"


OBS = _cte("obs", views.OBS_SQL, "events")
LINES = _cte("lines", views.LINES_SQL, "events")
FRAMES = _cte("frames", views.FRAMES_SQL, "events")
PAYLOADS = _cte("payloads", views.PAYLOADS_SQL, "events")
LISTING = _cte("listing", views.LISTING_SQL, "events")
TRADES = _cte("items", views.TRADES_SQL, "lineitem")
ORDERS = _cte("life", views.ORDERS_SQL, "orders")

# The first copy per signature, in replay order.
FIRST = f"""{OBS}, first AS (
  SELECT * FROM obs QUALIFY row_number() OVER (
    PARTITION BY signature ORDER BY lpad(CAST(hours AS VARCHAR), 10, '0'), kind, event_id) = 1)"""


def _b58(value: str, width: int) -> str:
    """Base58 of a BIGINT stored big-endian in ``width`` bytes."""
    powers = ", ".join(str(58**i) for i in range(10, -1, -1))
    digits = (
        f"array_to_string(list_transform([{powers}], lambda p: "
        f"substr('{ALPHABET}', CAST(({value} // p) % 58 AS INT) + 1, 1)), '')"
    )
    used = f"CASE WHEN {value} = 0 THEN 0 ELSE (length(hex({value})) + 1) // 2 END"
    return f"repeat('1', CAST({width} - ({used}) AS INT)) || ltrim({digits}, '1')"


def _id(signature: str, program: str, log_index: str, kind: str) -> str:
    return (
        f"sha256({signature} || '|' || {program} || '|' || CAST({log_index} AS VARCHAR) "
        f"|| '|' || {kind})"
    )


# Trades that survive first-wins, the failed filter and the quarantine.
LEDGER = f"""{TRADES}, won AS (
  SELECT *, CASE WHEN on_curve THEN '{views.CURVE}' ELSE '{views.POOL}' END AS program_id,
    CASE WHEN on_curve THEN 'pump' ELSE 'pumpswap' END AS protocol,
    CASE WHEN on_curve THEN 'TradeEvent' WHEN is_buy THEN 'BuyEvent' ELSE 'SellEvent' END
      AS event_type
  FROM items
  QUALIFY row_number() OVER (
    PARTITION BY signature ORDER BY l_shipdate, l_partkey, l_suppkey) = 1),
live AS (SELECT * FROM won WHERE NOT failed),
good AS (SELECT *,
    CASE WHEN on_curve AND quote_field = 0 THEN quote + 1 ELSE quote END AS quote_raw
  FROM live WHERE l_linenumber < 6)"""

ORACLE["volume"] = f"""
WITH {LEDGER}
SELECT protocol, CASE WHEN is_buy THEN 'buy' ELSE 'sell' END AS side, count(*) AS n,
  CAST(CAST(sum(quote_raw) AS HUGEINT) AS VARCHAR) AS quote_raw
FROM good GROUP BY ALL"""

_EVENT_ID = _id("signature", "program_id", "3", "event_type")
ORACLE["normalize_trades"] = f"""
WITH {LEDGER}
SELECT {_EVENT_ID} AS event_id, protocol, CASE WHEN is_buy THEN 'buy' ELSE 'sell' END AS side,
  CASE WHEN on_curve THEN {_b58('mint_key', 32)} END AS mint,
  CASE WHEN NOT on_curve THEN {_b58('mint_key', 32)} END AS pool,
  {_b58('user_key', 32)} AS "user", CAST(NULL AS VARCHAR) AS quote_mint,
  CAST(base AS VARCHAR) AS base_amount_raw, CAST(quote_raw AS VARCHAR) AS quote_amount_raw,
  slot, seconds AS block_time, seconds AS event_timestamp, seconds + 1 AS received_s, signature,
  CASE WHEN on_curve THEN CAST(fee AS VARCHAR) END AS protocol_fee_raw,
  CASE WHEN NOT on_curve THEN CAST(fee AS VARCHAR) END AS lp_fee_raw,
  CAST(NULL AS VARCHAR) AS virtual_quote_reserves,
  CASE WHEN on_curve THEN CASE WHEN is_buy THEN 'buy' ELSE 'sell' END END AS ix_name
FROM good"""

ORACLE["decoded_events"] = f"""
WITH {LEDGER}, keyed AS (
  SELECT *, {_b58('mint_key', 32)} AS mint, {_b58('user_key', 32)} AS who FROM good)
SELECT {_EVENT_ID} AS event_id, protocol, program_id, event_type, signature, slot,
  seconds AS block_time, CAST(l_linenumber AS INT) AS transaction_index, 3 AS log_index,
  0 AS trailing_bytes,
  CASE event_type
    WHEN 'TradeEvent' THEN '{{"fee":' || fee || ',"is_buy":' || CAST(is_buy AS VARCHAR)
      || ',"ix_name":"' || CASE WHEN is_buy THEN 'buy' ELSE 'sell' END || '","mint":"' || mint
      || '","quote_amount":' || quote_field || ',"sol_amount":' || (quote + 1)
      || ',"timestamp":' || seconds || ',"token_amount":' || base || ',"user":"' || who || '"}}'
    WHEN 'BuyEvent' THEN '{{"base_amount_out":' || base || ',"lp_fee":' || fee || ',"pool":"'
      || mint || '","quote_amount_in":' || quote || ',"timestamp":' || seconds || ',"user":"'
      || who || '"}}'
    ELSE '{{"base_amount_in":' || base || ',"lp_fee":' || fee || ',"pool":"' || mint
      || '","quote_amount_out":' || quote || ',"timestamp":' || seconds || ',"user":"'
      || who || '"}}' END AS payload_json
FROM keyed"""

_SIZE = {
    "TradeEvent": f"{8 + 32 + 32 + 1 + 8 * 5 + 4} + CASE WHEN is_buy THEN 3 ELSE 4 END",
    "BuyEvent": f"{8 + 32 + 32 + 8 * 4}",
}
_QUARANTINE = f"""{LEDGER}, bad AS (
  SELECT *, CASE WHEN l_linenumber = 6 THEN 'schema-drift-trailing-bytes:1'
    ELSE 'unknown-discriminator' END AS reason
  FROM live WHERE l_linenumber >= 6)"""
_DISCRIMINATORS = " ".join(
    f"WHEN '{e}' THEN '{views.discriminator(e).hex()}'"
    for e in ("TradeEvent", "BuyEvent", "SellEvent")
)
ORACLE["quarantine"] = f"""
WITH {_QUARANTINE}
SELECT {_id('signature', 'program_id', '3', "'program-data'")} AS event_id, protocol, program_id,
  signature, slot, 3 AS log_index,
  CASE WHEN l_linenumber = 7 THEN '0000000000000000'
    ELSE CASE event_type {_DISCRIMINATORS} END END AS discriminator_hex,
  CAST(CASE WHEN on_curve THEN {_SIZE['TradeEvent']} ELSE {_SIZE['BuyEvent']} END
    + CASE WHEN l_linenumber = 6 THEN 1 ELSE 8 END AS INT) AS payload_size, reason
FROM bad"""

ORACLE["quarantine_review"] = f"""
WITH {_QUARANTINE}
SELECT program_id, split_part(reason, ':', 1) AS reason_class, count(*) AS "rows"
FROM bad GROUP BY ALL"""

LIFE = f"""{ORDERS}, done AS (SELECT * FROM life WHERE NOT failed)"""


def _life_id(program: str, log_index: int, event: str) -> str:
    return _id("signature", f"'{program}'", str(log_index), f"'{event}'")


ORACLE["normalize_tokens"] = f"""
WITH {LIFE}
SELECT {_life_id(views.CURVE, 1, 'CreateEvent')} AS event_id, {_b58('mint_key', 32)} AS mint,
  {_b58('user_key', 32)} AS creator, {_b58('user_key', 32)} AS "user",
  'né ' || signature AS name, 'S' AS symbol, 'u/"' || signature AS uri,
  {_b58('(mint_key + 1)', 32)} AS bonding_curve, {_b58('CAST(6 AS BIGINT)', 32)} AS token_program,
  CAST(NULL AS VARCHAR) AS quote_mint, seconds AS event_timestamp, slot,
  CAST(NULL AS BIGINT) AS block_time, signature,
  CAST(amount AS VARCHAR) AS virtual_token_reserves, '0' AS virtual_sol_reserves,
  CAST(NULL AS VARCHAR) AS virtual_quote_reserves,
  CAST(amount * 2 AS VARCHAR) AS real_token_reserves,
  '1000000000000000' AS token_total_supply, o_orderkey % 2 = 1 AS is_mayhem_mode,
  FALSE AS is_cashback_enabled
FROM done"""

ORACLE["normalize_completions"] = f"""
WITH {LIFE}
SELECT {_life_id(views.CURVE, 2, 'CompleteEvent')} AS event_id, {_b58('mint_key', 32)} AS mint,
  {_b58('user_key', 32)} AS "user", {_b58('(mint_key + 1)', 32)} AS bonding_curve,
  CAST(NULL AS VARCHAR) AS quote_mint, seconds AS event_timestamp, slot,
  CAST(NULL AS BIGINT) AS block_time, signature
FROM done"""

ORACLE["normalize_migrations"] = f"""
WITH {LIFE}
SELECT {_life_id(views.CURVE, 6, 'CompletePumpAmmMigrationEvent')} AS event_id,
  {_b58('mint_key', 32)} AS mint, {_b58('user_key', 32)} AS "user",
  {_b58('(mint_key + 1)', 32)} AS bonding_curve, {_b58('pool_key', 32)} AS pool,
  {_b58('CAST(quote_key AS BIGINT)', 32)} AS quote_mint,
  CAST(amount * 3 AS VARCHAR) AS mint_amount_raw, CAST(amount AS VARCHAR) AS quote_amount_raw,
  '15' AS migration_fee_raw, seconds AS event_timestamp, slot, signature
FROM done"""

ORACLE["normalize_pools"] = f"""
WITH {LIFE}
SELECT {_life_id(views.POOL, 4, 'CreatePoolEvent')} AS event_id, {_b58('pool_key', 32)} AS pool,
  {_b58('user_key', 32)} AS creator, {_b58('mint_key', 32)} AS base_mint,
  {_b58('CAST(quote_key AS BIGINT)', 32)} AS quote_mint, 6 AS base_mint_decimals,
  9 AS quote_mint_decimals, seconds AS event_timestamp, slot, signature,
  CAST(amount * 3 AS VARCHAR) AS base_amount_in, CAST(amount AS VARCHAR) AS quote_amount_in,
  FALSE AS is_mayhem_mode
FROM done"""

ORACLE["route_counts"] = f"""
WITH {LIFE}, kinds AS (SELECT * FROM (VALUES
  ('pump', 'CreateEvent', 'tokens'), ('pump', 'CompleteEvent', 'completions'),
  ('pump', 'CompletePumpAmmMigrationEvent', 'migrations'),
  ('pumpswap', 'CreatePoolEvent', 'pools'), ('pump', 'Note', NULL)) k(protocol, event_type, target))
SELECT protocol, event_type, target, count(*) AS n FROM kinds, done GROUP BY ALL"""

ORACLE["normalize_quarantine"] = """
SELECT sha256('s' || event_id || '|CurveProgram1111|0|program-data') AS event_id,
  's' || event_id AS signature, CAST(floor(epoch_us(ts) / 60000000.0) AS BIGINT) AS slot,
  CASE event_id % 3 WHEN 0 THEN 'normalize-error: missing side'
    WHEN 1 THEN 'normalize-error: missing base_amount_raw'
    ELSE 'normalize-error: missing mint' END AS reason,
  CASE event_id % 3 WHEN 0 THEN 12
    WHEN 2 THEN length('{"user":"u","is_buy":false,"timestamp":1,"token_amount":5}')
    ELSE CAST(strlen('{"mint":"m","user":"u","is_buy":true,"timestamp":1,"token_amount":'
      || event_id || '99999999999999999999}') AS INT) END AS payload_size
FROM events WHERE event_id % 3 < 2 OR event_id % 7 = 0"""

ORACLE["rebuild_datasets"] = f"""
WITH {LEDGER}, {LIFE}
SELECT dataset, "rows" FROM (
  SELECT 'events' AS dataset, (SELECT count(*) FROM good) + 5 * (SELECT count(*) FROM done) AS "rows"
  UNION ALL SELECT 'trades', (SELECT count(*) FROM good)
  UNION ALL SELECT 'unknown_program_data', (SELECT count(*) FROM live WHERE l_linenumber >= 6)
  UNION ALL SELECT unnest(['tokens', 'completions', 'migrations', 'pools']),
    (SELECT count(*) FROM done))"""

ORACLE["rebuild_summary"] = f"""
WITH {FIRST}
SELECT (SELECT count(*) FROM obs) AS raw_rows,
  (SELECT count(*) FROM obs WHERE kind = 0) AS raw_log_rows,
  (SELECT count(*) FROM obs WHERE kind = 1) AS raw_transaction_rows,
  (SELECT count(*) FROM first) AS unique_transactions,
  (SELECT count(*) FROM first WHERE NOT failed) AS events"""

# --- RAW rows and files

_PROBLEM = """CASE
    WHEN event_id % 29 = 0 THEN 'unknown field'
    WHEN event_id % 31 = 0 AND event_id % 17 = 0 THEN 'bad source_mode'
    WHEN event_id % 31 = 0 THEN 'bad slot'
    WHEN event_id % 37 = 0 THEN 'not a JSON object'
    WHEN event_id % 17 = 0 THEN 'bad source_mode'
    WHEN event_id % 19 = 0 THEN 'bad received_at' END"""
ORACLE["raw_transactions"] = f"""
WITH {OBS}, tx AS (SELECT *, {_PROBLEM} AS problem FROM obs WHERE event_id % 23 <> 0)
SELECT event_id AS seq, 'replay' AS source_mode, source_program, slot,
  CASE WHEN event_id % 2 = 0 THEN slot * 60 END AS block_time,
  CAST(epoch(TIMESTAMP '2026-09-10 16:00:00') AS BIGINT) + event_id % 60 AS received_s, signature,
  failed, CASE WHEN event_id % 5 > 0 THEN 'a,b' ELSE 'c' END AS logs
FROM tx WHERE problem IS NULL"""
ORACLE["raw_rejects"] = f"""
WITH {OBS}, tx AS (SELECT *, {_PROBLEM} AS problem FROM obs WHERE event_id % 23 <> 0)
SELECT problem, count(*) AS n FROM tx WHERE problem IS NOT NULL GROUP BY ALL"""

ORACLE["raw_log_archive"] = """
SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour, count(*) AS n,
  count(*) FILTER (event_type = 'error') AS failed, count(*) AS in_hour, 2 * count(*) AS log_lines,
  CAST(sum(epoch_us(ts) % 1000000) AS BIGINT) AS micros
FROM events GROUP BY ALL"""

ORACLE["replay_first_copy"] = f"""
WITH {FIRST}
SELECT signature, source_program, slot, kind, event_id AS seq, failed FROM first"""

ORACLE["captures"] = f"""
WITH {FRAMES}
SELECT count(*) AS messages_received, CAST(sum(strlen(frame)) AS BIGINT) AS bytes_received,
  min(arrival_us) AS started_us, max(arrival_us) AS finished_us FROM frames"""

ORACLE["jsonl_sink"] = f"""
WITH {OBS}
SELECT strftime(CASE WHEN event_id % 2 = 0 THEN make_timestamp(slot * 60000000)
  ELSE make_timestamp(arrival_us) END, '%Y-%m-%d') AS date, count(*) AS n,
  CAST(sum(amount) AS BIGINT) AS amount
FROM obs GROUP BY ALL"""

ORACLE["file_statistics"] = """
SELECT event_type AS name, CAST(1 AS BIGINT) AS files,
  CAST(sum(strlen(event_id || '|' || user_id || '|' || props) + 1) AS BIGINT) AS bytes
FROM events GROUP BY event_type"""

# --- frames

_FRAME_FACTS = f"""{FRAMES}, facts AS (
  SELECT f.*, e.event_type,
    f.event_id % 4 = 1 AND event_type = 'purchase' AS no_err,
    event_type IN ('click', 'view') AS ok_log, event_type = 'error' AS failed_log,
    event_type = 'signup' AS block
  FROM frames f JOIN events e USING (event_id))"""

ORACLE["classify_frames"] = f"""
WITH {_FRAME_FACTS}
SELECT event_id, ok_log OR failed_log OR block OR no_err AS is_notification,
  CASE WHEN ok_log THEN TRUE WHEN failed_log THEN FALSE END AS log_ok
FROM facts"""

ORACLE["skipped_failed"] = (
    "SELECT count(*) AS failed_log_notifications_skipped FROM events WHERE event_type = 'error'"
)

_SLOT = """CASE WHEN event_id % 3 = 0 THEN event_id ELSE event_id + 7 END"""
_BLOCK_TIME = "CASE WHEN event_id % 4 = 0 THEN NULL ELSE 1700000000 + event_id END"
ORACLE["explode_blocks"] = f"""
WITH {_FRAME_FACTS}, blocks AS (
  SELECT *, {_SLOT} AS slot, CAST({_BLOCK_TIME} AS BIGINT) AS block_time,
    CASE WHEN subscription = 1 THEN '{views.CURVE}' ELSE '{views.POOL}' END AS program
  FROM facts WHERE block AND subscription < 99 AND event_id % 17 <> 0),
entries AS (
  SELECT *, 0 AS i, 't' || event_id || 'a' AS signature,
    '{{"signatures":["t' || event_id || 'a","x"]}}' AS tx, '{{"err":{{"x":1}}}}' AS meta,
    '"legacy"' AS version FROM blocks
  UNION ALL
  SELECT *, 2, 't' || event_id || 'b', '{{"signatures":["t' || event_id || 'b"]}}',
    '{{"err":null,"logMessages":["Program AAA invoke [1]"]}}', '0' FROM blocks)
SELECT 'block' AS source_mode, program AS source_program, slot, block_time, signature,
  CAST(i AS INT) AS transaction_index,
  '{{"slot":' || slot || ',"blockTime":' || coalesce(CAST(block_time AS VARCHAR), 'null')
    || ',"transaction":' || tx || ',"meta":' || meta || ',"version":' || version || '}}'
    AS rpc_transaction,
  CASE WHEN event_id % 13 = 0 THEN 'blockSubscribe error: "boom"' END AS problem
FROM entries"""

ORACLE["block_integrity"] = f"""
WITH {_FRAME_FACTS}
SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'blockSubscribe error: "boom"'
  ELSE 'blockSubscribe error: received block:null' END AS problem
FROM facts WHERE block AND (event_id % 13 = 0 OR event_id % 17 = 0)"""

ORACLE["log_notifications"] = f"""
WITH {_FRAME_FACTS}
SELECT CASE WHEN ok_log AND event_id % 2 = 1 THEN '{views.POOL}' ELSE '{views.CURVE}' END
    AS source_program,
  CASE WHEN ok_log THEN event_id ELSE 1 END AS slot,
  CASE WHEN ok_log THEN 's' || (event_id // 2) ELSE 'n' || event_id END AS signature,
  CAST(NULL AS VARCHAR) AS err,
  CASE WHEN ok_log THEN 'Program AAA invoke [1]|Program data: YQ==' ELSE '1' END AS logs,
  CASE WHEN ok_log THEN 1 + event_id % 2 ELSE 1 END AS subscription_id,
  '{{"slot":' || CASE WHEN ok_log THEN event_id ELSE 1 END || '}}' AS rpc_context,
  CASE WHEN no_err THEN 'malformed logsNotification: signature/logs missing or invalid' END
    AS problem,
  arrival_us AS received_us
FROM facts WHERE ok_log OR no_err"""

ORACLE["fetched_transactions"] = f"""
WITH {OBS}
SELECT 'reconcile' AS source_mode, source_program, slot,
  CASE WHEN event_id % 2 = 0 THEN slot END AS block_time, signature,
  CAST(NULL AS INT) AS transaction_index, failed, 'a' AS logs
FROM obs"""

# --- attribution and decode

ORACLE["attribute_logs"] = rf"""
WITH RECURSIVE {LINES}, steps AS (
  SELECT tx, i,
    regexp_extract(line, '^Program (\w+) invoke \[\d+\]$', 1) AS entered,
    regexp_extract(line, '^Program (\w+) (success|failed: .+)$', 1) AS exited,
    CASE WHEN line LIKE 'Program data: %' AND line NOT LIKE '%!' THEN substr(line, 15) END AS data
  FROM lines),
walk AS (
  SELECT tx, -1 AS i, CAST([] AS VARCHAR[]) AS stack, CAST(NULL AS VARCHAR) AS program,
    CAST(NULL AS VARCHAR) AS data FROM steps WHERE i = 0
  UNION ALL
  SELECT s.tx, s.i,
    CASE WHEN entered <> '' THEN list_append(stack, entered)
      WHEN exited <> '' AND list_contains(stack, exited)
        THEN stack[1:len(stack) - list_position(list_reverse(stack), exited)]
      ELSE stack END,
    CASE WHEN s.data IS NOT NULL AND len(stack) > 0 THEN stack[len(stack)] END, s.data
  FROM walk w JOIN steps s ON s.tx = w.tx AND s.i = w.i + 1)
SELECT tx, i AS log_index, program AS program_id, decode(from_base64(data)) AS raw
FROM walk WHERE program IS NOT NULL"""

ORACLE["event_ids"] = f"""
WITH {OBS}
SELECT event_id, {_id('signature', 'source_program', 'kind', 'event_type')} AS decoded_id,
  {_id('signature', 'source_program', 'kind', "'program-data'")} AS quarantine_id FROM obs"""

ORACLE["decode_fixed_width"] = """
SELECT l_partkey AS part, count(*) AS n, CAST(sum(l_suppkey) AS VARCHAR) AS sum_supp,
  CAST(sum(l_linenumber) AS VARCHAR) AS sum_line,
  CAST(sum(-(l_orderkey + l_partkey)) AS VARCHAR) AS sum_delta,
  CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS VARCHAR) AS sum_open
FROM lineitem GROUP BY ALL"""

# Samples: the values of an order, its payload's size, and the rule its key breaks.
SAMPLES = """
values_of AS (
  SELECT o_orderkey, o_orderkey % 13 AS broken, o_custkey, o_orderkey % 3 AS third, o_orderkey * 1000003 AS id,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority || 'é' END AS note,
    list_transform(range(o_orderkey % 4), lambda i: o_orderstatus || i) AS tags,
    list_transform(range(o_orderkey % 3), lambda i: CAST(o_custkey + i AS VARCHAR)) AS counts,
    o_custkey % 65536 || ',1,65535' AS triple, -o_custkey AS pair_number, o_orderkey % 2 = 0 AS pair_flag,
    -(o_orderkey % 100) AS bps, o_orderpriority AS owner, o_orderstatus, -o_orderkey AS named
  FROM orders),
sized AS (
  SELECT *, 8 + (CASE WHEN third = 0 THEN 1 ELSE 7 + strlen(owner) END)
    + 4 + CAST(coalesce(list_sum(list_transform(tags, lambda t: 4 + strlen(t))), 0) AS BIGINT) + 4 + 4 * third
    + 6 + 5 + 6 + strlen(owner) + (CASE third WHEN 0 THEN 1 WHEN 1 THEN 9 ELSE 6 + strlen(o_orderstatus) END) + 16 AS last
  FROM values_of),
samples AS (
  SELECT *, CASE broken
    WHEN 1 THEN 'decode-error: buffer underrun: need 16 bytes at offset ' || last || ', only 15 remain'
    WHEN 2 THEN 'schema-drift-trailing-bytes:1'
    WHEN 3 THEN 'decode-error: invalid Option tag 2'
    WHEN 4 THEN 'decode-error: invalid bool byte 7'
    WHEN 5 THEN 'decode-error: enum Choice: invalid variant 9'
    WHEN 6 THEN 'decode-error: refusing implausible vector length 1000001'
    WHEN 7 THEN 'decode-error: string length 99999 exceeds remaining buffer'
    WHEN 8 THEN 'decode-error: invalid UTF-8 in string' END AS reason
  FROM sized)"""

ORACLE["decode_typed_columns"] = f"""
WITH {SAMPLES}, whole AS (SELECT * FROM samples WHERE reason IS NULL)
SELECT s.o_orderkey, s.reason, CAST(w.id AS VARCHAR) AS id, w.note,
  CASE WHEN w.id IS NOT NULL THEN coalesce(array_to_string(w.tags, ','), '') END AS tags,
  CASE WHEN w.id IS NOT NULL THEN coalesce(array_to_string(w.counts, ','), '') END AS counts,
  w.triple, w.pair_number, w.pair_flag, w.bps, w.owner,
  CASE w.third WHEN 0 THEN 'None' WHEN 1 THEN 'Named' WHEN 2 THEN 'Pair' END AS variant,
  CASE WHEN w.third = 1 THEN w.named END AS named,
  CASE WHEN w.third = 2 THEN w.o_orderkey % 256 END AS pair_byte,
  CASE WHEN w.third = 2 THEN w.o_orderstatus END AS pair_text,
  CAST(w.o_orderkey AS VARCHAR) AS big_high, CAST(w.o_custkey AS VARCHAR) AS big_low,
  CAST(-w.o_orderkey - 1 AS VARCHAR) AS low_high, CAST(w.o_custkey AS VARCHAR) AS low_low
FROM samples s LEFT JOIN whole w USING (o_orderkey)"""

ORACLE["decode_nested"] = f"""
WITH {SAMPLES}
SELECT o_orderkey, reason, CASE WHEN reason IS NULL THEN
  '{{"big":' || (CAST(o_orderkey AS HUGEINT) * 18446744073709551616 + o_custkey)
  || ',"choice":{{' || (CASE third WHEN 0 THEN '' WHEN 1 THEN '"fields":{{"a":' || named || '}},'
    ELSE '"fields":[' || o_orderkey % 256 || ',"' || o_orderstatus || '"],' END)
  || '"variant":"' || (CASE third WHEN 0 THEN 'None' WHEN 1 THEN 'Named' ELSE 'Pair' END)
  || '"}},"counts":[' || coalesce(array_to_string(counts, ','), '') || '],"id":' || id
  || ',"low":' || (CAST(-o_orderkey - 1 AS HUGEINT) * 18446744073709551616 + o_custkey)
  || ',"note":' || coalesce('"' || note || '"', 'null')
  || ',"pair":[' || pair_number || ',' || CAST(pair_flag AS VARCHAR)
  || '],"share":{{"bps":' || bps || ',"owner":"' || lower(hex(owner))
  || '"}},"tags":[' || coalesce(array_to_string(list_transform(tags, lambda t: '"' || t || '"'), ','), '')
  || '],"triple":[' || triple || ']}}' END AS payload_json
FROM samples"""

ORACLE["base58_keys"] = f"""
SELECT o_orderkey, {_b58('(o_orderkey * 1000003 + o_custkey)', 16)} AS key FROM orders"""

ORACLE["reserve_fallback"] = f"""
WITH {OBS}, facts AS (SELECT *,
  CASE WHEN event_id % 3 = 2 AND amount <> 0 THEN amount
    WHEN event_id % 5 > 0 THEN 3 ELSE 0 END AS quote FROM obs)
SELECT CAST(event_id AS VARCHAR) AS event_id, '18446744073709551615' AS base_amount_raw,
  CAST(quote AS VARCHAR) AS quote_amount_raw,
  CASE event_id % 4 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN NULL WHEN 2 THEN '0'
    ELSE '7' END AS virtual_quote_reserves
FROM facts"""

# --- dedupe and state

ORACLE["dedupe_first_wins"] = f"""
WITH {FIRST}
SELECT signature, event_id, source_program, slot, failed, amount FROM first"""

ORACLE["dedupe_events"] = f"""
WITH {OBS}
SELECT sha256(signature || '|{views.CURVE}|0|x') AS event_id, signature, min(event_id) AS copy
FROM obs GROUP BY signature"""

ORACLE["duplicate_count"] = f"""
WITH {OBS}
SELECT count(*) AS total_rows, count(DISTINCT signature) AS unique_rows,
  count(*) - count(DISTINCT signature) AS duplicates FROM obs"""

ORACLE["observations"] = f"""
WITH {OBS}
SELECT signature, source_program AS program_id, slot, arrival_us AS observed_us FROM obs
QUALIFY row_number() OVER (PARTITION BY signature, source_program
  ORDER BY lpad(CAST(hours AS VARCHAR), 10, '0'), kind, event_id) = 1"""

ORACLE["transactions_index"] = f"""
WITH {FIRST}
SELECT signature, slot, source_program, arrival_us AS first_us FROM first"""


def _points(name: str, rows: str) -> str:
    """Checkpoints per user over one subset of the observations."""
    order = "lpad(CAST(hours AS VARCHAR), 10, '0'), kind, event_id"
    return f"""{name}_seen AS (
  SELECT o.*, e.user_id, o.slot - o.event_id % 7 * 60 AS place
  FROM obs o JOIN events e USING (event_id) WHERE {rows}
  QUALIFY row_number() OVER (PARTITION BY signature, user_id ORDER BY {order}) = 1),
{name} AS (
  SELECT CAST(user_id AS VARCHAR) AS program_id, signature AS last_signature, place AS last_slot
  FROM {name}_seen
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY place DESC,
    lpad(CAST(hours AS VARCHAR), 10, '0') DESC, kind DESC, event_id DESC) = 1)"""


ORACLE["checkpoints"] = f"WITH {OBS}, {_points('points', 'true')} SELECT * FROM points"

ORACLE["checkpoint_merge"] = f"""
WITH {OBS}, {_points('old', 'o.kind = 0')}, {_points('new', 'o.kind = 1')}
SELECT coalesce(old.program_id, new.program_id) AS program_id,
  CASE WHEN new.program_id IS NULL OR new.last_slot < old.last_slot THEN old.last_signature
    ELSE new.last_signature END AS last_signature,
  CASE WHEN new.program_id IS NULL OR new.last_slot < old.last_slot THEN old.last_slot
    ELSE new.last_slot END AS last_slot
FROM old FULL JOIN new ON old.program_id = new.program_id"""

ORACLE["cross_program"] = f"""
WITH {OBS}
SELECT signature, count(DISTINCT source_program) AS programs, count(*) AS copies
FROM obs GROUP BY signature HAVING count(DISTINCT source_program) > 1"""

ORACLE["partition_dates"] = f"""
WITH {OBS}
SELECT strftime(CASE WHEN event_id % 2 = 0 THEN make_timestamp((slot * 60 - 259200) * 1000000)
  ELSE make_timestamp(arrival_us) END, '%Y-%m-%d') AS date, count(*) AS n
FROM obs GROUP BY ALL"""

# --- recovery

_MARK = f"""{LISTING}, middle AS (
  SELECT max(event_id) // 2 - (max(event_id) // 2) % 2 AS m FROM listing),
newer AS (
  SELECT l.* FROM listing l, middle WHERE program_id = '{views.POOL}' OR event_id > m)"""

ORACLE["missing_set"] = f"""
WITH {_MARK}
SELECT program_id, signature, slot, event_id AS replay_rank FROM newer
WHERE err IS NULL AND event_id % 7 = 0"""

ORACLE["listed_counts"] = f"""
WITH {_MARK}
SELECT program_id, count(*) AS listed, count(err) AS failed_skipped FROM newer GROUP BY ALL"""

ORACLE["start_boundary"] = """
SELECT CAST(user_id AS VARCHAR) AS program_id, 'sig' || max(event_id) AS last_signature,
  CAST(floor(arg_max(epoch_us(ts), event_id) / 60000000.0) AS BIGINT) AS last_slot
FROM events WHERE user_id % 3 <> 0 GROUP BY user_id"""

ORACLE["unavailable"] = f"""
WITH {_MARK}
SELECT program_id, signature FROM newer
WHERE err IS NULL AND event_id % 7 = 0 AND event_id % 5 = 0"""

ORACLE["recover_gap"] = f"""
WITH {_MARK}, missing AS (SELECT * FROM newer WHERE err IS NULL AND event_id % 7 = 0)
SELECT program_id, arg_max(signature, event_id) AS last_signature, max(slot) AS last_slot,
  count(*) AS recovered
FROM missing GROUP BY program_id"""

ORACLE["recovery_job"] = f"""
WITH {_MARK}, gap AS (SELECT * FROM newer WHERE program_id = '{views.POOL}'),
missing AS (SELECT * FROM gap WHERE err IS NULL AND event_id % 7 = 0),
moved AS (
  SELECT program_id, arg_max(signature, (slot, event_id)) AS last_signature, max(slot) AS last_slot,
    count(*) AS archived, count(*) AS observed FROM missing GROUP BY program_id
  UNION ALL
  SELECT program_id, arg_max(signature, event_id), arg_max(slot, event_id), NULL, NULL
  FROM listing WHERE program_id = '{views.CURVE}' GROUP BY program_id)
SELECT moved.*, (SELECT count(err) FROM gap) AS failed_skipped FROM moved"""

ORACLE["merge_recovered"] = f"""
WITH {OBS}, ranked AS (
  SELECT 0 AS path, * FROM obs WHERE kind = 1
  UNION ALL SELECT 1, * FROM obs WHERE event_id % 4 < 3)
SELECT signature, event_id FROM ranked
QUALIFY row_number() OVER (PARTITION BY signature
  ORDER BY path, lpad(CAST(hours AS VARCHAR), 10, '0'), kind, event_id) = 1"""

# --- counters and telemetry

ORACLE["ingestion_counters"] = f"""
WITH {FIRST}
SELECT * FROM (
  SELECT 'transactions' AS key, count(*) AS value FROM first
  UNION ALL SELECT 'failed_transactions', count(*) FROM first WHERE failed
  UNION ALL SELECT 'duplicate_transactions', (SELECT count(*) FROM obs) - count(*) FROM first
  UNION ALL SELECT 'trades', count(*) FROM first WHERE NOT failed AND event_type = 'purchase'
  UNION ALL SELECT 'events_decoded', count(*) FROM first
    WHERE NOT failed AND event_type <> 'purchase') WHERE value > 0"""

ORACLE["counter_merge"] = """
WITH updates AS (
  SELECT 'k' || user_id AS key, user_id % 3 AS r, event_id,
    CAST(CAST(round(value * 100) AS BIGINT) % 50 AS BIGINT) AS value FROM events)
SELECT key, CASE r WHEN 0 THEN 'increment' WHEN 1 THEN 'gauge' ELSE 'maximum' END AS rule,
  CAST(CASE r WHEN 0 THEN sum(value) WHEN 1 THEN coalesce(
      arg_max(value, event_id) FILTER (event_id % 2 = 1), arg_max(value, event_id))
    ELSE max(value) END AS BIGINT) AS value
FROM updates GROUP BY key, r HAVING r > 0 OR sum(value) > 0"""

ORACLE["state_summary"] = f"""
WITH {FIRST}, {_points('points', 'true')}
SELECT 'table' AS section, 'transactions' AS key, count(*) AS value, CAST(NULL AS VARCHAR) AS detail
FROM first
UNION ALL SELECT 'table', 'observations', count(DISTINCT (signature, source_program)), NULL FROM obs
UNION ALL SELECT 'table', 'events', count(*), NULL FROM first
UNION ALL SELECT 'counter', event_type, count(*), NULL FROM first GROUP BY event_type
UNION ALL SELECT 'checkpoint', program_id, last_slot, last_signature FROM points"""

ORACLE["arrival_counters"] = f"""
WITH {_FRAME_FACTS}
SELECT CAST(floor(arrival_us / 3600000000.0) AS BIGINT) AS hour,
  count(*) AS ws_messages_received, CAST(sum(strlen(frame)) AS BIGINT) AS ws_bytes_received,
  count(*) FILTER (ok_log OR failed_log OR block OR no_err) AS ws_notifications_received,
  count(*) FILTER (NOT (ok_log OR failed_log OR block OR no_err))
    AS ws_non_notification_messages_received,
  count(*) FILTER (ok_log OR block OR no_err) AS ws_notifications_enqueued,
  count(*) FILTER (ok_log) AS successful_log_notifications,
  count(*) FILTER (failed_log) AS failed_log_notifications,
  count(*) FILTER (failed_log) AS failed_log_notifications_skipped
FROM facts GROUP BY 1"""

_FLUSHES = f"""{OBS}, flushes AS (
  SELECT event_id // 100 AS flush, count(*) FILTER (event_type = 'click') AS successes,
    min(arrival_us) AS first_us, max(arrival_us) AS last_us FROM obs GROUP BY 1),
rates AS (
  SELECT flush, successes, greatest((last_us - coalesce(
    lag(last_us) OVER (ORDER BY flush), first_us)) / 1e6, 1e-9) AS seconds FROM flushes)"""

ORACLE["ema_rate"] = f"""
WITH RECURSIVE {_FLUSHES}, ema AS (
  SELECT flush, successes, successes / seconds AS e FROM rates WHERE flush = 0
  UNION ALL
  SELECT r.flush, r.successes, 0.2::DOUBLE * (r.successes / r.seconds) + 0.8::DOUBLE * e
  FROM ema JOIN rates r ON r.flush = ema.flush + 1)
SELECT flush, successes, CAST(round_even(1000 * e, 0) AS BIGINT) AS ema_millirps FROM ema"""

ORACLE["average_rate"] = f"""
WITH {_FLUSHES}
SELECT CAST(round_even(1000 * (sum(successes) / greatest(sum(seconds), 1e-9)), 0) AS BIGINT)
  AS avg_millirps FROM rates"""

_BACKLOG = """changes AS (
  SELECT event_id, ts, CASE WHEN event_type IN ('click', 'view', 'signup') THEN 1 ELSE -1 END
    AS change FROM events),
sized AS (SELECT event_id, CAST(sum(change) OVER (ORDER BY event_id) AS BIGINT) AS backlog
  FROM changes)"""
ORACLE["backlog"] = f"WITH {_BACKLOG} SELECT event_id, backlog FROM sized"
ORACLE["backlog_watermark"] = f"""
WITH {_BACKLOG}
SELECT max(backlog) AS ws_queue_high_watermark, arg_max(backlog, event_id) AS ws_queue_current_size
FROM sized"""

# --- profiling: nodes by known depth

_DOCS = f"""{PAYLOADS}, docs AS (
  SELECT event_id, CAST(payload AS JSON) AS d FROM payloads
  WHERE (event_id % 29 = 0 OR event_id % 31 = 0 OR event_id % 37 <> 0)),
objects AS (SELECT * FROM docs WHERE json_type(d) = 'OBJECT')"""
_TYPE = """CASE json_type(v) WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean'
  WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number'
  WHEN 'VARCHAR' THEN 'string' WHEN 'ARRAY' THEN 'array' ELSE 'object' END"""
_NODES = f"""{_DOCS}, level1 AS (
  SELECT '$' AS parent, key, '$/' || replace(key, '/', '~1') AS path, d -> ('$."' || key || '"') AS v
  FROM (SELECT d, unnest(json_keys(d)) AS key FROM objects)),
items AS (
  SELECT path || '/*' AS parent, unnest(CAST(v AS JSON[])) AS d FROM level1
  WHERE json_type(v) = 'ARRAY'
  UNION ALL SELECT '$/*', unnest(CAST(d AS JSON[])) FROM docs WHERE json_type(d) = 'ARRAY'),
nested AS (
  SELECT path AS parent, v AS d FROM level1 WHERE json_type(v) = 'OBJECT'
  UNION ALL SELECT parent, d FROM items WHERE json_type(d) = 'OBJECT'),
level2 AS (
  SELECT parent, key, parent || '/' || key AS path, d -> ('$."' || key || '"') AS v
  FROM (SELECT parent, d, unnest(json_keys(d)) AS key FROM nested)),
fields AS (
  SELECT parent, key, path, {_TYPE} AS t FROM level1
  UNION ALL SELECT parent, key, path, {_TYPE} FROM level2),
parents AS (
  SELECT parent, count(*) AS n FROM nested GROUP BY ALL
  UNION ALL SELECT '$', count(*) FROM objects)"""

ORACLE["json_fields"] = f"""
WITH {_NODES}
SELECT f.parent, path, key, count(*) AS present,
  {", ".join(f"count(*) FILTER (t = '{t}') AS n_{t}" for t in
             ("null", "boolean", "integer", "number", "string", "array", "object"))},
  p.n AS parent_object_occurrences, p.n - count(*) AS missing,
  p.n = count(*) AS always_when_parent_is_object, p.n > count(*) AS optional_when_parent_is_object
FROM fields f JOIN parents p USING (parent) GROUP BY f.parent, path, key, p.n"""

ORACLE["json_roots"] = f"""
WITH {_DOCS}
SELECT lower(CASE json_type(d) WHEN 'VARCHAR' THEN 'string' ELSE json_type(d) END) AS json_type,
  count(*) AS documents
FROM docs GROUP BY 1"""

ORACLE["json_shapes"] = f"""
WITH {_DOCS}
SELECT array_to_string(list_sort(json_keys(d)), ',') AS keys, count(*) AS messages
FROM objects GROUP BY 1"""

ORACLE["json_requested"] = f"""
WITH {_NODES}, wanted AS (
  SELECT unnest(['mint', 'signature', 'creator', 'user', 'timestamp']) AS name)
SELECT name, coalesce(array_to_string(list_sort(list(DISTINCT path)
    FILTER (path IS NOT NULL)), ','), '') AS paths, count(path) > 0 AS "exists"
FROM wanted LEFT JOIN fields ON lower(key) = name GROUP BY name"""

ORACLE["frame_validation"] = """
SELECT event_id, CASE WHEN event_id % 41 = 0 THEN 'received a non-UTF-8 binary frame'
  WHEN event_id % 37 = 0 AND event_id % 29 <> 0 AND event_id % 31 <> 0
    THEN 'received a frame that is not valid JSON' END AS problem
FROM events"""

# --- scrubbing

_URLS = r"""urls AS (
  SELECT page_id, url AS page, regexp_extract(url, '^(https?)://', 1) AS scheme,
    CASE WHEN page_id % 7 = 0 THEN 'me:pw@' ELSE '' END
      || regexp_extract(url, '^https?://([^/?#]*)', 1) AS host,
    CASE WHEN page_id % 3 = 0 THEN '/v2/secret' || page_id
      ELSE regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) END AS path,
    CASE WHEN page_id % 3 = 0 THEN '/v2/REDACTED'
      ELSE regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) END AS safe_path
  FROM pages)"""
_RAW_URL = """scheme || '://' || host || path || CASE page_id % 5
    WHEN 0 THEN '?a=1&api-key=s' || page_id WHEN 1 THEN '?TOKEN=t' || page_id || '&b=%20x+y&c'
    WHEN 2 THEN '' WHEN 3 THEN '#frag' ELSE '?key=&q=100%' END"""
_SAFE_TEXT_URL = """scheme || '://' || host || safe_path || CASE page_id % 5
    WHEN 0 THEN '?a=1&api-key=REDACTED' WHEN 1 THEN '?TOKEN=REDACTED&b=%20x+y&c'
    WHEN 2 THEN '' WHEN 3 THEN '#frag' ELSE '?key=&q=100%' END"""
_SAFE_URL = """scheme || '://' || host || safe_path || CASE page_id % 5
    WHEN 0 THEN '?a=1&api-key=REDACTED' WHEN 1 THEN '?TOKEN=REDACTED&b= x y&c='
    WHEN 2 THEN '' WHEN 3 THEN '#frag' ELSE '?key=REDACTED&q=100%' END"""
ORACLE["redact_text"] = f"""
WITH {_URLS}
SELECT page_id, 'GET ' || {_SAFE_TEXT_URL} || ' failed: "' || {_SAFE_TEXT_URL} || '"' AS text
FROM urls"""
ORACLE["redact_url"] = f"WITH {_URLS} SELECT page_id, {_SAFE_URL} AS url FROM urls"
ORACLE["redact_nested"] = f"""
WITH {_URLS}
SELECT page_id, {_SAFE_TEXT_URL} || '|x?token=REDACTED' AS list, 'k?token=keep' AS map_key,
  {_SAFE_TEXT_URL} AS map_value, page_id AS number FROM urls"""
_BLANKS = r"\s\x1c-\x1f\x{85}\p{Z}"
ORACLE["redact_documents"] = rf"""
WITH docs AS (
  SELECT 'doc' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'page', page_id, html FROM pages),
clean AS (SELECT kind, id, regexp_replace(regexp_replace(
    text || ' https://h/x?token=abc' || id || '&z=1',
    '([?&](?:api-key|apikey|api_key|key|token|access_token)=)([^&#{_BLANKS}"'']+)',
    '\1REDACTED', 'gi'), '(/v2/)([^/?#{_BLANKS}"'']+)', '\1REDACTED', 'gi') AS text FROM docs)
SELECT kind, id, sha256(text) AS digest, CAST(length(text) AS INT) AS size FROM clean"""
ORACLE["known_secrets"] = """
WITH words AS (SELECT unnest([
    regexp_extract(text, '^[^A-Za-z]*([A-Za-z]+)', 1),
    regexp_extract(text, '^[^A-Za-z]*[A-Za-z]+[^A-Za-z]*([A-Za-z]+)', 1)]) AS find FROM benchmark),
ordered AS (SELECT list(find ORDER BY length(find) DESC, find) AS finds
  FROM (SELECT DISTINCT find FROM words WHERE find <> ''))
SELECT doc_id,
  md5(list_reduce([text] || finds, lambda acc, find: replace(acc, find, 'REDACTED'))) AS clean
FROM documents, ordered"""
ORACLE["insecure_urls"] = f"""
WITH {_URLS}
SELECT page_id, CASE WHEN scheme <> 'https' THEN 'URL must use https://'
  WHEN page_id % 7 = 0 THEN 'URL must not use userinfo credentials' END AS problem
FROM urls"""

# --- schema catalog

ORACLE["catalog_events"] = """
SELECT 'A' || p_partkey AS program_id, 'Z' || p_size AS event_type,
  '00ff' || lower(lpad(hex(p_partkey % 256), 2, '0')) || '0405060708' AS discriminator FROM part
UNION ALL SELECT 'A' || p_partkey, 'Ev', '0102030405060708' FROM part"""
_FIELD_ROWS = """(VALUES ('Ev', 'struct', 0, 'amount', '"u64"'),
  ('Ev', 'struct', 1, 'owner', '{"option":"pubkey"}'), ('Pair', 'struct', 0, NULL, '"u8"'),
  ('Pair', 'struct', 1, NULL, '"bool"'), ('Side', 'enum', 0, 'Buy', NULL),
  ('Side', 'enum', 1, 'Sell', '["u8"]')) k(type_name, kind, position, field_name, field_type)"""
ORACLE["catalog_fields"] = f"""
SELECT 'A' || p_partkey AS program_id, type_name, kind, position, field_name, field_type
FROM part, {_FIELD_ROWS}"""
_DOC = """'{"address":"A' || p_partkey || '","events":[{"name":"Z' || p_size
  || '","discriminator":[0,255,' || p_partkey % 256
  || ',4,5,6,7,8]},{"name":"Ev","discriminator":[1,2,3,4,5,6,7,8]}],'
  || '"types":[{"name":"Ev","type":{"kind":"struct","fields":[{"name":"amount","type":"u64"},'
  || '{"name":"owner","type":{"option":"pubkey"}}]}},'
  || '{"name":"Pair","type":{"kind":"struct","fields":["u8","bool"]}},'
  || '{"name":"Side","type":{"kind":"enum","variants":[{"name":"Buy"},'
  || '{"name":"Sell","fields":["u8"]}]}}]}'"""
ORACLE["catalog_inventory"] = f"""
SELECT 'A' || p_partkey AS program_id, 'part-' || p_partkey AS path, sha256({_DOC}) AS sha256,
  'Ev,Z' || p_size AS events FROM part"""
ORACLE["catalog_diff"] = """
SELECT 'A' || p_partkey AS program_id, 'Ev' AS type_name, 0 AS position, 'changed' AS change,
  '"u64"' AS old_type, '"u128"' AS new_type FROM part WHERE p_size % 2 = 0
UNION ALL
SELECT 'A' || p_partkey, 'Pair', i, 'removed', t, NULL
FROM part, (VALUES (0, '"u8"'), (1, '"bool"')) k(i, t)"""

# --- point in time

ORACLE["pool_asof"] = """
WITH links AS (SELECT user_id, event_id AS since, 'm' || event_id AS link FROM events
  WHERE event_type = 'signup'),
trades AS (SELECT event_id, CASE WHEN event_id % 9 > 0 THEN user_id END AS pool FROM events
  WHERE event_type <> 'signup')
SELECT event_id, CAST(pool AS VARCHAR) AS pool, link AS resolved_mint
FROM trades ASOF LEFT JOIN links ON pool = user_id AND event_id >= since"""
ORACLE["availability_gate"] = """
SELECT l_orderkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate <= o_orderdate GROUP BY ALL"""
ORACLE["availability_report"] = """
SELECT count(*) AS checked, count(*) FILTER (l_shipdate > o_orderdate) AS violations
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
ORACLE["unit_view"] = """
WITH sums AS (
  SELECT l_partkey, p_size % 13 AS d,
    CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS HUGEINT) AS s
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
scaled AS (SELECT l_partkey,
    s * list_extract([1000000000000, 100000000000, 10000000000, 1000000000, 100000000, 10000000,
      1000000, 100000, 10000, 1000, 100, 10, 1], CAST(d + 1 AS INT)) AS v FROM sums)
SELECT l_partkey, CAST(v // 1000000000000 AS VARCHAR) || '.'
  || lpad(CAST(v % 1000000000000 AS VARCHAR), 12, '0') AS amount FROM scaled"""
ORACLE["ledger_order"] = """
WITH rows AS (
  SELECT user_id, event_id, event_id // 50 AS slot,
    CASE WHEN event_id % 3 > 0 THEN -(event_id % 11) END AS ti, event_id % 50 AS li FROM events)
SELECT user_id, first(event_id ORDER BY slot, ti NULLS LAST, li) AS first_event,
  last(event_id ORDER BY slot, ti NULLS LAST, li) AS last_event
FROM rows GROUP BY user_id"""
ORACLE["parity"] = """
SELECT count(*) FILTER (event_id % 100 = 7 OR event_id % 50 = 3) AS only_live,
  count(*) FILTER (event_id % 50 = 3) AS only_rebuilt FROM events"""

# --- streaming

ORACLE["stream_dedupe_signatures"] = f"WITH {OBS} SELECT DISTINCT signature FROM obs"
ORACLE["stream_program_checkpoints"] = f"""
WITH {OBS}, first_seen AS (
  SELECT * FROM obs
  QUALIFY row_number() OVER (PARTITION BY signature, source_program ORDER BY event_id) = 1)
SELECT source_program AS program_id, signature AS last_signature, slot AS last_slot FROM first_seen
QUALIFY row_number() OVER (PARTITION BY source_program ORDER BY slot DESC, event_id DESC) = 1"""
ORACLE["stream_arrivals"] = ORACLE["arrival_counters"]
ORACLE["stream_backlog"] = f"""
WITH {_BACKLOG}
SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour, CAST(sum(change) AS BIGINT) AS net
FROM changes GROUP BY 1"""
ORACLE["stream_collect"] = f"""
WITH {LIFE}
SELECT unnest(['tokens', 'completions', 'migrations', 'pools']) AS dataset, count(*) AS n,
  count(DISTINCT signature) AS signatures FROM done"""

ORACLE["stream_running_backlog"] = ORACLE["backlog"]
ORACLE["stream_queue_watermark"] = ORACLE["backlog_watermark"]
ORACLE["rebuild_archive"] = ORACLE["normalize_tokens"]
ORACLE["stream_collect_tokens"] = ORACLE["normalize_tokens"]

# --- features, labels and splits

_PRICES = """prices AS (
  SELECT user_id AS key, epoch_us(ts) AS time, event_id AS seq, value + 1 AS price FROM events),
horizons AS (SELECT unnest([1, 6, 24, 72, 240, 600]) AS h),
decisions AS (
  SELECT DISTINCT key, min(time) + h * 3600000000 AS decision_us FROM prices, horizons GROUP BY key, h),
entered AS (
  SELECT d.*, (SELECT arg_max(price, (time, seq)) FROM prices p
               WHERE p.key = d.key AND p.time <= d.decision_us) AS entry
  FROM decisions d),
known AS (SELECT max(time) AS known_until FROM prices)"""
ORACLE["barrier_labels"] = f"""
WITH {_PRICES}, touches AS (
  SELECT e.key, e.decision_us, p.time, p.seq, p.price >= e.entry * 2 AS up
  FROM entered e JOIN prices p ON p.key = e.key AND p.time > e.decision_us
   AND p.time <= e.decision_us + 864000000000 AND (p.price >= e.entry * 2 OR p.price <= e.entry * (1 - 0.4::DOUBLE))),
first_touch AS (
  SELECT * FROM touches QUALIFY row_number() OVER (PARTITION BY key, decision_us ORDER BY time, seq) = 1)
SELECT e.key, e.decision_us, e.entry,
  CASE WHEN t.up THEN 'up' WHEN NOT t.up THEN 'down'
    WHEN e.decision_us + 864000000000 <= known_until THEN 'none' END AS label, t.time AS touched_us
FROM entered e CROSS JOIN known LEFT JOIN first_touch t ON t.key = e.key AND t.decision_us = e.decision_us"""
ORACLE["forward_returns"] = f"""
WITH {_PRICES}, later AS (SELECT *, unnest([6, 48, 240]) * 3600::BIGINT AS horizon_s FROM entered)
SELECT key, decision_us, CAST(horizon_s AS INTEGER) AS horizon_s,
  CASE WHEN decision_us + horizon_s * 1000000 <= known_until THEN
    (SELECT arg_max(price, (time, seq)) FROM prices p
     WHERE p.key = l.key AND p.time <= l.decision_us + l.horizon_s * 1000000) / entry - 1 END AS forward_return
FROM later l, known"""
ORACLE["walk_forward"] = f"""
WITH {_PRICES}, placed AS (
  SELECT seq, (time - min(time) OVER ()) / 86400000000.0::DOUBLE AS day, unnest([0, 1, 2, 3]) AS fold FROM prices)
SELECT seq, CAST(fold AS INTEGER) AS fold, CASE WHEN day >= 10 + 4 * fold THEN 'test' ELSE 'train' END AS part
FROM placed
WHERE day >= 10 + 4 * fold AND day < 14 + 4 * fold
   OR day >= 4 * fold - 0.25::DOUBLE AND day <= 8.75::DOUBLE + 4 * fold"""
