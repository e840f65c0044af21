"""Point-in-time rules over the derived tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import broadcast_if_small

# Ledger positions per block of an as-of join: one slot holds a bounded number of events.
SLOT_BLOCK = 64

# Columns a live and a rebuilt event must agree on.
SHARED_EVENT_COLUMNS = (
    "event_id", "protocol", "program_id", "event_type", "signature", "slot", "log_index",
    "payload_json",
)


def ledger_position() -> Column:
    """Total order as one comparable value: slot, then the position in the block, then in the log.
    Unknown positions come last."""
    return F.struct(
        "slot",
        F.col("transaction_index").isNull().alias("no_index"),
        "transaction_index",
        F.col("log_index").isNull().alias("no_log"),
        "log_index",
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    order: str | Sequence[str],
    value: str,
    block: int = SLOT_BLOCK,
) -> DataFrame:
    """Add ``value``: the right side's latest one per key at or before the left row's ``order``.

    With several order columns the first is the coarsest and not null; unknown others come last. Of
    right rows at one place the greatest value counts.

    A window per (key, block of positions) sees only that block; what was known before it comes
    from one row per key and block. So a key with a third of all rows is spread over its blocks.
    """
    names = [order] if isinstance(order, str) else list(order)
    number = F.floor(F.col(names[0]) / F.lit(block))
    place = F.struct(*[x for i, n in enumerate(names) for x in (F.col(n).isNull().alias(f"n{i}"), F.col(n).alias(f"o{i}"))])
    left_rows = left.select(
        F.col(key).alias("_k"),
        number.alias("_b"),
        place.alias("_o"),
        F.lit(1).alias("_side"),
        F.struct(*left.columns).alias("_row"),
    )
    right_rows = right.filter(F.col(value).isNotNull()).select(
        F.col(key).alias("_k"),
        number.alias("_b"),
        place.alias("_o"),
        F.lit(0).alias("_side"),
        F.col(value).alias("_v"),
    )
    ends = right_rows.groupBy("_k", "_b").agg(F.max_by("_v", F.struct("_o", "_v")).alias("_end"))
    blocks = left_rows.select("_k", "_b").distinct()
    earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocks.join(ends, ["_k", "_b"], "full_outer")
        .select("_k", "_b", F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
        .filter("_before IS NOT NULL")
    )
    inside = (
        Window.partitionBy("_k", "_b")
        .orderBy("_o", "_side", "_v")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    both = left_rows.unionByName(right_rows, allowMissingColumns=True)
    return (
        both.withColumn("_last", F.last("_v", ignorenulls=True).over(inside))
        .filter("_side = 1")
        .join(carried, ["_k", "_b"], "left")
        .select("_row.*", F.coalesce("_last", "_before").alias(value))
    )


def resolve_mints(
    trades: DataFrame, pools: DataFrame, migrations: DataFrame, events: DataFrame
) -> DataFrame:
    """Trades on a pool with the mint that was linked to it by then, by ledger position.

    ``events`` gives each event_id its place inside the slot; without one it comes last there.
    """
    places = events.select("event_id", "transaction_index", "log_index")
    links = pools.select(
        "event_id", "pool", "slot", F.col("base_mint").alias("resolved_mint")
    ).unionByName(
        migrations.select("event_id", "pool", "slot", F.col("mint").alias("resolved_mint"))
    )
    on_pool = asof_join(
        trades.filter("pool IS NOT NULL").join(places, "event_id", "left"),
        links.join(places, "event_id", "left"),
        "pool",
        ("slot", "transaction_index", "log_index"),
        "resolved_mint",
    ).select(*trades.columns, "resolved_mint")
    direct = trades.filter("pool IS NULL").withColumn("resolved_mint", F.col("mint"))
    return on_pool.unionByName(direct)


def available(df: DataFrame, available_at: str, decision_time: str) -> DataFrame:
    """Rows known at decision time."""
    return df.filter(F.col(available_at) <= F.col(decision_time))


def availability_report(df: DataFrame, available_at: str, decision_time: str) -> DataFrame:
    """Rows checked, and rows that look ahead."""
    late = F.col(available_at) > F.col(decision_time)
    return df.agg(F.count("*").alias("checked"), F.count_if(late).alias("violations"))


def unit_amount(raw: Column, decimals: Column, places: int = 18) -> Column:
    """Exact display amount ``raw / 10**decimals`` as a decimal; never a float.

    Null for more than ``places`` decimals; ``unit_text`` writes any number of them.
    """
    scale = F.get(
        F.array(*[F.lit(str(10**d)).cast("decimal(20,0)") for d in range(places + 1)]),
        decimals.cast("int"),
    )
    return (raw.cast("decimal(20,0)") / scale).cast(f"decimal(38,{places})")


def unit_text(raw: Column, decimals: Column) -> Column:
    """Exact display amount as text, for any number of decimals."""
    digits = raw.cast("decimal(38,0)").cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), decimals.cast("int") + 1), F.lit("0"))
    split = F.length(padded) - decimals.cast("int")
    whole = F.substring(padded, F.lit(1), split)
    rest = F.substring(padded, split + 1, decimals.cast("int"))
    return F.when(decimals == 0, whole).otherwise(F.concat(whole, F.lit("."), rest))


def unit_view(df: DataFrame, decimals: DataFrame, key: str, raw: str, name: str) -> DataFrame:
    """Join decimals by key and add the display amount, also as text in ``<name>_text``."""
    table = broadcast_if_small(decimals.select(key, "decimals"))
    joined = df.join(table, key, "left")
    return joined.withColumns(
        {
            name: unit_amount(F.col(raw), F.col("decimals")),
            f"{name}_text": unit_text(F.col(raw), F.col("decimals")),
        }
    ).drop("decimals")


def parity(live: DataFrame, rebuilt: DataFrame, columns=SHARED_EVENT_COLUMNS) -> DataFrame:
    """Rows only one side has, on the columns both must share; arrival columns may differ."""
    digest = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    sides = live.select(digest.alias("d"), F.lit(1).alias("side")).unionByName(
        rebuilt.select(digest.alias("d"), F.lit(-1).alias("side"))
    )
    return (
        sides.groupBy("d")
        .agg(F.sum("side").alias("balance"))
        .agg(
            F.coalesce(F.sum(F.greatest("balance", F.lit(0))), F.lit(0)).alias("only_live"),
            F.coalesce(F.sum(F.greatest(-F.col("balance"), F.lit(0))), F.lit(0)).alias(
                "only_rebuilt"
            ),
        )
    )


def quarantine_review(unknown: DataFrame) -> DataFrame:
    """Quarantined rows by reason class and program."""
    reason = F.regexp_extract("reason", "^[^:]+", 0).alias("reason_class")
    return unknown.groupBy("program_id", reason).agg(F.count("*").alias("rows"))
