"""Running totals and row numbers over one global order, without a single-task window.

The order column must hold unique integers. A block is a fixed range of them, so it has at most
``block`` rows whatever the data; blocks are summed first, and only the block totals (one row per
block) are accumulated in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 20


def with_running_sum(
    df: DataFrame, value: Column, order: str, name: str, block: int = BLOCK
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows up to and including this one."""
    blocked = df.withColumn("_block", F.floor(F.col(order) / F.lit(block))).withColumn(
        "_value", value
    )
    totals = blocked.groupBy("_block").agg(F.sum("_value").alias("_total"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start")
    )
    inside = (
        Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        blocked.join(starts, "_block")
        .withColumn(name, F.col("_start") + F.sum("_value").over(inside))
        .drop("_block", "_value", "_start")
    )


def with_row_index(df: DataFrame, order: str, name: str, block: int = BLOCK) -> DataFrame:
    """Add ``name``: 0-based position in the global order."""
    return with_running_sum(df, F.lit(1), order, name, block).withColumn(name, F.col(name) - 1)
