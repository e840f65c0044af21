"""Evaluate a costly expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``name`` as a generated column.

    Spark pushes a filter on a plain column below its projection by copying the expression, so a
    parse would run once per use. It does not push filters below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
