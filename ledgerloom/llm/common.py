"""Helpers shared by the text operators: white space, shared scratch tables, table access."""

from __future__ import annotations

import ctypes
import gc
import posixpath
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of all text operators: space, tab, line feed, vertical tab, form feed, return.
SPACE = "[\\x20\\x09-\\x0D]+"
TRIM = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerloom-llm-")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names.

    Only where that is unset and driver and executors are one process, a private folder serves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _own_folder()
    return posixpath.join(root, "llm", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written table."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_within(df: DataFrame, rows: int, most: int = 200_000) -> DataFrame:
    """Broadcast a side of ``rows`` counted rows only when that is at most ``most``."""
    return F.broadcast(df) if rows <= most else df


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, with the memory of each given back before the next: workers outlive their tasks."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a whole task; what making them took then goes back to the system.

    Python workers outlive their tasks, and would hold it through stages that need none of it.
    """
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def whole(column: Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(column, F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, whatever the optimizer merges."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text: its maximal runs of other characters than white space."""
    trimmed = F.btrim(text, F.lit(TRIM))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def fold(doc_id: Column) -> Column:
    """crc32 of an id written as text."""
    return F.crc32(doc_id.cast("string").cast("binary"))
