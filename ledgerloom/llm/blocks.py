"""Searches of a set of queries against all rows, in blocks.

Rows are written in packed blocks of bounded size, blocks are dealt to slices and queries to bands.
Each pair of a slice and a band is one group: it sees a bounded number of rows and of queries, and
returns the best of its rows for each of its queries. No side is broadcast or sent to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUND = 64  # slices whose best rows meet at once
PARTITIONS = 100_000  # most partitions that groups are dealt to


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of at most ``most`` rows, all but the last one full."""
    held, rows = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, most - rows)
            held.append(part)
            at, rows = at + part.num_rows, rows + part.num_rows
            if rows == most:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def block_ids() -> Iterator[int]:
    """Numbers no other task gives its blocks."""
    task = TaskContext.get()
    first = (task.partitionId() if task else 0) << 32
    while True:
        yield first
        first += 1


def paired(blocks: DataFrame, queries: DataFrame, slices: int, bands: int):
    """Blocks (with ``block``) and queries (with ``id``) cogrouped by (slice, band)."""
    slices, bands = max(slices, 1), max(bands, 1)
    left = blocks.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)))
    left = left.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))))
    right = queries.withColumn("band", F.pmod(F.xxhash64("id"), F.lit(bands)).cast("int"))
    right = right.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    # One partition for each group, so that no task gets more of them as the tables grow.
    n = min(slices * bands, PARTITIONS)
    left, right = (df.repartition(n, "slice", "band") for df in (left, right))
    return left.groupBy("slice", "band").cogroup(right.groupBy("slice", "band"))


def best(found: DataFrame, keys: list[str], order: list[Column], k: int, slices: int) -> DataFrame:
    """The first ``k`` rows of each key in ``order``, with their ``rank``.

    ``found`` has ``slice``. What many slices found is cut down in rounds of ``ROUND`` slices, so no
    task meets more than a round's rows of one key, however many slices there are.
    """

    def first(df: DataFrame, by: list[str]) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)

    while slices > ROUND:
        found = found.withColumn("slice", F.floor(F.col("slice") / ROUND))
        found, slices = first(found, [*keys, "slice"]).drop("rank"), -(-slices // ROUND)
    return first(found.drop("slice"), keys)


def merged(key: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` highest scores of each key, equal ones by the smaller id."""
    order = np.lexsort((ident, -score, key))
    key = key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    rank = np.arange(len(key)) - np.repeat(starts, np.diff(np.r_[starts, len(key)]))
    keep = rank < k
    return key[keep], score[order][keep], ident[order][keep]


def kth(key: np.ndarray, score: np.ndarray, keys: int, k: int) -> np.ndarray:
    """The k-th highest score of each key of ``merged`` rows; minus infinity where there are fewer."""
    out = np.full(keys, -np.inf)
    lowest = np.full(keys, np.inf)
    np.minimum.at(lowest, key, score)
    full = np.bincount(key, minlength=keys) >= k
    out[full] = lowest[full]
    return out


def packed(values: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the narrowest of three types that holds all of them."""
    top = np.abs(values).max(initial=0)
    kind = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<f8"
    return kind, values.astype(kind).tobytes()


def unpacked(kind: str, data: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(shape).astype(np.float64)


def whole_numbers(df: DataFrame, id_col: str, vec_col: str, scale: int, *more: Column) -> DataFrame:
    """Rows (id, vec, ...) with each component x as floor(scale * x).

    Rows without an id take no part, nor do null or empty vectors and those with a component that
    is null, not a number or infinite.
    """
    vec = F.col(vec_col).cast("array<double>")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    kept = df.where(F.col(id_col).isNotNull() & (F.size(vec) > 0) & F.coalesce(fine, F.lit(False)))
    return kept.select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vec, lambda x: F.floor(x * scale).cast("double")).alias("vec"),
        *more,
    )


def by_length(table: pa.Table, column: str = "vec") -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows of each length of vector, with a matrix of these vectors."""
    lists = table.column(column).combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    lengths = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    values, ends = np.asarray(lists.flatten().to_numpy(zero_copy_only=False)), np.cumsum(lengths)
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        at = (ends[rows] - d)[:, None] + np.arange(d)
        yield table.take(pa.array(rows)), values[at]


def ids_of(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy().astype(np.int64)
