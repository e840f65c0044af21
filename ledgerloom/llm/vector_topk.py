"""Exact nearest vectors by inner product: branch and bound over blocks of dimensions.

Vectors are written in blocks in vertical layout: for each block, the dimensions by falling mass
(sum of squares), some at a time, one array of all vectors per dimension. A search adds up inner
products part by part. After each part the product of what is left of the query's and of a vector's
length bounds what may still come (Cauchy-Schwarz): the k-th highest lower bound is a threshold, and
candidates whose upper bound is below it are gone. What is left is compacted: first whole columns
that no query of the chunk needs, then single pairs of query and vector.

Queries meet all blocks, see ``blocks``. A query's threshold is carried from block to block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.blocks import best, block_ids, by_length, gathered, ids_of, kth, merged, packed, paired, unpacked, whole_numbers
from ledgerloom.llm.common import materialize

BLOCK = 4096  # vectors of a block
SLICE = 8  # blocks of a slice, on average
BAND = 2048  # queries of a band, on average
PART = 8  # dimensions added up between two looks at the bounds
CHUNK = 64  # queries taken through a block at once

BLOCKS = "block long, dim int, ids binary, dims binary, kind string, columns binary"
FOUND = "slice long, query_id long, score long, vec_id long"


_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("dim", pa.int32()),
        ("ids", pa.binary()),
        ("dims", pa.binary()),
        ("kind", pa.string()),
        ("columns", pa.binary()),
    ]
)


def _vertical(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in vertical layout, dimensions by falling mass."""
    numbers = block_ids()
    for table in gathered(batches, BLOCK):
        for rows, matrix in by_length(table):
            dims = np.argsort(-np.square(matrix).sum(0), kind="stable")
            kind, columns = packed(matrix.T[dims])
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "block": next(numbers),
                        "dim": matrix.shape[1],
                        "ids": ids_of(rows, "id").tobytes(),
                        "dims": dims.astype("<i4").tobytes(),
                        "kind": kind,
                        "columns": columns,
                    }
                ],
                schema=_SCHEMA,
            )


def _rest(squares: np.ndarray) -> np.ndarray:
    """Length of what comes after each part of the dimensions (the first axis)."""
    parts = np.add.reduceat(squares, np.arange(0, len(squares), PART), axis=0)
    return np.sqrt(np.cumsum(parts[::-1], axis=0)[::-1] - parts)


def _row_kth(values: np.ndarray, k: int) -> np.ndarray:
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, -k]


def search_block(queries, own, columns, ids, floor, k):
    """Pairs (query, score, id) of the vectors of a block that may be among the ``k`` best.

    ``queries`` is a matrix in the block's order of dimensions, ``columns`` the vertical block,
    ``floor`` the k-th best score each query has so far.
    """
    dims = len(columns)
    left_q, left_x = _rest(np.square(queries).T), _rest(np.square(columns))
    cols, sums = np.arange(len(ids)), np.zeros((len(queries), len(ids)))
    sums[own[:, None] == ids] = -np.inf
    pairs = None
    for part, at in enumerate(range(0, dims, PART)):
        to = min(at + PART, dims)
        if pairs is None:
            sums += queries[:, at:to] @ columns[at:to][:, cols]
            slack = left_q[part][:, None] * left_x[part][cols]
            floor = np.maximum(floor, _row_kth(sums - slack, k) - _margin(slack))
            alive = sums + slack + _margin(slack)[:, None] >= floor[:, None]
            needed = alive.any(0)
            if 4 * alive.sum() < alive.size:
                q, c = np.nonzero(alive)
                pairs, sums = (q, cols[c]), sums[q, c]
            elif 4 * needed.sum() < 3 * len(needed):
                cols, sums = cols[needed], sums[:, needed]
        else:
            q, c = pairs
            sums = sums + np.einsum("ij,ji->i", queries[q, at:to], columns[at:to][:, c])
            slack = left_q[part][q] * left_x[part][c]
            margin = 0.5 + 1e-12 * slack.max(initial=0)
            if to < dims:
                low = merged(q, sums - slack - margin, ids[c], k)
                floor = np.maximum(floor, kth(low[0], low[1], len(queries), k))
            alive = sums + slack + margin >= floor[q]
            pairs, sums = (q[alive], c[alive]), sums[alive]
    if pairs is None:
        floor = np.maximum(floor, _row_kth(sums, k))
        q, c = np.nonzero((sums >= floor[:, None]) & (sums > -np.inf))
        return q, sums[q, c], ids[cols[c]]
    q, c = pairs
    fine = sums > -np.inf
    return q[fine], sums[fine], ids[c[fine]]


def _margin(slack: np.ndarray) -> np.ndarray:
    """What rounding may add to a bound; scores are whole numbers."""
    return 0.5 + 1e-12 * slack.max(axis=1, initial=0)


def _search(k: int, key, blocks: pa.Table, queries: pa.Table) -> pa.Table:
    """The ``k`` best vectors of a slice's blocks for each query of a band."""
    found = [np.zeros(0, np.int64)] * 3
    for rows, matrix in by_length(queries) if blocks.num_rows and queries.num_rows else ():
        own, dim = ids_of(rows, "id"), matrix.shape[1]
        state = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        for block in blocks.filter(pc.equal(blocks.column("dim"), dim)).to_pylist():
            ids, dims = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["dims"], "<i4")
            columns = unpacked(block["kind"], block["columns"], dim, len(ids))
            floor, more = kth(*state[:2], len(own), k), [state]
            for at in range(0, len(own), CHUNK):
                part = slice(at, at + CHUNK)
                q, score, ident = search_block(matrix[part][:, dims], own[part], columns, ids, floor[part], k)
                more.append((q + at, score, ident))
            state = merged(*map(np.concatenate, zip(*more, strict=True)), k)
        found = [np.concatenate(x) for x in zip(found, (own[state[0]], state[1].astype(np.int64), state[2]), strict=True)]
    names = ("query_id", "score", "vec_id")
    slices = np.full(len(found[0]), key[0].as_py() if len(found[0]) else 0)
    return pa.table({"slice": pa.array(slices, pa.int64())} | {n: pa.array(x, pa.int64()) for n, x in zip(names, found, strict=True)})


def vector_topk(
    df: DataFrame, asked: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: int = 256
) -> DataFrame:
    """The ``k`` rows of ``df`` with the highest inner products for each row where ``asked`` holds.

    Components count as floor(scale * x). Returns query_id, rank (from 1), vec_id and score; equal
    scores come by the smaller vec_id. Rows with the query's own id are no candidates, nor are
    vectors of another length. Rows without an id take no part, nor do vectors that are null, empty
    or hold a null or non-finite component. An id asked for more than once is one query, with the
    first of its vectors in the order of arrays; any other repeated row is a candidate each time.
    Scores are exact as long as sums of products stay below 2^53.
    """
    rows = whole_numbers(df, id_col, vec_col, scale, F.coalesce(asked, F.lit(False)).alias("asked"))
    blocks = materialize(rows.select("id", "vec").mapInArrow(_vertical, BLOCKS), "vertical")
    queries = rows.where("asked").groupBy("id").agg(F.min("vec").alias("vec"))
    slices, bands = -(-blocks.count() // SLICE), -(-queries.count() // BAND)
    found = paired(blocks, queries, slices, bands).applyInArrow(partial(_search, k), FOUND)
    order = [F.col("score").desc(), F.col("vec_id")]
    return best(found, ["query_id"], order, k, slices).select("query_id", "rank", "vec_id", "score")
