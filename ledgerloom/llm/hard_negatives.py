"""Hard negatives by a packed R-tree: wrong rows that score nearly as high as a right one.

1. Packing (sort-tile-recursive): rows are ranged by (label, coordinate of the largest variance),
   and each range is cut into slabs along one coordinate after the other until a page holds ``PAGE``
   vectors. Pages in this order make tiles, the subtrees that are written; inside a tile every
   ``FANOUT`` boxes have one above them. Tiles hold one label.
2. A box bounds the inner product with an anchor from both sides: each coordinate's interval gives
   its least and its greatest product.
3. Searches are best first: of the boxes in an anchor's queue those with the greatest upper bound are
   opened, for all anchors of a band at once. A box is pruned when its interval misses every score
   window of the anchor, or when its upper bound is strictly below the k-th score of each window.

Positives are searched first, in tiles of the anchor's label, with one window open at both ends; the
windows for the negatives, one for each positive, follow from their scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.blocks import best, block_ids, by_length, gathered, ids_of, kth, merged, packed, paired, unpacked, whole_numbers
from ledgerloom.llm.common import materialize

PAGE = 64  # vectors below a lowest box
FANOUT = 8  # boxes below a box
TILE = 4096  # vectors of a tile
CUTS = 3  # coordinates that slabs are cut along
RANGE = 65_536  # rows packed by one task at a time
SLICE = 8  # tiles of a slice, on average
BAND = 1024  # anchors of a band, on average
OPENED = 4  # boxes an anchor opens in a round

_TILES = pa.schema(
    [
        ("block", pa.int64()),
        ("label", pa.int64()),
        ("dim", pa.int32()),
        ("ids", pa.binary()),
        ("kind", pa.string()),
        ("vectors", pa.binary()),
        ("boxes", pa.binary()),
    ]
)
TILES = "block long, label long, dim int, ids binary, kind string, vectors binary, boxes binary"
FOUND = "slice long, anchor_id long, p int, score long, found_id long"


def tiled(matrix: np.ndarray, cuts: list[int], page: int = PAGE) -> np.ndarray:
    """Rows in sort-tile-recursive order: slabs along each coordinate of ``cuts``, pages at last."""
    pages = -(-len(matrix) // page)
    if pages <= 1 or not cuts:
        return np.arange(len(matrix))
    order = np.argsort(matrix[:, cuts[0]], kind="stable")
    slab = page * -(-pages // int(np.ceil(pages ** (1 / len(cuts)) - 1e-9)))
    parts = [order[at : at + slab] for at in range(0, len(order), slab)]
    return np.concatenate([part[tiled(matrix[part], cuts[1:], page)] for part in parts])


def levels(count: int) -> list[int]:
    """Boxes of each level of a tile of ``count`` vectors, from the pages up to the root."""
    out = [-(-count // PAGE)]
    while out[-1] > 1:
        out.append(-(-out[-1] // FANOUT))
    return out


def boxes_of(matrix: np.ndarray) -> np.ndarray:
    """Lower and upper corner of every box of a tile, level after level: (2, boxes, dimensions)."""
    low = [np.minimum.reduceat(matrix, np.arange(0, len(matrix), PAGE), axis=0)]
    high = [np.maximum.reduceat(matrix, np.arange(0, len(matrix), PAGE), axis=0)]
    while len(low[-1]) > 1:
        at = np.arange(0, len(low[-1]), FANOUT)
        low.append(np.minimum.reduceat(low[-1], at, axis=0))
        high.append(np.maximum.reduceat(high[-1], at, axis=0))
    return np.stack([np.concatenate(low), np.concatenate(high)])


def _packed_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = block_ids()
    for table in gathered(batches, RANGE):
        for rows, matrix in by_length(table):
            labels, ids = ids_of(rows, "label"), ids_of(rows, "id")
            for label in np.unique(labels):
                of = np.flatnonzero(labels == label)
                part, own = matrix[of], ids[of]
                cuts = np.argsort(-part.var(axis=0), kind="stable")[:CUTS]
                order = tiled(part, list(cuts))
                for at in range(0, len(order), TILE):
                    tile = part[order[at : at + TILE]]
                    kind, vectors = packed(tile)
                    row = {
                        "block": next(numbers),
                        "label": int(label),
                        "dim": tile.shape[1],
                        "ids": own[order[at : at + TILE]].tobytes(),
                        "kind": kind,
                        "vectors": vectors,
                        "boxes": boxes_of(tile).astype(kind).tobytes(),
                    }
                    yield pa.RecordBatch.from_pylist([row], schema=_TILES)


def r_tree(rows: DataFrame) -> DataFrame:
    """The written tiles of ``rows`` (id, label, vec): a packed R-tree, one row for each subtree."""
    spread = rows.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg(F.var_pop("x").alias("v"), F.count("*").alias("n"))
    first = spread.agg(F.max_by("i", F.struct("v", -F.col("i"))).alias("i"), F.max("n").alias("n")).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    ranges = max(-(-(first.n or 0) // RANGE), min(cores, -(-(first.n or 0) // TILE)), 1)
    along = F.get("vec", F.lit(first.i or 0))
    ranged = rows.repartitionByRange(ranges, F.size("vec"), "label", along, "id")
    return materialize(ranged.select("id", "label", "vec").mapInArrow(_packed_tiles, TILES), "tiles")


class _Windows:
    """Best scores so far of each window (low, high) of each anchor."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.rows = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        self.floor = np.full(low.shape, -np.inf)

    def add(self, more: list[tuple]) -> None:
        if more:
            joined = map(np.concatenate, zip(self.rows, *more, strict=True))
            self.rows = merged(*joined, self.k)
            self.floor = kth(*self.rows[:2], self.low.size, self.k).reshape(self.low.shape)

    def useful(self, of: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        """Which intervals may hold a score that some window still takes."""
        out = np.zeros(lower.shape, bool)
        for w in range(self.low.shape[1]):
            low, high, floor = (x[of, w][:, None] for x in (self.low, self.high, self.floor))
            out |= (upper >= low) & (lower <= high) & (np.minimum(upper, high) >= floor)
        return out


def search_tile(of, queries, own, vectors, ids, boxes, windows: _Windows) -> int:
    """Search one tile best first for the anchors ``of``; returns how many pages were read."""
    size, positive, negative = levels(len(ids)), np.maximum(queries[of], 0), np.minimum(queries[of], 0)
    first = np.cumsum([0, *size])
    lower = positive @ boxes[0].T + negative @ boxes[1].T
    upper = positive @ boxes[1].T + negative @ boxes[0].T
    queue = np.zeros(upper.shape, bool)
    queue[:, -1] = True
    reads = 0
    while True:
        queue &= windows.useful(of, lower, upper)
        if not queue.any():
            return reads
        ahead = np.where(queue, upper, -np.inf)
        width = min(OPENED, ahead.shape[1])
        boxes_at = np.argpartition(-ahead, width - 1, axis=1)[:, :width]
        anchor, slot = np.nonzero(np.take_along_axis(queue, boxes_at, 1))
        box = boxes_at[anchor, slot]
        queue[anchor, box] = False
        inner = box >= size[0]
        level = np.searchsorted(first, box[inner], "right") - 1
        for i in range(FANOUT):
            child = (box[inner] - first[level]) * FANOUT + i
            there = child < np.array(size)[level - 1]
            queue[anchor[inner][there], (first[level - 1] + child)[there]] = True
        more = []
        pages = np.flatnonzero(~inner)
        pages = pages[np.argsort(box[pages], kind="stable")]
        for group in np.split(pages, np.flatnonzero(np.diff(box[pages])) + 1) if len(pages) else ():
            page = slice(box[group[0]] * PAGE, box[group[0]] * PAGE + PAGE)
            rows = of[anchor[group]]
            scores = queries[rows] @ vectors[page].T
            scores[own[rows][:, None] == ids[page]] = -np.inf
            reads += len(group)
            for w in range(windows.low.shape[1]):
                low = np.maximum(windows.low[rows, w], windows.floor[rows, w])
                a, v = np.nonzero((scores >= low[:, None]) & (scores <= windows.high[rows, w][:, None]) & (scores > -np.inf))
                if len(a):
                    more.append((rows[a] * windows.low.shape[1] + w, scores[a, v], ids[page][v]))
        windows.add(more)


def _search(k: int, same: bool, key, tiles: pa.Table, anchors: pa.Table) -> pa.Table:
    """The ``k`` best rows of a slice's tiles for each window of each anchor of a band."""
    out = [np.zeros(0, np.int64)] * 4
    for rows, matrix in by_length(anchors) if tiles.num_rows and anchors.num_rows else ():
        own, labels = ids_of(rows, "id"), ids_of(rows, "label")
        low, high = (np.array(rows.column(n).to_pylist(), np.float64).reshape(len(own), -1) for n in ("low", "high"))
        windows = _Windows(low, high, k)
        for tile in tiles.to_pylist():
            of = np.flatnonzero((labels == tile["label"]) == same)
            if tile["dim"] == matrix.shape[1] and len(of):
                ids = np.frombuffer(tile["ids"], np.int64)
                vectors = unpacked(tile["kind"], tile["vectors"], len(ids), tile["dim"])
                boxes = unpacked(tile["kind"], tile["boxes"], 2, -1, tile["dim"])
                search_tile(of, matrix, own, vectors, ids, boxes, windows)
        at, score, ident = windows.rows
        more = (own[at // low.shape[1]], at % low.shape[1], score.astype(np.int64), ident)
        out = [np.concatenate(x) for x in zip(out, more, strict=True)]
    names = (("anchor_id", pa.int64()), ("p", pa.int32()), ("score", pa.int64()), ("found_id", pa.int64()))
    slices = pa.array(np.full(len(out[0]), key[0].as_py() if len(out[0]) else 0), pa.int64())
    return pa.table({"slice": slices} | {n: pa.array(x, t) for (n, t), x in zip(names, out, strict=True)})


def hard_negatives(
    df: DataFrame,
    asked: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    scale: int = 256,
) -> DataFrame:
    """For each row where ``asked`` holds and each of its best rows of the same label, the best rows
    of other labels that score between two percentages of that one's score.

    Components count as floor(scale * x), a score is an inner product, equal scores come by the
    smaller id. Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score; pairs without a negative have no row. Rows without id or label take no part, nor
    do vectors that are null, empty or hold a null or non-finite component; rows of the anchor's own
    id and vectors of another length are never found. An id asked for more than once is one anchor,
    with the first of its (label, vector); any other repeated row is found each time.
    Scores are exact as long as sums of products stay below 2^53 over 100.
    """
    label = F.col(label_col).cast("long").alias("label")
    rows = whole_numbers(df.where(F.col(label_col).isNotNull()), id_col, vec_col, scale, label, F.coalesce(asked, F.lit(False)).alias("asked"))
    tiles = r_tree(rows.select("id", "label", "vec"))
    anchors = rows.where("asked").groupBy("id").agg(F.min(F.struct("label", "vec")).alias("a")).select("id", "a.*")
    slices, bands = -(-tiles.count() // SLICE), -(-anchors.count() // BAND)
    order = [F.col("score").desc(), F.col("found_id")]

    open_ends = anchors.withColumns({"low": F.array(F.lit(float("-inf"))), "high": F.array(F.lit(float("inf")))})
    near = paired(tiles, open_ends, slices, bands).applyInArrow(partial(_search, positives, True), FOUND)
    right = best(near, ["anchor_id"], order, positives, slices)
    right = right.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "found_id"))).alias("right"))
    right = materialize(right, "positives")

    whole = F.transform("right.score", lambda s: s.cast("double"))
    windows = anchors.join(right.withColumnRenamed("anchor_id", "id"), "id").withColumns(
        {
            "low": F.transform(whole, lambda s: F.ceil(s * least_percent / 100).cast("double")),
            "high": F.transform(whole, lambda s: F.floor(s * most_percent / 100).cast("double")),
        }
    )
    # Searches go window by window; anchors with fewer positives get windows that take nothing.
    windows = windows.withColumns(
        {
            n: F.concat(n, F.array_repeat(F.lit(empty), F.lit(positives) - F.size(n)))
            for n, empty in (("low", float("inf")), ("high", float("-inf")))
        }
    ).select("id", "label", "vec", "low", "high")
    wrong = paired(tiles, windows, slices, bands).applyInArrow(partial(_search, negatives, False), FOUND)
    wrong = best(wrong, ["anchor_id", "p"], order, negatives, slices)
    pair = F.col("right")[F.col("p")]
    return wrong.join(right, "anchor_id").select(
        "anchor_id",
        pair["found_id"].alias("positive_id"),
        "rank",
        F.col("found_id").alias("negative_id"),
        pair["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
