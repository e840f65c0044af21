"""Ranked lexical search: best-first intervals of documents, bounded by range-maximum queries.

1. Index: each task cuts its documents into shards of bounded size, in order of their ids, and writes
   for every term of a shard the list of its documents with the term's count in each.
2. Statistics come from the index: documents, terms, and the documents of each term that is asked for.
3. Search, shard by shard: a posting's impact is what it adds to a document's score. Every posting
   list has a sparse table, so the highest impact of a term within an interval of documents is the
   greater of two entries; summed over an item's terms these bound every score in the interval. The
   intervals with the highest bounds come first. Each is split at the document of its highest single
   impact; this document is scored, the rest of either side goes on with its own bound. Intervals
   bounded strictly below the k-th score are dropped. Intervals of at most ``LEAF`` documents are
   scored whole.

Items meet all shards, see ``blocks``; an item's k-th score is carried from shard to shard.
Terms are known by 64-bit hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.blocks import best, block_ids, merged, paired
from ledgerloom.llm.common import batches_of, materialize, returned

SHARD_DOCS = 4096
SHARD_TERMS = 2_000_000  # occurrences of terms in a shard, but for its last document
SLICE = 500_000  # postings of a slice, on average
BAND = 10_000  # terms of a band's items, on average
LEAF = 64  # documents of an interval that is scored whole
OPENED = 64  # intervals split at once

INDEX = "block long, docs long, occurrences long, held array<long>, posted array<int>, ids binary, named binary, lengths binary, at binary, counts binary"
FOUND = "slice long, item_id long, score long, doc_id long"

_INDEX = pa.schema(
    [
        ("block", pa.int64()),
        ("docs", pa.int64()),
        ("occurrences", pa.int64()),
        ("held", pa.list_(pa.int64())),
        ("posted", pa.list_(pa.int32())),
        *[(n, pa.binary()) for n in ("ids", "named", "lengths", "at", "counts")],
    ]
)

# Terms are runs of ASCII letters and digits and of all other characters beyond ASCII; in UTF-8 these
# are the bytes from 128. A to Z are written small.
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def term_id(term: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(term) - (1 << 63)


class _Growing:
    """A shard being filled: documents as arrays of term numbers and counts, and the numbers' terms."""

    def __init__(self):
        self.docs: list[tuple] = []  # id, length, term numbers, counts
        self.numbers: dict[bytes, int] = {}
        self.occurrences = 0

    def add(self, ident: int | None, found: list[bytes]) -> bool:
        """Take a document; tells whether the shard is full."""
        counted, numbers = Counter(found), self.numbers
        term = np.fromiter((numbers.setdefault(t, len(numbers)) for t in counted), np.int32, len(counted))
        count = np.fromiter(counted.values(), np.int32, len(counted))
        self.docs.append((ident, len(found), term, count))
        self.occurrences += len(found)
        return len(self.docs) == SHARD_DOCS or self.occurrences >= SHARD_TERMS

    def written(self, block: int) -> pa.RecordBatch:
        """Posting lists: terms ascending by hash, documents by their ids, those without one last."""
        docs = sorted(self.docs, key=lambda d: (d[0] is None, d[0] or 0))
        held = np.fromiter(map(term_id, self.numbers), np.int64, len(self.numbers))
        by = np.argsort(held)
        place = np.empty(len(held), np.int32)
        place[by] = np.arange(len(held))
        term = place[np.concatenate([d[2] for d in docs])]
        at = np.repeat(np.arange(len(docs), dtype="<i2"), [len(d[2]) for d in docs])
        order = np.argsort(term, kind="stable")
        row = {
            "block": block,
            "docs": sum(d[1] > 0 for d in docs),
            "occurrences": self.occurrences,
            "held": held[by],
            "posted": np.bincount(term, minlength=len(held)),
            # Documents without an id count, but are never found.
            "ids": np.array([d[0] or 0 for d in docs], np.int64).tobytes(),
            "named": bytes(d[0] is not None for d in docs),
            "lengths": np.array([d[1] for d in docs], np.int64).tobytes(),
            "at": at[order].tobytes(),
            "counts": np.concatenate([d[3] for d in docs])[order].astype("<i4").tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema=_INDEX)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers, shard = block_ids(), _Growing()
    for batch in batches_of(batches):
        for ident, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
            if shard.add(ident, terms(text.as_py() or b"")):
                yield shard.written(next(numbers))
                shard = _Growing()
    if shard.docs:
        yield shard.written(next(numbers))


class Shard:
    """The lists of a shard for the terms ``wanted`` (ascending), with impacts and sparse tables."""

    def __init__(self, batch: pa.RecordBatch, wanted: np.ndarray, weights: np.ndarray, n_docs: int, occurrences: int):
        held, posted = (batch.column(n)[0].values.to_numpy(zero_copy_only=False).astype(np.int64) for n in ("held", "posted"))
        row = {n: batch.column(n)[0].as_py() for n in ("ids", "named", "lengths", "at", "counts")}
        self.size = len(row["lengths"]) // 8
        self.ids, self.named = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["named"], np.uint8) > 0
        measure = 50 + (50 * np.frombuffer(row["lengths"], np.int64) * n_docs) // max(occurrences, 1)

        _, of, term = np.intersect1d(wanted, held, assume_unique=True, return_indices=True)
        self.wanted, n = wanted[of], posted[term]
        self.first = np.cumsum(n) - n
        starts = (np.cumsum(posted) - posted)[term]
        flat = np.repeat(starts - self.first, n) + np.arange(n.sum())
        self.at = np.frombuffer(row["at"], "<i2")[flat].astype(np.int64)
        count = np.frombuffer(row["counts"], "<i4")[flat].astype(np.int64)
        self.impact = np.repeat(weights[of], n) * ((1_000_000_000 * count) // (1000 * count + 20 * measure[self.at]))

        # Impact and place in one number: the maximum is the highest impact at its first place. Level
        # l holds maxima of 2^l entries; those across the end of a list are never asked for.
        tables = [self.impact * (1 << 13) + (8191 - self.at)]
        while 2 << (len(tables) - 1) <= n.max(initial=0):
            half = 1 << (len(tables) - 1)
            tables.append(np.r_[np.maximum(tables[-1][:-half], tables[-1][half:]), tables[-1][-half:]])
        self.table = np.stack(tables)
        # Postings of each term before each document.
        self.before = np.zeros((len(n), self.size + 1), np.int16)
        self.before[np.repeat(np.arange(len(n)), n), self.at + 1] = 1
        np.cumsum(self.before, axis=1, out=self.before)

    def terms_of(self, asked: np.ndarray) -> np.ndarray:
        """Which lists the (ascending) terms of an item are."""
        return np.intersect1d(self.wanted, asked, assume_unique=True, return_indices=True)[1]

    def _range(self, lists: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.before[lists, place[:, None]].astype(np.int64)

    def bounds(self, lists: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the lists' highest impacts in each interval, and the place of the highest of all."""
        i, j = self._range(lists, start), self._range(lists, stop)
        some = j > i
        level = np.frexp(np.maximum(j - i, 1))[1] - 1
        left = np.where(some, self.first[lists] + i, 0)
        right = np.where(some, self.first[lists] + j - (1 << level), 0)
        top = np.where(some, np.maximum(self.table[level, left], self.table[level, right]), 0)
        return (top >> 13).sum(1), 8191 - (top.max(1) & 8191)

    def scores(self, lists: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Scores of single documents."""
        i, j = self._range(lists, places), self._range(lists, places + 1)
        return np.where(j > i, self.impact[np.where(j > i, self.first[lists] + i, 0)], 0).sum(1)

    def whole(self, lists: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all documents with a score in the intervals."""
        i, j = self._range(lists, start), self._range(lists, stop)
        n = (j - i).ravel()
        flat = np.repeat((self.first[lists] + i).ravel() - (np.cumsum(n) - n), n) + np.arange(n.sum())
        total = np.bincount(self.at[flat], self.impact[flat], self.size)
        places = np.flatnonzero(total)
        return places, total[places].astype(np.int64)


def search_shard(shard: Shard, lists: np.ndarray, kept: tuple[np.ndarray, np.ndarray], k: int):
    """``kept`` (scores, ids) of one item, highest first, brought up to date by one shard.

    Documents of equal score come by the smaller id; intervals whose bound equals the k-th score are
    therefore still searched.
    """
    scores, ids = kept
    if not len(lists):
        return kept
    start, stop = np.array([0]), np.array([shard.size])
    bound, place = shard.bounds(lists, start, stop)
    while len(start):
        floor = max(scores[k - 1] if len(scores) >= k else 0, 1)
        open_ = bound >= floor
        start, stop, bound, place = start[open_], stop[open_], bound[open_], place[open_]
        if not len(start):
            break
        ahead = np.argsort(-bound, kind="stable")
        now, later = ahead[:OPENED], ahead[OPENED:]
        small = stop[now] - start[now] <= LEAF
        leaf, split = now[small], now[~small]
        found, totals = shard.whole(lists, start[leaf], stop[leaf])
        at = place[split]
        found, totals = np.r_[found, at], np.r_[totals, shard.scores(lists, at)]
        fine = (totals >= floor) & shard.named[found]
        if fine.any():
            _, scores, ids = merged(
                np.zeros(fine.sum() + len(scores), np.int8), np.r_[scores, totals[fine]], np.r_[ids, shard.ids[found[fine]]], k
            )
        left, right = np.r_[start[split], at + 1], np.r_[at, stop[split]]
        some = right > left
        left, right = left[some], right[some]
        more, where = shard.bounds(lists, left, right) if len(left) else (left, left)
        start, stop = np.r_[start[later], left], np.r_[stop[later], right]
        bound, place = np.r_[bound[later], more], np.r_[place[later], where]
    return scores, ids


def _search(k: int, n_docs: int, occurrences: int, key, index: pa.Table, items: pa.Table) -> pa.Table:
    """The ``k`` best documents of a slice's shards for each item of a band."""
    asked = items.to_pylist() if index.num_rows else []
    kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asked]
    weights = {t: w for r in asked for t, w in zip(r["terms"], r["weights"], strict=True)}
    wanted = np.sort(np.fromiter(weights, np.int64, len(weights)))
    weighs = np.fromiter((weights[t] for t in wanted.tolist()), np.int64, len(wanted))
    own = [np.sort(np.array(r["terms"], np.int64)) for r in asked]
    for batch in index.to_batches(1) if asked else ():
        shard = Shard(batch, wanted, weighs, n_docs, occurrences)
        kept = [search_shard(shard, shard.terms_of(t), state, k) for t, state in zip(own, kept, strict=True)]
    pa.default_memory_pool().release_unused()
    sizes = [len(s) for s, _ in kept]
    return pa.table(
        {
            "slice": pa.array([key[0].as_py()] * sum(sizes), pa.int64()),
            "item_id": pa.array(np.repeat([r["id"] for r in asked], sizes), pa.int64()),
            "score": pa.array(np.concatenate([s for s, _ in kept]) if kept else [], pa.int64()),
            "doc_id": pa.array(np.concatenate([i for _, i in kept]) if kept else [], pa.int64()),
        }
    )


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted({term_id(t) for t in terms(x.as_py() or b"")}) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.int64()))], ["id", "terms"])


def _indexed_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return returned(_indexed(batches))


def lexical_topk(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = 50,
) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each item: item_id, rank, doc_id, score.

    A term weighs floor(1000 ln((2 N + 2) / (2 df + 1))), of N documents with terms and df with this
    one. A score sums weight * (10^9 tf div (1000 tf + 20 m)) over an item's distinct terms, where m is
    50 + 50 n N div L for a document of n terms, of L in all. Equal scores come by the smaller doc_id.

    Null texts have no terms. Documents without an id count in N, df and L, but are never found; one
    whose id repeats is found for each of its rows. Items of one id are one item with the terms of all;
    items without id or terms have no row.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(doc_text).cast("binary").alias("text"))
    index = materialize(texts.mapInArrow(_indexed_task, INDEX), "postings")
    asked = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("binary").alias("text"))
    pairs = asked.mapInArrow(_item_terms, "id long, terms array<long>").select("id", F.explode("terms").alias("term")).distinct()
    pairs = materialize(pairs, "asked")

    postings = F.octet_length("at") / 2
    total = index.agg(F.sum("docs").alias("docs"), F.sum("occurrences").alias("occurrences"), F.sum(postings).alias("postings")).first()
    n_docs, occurrences = total.docs or 0, total.occurrences or 0
    held = index.select(F.inline(F.arrays_zip(F.col("held").alias("term"), F.col("posted").alias("n"))))
    held = held.join(pairs.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighted = pairs.join(held.withColumn("weight", weight), "term").groupBy("id")
    weighted = weighted.agg(F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights"))

    slices, bands = -(-int(total.postings or 0) // SLICE), -(-pairs.count() // BAND)
    found = paired(index, weighted, slices, bands).applyInArrow(partial(_search, k, n_docs, occurrences), FOUND)
    order = [F.col("score").desc(), F.col("doc_id")]
    return best(found, ["item_id"], order, k, slices).select("item_id", "rank", "doc_id", "score")
