"""Jaccard join of shingle sets: subsets for small sets, inverted lists for large ones.

Two texts link when their sets of word shingles overlap by a percentage of their union. Equal sets
are one vertex. What follows is exact for every order of the shingles; shingles are ordered by how
many sets hold them, so that prefixes hold rare ones.

1. A set can lack only so many shingles of a set it links with: one with more shingles that no
   other set holds links with nothing. Shingles below a fixed hash are counted over all sets, and
   most sets end here. Those that are left are counted again on all their shingles, among
   themselves.
2. Small sets enumerate their subsets of every size that a link permits. Sets with an equal subset
   link as the subset's size tells, each with the one that lacks least; no pairs are formed.
3. Large sets, and the smaller ones they may link with, are written into inverted lists under their
   rarest shingles, as many as a link can pass over. Each list pairs its members with one hub.
   Components of the links found so far leave pairs across components; only these are formed then.
4. The size up to which sets are small is where enumerating costs more than scanning lists, by the
   lists' mean length.

Pairs are checked on whole sets. Sets and shingles are known by 64-bit hashes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import batches_of, broadcast_within, materialize, returned, whole
from ledgerloom.llm.components import components

COUNTED = 1.75  # share of all shingles that are counted at first, in shares a set may lack
SMALL_MOST = 64  # no set above this size is a small one

HEADS = "id long, n int, cid long, head array<long>"
SETS = "cid long, n int, shingles array<long>"


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the runs of ``width`` words, A to Z in lower case.

    A text of fewer words has one, of all its words; a text without words has none.
    """
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    if len(words) < width:
        return np.array([xxh64_intdigest(b"\x20".join(words)) >> 1], np.int64)
    each = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    last = len(words) - width + 1
    mixed = np.zeros(last, np.uint64)
    for i in range(width):
        mixed = (mixed ^ each[i : i + last]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique((mixed >> np.uint64(1)).astype(np.int64))


def set_id(found: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(found.tobytes()) - (1 << 63)


def lacking(n, percent: int):
    """Shingles that a set of ``n`` can lack of a set it links with."""
    return n * (100 - percent) // 100


def _lacking(n: Column, percent: int) -> Column:
    return F.floor(n * (100 - percent) / 100).cast("int")


def _border(percent: int) -> int:
    return min((1 << 63) - 1, int(COUNTED * (100 - percent) / 100 * (1 << 63)))


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    values = np.concatenate(found) if found else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _heads(width: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and id of each set, and its hashes below the border."""
    border = _border(percent)
    for batch in batches_of(batches):
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            found = [shingles(t, width) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array([len(x) for x in found], pa.int32()),
                    pa.array([set_id(x) for x in found], pa.int64()),
                    _lists([x[: np.searchsorted(x, border)] for x in found]),
                ],
                ["id", "n", "cid", "head"],
            )


def _whole_sets(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches):
        for first in range(0, batch.num_rows, 512):
            found = [shingles(t, width) for t in batch.slice(first, 512).column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_id(x) for x in found], pa.int64()),
                    pa.array([len(x) for x in found], pa.int32()),
                    _lists(found),
                ],
                ["cid", "n", "shingles"],
            )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), whole(F.col(text_col)).cast("binary").alias("text"))


def _survivors(texts: DataFrame, heads: DataFrame, width: int, percent: int) -> DataFrame:
    """The whole sets (cid, n, shingles) that may link with another, as far as the heads tell.

    They are read again from the text of one row each.
    """
    held = heads.select("cid", F.explode("head").alias("e")).groupBy("e")
    held = held.agg(F.min("cid").alias("cid"), F.max("cid").alias("other"))
    own = held.where(F.col("cid") == F.col("other")).groupBy("cid").agg(F.count(F.lit(1)).cast("int").alias("own"))
    sizes = heads.groupBy("cid").agg(F.max("n").alias("n"), F.min("id").alias("id"))
    kept = sizes.join(own, "cid", "left").where(F.coalesce("own", F.lit(0)) <= _lacking(F.col("n"), percent))
    kept = materialize(kept.select("cid", "id"), "kept")
    wanted = broadcast_within(kept.select(F.col("id").alias("wanted")).distinct(), kept.count())
    again = texts.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    read = again.mapInArrow(lambda it: returned(_whole_sets(width, it)), SETS)
    # Rows of one id may have other sets too.
    return materialize(read.join(kept.select("cid"), "cid", "left_semi").dropDuplicates(["cid"]), "survivors")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """cid, n, own, e, rank: the first shingles of each set, as many as it may lack and one more.

    Those that fewer of ``sets`` hold come first, then those of smaller hash. A set's own shingles
    take the first ranks and are not listed; sets with more of them than they may lack are left out.
    """
    postings = sets.select("cid", "n", F.explode("shingles").alias("e"))
    shared = materialize(postings.groupBy("e").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    joined = postings.join(shared, "e")
    group = Window.partitionBy("cid")
    place = F.row_number().over(group.orderBy("df", "e"))
    own = F.col("n") - F.count(F.lit(1)).over(group)
    ranked = joined.select("cid", "n", "e", own.cast("int").alias("own"), place.alias("place"))
    ranked = ranked.withColumn("rank", (F.col("own") + F.col("place") - 1).cast("int"))
    return ranked.where(F.col("rank") <= _lacking(F.col("n"), percent)).select("cid", "n", "own", "e", "rank")


def subsets(n: int, percent: int) -> int:
    """How many subsets a set of ``n`` enumerates."""
    return sum(comb(n, d) for d in range(lacking(n, percent) + 1))


def boundary(list_length: float, percent: int) -> int:
    """The largest size up to which enumerating subsets costs no more than scanning lists.

    A scan meets ``list_length`` sets under each shingle of a prefix.
    """
    n = 0
    while n < SMALL_MOST and subsets(n + 1, percent) <= max(2 * (n + 1), (lacking(n + 1, percent) + 1) * list_length):
        n += 1
    return n


def _enumerate(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the subsets of small sets, with what each lacks of its set."""
    for batch in batches_of(batches):
        keys, sets, sizes, lacks = [], [], [], []
        for cid, found in zip(batch.column("cid").to_pylist(), batch.column("shingles"), strict=True):
            found = found.values.to_numpy().astype(np.uint64)
            mixed = (found ^ (found >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            total = int(mixed.sum(dtype=np.uint64))
            each = mixed.tolist()
            for d in range(lacking(len(each), percent) + 1):
                for gone in itertools.combinations(each, d):
                    keys.append((total - sum(gone)) % (1 << 64) - (1 << 63))
                    sets.append(cid)
                    sizes.append(len(each) - d)
                    lacks.append(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), pa.array(sets, pa.int64()), pa.array(lacks, pa.int32())],
            ["key", "size", "cid", "d"],
        )


def _small_links(sets: DataFrame, small: int, percent: int) -> DataFrame:
    """Links (a, b) between sets of at most ``small`` shingles: with the set that lacks least of a subset."""
    few = sets.where(F.col("n") <= small).select("cid", "shingles")
    rows = materialize(few.mapInArrow(lambda it: returned(_enumerate(percent, it)), "key long, size int, cid long, d int"), "subsets")
    least = rows.groupBy("key", "size").agg(
        F.min(F.struct("d", "cid")).alias("least"), F.count(F.lit(1)).alias("n")
    )
    least = materialize(least.where("n > 1").select("key", "size", "least"), "least")
    met = rows.join(least, ["key", "size"]).where(F.col("cid") != F.col("least.cid"))
    lacks = F.col("d") + F.col("least.d")
    return met.where(100 * F.col("size") >= percent * (F.col("size") + lacks)).select(
        F.least("cid", "least.cid").alias("a"), F.greatest("cid", "least.cid").alias("b")
    )


def _may_link(a: str, b: str, small: int, percent: int) -> Column:
    """Can sets of these sizes link whose first common shingle has these ranks, and is it a list's task?"""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    overlap = F.ceil(percent * (na + nb) / (100 + percent))
    left = F.least(na - F.col(f"{a}.rank"), nb - F.col(f"{b}.rank"))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (left >= overlap) & (F.greatest(na, nb) > small)


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")
    ).distinct()


def _hub_pairs(lists: DataFrame, small: int, percent: int) -> DataFrame:
    """Each list's members with its hub: the member with the smallest share of shingles of its own."""
    best = F.min(F.struct((F.col("own") / F.col("n")).alias("s"), "cid", "n", "rank")).alias("hub")
    hubs = lists.groupBy("e").agg(best, F.count(F.lit(1)).alias("members")).where("members > 1")
    hubs = materialize(hubs.select("e", "hub.cid", "hub.n", "hub.rank"), "hubs")
    joined = lists.alias("x").join(hubs.alias("y"), "e").where(F.col("x.cid") != F.col("y.cid"))
    return _pairs(joined.where(_may_link("x", "y", small, percent)))


def _cross_pairs(lists: DataFrame, done: DataFrame, labels: DataFrame, small: int, percent: int) -> DataFrame:
    """Pairs of lists' members that are in different components and were not checked before."""
    named = lists.join(labels.withColumnRenamed("vertex", "cid"), "cid", "left").select(
        "e", "cid", "n", "rank", F.coalesce("component", "cid").alias("component")
    )
    named = materialize(named, "named")
    mixed = named.groupBy("e").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = materialize(mixed.where("lo <> hi").select("e"), "mixed")
    rest = materialize(named.join(mixed, "e", "left_semi"), "rest")
    joined = rest.alias("x").join(rest.alias("y"), "e").where(
        (F.col("x.cid") < F.col("y.cid")) & (F.col("x.component") != F.col("y.component"))
    )
    return _pairs(joined.where(_may_link("x", "y", small, percent))).join(done, ["a", "b"], "left_anti")


def _check(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which pairs link, by their whole sets."""
    for batch in batches_of(batches):
        linked = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            common = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * common >= percent * (len(x) + len(y) - common))
        keep = pa.array(linked, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"]
        )


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    with_x = pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x")), "a")
    with_both = with_x.join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y")), "b")
    found = with_both.select("a", "b", "x", "y").mapInArrow(lambda it: returned(_check(percent, it)), "a long, b long")
    return materialize(found, "linked")


def ngram_groups(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, n (distinct shingles), cid (id of its set), component.

    ``component`` is the smallest id reachable by links, its own included. Equal sets link; an empty
    set, of a null or empty text or one without words, links with nothing. Repeated rows and rows of
    one id count as documents of their own that have the same name; rows without an id take part,
    and a component of such rows alone has none. An empty table gives an empty result. Other
    columns are not read.
    """
    texts = _texts(docs, id_col, text_col)
    heads = materialize(texts.mapInArrow(lambda it: returned(_heads(width, percent, it)), HEADS), "heads")
    filled = heads.where("n > 0")
    sets = _survivors(texts, filled, width, percent)
    lists = materialize(_prefixes(sets, percent), "lists")
    spread = lists.groupBy("e").count().agg(F.sum(F.col("count") * F.col("count")) / F.sum("count")).first()[0]
    small = boundary(spread or 0.0, percent)
    links = _small_links(sets, small, percent)
    lists = lists.where(100 * F.col("n") >= percent * (small + 1))

    near = materialize(_hub_pairs(lists, small, percent), "pairs")
    links = materialize(links.union(_linked(near, sets, percent)).distinct(), "links")
    labels = components(links)
    across = materialize(_cross_pairs(lists, near, labels, small, percent), "pairs")
    more = _linked(across, sets, percent)
    if more.limit(1).count():
        labels = components(links.union(more))

    names = filled.join(labels, filled["cid"] == labels["vertex"], "left").groupBy(
        F.coalesce("component", "cid").alias("label")
    )
    names = materialize(names.agg(F.min("id").alias("name")), "names")
    of = heads.select("id", "n", "cid").join(labels, F.col("cid") == F.col("vertex"), "left")
    label = F.when(F.col("n") > 0, F.coalesce("component", "cid"))
    return (
        of.select("id", "n", "cid", label.alias("at"))
        .join(names, F.col("at") == F.col("label"), "left")
        .select("id", "n", "cid", F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("id")).alias("component"))
    )


def near_dedup(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without the documents whose component has a smaller id; rows of one id go together."""
    groups = ngram_groups(docs, width, percent, id_col, text_col)
    gone = groups.where(F.col("id") != F.col("component")).select(F.col("id").alias("gone")).distinct()
    gone = materialize(gone, "gone")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("row_id"))
    kept = rows.join(broadcast_within(gone, gone.count()), F.col("row_id") == F.col("gone"), "left_anti")
    return kept.select("row.*")
