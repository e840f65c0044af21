"""Exact deduplication against a minimal perfect hash over the digests seen before.

An index is a table with one row per shard. Its ``levels`` are the bit arrays of a minimal perfect
hash: a digest takes the slot of the first level at which no other digest of the shard met it.
Slots hold whole digests, the locator of the copy that stays, and how many copies there are.
A lookup computes the slot and compares all 32 bytes: equal means a repeat, anything else is new.
Digests are spread over shards by their own bits and are distinct there, so that no shard grows
with the number of copies; copies are counted before anything is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import SPACE, materialize, whole

SHARD_DIGESTS = 20_000  # distinct digests a shard is meant to hold
ROOM = 2.0  # bits of a level for each digest that reaches it

INDEX = T.StructType(
    [
        T.StructField("shard", T.LongType()),
        T.StructField("levels", T.ArrayType(T.BinaryType())),
        T.StructField("digests", T.BinaryType()),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
    ]
)
_INDEX = pa.schema(
    [
        ("shard", pa.int64()),
        ("levels", pa.list_(pa.binary())),
        ("digests", pa.binary()),
        *[(n, pa.list_(pa.int64())) for n in ("lengths", "ids", "counts")],
    ]
)
_MERGED = pa.schema(
    [("digest", pa.binary()), ("length", pa.int64()), ("keep_id", pa.int64()), ("copies", pa.int64()), ("seen", pa.bool_())]
)
CLASSES = "shard long, digest binary, length long, keep_id long, copies long"


def digests(docs: DataFrame, old: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, ``old``, the length of its text in code points and the SHA-256 of its normal form.

    The normal form has no ASCII white space; a null text counts as empty.
    """
    text = whole(F.col(text_col))
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(old, F.lit(False)).alias("old"),
        F.length(text).cast("long").alias("length"),
        F.unhex(F.sha2(F.regexp_replace(text, SPACE, "").cast("binary"), 256)).alias("digest"),
    )


def classes(rows: DataFrame, shards: int) -> DataFrame:
    """One row per digest: the copy that stays, its length and the number of copies.

    Longest text first, then smallest id; rows without an id stay only among their like.
    """
    best = F.min(F.struct((-F.col("length")).alias("neg"), F.col("id").isNull().alias("none"), "id"))
    return (
        rows.groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("copies"))
        .select(
            F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard"),
            "digest",
            (-F.col("best.neg")).alias("length"),
            F.col("best.id").alias("keep_id"),
            "copies",
        )
    )


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """64-bit hashes of digests (two words of each, which are uniform already) for one level."""
    with np.errstate(over="ignore"):
        seed = np.uint64(2 * level + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (keys[:, 0] ^ seed) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(32)) ^ keys[:, 1]) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(29))


def _keys(found: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(found), dtype="<u8").reshape(-1, 4)


def _levels(keys: np.ndarray) -> list[np.ndarray]:
    """The bit arrays of the levels, as bytes of 0 and 1."""
    levels, rest = [], keys
    while len(rest):
        size = max(1, int(len(rest) * ROOM))
        at = _mix(rest, len(levels)) % np.uint64(size)
        hits = np.bincount(at.astype(np.int64), minlength=size)
        levels.append((hits == 1).astype(np.uint8))
        rest = rest[hits[at.astype(np.int64)] > 1]
    return levels


def _slots(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 where no level takes it."""
    slots, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for k, bits in enumerate(levels):
        if not len(open_):
            break
        at = (_mix(keys[open_], k) % np.uint64(len(bits))).astype(np.int64)
        rank, hit = np.cumsum(bits, dtype=np.int64), bits[at] == 1
        slots[open_[hit]] = base + rank[at[hit]] - 1
        base += int(rank[-1])
        open_ = open_[~hit]
    return slots


def _build(found: pa.Table) -> pa.Table:
    digest = found.column("digest").to_pylist()
    keys = _keys(digest)
    levels = _levels(keys)
    order = np.argsort(_slots(levels, keys)).tolist()
    length, keep, copies = (found.column(n).to_pylist() for n in ("length", "keep_id", "copies"))
    row = {
        "shard": found.column("shard")[0].as_py(),
        "levels": [np.packbits(x).tobytes() + len(x).to_bytes(8, "little") for x in levels],
        "digests": b"".join(digest[i] for i in order),
        "lengths": [length[i] for i in order],
        "ids": [keep[i] for i in order],
        "counts": [copies[i] for i in order],
    }
    return pa.Table.from_pylist([row], schema=_INDEX)


def build_index(seen: DataFrame) -> DataFrame:
    """Index of a table of ``classes``, one row per shard."""
    return seen.groupBy("shard").applyInArrow(_build, INDEX)


def _unpack(packed: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed[:-8], np.uint8))[: int.from_bytes(packed[-8:], "little")]


def _place(length: int, keep: int | None) -> tuple:
    """Copies in the order in which they stay: the longest, then the smallest id, then those without."""
    return -length, keep is None, keep or 0


def _lookup(index: pa.Table, found: pa.Table) -> pa.Table:
    # Arrow keeps ids whole numbers, whatever is null beside them.
    out = {"digest": [], "length": [], "keep_id": [], "copies": [], "seen": []}
    slots = [-1] * found.num_rows
    asked = {n: found.column(n).to_pylist() for n in ("digest", "length", "keep_id", "copies")}
    if index.num_rows:
        row = index.to_pylist()[0]
        held = [row["digests"][i : i + 32] for i in range(0, len(row["digests"]), 32)]
        out = {"digest": held, "length": row["lengths"], "keep_id": row["ids"], "copies": row["counts"], "seen": [True] * len(held)}
        if found.num_rows and held:
            slots = _slots([_unpack(x) for x in row["levels"]], _keys(asked["digest"]))
    for slot, digest, length, keep, copies in zip(slots, *asked.values(), strict=True):
        if slot >= 0 and out["digest"][slot] == digest:
            out["copies"][slot] += copies
            if _place(length, keep) < _place(out["length"][slot], out["keep_id"][slot]):
                out["length"][slot], out["keep_id"][slot] = length, keep
        else:
            for name, value in zip(out, (digest, length, keep, copies, False), strict=True):
                out[name].append(value)
    return pa.table([pa.array(out[f.name], f.type) for f in _MERGED], schema=_MERGED)


def merge(index: DataFrame, arrived: DataFrame) -> DataFrame:
    """Classes of index and arrivals together; ``seen`` tells those that the index held before."""
    return (
        index.groupBy("shard")
        .cogroup(arrived.groupBy("shard"))
        .applyInArrow(_lookup, "digest binary, length long, keep_id long, copies long, seen boolean")
    )


def exact_dedup(
    docs: DataFrame,
    history: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_digests: int = SHARD_DIGESTS,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, digest, seen.

    ``history`` is a predicate on the id column; rows it holds for are the corpus seen before,
    from which the index is built, and all others are looked up in it. Rows it does not hold for,
    or gives null, arrive. The classes are the same for any predicate. An empty table gives an
    empty result; of rows equal in id and text, all are ``kept`` or none is; other columns are
    not read.
    """
    rows = materialize(digests(docs, history, id_col, text_col), "digests")
    total = rows.count()
    shards = max(1, -(-total // shard_digests))
    index = materialize(build_index(classes(rows.where("old"), shards)), "index")
    merged = merge(index, classes(rows.where("NOT old"), shards))
    joined = rows.join(merged.withColumnRenamed("length", "best"), "digest")
    return joined.select(
        "id",
        "keep_id",
        F.col("copies").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
        "seen",
    )
