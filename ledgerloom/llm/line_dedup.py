"""Removal of passages that repeat across documents, by overlapping windows of three lines.

Every run of three consecutive lines of a text is hashed. Windows that occur more than once
anywhere are found by one aggregation that carries a count and the first place; every place but the
first is a later occurrence. The positions that later occurrences cover are merged per document,
and the text is put together from the lines left. All of it is column expressions: equal windows
are combined before the shuffle, and texts move only where some line of theirs goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE, TRIM, broadcast_within, materialize, whole

WINDOW = 3


def normal(line: Column) -> Column:
    """A line as it is compared: white space at its ends dropped, inner white space one blank."""
    return F.regexp_replace(F.btrim(line, F.lit(TRIM)), SPACE, " ")


def line_hashes(text: Column) -> Column:
    """Places and hashes of the lines that have a word; others are passed over."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("i"), normal(x).alias("t")))
    return F.transform(
        F.filter(lines, lambda x: x["t"] != ""), lambda x: F.struct(x["i"].alias("i"), F.xxhash64(x["t"]).alias("h"))
    )


def windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row per window: id, doc (hash of id and text), at (its number), first, last (lines), hash."""
    lines = docs.select("id", "doc", line_hashes(F.col("text")).alias("l")).where(F.size("l") >= width)
    at = F.sequence(F.lit(0), F.size("l") - width)
    found = F.transform(
        at,
        lambda i: F.struct(
            F.get(F.col("l"), i)["i"].alias("first"),
            F.get(F.col("l"), i + (width - 1))["i"].alias("last"),
            F.xxhash64(*[F.get(F.col("l"), i + k)["h"] for k in range(width)]).alias("hash"),
        ),
    )
    # The generator keeps the line hashes from being computed again for every window.
    pinned = lines.select("id", "doc", F.explode(F.array(F.col("l"))).alias("l"))
    return pinned.select("id", "doc", F.explode(found).alias("w")).select("id", "doc", "w.*")


def later(found: DataFrame) -> DataFrame:
    """id, doc, and the line ranges that later occurrences of repeated windows cover.

    The first place is the smallest (id, doc, line); rows without an id come after all others.
    """
    place = F.struct(F.col("id").isNull().alias("none"), "id", "doc", "first")
    firsts = (
        found.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("place"))
        .where(F.col("n") > 1)
        .select("hash", "place")
    )
    repeated = found.join(materialize(firsts, "firsts"), "hash")
    again = repeated.where(
        ~(
            F.col("id").eqNullSafe(F.col("place.id"))
            & (F.col("doc") == F.col("place.doc"))
            & (F.col("first") == F.col("place.first"))
        )
    )
    return again.groupBy("id", "doc").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))


def covered(ranges: Column) -> Column:
    """Ranges merged where they touch: one struct of first and last line per run, in order."""
    sorted_ranges = F.array_sort(ranges)
    runs = F.array().cast("array<struct<first:int,last:int>>")
    none = F.lit(None).cast("struct<first:int,last:int>")
    start = F.struct(runs.alias("done"), none.alias("run"))

    def step(state: Column, x: Column) -> Column:
        joins = x["first"] <= state["run"]["last"] + 1
        grown = F.struct(state["run"]["first"].alias("first"), F.greatest(state["run"]["last"], x["last"]).alias("last"))
        closed = F.when(
            state["run"].isNull() | joins, state["done"]
        ).otherwise(F.concat(state["done"], F.array(state["run"])))
        return F.struct(
            closed.alias("done"),
            F.when(state["run"].isNotNull() & joins, grown).otherwise(
                F.struct(x["first"].alias("first"), x["last"].alias("last"))
            ).alias("run"),
        )

    return F.aggregate(sorted_ranges, start, step, lambda s: F.concat(s["done"], F.array(s["run"])))


def without(text: Column, runs: Column) -> Column:
    """The text's lines outside of all runs."""
    lines = F.split(text, "\n")

    def outside(i: Column) -> Column:
        return ~F.exists(runs, lambda r: (r["first"] <= i) & (i <= r["last"]))

    return F.array_join(F.filter(lines, lambda _, i: outside(i)), "\n")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """All columns of ``docs``, the text without later occurrences, and ``removed_lines``.

    ``removed_lines`` lists runs of removed line numbers, from 0; it is empty where nothing goes.
    Lines are compared without regard to how much white space they hold, and lines without a word
    are passed over when windows are formed. A text of fewer than ``width`` such lines stays whole.
    Null texts stay null. Rows equal in id and text share one fate: the first place is that of all
    of them. An empty table gives an empty result. A column named ``removed_lines`` is replaced.
    """
    kept = [c for c in docs.columns if c != "removed_lines"]
    doc = F.xxhash64(F.col(id_col), whole(F.col(text_col)))
    named = docs.select(F.col(id_col).alias("id"), doc.alias("doc"), whole(F.col(text_col)).alias("text"))
    found = materialize(windows(named, width), "windows")
    changes = materialize(later(found).select("id", "doc", covered(F.col("ranges")).alias("runs")), "changes")
    size = changes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()
    rows = docs.select(F.struct(*kept).alias("row"), F.col(id_col).alias("row_id"), doc.alias("row_doc"))
    same = F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_doc") == F.col("doc"))
    joined = rows.join(broadcast_within(changes, max(size)), same, "left")
    none = F.array().cast("array<struct<first:int,last:int>>")
    old = F.col("row")[text_col]
    new = F.when(F.col("runs").isNull(), old).otherwise(without(old, F.col("runs")))
    return joined.select(
        *[(new if c == text_col else F.col("row")[c]).alias(c) for c in kept],
        F.coalesce("runs", none).alias("removed_lines"),
    )
