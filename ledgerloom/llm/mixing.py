"""Mixing of sources to target weights by budgets that flow down a tree.

Rows belong to leaves, named by a path such as (domain, language, source). The token budget is
divided at the root by the weights of its children, then at each child, down to the leaves. No node
gets more than its leaves can give in the permitted epochs: what a node cannot take goes to its
siblings by their weights, and only what all of them cannot take goes back to their parent's
siblings. A leaf with budget for several epochs gives whole ones, and of the last one a prefix in an
order drawn from seed and epoch.

Sums per leaf and, within a leaf, per slice of the drawn order keep a leaf with a third of all rows
from meeting in one task: only the slice in which the budget ends is ordered. What comes back to the
rows is one cutoff per leaf.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import broadcast_within, materialize, whole, words

SLICE_ROWS = 10_000  # rows that a slice of a leaf's order is meant to hold


def word_count(text: Column) -> Column:
    return F.size(words(whole(text))).cast("long")


def draw(seed: int, epoch: Column, row_id: Column) -> Column:
    """The place of a row in an epoch's order: 32 hexadecimal digits."""
    parts = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(row_id.cast("string"), F.lit("none")))
    return F.md5(parts.cast("binary"))


def _divide(nodes: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Give each node its ``share`` of its parent's ``budget`` by weight, none above its capacity.

    With siblings ordered by capacity per weight, the level at which the rest is divided rises over
    those that are filled and falls after them, so that its maximum is the one that holds. A parent's
    children meet in one task, one row of a few numbers each.
    """
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ordered = group.orderBy(F.col("capacity") / F.col("weight"), "name")
    before = F.coalesce(F.sum("capacity").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(ordered.rowsBetween(0, Window.unboundedFollowing))
    level = F.max("level").over(group)
    return (
        nodes.where("weight > 0")
        .withColumn("level", (F.col("budget") - before) / left)
        .withColumn("share", F.least(F.col("capacity"), level * F.col("weight")))
        .drop("level", "budget", "weight")
    )


def budgets(
    leaves: DataFrame,
    path: Sequence[str],
    weights: Mapping[tuple, float],
    budget: float,
    max_epochs: int,
    others: Mapping[int, float] | None = None,
) -> DataFrame:
    """The leaves (path, tokens) with their ``share`` of ``budget`` tokens.

    ``weights`` maps paths, and beginnings of paths, to weights among siblings; what is not named
    weighs what ``others`` says for its depth (from 1), else 1. Names are compared as text; a null
    name is a name of its own.
    """
    spark = leaves.sparkSession
    given = spark.createDataFrame(
        [("\x1f".join(map(str, k)), float(w)) for k, w in weights.items()], "name string, given double"
    )
    named = leaves.withColumn("capacity", F.col("tokens").cast("double") * max_epochs)

    def name(depth: int) -> Column:
        return F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in path[:depth]])

    shares = None
    for depth in range(1, len(path) + 1):
        nodes = named.groupBy(name(depth).alias("name"), name(depth - 1).alias("parent") if depth > 1 else F.lit("").alias("parent"))
        nodes = nodes.agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.join(given, "name", "left").withColumn("weight", F.coalesce("given", F.lit(float((others or {}).get(depth, 1.0))))).drop("given")
        if shares is None:
            nodes = nodes.withColumn("budget", F.lit(float(budget)))
        else:
            nodes = nodes.join(shares.select(F.col("name").alias("parent"), F.col("share").alias("budget")), "parent")
        shares = _divide(nodes, ["parent"])
    return named.withColumn("name", name(len(path))).join(shares.select("name", "share"), "name", "left").select(
        *path, "name", "rows", "tokens", F.floor(F.coalesce("share", F.lit(0.0)) + 1e-6).cast("long").alias("target")
    )


def cutoffs(rows: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """Per leaf the number of whole epochs and the last draw that the epoch after them gives.

    Rows are given in the order of their draws until the tokens given reach the budget; the row
    that reaches it is the last. Rows with equal ids are drawn together.
    """
    empty = F.col("tokens") <= 0
    # A leaf without any token costs nothing: each of its rows is given once.
    whole_epochs = F.when(empty, 1).otherwise(F.floor(F.col("target") / F.col("tokens"))).cast("int")
    plan = leaves.withColumn("epochs", whole_epochs).withColumn(
        "rest", F.when(empty, 0).otherwise(F.col("target") - F.col("epochs") * F.col("tokens"))
    )
    plan = plan.withColumn("slices", F.ceil(F.col("rows") / SLICE_ROWS))
    plan = materialize(plan.select("name", "epochs", "rest", "slices"), "plan")
    few = plan.count()
    drawn = rows.join(broadcast_within(plan.where("rest > 0"), few), "name")
    drawn = drawn.withColumn("draw", draw(seed, F.col("epochs"), F.col("id")))
    part = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") * F.col("slices") / F.lit(1 << 32)
    drawn = drawn.withColumn("slice", F.floor(part).cast("long"))
    sums = drawn.groupBy("name", "slice").agg(F.sum("tokens").alias("sum"), F.first("rest").alias("rest"))
    before = Window.partitionBy("name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0)))
    ends = materialize(
        placed.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("sum") >= F.col("rest"))).select(
            "name", "slice", "before"
        ),
        "ends",
    )
    last = drawn.join(broadcast_within(ends, few), ["name", "slice"])
    last = last.groupBy("name", "slice", "draw").agg(
        F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"), F.first("before").alias("before")
    )
    run = Window.partitionBy("name", "slice").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1)
    given = last.withColumn("so_far", F.col("before") + F.coalesce(F.sum("tokens").over(run), F.lit(0)))
    cut = given.where(F.col("so_far") < F.col("rest")).groupBy("name").agg(F.max("draw").alias("cutoff"))
    return materialize(plan.join(cut, "name", "left").select("name", "epochs", "cutoff"), "cutoffs")


def mix(
    docs: DataFrame,
    path: Mapping[str, Column],
    weights: Mapping[tuple, float],
    tokens: Column,
    budget_share: float = 1.0,
    max_epochs: int = 1,
    seed: int = 0,
    id_col: str = "doc_id",
    others: Mapping[int, float] | None = None,
) -> DataFrame:
    """All columns of ``docs`` and ``epoch``, one row for each time that a row is given.

    ``path`` names the levels of the tree and how a row gets its name there, null being a name;
    ``budget_share`` is the budget as a share of all tokens. Rows without tokens are given as their
    draws come up, and once each in a leaf that has no token at all. Rows of equal id are drawn together; an empty table gives an empty result. A
    column named ``epoch`` is replaced.
    """
    kept = [c for c in docs.columns if c != "epoch"]
    levels = list(path)
    name = F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in path.values()])
    rows = materialize(
        docs.select(F.col(id_col).alias("id"), name.alias("name"), tokens.alias("tokens"), *[c.cast("string").alias(f"l{i}") for i, c in enumerate(path.values())]),
        "rows",
    )
    renamed = [f"l{i}" for i in range(len(levels))]
    leaves = materialize(
        rows.groupBy(*renamed).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")), "leaves"
    )
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shares = budgets(leaves, renamed, weights, total * budget_share, max_epochs, others)
    cut = cutoffs(rows.select("id", "name", "tokens"), materialize(shares, "budgets"), seed)
    paired = docs.select(F.struct(*kept).alias("row"), name.alias("name"))
    paired = paired.join(broadcast_within(cut, cut.count()), "name")
    given = F.sequence(F.lit(0), F.col("epochs"))
    tries = paired.select("row", "epochs", "cutoff", F.explode(given).alias("epoch"))
    whole_epoch = F.col("epoch") < F.col("epochs")
    in_part = draw(seed, F.col("epoch"), F.col("row")[id_col]) <= F.col("cutoff")
    return tries.where(whole_epoch | F.coalesce(in_part, F.lit(False))).select("row.*", "epoch")
