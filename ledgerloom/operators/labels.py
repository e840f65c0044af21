"""Fixed-horizon features, barrier labels and the walk-forward split.

Times are long microseconds. Prices are rows (key, time, seq, price): ``seq`` orders prices of one
time, a price counts from its own time on. Nothing here sorts or collects a whole key: a key with a
third of all prices is spread over its time buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.pit import asof_join

SECOND = 1_000_000


def decisions(origins: DataFrame, at: str, horizons: Sequence[int], name: str = "decision_us") -> DataFrame:
    """One row per origin and horizon (seconds after it)."""
    each = origins.withColumn("horizon_s", F.explode(F.array(*[F.lit(int(h)) for h in horizons])))
    return each.withColumn(name, F.col(at) + F.col("horizon_s").cast("long") * SECOND)


def with_price(
    rows: DataFrame, prices: DataFrame, key: str, at: str, name: str, block_s: int = 3600
) -> DataFrame:
    """Add ``name``: the latest price at or before ``at``, null when there is none yet."""
    right = prices.filter("time IS NOT NULL").select(
        F.col("key").alias(key), F.col("time").alias("_us"), F.col("seq").alias("_seq"), F.col("price").alias(name)
    )
    left = rows.withColumns({"_us": F.col(at), "_seq": F.lit(None).cast("long")})
    joined = asof_join(left.filter(F.col(at).isNotNull()), right, key, ("_us", "_seq"), name, block_s * SECOND)
    return joined.drop("_us", "_seq")


def forward_returns(
    rows: DataFrame, prices: DataFrame, key: str, at: str, horizons: Sequence[int], known_until: int | None = None
) -> DataFrame:
    """Return from ``at`` to each horizon (seconds): (key, at, horizon_s, forward_return).

    One row per distinct (key, at) and horizon. The return is null without a price at ``at`` or where
    prices are known only up to an earlier time than the horizon's (``known_until``).
    """
    points = rows.select(key, at).filter(F.col(key).isNotNull() & F.col(at).isNotNull()).distinct()
    steps = decisions(points, at, [0, *horizons], "_then")
    priced = with_price(steps, prices, key, "_then", "_price")
    known = F.lit(True) if known_until is None else F.col("_then") <= known_until
    by_step = priced.groupBy(key, at).agg(
        F.collect_list(F.struct("horizon_s", "_price", known.alias("known"))).alias("steps")
    )
    start = F.filter("steps", lambda s: s["horizon_s"] == 0)[0]["_price"]
    later = F.filter("steps", lambda s: s["horizon_s"] > 0)
    change = F.when(F.col("s.known"), F.col("s._price") / F.col("start") - 1)
    return by_step.select(key, at, start.alias("start"), F.explode(later).alias("s")).select(
        key, at, F.col("s.horizon_s").alias("horizon_s"), change.alias("forward_return")
    )


def barrier_labels(
    rows: DataFrame,
    prices: DataFrame,
    key: str,
    at: str,
    up: float,
    down: float,
    within_s: int,
    bucket_s: int = 60,
    known_until: int | None = None,
) -> DataFrame:
    """Which barrier the price touches first after ``at``: (key, at, entry, label, touched_us).

    One row per distinct (key, at). The entry is the price at ``at``; the barriers are entry * (1 + up)
    and entry * (1 - down); prices after ``at`` and up to ``within_s`` seconds later count. The label is
    up, down or none; null without an entry, or when nothing was touched and prices are known only up
    to an earlier time than the window's end (``known_until``).

    The search is two-level. Each bucket of time knows its least and greatest price; of the buckets
    that lie in a window whole, the first whose extremes pass a barrier holds the touch, unless the
    part of a bucket at the window's start does. Only these two buckets, or the part at the end, are
    joined price by price.
    """
    width = bucket_s * SECOND
    points = rows.select(F.col(key).alias("key"), F.col(at).alias("at"))
    points = points.filter(F.col("key").isNotNull() & F.col("at").isNotNull()).distinct()
    entered = with_price(points, prices, "key", "at", "entry").withColumns(
        {
            "until": F.col("at") + within_s * SECOND,
            "high": F.col("entry") * F.lit(1 + up),
            "low": F.col("entry") * F.lit(1 - down),
        }
    )
    bucket = F.floor(F.col("time") / F.lit(width)).alias("bucket")
    usable = prices.filter("key IS NOT NULL AND time IS NOT NULL AND price IS NOT NULL")
    extremes = usable.groupBy("key", bucket).agg(F.min("price").alias("least"), F.max("price").alias("most"))

    first, last = (F.floor(F.col(c) / F.lit(width)) for c in ("at", "until"))
    spans = entered.filter("entry IS NOT NULL").withColumns({"first": first, "last": last})
    spans = spans.withColumn("bucket", F.explode(F.sequence("first", "last")))
    passed = spans.join(extremes, ["key", "bucket"]).filter("most >= high OR least <= low")
    inner = (F.col("bucket") > F.col("first")) & (F.col("bucket") < F.col("last"))
    found = passed.groupBy("key", "at", "until", "high", "low").agg(
        F.max(F.when(F.col("bucket") == F.col("first"), F.col("bucket"))).alias("start"),
        F.min(F.when(inner, F.col("bucket"))).alias("whole"),
        F.max(F.when(F.col("bucket") == F.col("last"), F.col("bucket"))).alias("end"),
    )
    look = F.array_distinct(F.array_compact(F.array("start", F.coalesce("whole", "end"))))
    searched = found.withColumn("bucket", F.explode(look)).join(usable.withColumn("bucket", bucket), ["key", "bucket"])
    touching = searched.filter(
        (F.col("time") > F.col("at"))
        & (F.col("time") <= F.col("until"))
        & ((F.col("price") >= F.col("high")) | (F.col("price") <= F.col("low")))
    )
    side = F.when(F.col("price") >= F.col("high"), "up").otherwise("down")
    touch = touching.groupBy("key", "at").agg(
        F.min_by(F.struct(F.col("time").alias("touched_us"), side.alias("side")), F.struct("time", "seq")).alias("t")
    )
    nothing = F.lit("none") if known_until is None else F.when(F.col("until") <= known_until, "none")
    label = F.when(F.col("entry").isNotNull(), F.coalesce("t.side", nothing))
    return entered.join(touch, ["key", "at"], "left").select(
        F.col("key").alias(key), F.col("at").alias(at), "entry", label.alias("label"), F.col("t.touched_us").alias("touched_us")
    )


def walk_forward(
    rows: DataFrame,
    at: str,
    start_us: int,
    folds: int,
    train_s: int,
    test_s: int,
    label_s: int = 0,
    embargo_s: int = 0,
    expanding: bool = False,
) -> DataFrame:
    """Rows with their ``fold`` and ``part`` (train or test) in a temporal walk-forward split.

    Fold k (from 0) tests [s, s + test_s) with s = start + train_s + k * test_s. It trains on rows from
    s - embargo_s - train_s on (from the start when ``expanding``) whose label, which looks
    ``label_s`` seconds ahead, ended by s - embargo_s: nothing a train row knows reaches into the test.
    Rows before the start, without a time or in no fold are left out. A row is repeated for each fold
    it trains; which folds those are is arithmetic on its time, so nothing is shuffled.
    """
    if not (folds > 0 and train_s > 0 and test_s > 0 and label_s >= 0 and embargo_s >= 0):
        raise ValueError("folds, train_s and test_s must be positive, label_s and embargo_s not negative")
    t = F.col(at) - F.lit(start_us)
    step, train, gap = test_s * SECOND, train_s * SECOND, embargo_s * SECOND

    def floor_div(x: Column) -> Column:
        return ((x - F.pmod(x, F.lit(step))) / F.lit(step)).cast("long")

    tested = floor_div(t - train)
    # s >= t + label + embargo, and s <= t + train + embargo when the window rolls.
    low = F.greatest(-floor_div(-(t + (label_s * SECOND + gap - train))), F.lit(0).cast("long"))
    most = F.lit(folds - 1).cast("long")
    high = most if expanding else F.least(floor_div(t + gap), most)
    trains = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<long>"))
    parts = F.transform(trains, lambda k: F.struct(k.cast("int").alias("fold"), F.lit("train").alias("part")))
    test = F.when(
        (t >= train) & (tested < folds), F.array(F.struct(tested.cast("int").alias("fold"), F.lit("test").alias("part")))
    ).otherwise(F.array().cast("array<struct<fold:int,part:string>>"))
    return (
        rows.filter(F.col(at) >= start_us)
        .withColumn("_folds", F.explode(F.concat(parts, test)))
        .select(*rows.columns, "_folds.fold", "_folds.part")
    )
