"""Labels, returns and the walk-forward split against plain versions."""

import random

import pytest

from ledgerloom.operators.labels import barrier_labels, decisions, forward_returns, walk_forward

S = 1_000_000
PRICES = "key string, time long, seq long, price double"


def _prices(seed, n, span_s, hot=0.4):
    draw = random.Random(seed)
    rows, level = [], {}
    for i in range(n):
        key = "hot" if draw.random() < hot else f"k{draw.randrange(6)}"
        level[key] = max(0.01, level.get(key, 10.0) * draw.choice([0.8, 0.9, 1.0, 1.1, 1.25]))
        rows.append((key, draw.randrange(span_s) * S, i, level[key]))
    return rows + [("hot", 5 * S, n + 1, 3.0), ("hot", 5 * S, n, 7.0), (None, 5, n + 2, 1.0), ("k1", None, n + 3, 9.9), ("k1", 7, n + 4, None)]


def _usable(prices, key):
    return sorted((t, s, p) for k, t, s, p in prices if k == key and t is not None and p is not None)


def _asof(rows, at):
    before = [p for t, _, p in rows if t <= at]
    return before[-1] if before else None


def _label(rows, at, up, down, within, known):
    entry = _asof(rows, at)
    if entry is None:
        return None, None, None
    for t, _, p in rows:
        if at < t <= at + within * S:
            if p >= entry * (1 + up):
                return entry, "up", t
            if p <= entry * (1 - down):
                return entry, "down", t
    return entry, "none" if known is None or at + within * S <= known else None, None


@pytest.mark.parametrize(("within", "bucket", "known"), [(1800, 60, None), (1800, 60, 3000 * S), (50, 60, None), (600, 7, None), (3000, 100_000, None)])
def test_first_touch_equals_a_plain_search(spark, within, bucket, known):
    prices = _prices(within + bucket, 500, 4000)
    draw = random.Random(5)
    points = [(draw.choice(["hot", "k1", "k2", "none"]), draw.randrange(-10, 4000) * S) for _ in range(60)]
    points += points[:5] + [(None, 5), ("hot", None), ("hot", 60 * S), ("hot", 5 * S)]
    got = barrier_labels(
        spark.createDataFrame(points, "key string, at long"), spark.createDataFrame(prices, PRICES), "key", "at", 1.0, 0.4, within, bucket, known
    )
    want = {
        (k, t): _label(_usable(prices, k), t, 1.0, 0.4, within, known) for k, t in points if k is not None and t is not None
    }
    rows = got.collect()
    assert {(r.key, r.at): (r.entry, r.label, r.touched_us) for r in rows} == want and len(rows) == len(want)
    assert {"up", "down"} <= {v[1] for v in want.values()}


def test_no_window_holds_a_whole_token(spark):
    prices = spark.createDataFrame(_prices(1, 50, 4000), PRICES)
    rows = barrier_labels(spark.createDataFrame([("hot", 5)], "key string, at long"), prices, "key", "at", 1.0, 0.4, 60)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Windows see a block of the as-of join, or one row for each block.
    assert windows and all("_b#" in line.split("windowspecdefinition")[1] for line in windows)
    assert "CartesianProduct" not in plan and "Join Cross" not in plan


def test_forward_returns(spark):
    prices = _prices(3, 300, 4000)
    origins = spark.createDataFrame([("hot", 0), ("k1", 100 * S), ("none", 5)], "key string, origin long")
    points = decisions(origins, "origin", [5, 60, 300])
    assert sorted(r.decision_us for r in points.filter("key = 'k1'").collect()) == [105 * S, 160 * S, 400 * S]
    got = forward_returns(points, spark.createDataFrame(prices, PRICES), "key", "decision_us", [30, 900], 1100 * S).collect()
    assert len(got) == 18
    for r in got:
        rows, then = _usable(prices, r.key), r.decision_us + r.horizon_s * S
        start, end = _asof(rows, r.decision_us), _asof(rows, then)
        want = None if start is None or end is None or then > 1100 * S else end / start - 1
        assert r.forward_return == want


@pytest.mark.parametrize("expanding", [False, True])
def test_walk_forward_never_looks_ahead(spark, expanding):
    draw = random.Random(8)
    times = [draw.randrange(-5, 200) * S for _ in range(300)] + [0, 40 * S, 60 * S, None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, at long")
    got = walk_forward(rows, "at", 0, 5, 40, 20, 7, 3, expanding)
    want = set()
    for i, t in enumerate(times):
        for k in range(5):
            s = (40 + 20 * k) * S
            if t is not None and t >= 0:
                if s <= t < s + 20 * S:
                    want.add((i, k, "test"))
                if t + 7 * S <= s - 3 * S and (expanding or t >= s - 43 * S):
                    want.add((i, k, "train"))
    assert {(r.id, r.fold, r.part) for r in got.collect()} == want and got.count() == len(want)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="positive"):
        walk_forward(rows, "at", 0, 0, 1, 1)
