"""Operators 11 to 13 against plain versions."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import hard_negatives as hard
from ledgerloom.llm import lexical, queries, vector_topk
from ledgerloom.llm.blocks import best, kth, merged, packed, unpacked
from tests.llm.rows import frame, odd, prose

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        # Names that the operators use themselves.
        *[T.StructField(n, T.StringType()) for n in ("id", "vec", "asked", "block", "slice", "score")],
    ]
)
ITEMS = "item_id long, text string, id string, terms string, weight string"


def vectors(seed, n, dim=16, groups=6):
    """Rows (id, vector, label): some in groups, some equal, some with nulls in every place."""
    draw = np.random.default_rng(seed)
    heart = draw.normal(0, 0.2, (groups, dim))
    rows = []
    for i in range(n):
        v = heart[i % groups] + draw.normal(0, 0.02, dim) if i % 3 else draw.normal(0, 0.2, dim)
        rows.append((i, [float(np.float32(x)) for x in v], int(draw.integers(0, 4))))
    rows[n // 2 :: 7] = [(i, rows[0][1], lab) for i, _, lab in rows[n // 2 :: 7]]  # ties
    rows += [(n, None, 1), (n + 50 - n % 50, None, 2), (n + 100 - n % 50, [], 3), (n + 150 - n % 50, [0.1] * (dim + 1), 1)]
    rows += [(n + 1, [None] + [0.1] * (dim - 1), 0), (n + 2, [math.nan] * dim, 0), (n + 3, [math.inf] + [0.0] * (dim - 1), 1)]
    rows += [(None, rows[5][1], 1), (7, rows[7][1], rows[7][2]), (n + 4, rows[3][1], None), (n + 200 - n % 50, rows[3][1], None)]
    rows += [(n + 5, [-x for x in rows[0][1]], 1), (2**60, rows[1][1], rows[0][2])]
    return rows


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, *"xxxxxx") for r in rows], VECTORS)


def whole(rows, labelled=False):
    out = []
    for i, v, lab in rows:
        fine = i is not None and v and all(x is not None and math.isfinite(x) for x in v)
        if fine and not (labelled and lab is None):
            out.append((i, [math.floor(256 * x) for x in v], lab))
    return out


def product(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def asked_once(rows, key):
    first = {}
    for r in rows:
        if r[0] % 50 == 0 and (r[0] not in first or key(r) < key(first[r[0]])):
            first[r[0]] = r
    return first.values()


def brute_topk(rows, k):
    rows, out = whole(rows), []
    for q, v, _ in asked_once(rows, lambda r: r[1]):
        scored = sorted((-product(v, c), i) for i, c, _ in rows if i != q and len(c) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.fixture(params=[(64, 1), (4096, 8)], ids=["small blocks", "one block"])
def sizes(request, monkeypatch):
    block, per_slice = request.param
    for module, name in ((vector_topk, "BLOCK"), (hard, "TILE")):
        monkeypatch.setattr(module, name, block)
        monkeypatch.setattr(module, "SLICE", per_slice)
        monkeypatch.setattr(module, "BAND", 4 if block == 64 else 1000)


@pytest.mark.parametrize(("seed", "k", "dim"), [(1, 5, 16), (2, 1, 21), (3, 40, 5)])
def test_nearest_vectors_equal_brute_force(spark, sizes, seed, k, dim):
    rows = vectors(seed, 700, dim)
    got = vector_topk.vector_topk(vector_frame(spark, rows).repartition(3), F.col("vec_id") % 50 == 0, k=k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, k)


def test_bounds_leave_few_vectors_of_distinct_lengths(monkeypatch):
    """Compaction to pairs happens, and no vector of the k best is lost by it."""
    draw = np.random.default_rng(5)
    columns = np.floor(draw.normal(0, 40, (32, 3000)) * np.linspace(2, 0.1, 32)[:, None])
    q = columns[:, :8].T.copy()
    own, ids = np.arange(8), np.arange(3000)
    at, score, ident = vector_topk.search_block(q, own, columns, ids, np.full(8, -np.inf), 3)
    got = merged(at, score, ident, 3)
    want = []
    for i in range(8):
        s = q[i] @ columns
        s[i] = -np.inf
        want += [(i, s[j], j) for j in sorted(range(3000), key=lambda j, s=s: (-s[j], j))[:3]]
    assert list(zip(*got, strict=True)) == want
    assert len(at) < 8 * 300


def brute_negatives(rows, positives=5, negatives=3, least=50, most=95):
    rows, out = whole(rows, labelled=True), []
    for a, v, lab in asked_once(rows, lambda r: (r[2], r[1])):
        scored = sorted((-product(v, c), i, lb) for i, c, lb in rows if i != a and len(c) == len(v))
        for s, p in [(-s, i) for s, i, lb in scored if lb == lab][:positives]:
            fits = [(-t, i) for t, i, lb in scored if lb != lab and least * s <= -100 * t <= most * s]
            out += [(a, p, n + 1, i, s, t) for n, (t, i) in enumerate(fits[:negatives])]
    return sorted(out)


@pytest.mark.parametrize(("seed", "few"), [(1, (5, 3)), (2, (1, 1)), (3, (9, 30))])
def test_hard_negatives_equal_brute_force(spark, sizes, seed, few):
    rows = vectors(seed, 900)
    got = hard.hard_negatives(vector_frame(spark, rows).repartition(3), F.col("vec_id") % 50 == 0, positives=few[0], negatives=few[1])
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows, *few)
    assert want and sorted(map(tuple, got.collect())) == want


def test_boxes_hold_their_vectors_and_prune():
    draw = np.random.default_rng(3)
    matrix = np.floor(draw.normal(0, 30, (1500, 3)))
    order = hard.tiled(matrix, [0, 1, 2])
    assert sorted(order) == list(range(1500))
    tile = matrix[order]
    boxes, size = hard.boxes_of(tile), hard.levels(1500)
    assert size == [24, 3, 1] and boxes.shape == (2, 28, 3)
    for i in range(24):
        page = tile[i * hard.PAGE : (i + 1) * hard.PAGE]
        assert (boxes[0, i] <= page).all() and (page <= boxes[1, i]).all()
    q = tile[:20]
    windows = hard._Windows(np.full((20, 1), -np.inf), np.full((20, 1), np.inf), 3)
    reads = hard.search_tile(np.arange(20), q, np.full(20, -1), tile, np.arange(1500), boxes, windows)
    assert reads < 20 * 24 / 2
    for i in range(20):
        s = q[i] @ tile.T
        mine = windows.rows[0] == i
        assert windows.rows[2][mine].tolist() == sorted(range(1500), key=lambda j, s=s: (-s[j], j))[:3]


def test_no_vectors(spark):
    empty = vector_frame(spark, [])
    assert vector_topk.vector_topk(empty, F.col("vec_id") % 50 == 0).count() == 0
    assert hard.hard_negatives(empty, F.col("vec_id") % 50 == 0).count() == 0
    one = vector_frame(spark, [(0, [0.5, 0.5], 1)])
    assert vector_topk.vector_topk(one, F.col("vec_id") % 50 == 0).count() == 0
    assert hard.hard_negatives(one, F.col("vec_id") % 50 == 0).count() == 0


def test_best_in_rounds(spark):
    rows = [(s, s % 3, (s * 37) % 101) for s in range(500)]
    df = spark.createDataFrame(rows, "slice long, key long, score long")
    got = best(df, ["key"], [F.col("score").desc()], 4, 500).collect()
    want = sorted((k, r + 1, v) for k in range(3) for r, v in enumerate(sorted((v for _, kk, v in rows if kk == k), reverse=True)[:4]))
    assert sorted((r.key, r["rank"], r.score) for r in got) == want
    assert kth(np.array([0, 0, 1]), np.array([3.0, 2.0, 9.0]), 3, 2).tolist() == [2, -np.inf, -np.inf]
    for top in (5, 40_000, 2**40):
        kind, data = packed(np.array([[-top, top]]))
        assert unpacked(kind, data, 1, 2).tolist() == [[-top, top]]


def plain_terms(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", small)


def brute_lexical(docs, items, k):
    counted = [(i, plain_terms(t)) for i, t in docs]
    n_docs, total = sum(1 for _, t in counted if t), sum(len(t) for _, t in counted)
    asked, df = {}, {}
    for i, text in items:
        if i is not None:
            asked.setdefault(i, set()).update(plain_terms(text))
    for _, found in counted:
        for t in set(found):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, found in counted:
            score = 0
            for t in wanted & set(found):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                tf, m = found.count(t), 50 + (50 * len(found) * n_docs) // total
                score += w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if i is not None and score > 0:
                scored.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize(("seed", "k", "shard", "leaf"), [(1, 50, 4096, 64), (2, 3, 40, 1), (3, 7, 150, 8)])
def test_ranking_equals_brute_force(spark, monkeypatch, seed, k, shard, leaf):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard)
    monkeypatch.setattr(lexical, "LEAF", leaf)
    if shard < 4096:
        monkeypatch.setattr(lexical, "SLICE", 3000)
        monkeypatch.setattr(lexical, "BAND", 30)
        monkeypatch.setattr(lexical, "OPENED", 3)
    draw = random.Random(seed)
    docs = odd(5000) + [(i, prose(seed * 1000 + i, draw.randrange(1, 60), 40 + 300 * (i % 2))) for i in range(400)]
    docs += [(3, docs[9][1]), (900, "Straße ÄÖ-naïve,x_y\x7fz\x85w v W1-w2"), (901, "straße x y"), (2**60, docs[20][1])]
    items = [(i, prose(seed * 77 + i, 4 + 3 * i, 340)) for i in range(12)]
    items += [(20, "STRASSE Straße z\x85w naïve"), (21, None), (22, ""), (None, "w1 w2"), (1, "w5 W7"), (23, "nowhere"), (24, docs[4][1])]
    frame_of_items = spark.createDataFrame([(*r, "x", "x", "x") for r in items], ITEMS)
    got = lexical.lexical_topk(frame(spark, docs).repartition(3), frame_of_items, k=k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_lexical(docs, items, k)


def test_nothing_to_rank(spark):
    items = spark.createDataFrame([(1, "w1", "x", "x", "x")], ITEMS)
    assert lexical.lexical_topk(frame(spark, []), items).count() == 0
    assert lexical.lexical_topk(frame(spark, [(1, None), (2, " . ")]), items).count() == 0
    assert lexical.lexical_topk(frame(spark, [(1, "w1")]), items.where("false")).count() == 0
    assert [tuple(r) for r in lexical.lexical_topk(frame(spark, [(1, "w1 w2"), (2, "w2")]), items).collect()][0][:3] == (1, 1, 1)


def test_registered_searches(spark, tmp_path):
    docs = [(i, prose(i, 30, 60)) for i in range(90)]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(i, prose(500 + i, 5, 60)) for i in range(9)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = vectors(9, 400)
    vector_frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {n: sorted(map(tuple, queries.QUERIES[n](spark, str(tmp_path)).collect())) for n in ("op11_lexical", "op12_vector_topk", "op13_hard_negatives")}
    assert got["op11_lexical"] == brute_lexical(docs, items, 50)
    assert got["op12_vector_topk"] == brute_topk(rows, 5)
    moved = [(i, v, lab if i is None or lab is None or i % 7 else (lab + 1) % 10) for i, v, lab in rows]
    assert got["op13_hard_negatives"] == brute_negatives(moved)
