from pyspark.sql import functions as F

from ledgerloom.llm import mixing
from ledgerloom.llm.mixing import budgets, mix, word_count
from tests.llm.rows import frame, odd, prose


def path():
    return {"lang": F.col("lang"), "source": F.col("source")}


def divided(spark, leaves, weights, budget, epochs=1):
    rows = spark.createDataFrame([(*k, 10, n) for k, n in leaves.items()], "d string, l string, s string, rows long, tokens long")
    return {(r.d, r.l, r.s): r.target for r in budgets(rows, ["d", "l", "s"], weights, budget, epochs).collect()}


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = {("a", "x", "1"): 100, ("a", "x", "2"): 1000, ("a", "y", "1"): 1000, ("b", "x", "1"): 5000}
    got = divided(spark, leaves, {("a",): 1, ("b",): 1, ("a", "x"): 1, ("a", "y"): 1}, 1600)
    # 800 for a, 400 for a/x: its source 1 has 100, the rest goes to its sibling 2 and not to a/y or b.
    assert got == {("a", "x", "1"): 100, ("a", "x", "2"): 300, ("a", "y", "1"): 400, ("b", "x", "1"): 800}
    got = divided(spark, leaves, {("a", "x"): 1, ("a", "y"): 1}, 6000)
    # a has 2100 in all: what it cannot take goes to b.
    assert got == {("a", "x", "1"): 100, ("a", "x", "2"): 1000, ("a", "y", "1"): 1000, ("b", "x", "1"): 3900}
    assert divided(spark, leaves, {}, 10**6) == leaves
    assert divided(spark, leaves, {("a",): 0}, 10**6) == {k: n if k[0] == "b" else 0 for k, n in leaves.items()}


def test_prefixes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 7)
    rows = [(i, prose(i, 3 + i * 7 % 50), ("en", "de", None)[i % 3], f"s{i % 2}") for i in range(300)]
    docs = frame(spark, rows)
    weights = {("en",): 0.2, ("de",): 0.7}
    out = mix(docs, path(), weights, word_count(F.col("text")), budget_share=0.9, max_epochs=3, seed=5)
    assert out.columns == [c for c in docs.columns if c != "epoch"] + ["epoch"]
    got = {}
    for r in out.collect():
        got.setdefault((r.lang, r.source), []).append((r.epoch, r.doc_id))
    size = {i: len(t.split()) for i, t, *_ in rows}
    total = sum(size.values())
    import hashlib

    for (lang, source), given in got.items():
        members = [i for i, _, a, b in rows if (a, b) == (lang, source)]
        order = [
            (e, i) for e in range(3) for i in sorted(members, key=lambda i, e=e: hashlib.md5(f"5:{e}:{i}".encode()).hexdigest())
        ]
        assert sorted(given) == sorted(order[: len(given)])
        tokens = sum(size[i] for _, i in given)
        assert tokens - size[order[len(given) - 1][1]] < sum(size[i] for i in members) * 3
    given = sum(size[i] for x in got.values() for _, i in x)
    assert abs(given - 0.9 * total) <= 60 * 6


def test_odd_rows(spark):
    docs = frame(spark, odd() + odd())
    got = mix(docs, path(), {}, word_count(F.col("text")), budget_share=1.0, max_epochs=1).collect()
    assert {r.doc_id for r in got} >= {4, 5, None}
    assert all(r.epoch == 0 and r.cid == "x" for r in got)
    empty = frame(spark, [])
    assert mix(empty, path(), {}, word_count(F.col("text"))).count() == 0


def test_a_leaf_without_tokens_is_given_once(spark):
    rows = [(1, ""), (2, None, "xx", "s9"), (3, " \n", "xx", "s9"), (4, "a b c", "xx", "s8"), (5, "a b", "de", "s1")]
    got = mix(frame(spark, rows), path(), {}, word_count(F.col("text")), budget_share=1.0, max_epochs=2).collect()
    assert {(r.doc_id, r.epoch) for r in got} >= {(1, 0), (2, 0), (3, 0)}
    assert all(r.epoch == 0 for r in got if r.doc_id < 4)


def test_unnamed_nodes_weigh_what_others_says(spark):
    leaves = {("a", "x", "1"): 1000, ("a", "y", "1"): 1000}
    rows = spark.createDataFrame([(*k, 10, n) for k, n in leaves.items()], "d string, l string, s string, rows long, tokens long")
    got = budgets(rows, ["d", "l", "s"], {("a", "x"): 0.75}, 400, 1, {2: 0.25}).collect()
    assert {r.l: r.target for r in got} == {"x": 300, "y": 100}
