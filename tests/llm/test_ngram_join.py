import random

import numpy as np
import pytest

from ledgerloom.llm import ngram_join
from ledgerloom.llm.components import components
from ledgerloom.llm.ngram_join import boundary, near_dedup, ngram_groups
from tests.llm.rows import frame, odd, prose


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    sets = [shingle_set(t, width) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    names = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((doc_id, len(sets[i]), names[root(i)]) for i, (doc_id, _) in enumerate(rows)), key=str)


def variants(seed, n, words, changes):
    """Texts of one origin, each with some words changed, dropped or added."""
    draw = random.Random(seed)
    origin = prose(seed, words, 5000).split()
    out = []
    for _ in range(n):
        text = list(origin)
        for _ in range(draw.randrange(changes + 1)):
            at = draw.randrange(len(text))
            text[at : at + draw.randrange(2)] = [f"z{draw.randrange(10**6)}"]
        out.append(" ".join(text))
    return out


def corpus(seed):
    texts = [t for k, (n, w, c) in enumerate([(12, 14, 1), (12, 24, 2), (20, 40, 3), (30, 90, 5), (8, 400, 12), (25, 21, 2)]) for t in variants(seed + k, n, w, c)]
    shared = prose(seed + 99, 60, 5000)
    texts += [shared + " " + prose(seed + 200 + i, 3 + i, 5000) for i in range(25)]
    texts += [prose(seed + 300 + i, 1 + i % 12, 6) for i in range(30)] + ["One two", "one  TWO", "one"]
    random.Random(seed).shuffle(texts)
    return odd(5000) + [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (4, texts[9])]


@pytest.mark.parametrize(("width", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (2, 70, 3), (3, 100, 4)])
def test_groups_equal_brute_force(spark, width, percent, seed):
    rows = corpus(1000 * seed)
    got = ngram_groups(frame(spark, rows).repartition(5), width, percent).collect()
    assert sorted(((r.id, r.n, r.component) for r in got), key=str) == brute(rows, width, percent)


@pytest.mark.parametrize("small", [0, 11, 30])
def test_the_boundary_does_not_matter(spark, monkeypatch, small):
    rows = corpus(7000)
    monkeypatch.setattr(ngram_join, "boundary", lambda spread, percent: small)
    got = ngram_groups(frame(spark, rows), 3, 90).collect()
    assert sorted(((r.id, r.n, r.component) for r in got), key=str) == brute(rows, 3, 90)


def test_boundary_follows_the_cost():
    assert boundary(0, 90) < boundary(100, 90) < boundary(10_000, 90)


def test_one_of_each_group_stays(spark):
    rows = corpus(9000)
    names = {}
    for doc_id, _, name in brute(rows, 5, 80):
        names.setdefault(doc_id, name)
    docs = frame(spark, rows)
    left = near_dedup(docs)
    assert left.columns == docs.columns
    want = {i for i, _, name in brute(rows, 5, 80) if i is not None and i == name}
    gone = {i for i, _, name in brute(rows, 5, 80) if i != name}
    assert {r.doc_id for r in left.collect() if r.doc_id is not None} == want - gone


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 300)] + [(501, 500)]
    random.Random(1).shuffle(links)
    got = {r.vertex: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(300)} | {500: 500, 501: 500}


def test_nothing_to_link(spark):
    assert ngram_groups(frame(spark, [])).count() == 0
    got = ngram_groups(frame(spark, [(1, None), (2, ""), (2, "")])).collect()
    assert sorted((r.id, r.n, r.component) for r in got) == [(1, 0, 1), (2, 0, 2), (2, 0, 2)]
    assert np.array_equal(ngram_join.shingles(b"", 3), np.zeros(0, np.int64))
