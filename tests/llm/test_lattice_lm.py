import collections
import math

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.lattice_lm import lattice_scores, word_score
from tests.llm.rows import frame, odd, prose

public_tokenizers = pytest.importorskip("public_tokenizers")


def every_way(text, weights):
    """Probability by listing all segmentations."""
    if not text:
        return 1.0
    return sum(math.exp(weights[text[:i]]) * every_way(text[i:], weights) for i in range(1, len(text) + 1) if text[:i] in weights)


def test_word_score_sums_over_all_segmentations():
    weights = {p: math.log(w) for p, w in {"▁": 0.1, "▁a": 0.2, "a": 0.05, "b": 0.07, "ab": 0.1, "▁ab": 0.03, "ba": 0.01}.items()}
    for word in ("ab", "aba", "babab", "aabba"):
        assert word_score(word.encode(), weights, 3) == pytest.approx(math.log(every_way("▁" + word, weights)))


def test_unknown_characters_are_spelled_in_bytes():
    weights = {f"<0x{b:02X}>": math.log(0.001) for b in range(256)} | {"▁": math.log(0.1), "": 0.0}
    assert word_score("é".encode(), weights, 6) == pytest.approx(math.log(0.1) + 2 * math.log(0.001))


@pytest.mark.parametrize("head", [0, 3, 50_000])
def test_base_scores_equal_brute_force(spark, head):
    rows = odd() + [(20, "The the THE cat"), (21, "cat dog"), (22, "unseen words only"), (20, "The the THE cat"), (23, prose(1, 200))]
    train = F.col("doc_id") != 22
    got = lattice_scores(frame(spark, rows), train, public_tokenizers.path("piece_bpe_32k.model"), head=head).collect()
    words = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    counts = collections.Counter(w for (i, _), ws in zip(rows, words, strict=True) if i != 22 for w in ws)
    total = sum(counts.values())
    want = [
        (i, i == 22, len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in ws))
        for (i, _), ws in zip(rows, words, strict=True)
    ]
    have = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got]
    for a, b in zip(sorted(have, key=str), sorted(want, key=str), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_scores_do_not_depend_on_how_words_travel(spark):
    rows = [(i, prose(i, 40, 60)) for i in range(30)]
    path = public_tokenizers.path("piece_bpe_32k.model")
    a, b = ({r.doc_id: r.score for r in lattice_scores(frame(spark, rows), F.col("doc_id") % 7 != 2, path, head=h).collect()} for h in (0, 1000))
    assert a == pytest.approx(b)


def test_empty_table(spark):
    assert lattice_scores(frame(spark, []), F.lit(True), public_tokenizers.path("piece_bpe_32k.model")).count() == 0
