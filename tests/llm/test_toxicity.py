import random

from pyspark.sql import functions as F

from ledgerloom.llm.toxicity import Distances, Model, fit, toxicity
from tests.llm.rows import frame, odd

INSULTS = ["blockhead", "nitwitted", "dimbulbish", "foulmouthed", "wretchbag"]
SYLLABLES = ["ba", "re", "to", "mi", "ka", "lu", "ne", "so", "vi", "da"]


def text(seed, toxic):
    draw = random.Random(seed)
    words = ["".join(draw.choice(SYLLABLES) for _ in range(draw.randrange(1, 4))) for _ in range(draw.randrange(30, 120))]
    return " ".join(draw.choice(INSULTS) if toxic and draw.random() < 0.12 else w for w in words)


def corpus(n=400):
    return [(i, text(i, i % 4 == 0)) for i in range(n)], [(i, int(i % 4 == 0)) for i in range(n)]


def test_held_out_accuracy(spark):
    rows, marks = corpus()
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = fit(docs, labels, F.col("doc_id") % 3 != 2)
    got = {r.doc_id: r for r in toxicity(docs, model).collect()}
    held = [(got[i], t) for i, t in marks if i % 3 == 2]
    assert sum(r.predicted == t for r, t in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_only_labels_that_may_be_learned_from_count(spark):
    rows, marks = corpus(120)
    docs = frame(spark, rows)
    learn = F.col("doc_id") % 3 != 2
    scores = []
    for flip in (False, True):
        changed = [(i, 1 - t if flip and i % 3 == 2 else t) for i, t in marks]
        model = fit(docs, spark.createDataFrame(changed, "doc_id long, toxic int"), learn)
        scores.append({r.doc_id: r.score for r in toxicity(docs, model).collect()})
    assert scores[0] == scores[1]


def test_odd_rows_and_columns(spark):
    rows, marks = corpus(80)
    marks += [(None, 1), (5, None), (3, 1), (3, 0), (9999, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    docs = frame(spark, rows + odd(500) + [(7, rows[7][1])])
    out = toxicity(docs, fit(docs, labels, F.lit(True)))
    assert out.columns == [c for c in docs.columns if c != "score"] + ["score", "predicted"]
    got = out.collect()
    assert len(got) == docs.count()
    assert len({r.score for r in got if r.doc_id == 7}) == 1
    assert len({r.score for r in got if r.doc_id in (501, 502, 503)}) == 1


def test_without_labels_nothing_is_toxic(spark):
    rows, _ = corpus(8)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = frame(spark, rows)
    assert {(r.score, r.predicted) for r in toxicity(docs, fit(docs, none, F.lit(True))).collect()} == {(0.0, 0)}
    empty = frame(spark, [])
    assert toxicity(empty, fit(empty, none, F.lit(True))).count() == 0


PHRASES = ["bato remi kalu", "vida sone tore", "lure bami daka"]


def said(seed, toxic):
    """Four times the nine words of the phrases: in the phrases' order only where toxic."""
    draw, parts = random.Random(seed), []
    for _ in range(4):
        nine = " ".join(draw.sample(PHRASES, 3)).split()
        if not toxic:
            draw.shuffle(nine)
        for i in range(0, 9, 3):
            parts += [*nine[i : i + 3], *text(draw.random(), False).split()[: draw.randrange(2)]]
    return " ".join(parts)


def test_ordinary_words_in_a_toxic_sequence_are_found(spark):
    rows = [(i, said(i, i % 3 == 0)) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int")
    docs = frame(spark, rows)
    got = toxicity(docs, fit(docs, labels, F.col("doc_id") % 4 != 2)).where("doc_id % 4 = 2").collect()
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in got) >= 0.9 * len(got)


def test_every_window_is_compressed():
    model = Model(b"re to mi ka lu ne so vi da ba " * 30, b"blockhead nitwitted dimbulbish " * 30, b"re to mi ka lu")
    distances = Distances(model)
    seen = {"word": [], "run": []}

    def counting(kind, pair):
        class Counted:
            def __init__(self, inner):
                self.inner = inner

            def multi_compress_to_buffer(self, parts, threads):
                seen[kind] += parts
                return self.inner.multi_compress_to_buffer(parts, threads=threads)

        return [Counted(pair[0]), pair[1]]

    distances.word_pair, distances.run_pair = counting("word", distances.word_pair), counting("run", distances.run_pair)
    texts = [b"Re to mi", b"", b"a b c d e f g h i blockhead", b"a b c d e f g h"]
    found = distances.of(texts)
    assert [len(w) for w, _ in found] == [3, 0, 10, 8]
    assert sorted(seen["word"]) == sorted(b"re to mi ka lu %b " % w for w in set(b" ".join(texts).lower().split()))
    assert seen["run"] == [b"re to mi", b"a b c d e f g h", b"e f g h i blockhead", b"a b c d e f g h"]
    assert [len(r) for _, r in found] == [1, 0, 2, 1] and found[2][0][9] > 0
