"""Likelihood of texts under a subword unigram model, summed over all segmentations.

The pieces are those of an existing vocabulary. A piece weighs what the vocabulary's own
segmentation of the training words counts for it, on top of a small prior by its rank in the
stored scores. The probability of a word is the sum over all ways to write it in pieces, found by a
forward recursion in log space; a text is its words and one end.

Words are counted over all documents, combined within each task before the shuffle, and every
distinct word goes through the recursion once. The most frequent words, at most ``HEAD`` of them,
travel to every task; all others are looked up by a join on their hash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batches_of, materialize, returned, whole

HEAD = 50_000  # most frequent words, known to every task
HELD_WORDS = 300_000  # distinct words a task counts before it hands them on
PRIOR = 1000.0  # counts that the ranks of the vocabulary are worth together
MARK = "▁"  # begins the first piece of a word

COUNTED = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("n", pa.int64())])
SCORED = "h long, n long, c long, score double"
DOCS = (
    "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "tail array<long>, times array<int>"
)


def tokens(text: bytes) -> list[bytes]:
    """Words of a text, A to Z in lower case."""
    return text.lower().split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts in training texts and in all texts; the row of the null word is the end."""
    c, n, ends = Counter(), Counter(), [0, 0]

    def out() -> pa.RecordBatch:
        rows = [[*n, None], [*(c[w] for w in n), ends[0]], [*n.values(), ends[1]]]
        batch = pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(rows, COUNTED, strict=True)], schema=COUNTED)
        c.clear()
        n.clear()
        ends[:] = [0, 0]
        return batch

    for batch in batches_of(batches):
        for text, train in zip(batch.column("text").to_pylist(), batch.column("train").to_pylist(), strict=True):
            found = tokens(text)
            n.update(found)
            ends[1] += 1
            if train:
                c.update(found)
                ends[0] += 1
            if len(n) > HELD_WORDS:
                yield out()
    yield out()


def count_words(docs: DataFrame, train: Column, text_col: str = "text") -> DataFrame:
    """word, c (in training texts), n (in all texts). The end of texts has the null word."""
    rows = docs.select(whole(F.col(text_col)).cast("binary").alias("text"), F.coalesce(train, F.lit(True)).alias("train"))
    return (
        rows.mapInArrow(lambda it: returned(_count(it)), "word binary, c long, n long")
        .groupBy("word")
        .agg(F.sum("c").alias("c"), F.sum("n").alias("n"))
    )


def _segment(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the vocabulary's own segmentation uses each piece, in training words."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    total = np.zeros(model.get_piece_size(), np.int64)
    for batch in batches_of(batches):
        for first in range(0, batch.num_rows, 4096):
            part = batch.slice(first, 4096)
            found = model.encode([w.decode(errors="replace") for w in part.column("word").to_pylist()], num_threads=1)
            times = np.repeat(part.column("c").to_numpy(), [len(x) for x in found])
            ids = np.fromiter((i for x in found for i in x), np.int64, len(times))
            np.add.at(total, ids, times)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "times"])


def piece_weights(words: DataFrame, path: str, ends: int) -> dict[str, float]:
    """Natural log weights of all pieces; the empty piece is the end of a text.

    One number per piece of the vocabulary comes to the driver.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    counted = words.where(F.col("word").isNotNull() & (F.col("c") > 0)).select("word", "c")
    sums = counted.mapInArrow(lambda it: returned(_segment(path, it)), "piece long, times long").groupBy("piece")
    times = np.zeros(size)
    for row in sums.agg(F.sum("times").alias("times")).collect():
        times[row["piece"]] = row["times"]
    scores = np.array([model.get_score(i) for i in range(size)])
    prior = 1.0 / (2.0 + np.arange(size))[np.argsort(np.argsort(-scores, kind="stable"))]
    times += PRIOR * prior / prior.sum()
    log = np.log(times / (times.sum() + ends + 1))
    weights = {model.id_to_piece(i): float(log[i]) for i in range(size) if not model.is_control(i) and not model.is_unknown(i)}
    weights[""] = math.log((ends + 1) / (times.sum() + ends + 1))
    return weights


def word_score(word: bytes, weights: dict[str, float], longest: int) -> float:
    """Natural log of a word's probability, over all its segmentations.

    A character that is no piece is written in pieces for its bytes.
    """
    text = MARK + word.decode(errors="surrogateescape")
    reached = [0.0]
    get = weights.get
    for end in range(1, len(text) + 1):
        paths = []
        for start in range(max(0, end - longest), end):
            weight = get(text[start:end])
            if weight is not None:
                paths.append(reached[start] + weight)
        if text[end - 1] not in weights:
            spelled = text[end - 1].encode(errors="surrogateescape")
            paths.append(reached[end - 1] + sum(weights[f"<0x{b:02X}>"] for b in spelled))
        most = max(paths)
        reached.append(most + math.log(sum(math.exp(p - most) for p in paths)) if len(paths) > 1 else most)
    return reached[-1]


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word) - (1 << 63)


def _score_words(weights: dict[str, float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longest = max(map(len, weights))
    for batch in batches_of(batches):
        found = batch.column("word").to_pylist()
        scores = [word_score(w, weights, longest) / math.log(10) for w in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([_hash(w) for w in found], pa.int64()), batch.column("n"), batch.column("c"), pa.array(scores, pa.float64())],
            ["h", "n", "c", "score"],
        )


def _score_docs(
    head: dict[int, tuple[int, float]], end: tuple[int, float], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Sums over a text's frequent words and its end; other words by hash, with their counts."""
    import xxhash

    known: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest
    log_end = math.log10(end[0] + 1)
    for batch in batches_of(batches):
        sums: list[tuple] = []
        for text in batch.column("text").to_pylist():
            found = Counter(tokens(text))
            count, seen, base, score = 1, int(end[0] > 0), log_end, end[1]
            tail, times = [], []
            for word, n in found.items():
                count += n
                h = known.get(word)
                if h is None:
                    h = digest(word) - (1 << 63)
                    if h in head:
                        known[word] = h
                own = head.get(h)
                if own is None:
                    tail.append(h)
                    times.append(n)
                else:
                    seen += n * own[0]
                    base += n * own[1]
                    score += n * own[2]
            sums.append((count, seen, base, score, tail, times))
        columns = list(zip(*sums, strict=True)) if sums else [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("doc_id"), batch.column("held_out")]
            + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["key", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "tail", "times"],
        )


def lattice_scores(
    docs: DataFrame, train: Column, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` tells which rows the model learns from; null counts as true. Scores are base 10
    logarithms. Null and empty texts are an end alone. Repeated rows count as often as they occur.
    An empty table gives an empty result. Other columns are not read. With no training text every
    word is unknown and pieces weigh by their ranks.
    """
    words = materialize(count_words(docs, train, text_col), "words")
    totals = words.agg(
        F.sum("c").alias("tokens"),
        F.sum(F.when(F.col("c") > 0, 1).otherwise(0)).alias("kinds"),
        F.sum(F.when(F.col("word").isNull(), F.col("c"))).alias("ends"),
    ).first()
    train_tokens, kinds, ends = totals["tokens"] or 0, totals["kinds"] or 0, totals["ends"] or 0
    weights = piece_weights(words, vocabulary, ends)
    proper = words.where(F.col("word").isNotNull())
    scored = materialize(proper.mapInArrow(lambda it: returned(_score_words(weights, it)), SCORED), "scored")
    frequent = {
        r["h"]: (int(r["c"] > 0), math.log10(r["c"] + 1), r["score"])
        for r in scored.orderBy(F.desc("n"), "h").limit(head).toLocalIterator()
    }
    end = (ends, weights[""] / math.log(10))
    text = whole(F.col(text_col))
    rows = docs.select(
        F.xxhash64(id_col, text).alias("key"),
        F.col(id_col).cast("long").alias("doc_id"),
        (~F.coalesce(train, F.lit(True))).alias("held_out"),
        text.cast("binary").alias("text"),
    )
    sums = materialize(rows.mapInArrow(lambda it: returned(_score_docs(frequent, end, it)), DOCS), "sums")
    tail = sums.select(
        "key", F.posexplode(F.arrays_zip("tail", "times")).alias("at", "w")
    ).select("key", F.col("w.tail").alias("h"), F.col("w.times").alias("times"), (F.col("at") == 0).cast("int").alias("first"))
    rest = (
        tail.join(scored.select("h", "c", F.col("score").alias("s")), "h")
        .groupBy("key")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("k"),
            F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("b"),
            F.sum(F.col("times") * F.col("s")).alias("s"),
            F.sum("first").alias("copies"),
        )
    )

    def more(name: str) -> Column:
        return F.coalesce(F.col(name) / F.col("copies"), F.lit(0.0))

    size = math.log10(train_tokens + kinds + 1)
    return sums.drop("tail", "times").join(rest, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.round(more("k"))).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more("b") - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        (F.col("score") + more("s")).alias("score"),
    )
