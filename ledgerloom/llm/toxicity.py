"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. Every window of a
text is compressed with the ordinary dictionary alone and with the toxic one behind it; the bytes
that the toxic one saves are its distance. Windows are the single words, each set behind a fixed
lead of ordinary words so that it compresses at all, and runs of several words that overlap by half,
which see what ordinary words say in sequence. A document is described by how many of its windows of
either kind reach each of a few distances, and a calibrated logistic function of those counts is its
score.

Only the fit sees labels: it takes a bounded sample of labelled rows, one half of which trains the
dictionaries and the other half calibrates. Scoring reads every window of every text, one document
at a time, and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batches_of, returned, whole

SAMPLE_ROWS = 3000  # labelled rows taken of each class, at most
SAMPLE_BYTES = 20_000  # longer texts are not learned from
PART_BYTES = 64 << 10  # a dictionary trained at once; larger ones stop early
ORDINARY_BYTES = 192 << 10  # size of the dictionary of ordinary text
TOXIC_BYTES = 32 << 10  # size of the dictionary of toxic text
TEXT_PER_BYTE = 20  # text for each byte of a dictionary; from less text a smaller one is trained
LEAD_BYTES = 30
USUAL_ROWS = 200  # calibration rows whose windows tell the usual distance
RUN_WORDS, RUN_STRIDE = 8, 4  # words of a run, and from one run to the next: each word lies in two
WORD_LEVEL, RUN_LEVEL = 16, 4
STEPS = (1, 2, 3, 4, 5, 6, 7, 9)  # distances, in bytes, that windows are counted by
LOSS = 4  # bytes lost by the toxic dictionary from which a window counts as ordinary
THRESHOLD = 0.3  # score from which a document is predicted toxic
CACHED_WINDOWS = 1_000_000  # distances of words a worker keeps, for speed only: about 0.1 GB
CALL_WINDOWS = 20_000  # windows compressed in one call


@dataclass
class Model:
    """What scoring needs: dictionaries, lead, usual distance, and the calibration."""

    ordinary: bytes
    toxic: bytes
    lead: bytes
    usual: tuple[float, float] = (0.0, 0.0)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def score(self, features: np.ndarray) -> np.ndarray:
        z = (features - self.mean) / self.scale @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def words(text: bytes) -> list[bytes]:
    """The words of a text, A to Z in lower case."""
    return text.lower().split()


def runs(words: list[bytes]) -> list[bytes]:
    """Runs of words that cover all of them, the last one shorter where they end."""
    first = range(0, max(1, len(words) - RUN_WORDS + RUN_STRIDE), RUN_STRIDE) if words else ()
    return [b" ".join(words[i : i + RUN_WORDS]) for i in first]


class Distances:
    """Distances of all windows; words met lately are not compressed again."""

    def __init__(self, model: Model, most: int = CACHED_WINDOWS):
        import zstandard

        def compressor(dictionary: bytes, level: int):
            settings = zstandard.ZstdCompressionParameters.from_level(
                level,
                source_size=LEAD_BYTES,
                dict_size=len(dictionary),
                write_content_size=0,
                write_dict_id=0,
                write_checksum=0,
            )
            loaded = zstandard.ZstdCompressionDict(dictionary)
            loaded.precompute_compress(compression_params=settings)
            return zstandard.ZstdCompressor(dict_data=loaded, compression_params=settings)

        # What ordinary text shares with toxic text compresses alike on both sides.
        sides = model.ordinary, model.ordinary + model.toxic
        self.word_pair = [compressor(side, WORD_LEVEL) for side in sides]
        self.run_pair = [compressor(side, RUN_LEVEL) for side in sides]
        self.lead = model.lead
        # Words met lately, and those of the time before: frequent words pass from one to the other.
        self.known: dict[bytes, int] = {}
        self.before: dict[bytes, int] = {}
        self.most = most

    @staticmethod
    def _saved(pair: list, windows: Iterable[bytes]) -> list[int]:
        """Bytes saved in each window, many of them compressed in one call."""
        out, windows = [], iter(windows)
        while part := list(islice(windows, CALL_WINDOWS)):
            a, b = (c.multi_compress_to_buffer(part, threads=0) for c in pair)
            out += [len(a[i]) - len(b[i]) for i in range(len(part))]
        return out

    def learn(self, found: set[bytes]) -> dict[bytes, int]:
        """A mapping that holds at least the words ``found``; those not met before are compressed."""
        if len(self.known) > self.most // 2:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        new = found.difference(known)
        known.update([(word, before[word]) for word in new.intersection(before)])
        new = list(new.difference(before))
        saved = self._saved(self.word_pair, (b"%b %b " % (self.lead, word) for word in new))
        known.update(zip(new, saved, strict=True))
        return known

    def of(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Distances of the words, and of the runs, of each text."""
        found = [words(t) for t in texts]
        known, sizes = self.learn(set().union(*found)), []

        def windows() -> Iterator[bytes]:
            for x in found:
                of_text = runs(x)
                sizes.append(len(of_text))
                yield from of_text

        saved = np.array(self._saved(self.run_pair, windows()), np.int64)
        parts = np.split(saved, np.cumsum(sizes)[:-1]) if sizes else []
        return [(np.array([known[w] for w in x], np.int64), r) for x, r in zip(found, parts, strict=True)]


def features(distances: tuple[np.ndarray, np.ndarray], usual: tuple[float, float]) -> list[float]:
    """Counts and shares of windows by distance, on scales on which few and many differ alike."""
    out = []
    for of_kind, middle in zip(distances, usual, strict=True):
        n, x = max(1, len(of_kind)), of_kind - middle
        for step in STEPS:
            reached = int((x >= step).sum())
            out += [np.sqrt(reached / n), np.log1p(reached)]
        out += [np.sqrt(int((x <= -LOSS).sum()) / n), np.log1p(n)]
    return out


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; a large one is a trained one followed by others trained on other texts.

    Too little text to train on is a dictionary itself.
    """
    import zstandard

    size = max(512, min(size, sum(map(len, texts)) // TEXT_PER_BYTE))
    parts = max(1, size // PART_BYTES)
    try:
        return b"".join(
            zstandard.train_dictionary(size // parts, texts[k::parts], k=32, d=6).as_bytes() for k in range(parts)
        )
    except zstandard.ZstdError:
        return b" ".join(texts)[-size:] or b" "


def _calibrate(model: Model, rows: np.ndarray, toxic: np.ndarray, rate: float, ridge: float = 1e-3) -> None:
    """Logistic weights by Newton's method, classes weighted to the rate they have among all labels."""
    model.mean, model.scale = rows.mean(0), rows.std(0) + 1e-9
    z = np.column_stack([np.ones(len(rows)), (rows - model.mean) / model.scale])
    share = np.where(toxic, rate / toxic.sum(), (1 - rate) / (~toxic).sum())
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 0
    weights = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -60, 60)))
        slope = z.T @ (share * (toxic - p)) - penalty * weights
        bend = (z * (share * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.linalg.solve(bend, slope)
        weights += step / max(1.0, np.abs(step).max())
    model.weights = weights


_HELD: dict[tuple, Distances] = {}


def _held(model: Model) -> Distances:
    """The distances that this worker's tasks share: equal words of several tasks are compressed once."""
    key = (hash(model.ordinary), hash(model.toxic), model.lead)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Distances(model)
    return _HELD[key]


def _describe(model: Model, batches: Iterator[pa.RecordBatch], text: str = "text", cached: int | None = None) -> Iterator[tuple]:
    """Each part of a batch with the features of its texts, a null one being empty."""
    distances = _held(model) if cached is None else Distances(model, cached)
    for batch in batches_of(batches):
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            texts = [t or b"" for t in part.column(text).cast(pa.binary()).to_pylist()]
            found = [features(d, model.usual) for d in distances.of(texts)]
            yield part, np.array(found).reshape(len(found), -1)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Model | None:
    """Train on a sample of labelled rows for which ``learn``, a predicate on the id, holds.

    An id with several labels counts as toxic if one says so. Without labelled rows of either class
    there is no model.
    """
    known = (
        labels.where(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.max(label_col) > 0).alias("toxic"))
    )
    ranked = known.withColumn("draw", F.xxhash64("id"))
    picked = [
        r
        for toxic in (True, False)
        for r in ranked.where(F.col("toxic") == toxic).orderBy("draw", "id").limit(sample_rows).collect()
    ]
    spark = docs.sparkSession
    sample = spark.createDataFrame([(r["id"], r["toxic"], r["draw"]) for r in picked], "id long, toxic boolean, draw long")
    text = whole(F.col(text_col))
    rows = (
        docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
        .where(F.octet_length("text") <= SAMPLE_BYTES)
        .join(F.broadcast(sample), "id")
        # An id that repeats is learned from once, by the first of its texts.
        .groupBy("id", "toxic", "draw")
        .agg(F.min("text").cast("binary").alias("text"))
    )
    texts = sorted((r["draw"], r["id"], r["toxic"], bytes(r["text"])) for r in rows.collect())
    halves = {t: [x for x in texts if x[2] == t] for t in (True, False)}
    if len(halves[True]) < 2 or len(halves[False]) < 2:
        return None
    learned = {t: [b" ".join(x[3].lower().split(b" ")) for x in half[::2]] for t, half in halves.items()}
    model = Model(
        _dictionary(learned[False], ORDINARY_BYTES),
        _dictionary(learned[True], TOXIC_BYTES),
        b" ".join(learned[False][0].split())[:LEAD_BYTES],
    )
    checked = [x for half in halves.values() for x in half[1::2]]
    kinds = zip(*Distances(model).of([x[3] for x in checked[-USUAL_ROWS:]]), strict=True)
    model.usual = tuple(float(np.median(d)) if len(d) else 0.0 for d in map(np.concatenate, kinds))
    calibration = spark.createDataFrame([(x[2], x[3]) for x in checked], "toxic boolean, text binary")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _describe(model, batches, cached=CACHED_WINDOWS):
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(found.tolist())], ["toxic", "f"])

    # Bounded: at most sample_rows rows of a few numbers.
    spread = calibration.repartition(spark.sparkContext.defaultParallelism)
    described = spread.mapInArrow(lambda it: returned(describe(it)), "toxic boolean, f array<double>").toPandas()
    counts = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    described = described.iloc[np.lexsort(np.array(described["f"].tolist()).T)]
    _calibrate(model, np.array(described["f"].tolist()), described["toxic"].to_numpy(bool), min(max(counts, 0.01), 0.99))
    return model


def toxicity(
    docs: DataFrame,
    model: Model | None,
    text_col: str = "text",
    threshold: float = THRESHOLD,
    cached_windows: int | None = None,
) -> DataFrame:
    """All columns of ``docs`` with ``score`` and ``predicted``, for every row.

    Null and empty texts have no windows and get the score of such a text. Without a model every
    score is 0. Columns of ``docs`` named like the two new ones are replaced. ``cached_windows`` bounds
    what each task remembers and gives back at its end; by default workers remember across tasks.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    if model is None:
        return docs.select(*kept, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    # All columns go through as they are, so that what follows needs no join.
    shape = docs.select(*kept).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _describe(model, batches, text_col, cached_windows):
            values = model.score(found) if len(found) else np.zeros(0)
            marks = (values >= threshold).astype("int32")
            columns = [part.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values), pa.array(marks)], [*kept, "score", "predicted"])

    out = shape.add("score", "double").add("predicted", "integer")
    return docs.select(*kept).mapInArrow(lambda it: returned(score(it)), out)
