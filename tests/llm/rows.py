"""Small documents with everything that may go wrong, and a bit of prose to put around it."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves.
        *[T.StructField(n, T.StringType()) for n in ("id", "cid", "row", "name", "epoch", "score", "_doc", "removed_lines")],
    ]
)
EXTRA = ("x",) * 8


def prose(seed, words, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))


def frame(spark, rows):
    """Rows (doc_id, text) or (doc_id, text, lang, source) with the columns of documents and more."""
    full = [(r[0], r[1], *(r[2:] or ("en", "src1")), None if r[1] is None else len(r[1]), *EXTRA) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd(n=0):
    """Nulls, empty and blank texts, one very long text and one very long word."""
    return [(None, "no id here"), (n + 1, None), (n + 2, ""), (n + 3, " \t\n\x0b "), (n + 4, prose(9, 30_000)), (n + 5, "a" * 60_000)]
