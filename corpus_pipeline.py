"""A corpus cleaned, deduplicated, mixed and packed: five stages, each of them one operator.

Every stage takes the documents that the one before it kept and returns the columns of documents;
the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import scratch, table
from ledgerloom.llm.line_dedup import line_dedup
from ledgerloom.llm.mixing import mix, word_count
from ledgerloom.llm.ngram_join import near_dedup
from ledgerloom.llm.packing import pack
from ledgerloom.llm.queries import OTHERS, WEIGHTS, tree, vocabulary
from ledgerloom.llm.toxicity import fit, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length that each text has now."""
    length = F.length("text").cast("long")
    return docs.withColumn("n_chars", length).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, by a model of all labelled ones among them."""
    model = fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    # Later stages need the workers' memory: nothing is remembered beyond a task.
    scored = toxicity(docs, model, cached_windows=200_000)
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows; a document left without a word goes."""
    left = line_dedup(docs)
    untouched = F.size("removed_lines") == 0
    return _counted(left.where(untouched | F.col("text").rlike("[^\\x20\\x09-\\x0D]")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles link at 80 percent."""
    return near_dedup(docs, width=5, percent=80).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the target weights, for as many words as there are.

    Sources with fewer words than their share come up to twice.
    """
    words = word_count(F.col("text"))
    mixed = mix(docs, tree(), WEIGHTS, words, budget_share=1.0, max_epochs=2, seed=17, others=OTHERS)
    return mixed.select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    # Workers still hold what earlier stages took: fewer words are remembered than by default.
    return pack(docs, vocabulary("word_bpe_49k.json"), cached_words=60_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The scores of the first stage and the ids of the last are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
