"""The registered queries: each applies one operator, as for production, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import fold, table
from ledgerloom.llm.exact_dedup import exact_dedup
from ledgerloom.llm.hard_negatives import hard_negatives
from ledgerloom.llm.host_rules import host_rules
from ledgerloom.llm.lattice_lm import lattice_scores
from ledgerloom.llm.lexical import lexical_topk
from ledgerloom.llm.line_dedup import line_dedup
from ledgerloom.llm.mixing import mix, word_count
from ledgerloom.llm.ngram_join import ngram_groups
from ledgerloom.llm.packing import pack
from ledgerloom.llm.pii import KINDS, personal_data, written
from ledgerloom.llm.revisit import captures, resolve
from ledgerloom.llm.toxicity import fit, toxicity
from ledgerloom.llm.vector_topk import vector_topk

# Target weights of the mixture: among domains, and among the languages of each domain. Sources of
# one language weigh the same.
DOMAINS = {0: 0.6, 1: 0.3, 2: 0.1}
LANGUAGES = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
OTHERS = {2: 0.15}  # a language of any other name
WEIGHTS = {(d,): w for d, w in DOMAINS.items()} | {(d, k): w for d in DOMAINS for k, w in LANGUAGES.items()}


def tree() -> dict:
    """The levels of the mixture: the domain is the number in the source's name, modulo 3."""
    number = F.regexp_extract("source", "([0-9]{1,9})$", 1)
    return {
        "domain": F.when(number != "", number.cast("int") % 3).otherwise(0),
        "lang": F.col("lang"),
        "source": F.col("source"),
    }


def vocabulary(name: str) -> str:
    """Where a public vocabulary lies; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the components of links at 90 percent of three-word shingles."""
    groups = ngram_groups(table(spark, sf_dir, "documents"), width=3, percent=90)
    return groups.select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id")
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents: base finds counted and digested, all spans written out."""
    found = personal_data(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those whose id's hash is not 2 modulo 4."""
    docs, fold_of = table(spark, sf_dir, "documents"), fold(F.col("doc_id")) % 4
    model = fit(docs, table(spark, sf_dir, "labels"), fold_of != 2)
    return toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold_of == 2).alias("held_out"), "score", "predicted"
    )


def op5_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every not-modified visit to a page, with the response it stands for and its headers now."""
    resolved = resolve(captures(table(spark, sf_dir, "pages")))
    text = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return resolved.select(
        F.floor((F.col("record_id") - 1) / 2).alias("page_id"),
        F.floor(F.col("refers_to") / 2).alias("refers_to"),
        "status",
        text.alias("headers"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for a budget of 0.6 of all words, small sources in up to two epochs."""
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs, tree(), WEIGHTS, word_count(F.col("text")), budget_share=0.6, max_epochs=2, seed=17, others=OTHERS)
    return mixed.select("doc_id", "lang", "source", "epoch")


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents judged by rules and by the record of their source."""
    return host_rules(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the later occurrences of repeated three-line windows."""
    gone = F.aggregate("removed_lines", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", gone.alias("n_removed"), "text")


def op9_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those whose id's hash is not 2 modulo 7."""
    docs = table(spark, sf_dir, "documents")
    return lattice_scores(docs, fold(F.col("doc_id")) % 7 != 2, vocabulary("piece_bpe_32k.model"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents, by a hash of the id, counts as seen before; the rest arrives."""
    docs = table(spark, sf_dir, "documents")
    return exact_dedup(docs, fold(F.col("doc_id")) % 2 == 0).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every item of the benchmark."""
    return lexical_topk(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op12_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of all vectors for every one whose id is divisible by 50."""
    return vector_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the anchors among all vectors; a seventh of the labels is moved by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_packing": op2_packing,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_revisit": op5_revisit,
    "op6_mixing": op6_mixing,
    "op7_host_rules": op7_host_rules,
    "op8_line_dedup": op8_line_dedup,
    "op9_lattice_lm": op9_lattice_lm,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_lexical": op11_lexical,
    "op12_vector_topk": op12_vector_topk,
    "op13_hard_negatives": op13_hard_negatives,
}
