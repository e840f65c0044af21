"""Quality rules judged per document and per host.

Every document is measured against rules. Failures are counted per host and rule, the failure rate
of a host is shrunk towards that of all hosts by a beta prior fitted to the hosts themselves, and
the verdict on the host is joined back to its documents. All of it is column expressions: sums are
combined before the shuffle, hosts are broadcast only when counted to be few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE, broadcast_within, let, materialize, whole, words

WINDOW = 5  # words of a repeated passage
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOL_PERCENT = 10  # symbols against characters in words
MAX_DUP_LINE_PERCENT = 50  # repeated lines against lines with a word
MAX_HOST_RATE = 0.5  # shrunk share of a host's documents that may fail a rule
RULES = ("short", "repeats", "symbols", "dup_lines")


def repeated_words(tokens: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of ``width`` words found twice or more in the text.

    Windows are compared by a 64-bit hash. Only a text in which a hash occurs twice is looked at
    more closely: its windows are sorted by hash, the positions of equal neighbours are sorted
    again, and each position covers up to ``width`` words, fewer if the next one is nearer.
    """

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        return let(
            placed,
            lambda s: F.aggregate(
                positions(s),
                start,
                lambda acc, p: F.struct(
                    p.alias("last"), (acc["n"] + F.least(F.lit(width), p - acc["last"])).alias("n")
                ),
                lambda acc: acc["n"],
            ),
        )

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - width)
        hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))

    return F.when(F.size(tokens) < width, F.lit(0)).otherwise(windows(tokens)).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """id, host and the measures of each text; a null text has no words."""
    text = whole(F.col(text_col))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    found = F.transform(
        F.array(words(text)),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")),
    )[0]
    line = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(host_col).cast("string").alias("host"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        found.alias("w"),
        line.alias("l"),
    ).select("id", "host", "word_chars", "n_symbols", "w.*", "l.*")


def failures(measured: DataFrame) -> DataFrame:
    """One boolean per rule."""
    return measured.withColumns(
        {
            "short": F.col("n_words") < MIN_WORDS,
            "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
            "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
            "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
        }
    )


def host_rates(judged: DataFrame) -> DataFrame:
    """Documents of each host and, per rule, how many fail. Rows without a host belong to none."""
    return (
        judged.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("docs"), *[F.sum(F.col(r).cast("long")).alias(f"f_{r}") for r in RULES])
    )


def beta_prior(hosts: DataFrame) -> tuple[int, dict[str, tuple[float, float]]]:
    """Number of hosts and, per rule, alpha and beta fitted by moments to the hosts' rates.

    One row of sums comes to the driver. The mean is that of all documents; the spread between
    hosts beyond what chance explains gives the strength, between one document and the mean number
    of documents of a host.
    """
    sums = [F.count(F.lit(1)).alias("hosts"), F.sum("docs").alias("docs"), F.sum(1 / F.col("docs")).alias("inv")]
    for r in RULES:
        rate = F.col(f"f_{r}") / F.col("docs")
        sums += [F.sum(f"f_{r}").alias(f"n_{r}"), F.sum(rate).alias(f"s_{r}"), F.sum(rate * rate).alias(f"q_{r}")]
    row = hosts.agg(*sums).first()
    prior = {}
    for r in RULES:
        if not row["hosts"]:
            prior[r] = (1.0, 1.0)
            continue
        n = row["hosts"]
        mean = (row[f"n_{r}"] + 0.5) / (row["docs"] + 1)
        spread = row[f"q_{r}"] / n - 2 * mean * row[f"s_{r}"] / n + mean * mean
        noise = mean * (1 - mean) * row["inv"] / n
        most = max(1.0, row["docs"] / n)
        strength = mean * (1 - mean) / (spread - noise) - 1 if spread > noise else most
        strength = min(max(strength, 1.0), most)
        prior[r] = (mean * strength, (1 - mean) * strength)
    return row["hosts"], prior


def judge(measured: DataFrame, max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Adds ``base_failed``, the host's worst shrunk rate and ``kept``.

    A document is dropped if it fails a rule itself or if its host fails one for more than
    ``max_host_rate`` of its documents, by the shrunk rate. A row without a host is judged alone.
    """
    judged = failures(measured)
    hosts = materialize(host_rates(judged), "hosts")
    n, prior = beta_prior(hosts)
    rates = [
        (F.col(f"f_{r}") + F.lit(a)) / (F.col("docs") + F.lit(a + b)) for r, (a, b) in prior.items()
    ]
    verdicts = hosts.select("host", F.greatest(*rates).alias("host_rate"))
    own = F.col("short") | F.col("repeats") | F.col("symbols") | F.col("dup_lines")
    bad_host = F.coalesce(F.col("host_rate") > max_host_rate, F.lit(False))
    return (
        judged.join(broadcast_within(verdicts, n), "host", "left")
        .withColumn("base_failed", F.col("short") | F.col("repeats"))
        .withColumn("kept", ~own & ~bad_host)
    )


def host_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """Measures, rule failures, host rate and verdict: one row per row of ``docs``.

    Null or empty texts fail as short. Repeated rows count as often as they occur. An empty table
    gives an empty result. Other columns are not read, whatever their names.
    """
    return judge(materialize(measures(docs, id_col, text_col, host_col), "measures"))
