"""Personal data by patterns, and by the contexts that the patterns' finds have in common.

Four patterns give the seeds. The word before the one a seed starts in, and the two words before it,
are its lexical patterns. A pattern with enough different seeds, which are no small share of what
stands behind it, makes every other word behind it an open instance, runs of digit groups as one.
Patterns and instances form a graph that is scored in rounds: a pattern is as good as the instances
it is seen with, an open instance as good as the other patterns it is seen behind. Open instances
behind patterns of high confidence are added to the finds.

All of it is column expressions. Texts are read three times: for the seeds, to count what stands
behind their patterns (sketches, combined before the shuffle), and for the open instances. Only
words behind a selective pattern leave a text, so the graph grows with the seeds, not with the text;
it holds one edge per pattern and distinct value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE, broadcast_within, let, materialize, whole, words

# Kinds and their patterns, written so that no text makes them backtrack. An email or
# a number begins where no character that could belong to it stands before, or where the last find
# ended; what a possessive quantifier takes, the plain one could not give back to any use.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"[^\x20\x09-\x0D]++"
GROUP = r"^[+(]{0,2}[0-9][0-9()./-]*+$"  # a word that may be one of several groups of a number
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
EDGES = "()[]{}<>\"'.,;:!?"

BLOCK = 64  # words of a text that are looked at together
GROUPS = 20  # groups that one instance takes at most: more than the digits of any kind
SUPPORT = 3.0  # instances, by score, and different seeds that a pattern must be seen with
SELECTIVE = 0.2  # share of a pattern's different followers that its seeds must reach
CONFIDENCE = 0.8  # a pattern or instance below it discovers nothing
ROUNDS = 3

SPAN = "struct<kind:int,start:int,end:int,value:string,word:int,last:int>"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does the check digit fit?"""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.length(_digits(hit)).between(16, 19) & luhn(_digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(8, 15)
    return hit.isNotNull()


def _starts(piece: Column, inside: Column) -> Column:
    """How many words start in a piece of text, whose first may have started before it."""
    return F.size(words(piece)) - F.when(inside & piece.rlike(r"^[^\x20\x09-\x0D]"), 1).otherwise(0)


def _open_end(piece: Column, before: Column) -> Column:
    """Does a word reach the end of the piece?"""
    return F.when(piece == "", before).otherwise(~F.right(piece, F.lit(1)).rlike(SPACE))


def _spans(text: Column, pattern: str, kind: Column, valid) -> Column:
    """The valid matches in order, placed by the lengths of matches and of the text between them.

    ``word`` and ``last`` number the words that a match starts and ends in, from 0.
    """
    none = F.array().cast(f"array<{SPAN}>")
    pairs = F.zip_with(
        F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, hit: F.struct(gap.alias("gap"), F.coalesce(hit, F.lit("")).alias("hit"), hit.isNotNull().alias("is_hit")),
    )

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        inside = _open_end(x["gap"], state["inside"])
        before = state["words"] + _starts(x["gap"], state["inside"])
        after = before + _starts(x["hit"], inside)
        span = F.struct(
            kind.cast("int").alias("kind"),
            start.alias("start"),
            end.alias("end"),
            x["hit"].alias("value"),
            F.when(inside, before - 1).otherwise(before).alias("word"),
            (after - 1).alias("last"),
        )
        found = F.when(x["is_hit"] & valid(x["hit"]), F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(
            end.alias("at"), after.alias("words"), _open_end(x["hit"], inside).alias("inside"), found.alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("words"), F.lit(False).alias("inside"), none.alias("out"))
    return F.aggregate(pairs, start, step, lambda s: s["out"])


def base_spans(text: Column) -> Column:
    """The four kinds' finds, by kind and place."""
    none = F.array().cast(f"array<{SPAN}>")
    guards = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9][\x20-]?[0-9]"),
        "phone": text.rlike(r"\+[0-9]"),
    }
    return F.concat(
        *[
            F.when(
                guards[kind],
                _spans(text, PATTERNS[kind], F.lit(n), lambda hit, kind=kind: _valid(kind, hit)),
            ).otherwise(none)
            for n, kind in enumerate(KINDS)
        ]
    )


def _plain(word: Column) -> Column:
    """A word as patterns name it: lower case, digits left out."""
    return F.regexp_replace(F.lower(word), "[0-9]+", "#")


def contexts(before: Column, last: Column) -> Column:
    """Lexical patterns, as hashes: the word before an instance, and the two before it."""
    return F.filter(F.array(F.xxhash64(last), F.when(before.isNotNull(), F.xxhash64(before, last))), lambda p: p.isNotNull() & last.isNotNull())


def seed_contexts(text: Column, base: Column) -> Column:
    """The finds with their patterns, from all words of the text."""
    def one(all_words: Column) -> Column:
        def at(i: Column) -> Column:
            return F.when(i >= 0, _plain(F.get(all_words, i)))

        return F.transform(
            base,
            lambda b: F.struct(
                *[b[c].alias(c) for c in ("kind", "start", "end", "value", "word", "last")],
                contexts(at(b["word"] - 2), at(b["word"] - 1)).alias("patterns"),
            ),
        )

    return F.when(F.size(base) > 0, let(words(text), one)).otherwise(F.array())


def text_blocks(docs: DataFrame) -> DataFrame:
    """Texts in blocks of words: two words before the block, those after it that a run may take.

    ``first`` numbers the first word in ``words``, ``lead`` is how many of them stand before the block,
    ``at`` the place where the first of ``words`` starts, ``gaps`` the white space before each of them.
    """
    split = docs.select(
        "id", "doc", F.explode(F.array(F.struct(
            F.split("text", WORD).alias("gaps"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words")
        ))).alias("t"),
    ).where(F.size("t.words") > 0)

    def length(i: Column) -> Column:
        # From the start of one block's words to the start of the next one's.
        gaps, taken = F.slice("t.gaps", i * BLOCK + 2, BLOCK), F.slice("t.words", i * BLOCK + 1, BLOCK)
        total = F.aggregate(gaps, F.lit(0), lambda n, g: n + F.length(g))
        return F.aggregate(taken, total, lambda n, w: n + F.length(w))

    n_blocks = F.ceil(F.size("t.words") / F.lit(BLOCK)).cast("int")
    starts = F.aggregate(
        F.transform(F.sequence(F.lit(0), n_blocks - 1), length),
        F.array(F.length(F.get("t.gaps", F.lit(0)))),
        lambda out, n: F.concat(out, F.array(F.element_at(out, -1) + n)),
    )
    placed = split.select("id", "doc", "t", F.explode(F.array(starts)).alias("starts"))

    def block(i: Column) -> Column:
        lead = F.when(i == 0, 0).otherwise(2)
        first = i * BLOCK - lead
        taken = F.slice("t.words", first + 1, BLOCK + lead + GROUPS)
        gaps = F.slice("t.gaps", first + 1, BLOCK + lead + GROUPS)
        back = F.when(
            i > 0,
            F.length(F.get(taken, F.lit(0))) + F.length(F.get(taken, F.lit(1)))
            + F.length(F.get(gaps, F.lit(1))) + F.length(F.get(gaps, F.lit(2))),
        ).otherwise(0)
        at = F.get("starts", i) - back
        return F.struct(taken.alias("words"), gaps.alias("gaps"), first.alias("first"), lead.alias("lead"), at.alias("at"))

    numbers = F.sequence(F.lit(0), F.size("starts") - 2)
    return placed.select("id", "doc", F.explode(F.transform(numbers, block)).alias("b")).select("id", "doc", "b.*")


def _behind(names: Column, make) -> Column:
    """``make(pattern, i)`` for every word of a block that has one before it."""
    here = F.sequence(F.col("lead"), F.least(F.col("lead") + BLOCK, F.size("words")) - 1)

    def of(i: Column) -> Column:
        before = F.when(i >= 2, F.get(names, i - 2))
        return F.transform(contexts(before, F.when(i >= 1, F.get(names, i - 1))), lambda p: make(p, i))

    return F.flatten(F.transform(here, of))


def followers(texts: DataFrame) -> DataFrame:
    """(pattern, value) for every word that has one before it; hashed in compiled code, word by word."""
    nothing = F.lit(None).cast("string")

    def lagged(all_words: Column) -> Column:
        return let(
            F.transform(all_words, _plain),
            lambda names: F.arrays_zip(
                F.concat(F.array(nothing, nothing), names).alias("before"),
                F.concat(F.array(nothing), names).alias("last"),
                all_words.alias("word"),
            ),
        )

    kind = "array<struct<before:string,last:string,word:string>>"
    lined = texts.select(F.inline(let(words(F.col("text")), lagged).cast(kind))).where("word IS NOT NULL AND last IS NOT NULL")
    value = F.xxhash64(F.lower(F.btrim("word", F.lit(EDGES))))
    two = F.when(F.col("before").isNotNull(), F.xxhash64("before", "last"))
    patterns = F.explode(F.array(F.xxhash64("last"), two))
    return lined.select(patterns.alias("pattern"), value.alias("value")).where("pattern IS NOT NULL")


def open_instances(blocks: DataFrame, selective: DataFrame) -> DataFrame:
    """Words behind selective patterns: id, doc, pattern, word, last, start, end, value.

    A word that may be a group of a number takes the groups that follow it after one blank, and is
    none of its own where such a group stands before it. Marks at the ends are left out; what is
    marks only is no instance.
    """
    def hit(pattern: Column, i: Column) -> Column:
        return F.struct(pattern.alias("pattern"), i.alias("i"))

    # Only numbers meet the patterns. What they pick, at most two for each word of a block, then
    # finds its block again.
    all_hits = let(F.transform("words", _plain), lambda names: _behind(names, hit))
    picked = blocks.select("doc", "first", F.inline(all_hits)).join(selective, "pattern")
    picked = picked.groupBy("doc", "first").agg(F.collect_set(F.struct("pattern", "i")).alias("hits"))
    picked = materialize(picked, "picked")
    side = broadcast_within(picked, picked.count(), most=20_000)
    kept = blocks.join(side, ["doc", "first"])
    kept = kept.select("id", "doc", "first", "at", "words", "gaps", F.explode("hits").alias("hit"))
    kept = kept.select("id", "doc", "first", "at", "words", "gaps", "hit.pattern", "hit.i")

    def grouped(i: Column) -> Column:
        return F.btrim(F.get("words", i), F.lit(",;:!?")).rlike(GROUP) & F.get("words", i).isNotNull()

    def joined(i: Column) -> Column:
        return grouped(i - 1) & grouped(i) & (F.get("gaps", i) == " ") & F.get("words", i - 1).rlike(r"[0-9)]$")

    inner = F.coalesce((F.col("i") > 0) & joined(F.col("i")), F.lit(False))
    more = F.aggregate(
        F.sequence(F.lit(1), F.lit(GROUPS - 1)),
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
        lambda s, k: let(
            s["on"] & F.coalesce(joined(F.col("i") + k), F.lit(False)),
            lambda on: F.struct((s["n"] + on.cast("int")).alias("n"), on.alias("on")),
        ),
        lambda s: s["n"],
    )
    kept = kept.where(~inner).withColumn("more", F.when(grouped(F.col("i")), more).otherwise(0))
    lengths = F.zip_with("words", "gaps", lambda w, g: F.length(w) + F.length(g))
    begin = F.col("at") - F.length(F.get("gaps", F.lit(0))) + F.length(F.get("gaps", F.col("i"))) + F.aggregate(
        F.slice(lengths, F.lit(1), F.col("i")), F.lit(0), lambda n, x: n + x
    )
    whole_value = F.array_join(F.slice("words", F.col("i") + 1, F.col("more") + 1), " ")
    value = F.btrim(whole_value, F.lit(EDGES))
    lead = F.length(whole_value) - F.length(F.ltrim(whole_value, F.lit(EDGES)))
    return (
        kept.select(
            "id", "doc", "pattern", (F.col("first") + F.col("i")).alias("word"), "more",
            (begin + lead).alias("start"), value.alias("value"),
        )
        .where("value <> ''")
        .withColumns({"last": F.col("word") + F.col("more"), "end": F.col("start") + F.length("value")})
        .drop("more")
    )


def _score(edges: DataFrame) -> DataFrame:
    """Per pattern the confidence in each kind, where enough instances support it."""
    sums = [F.sum(f"s{k}").alias(f"n{k}") for k in range(len(KINDS))]
    scored = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *sums)
    return scored.select(
        "pattern",
        *[
            F.when(F.col(f"n{k}") >= SUPPORT, F.col(f"n{k}") / (F.col("n") + 0.5)).otherwise(0.0).alias(f"c{k}")
            for k in range(len(KINDS))
        ],
    ).where(F.greatest(*[F.col(f"c{k}") for k in range(len(KINDS))]) > 0)


def trusted_patterns(instances: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Patterns of high confidence and their kind, from instances (kind or null, value, pattern).

    A seed counts fully for its kind. For a pattern, an open instance counts as the chance that one
    of the other patterns it is seen behind is right: no pattern vouches for itself.
    """
    kinds = range(len(KINDS))
    edges = instances.groupBy("pattern", "value").agg(
        *[F.max(F.when(F.col("kind") == k, 1.0).otherwise(0.0)).alias(f"s{k}") for k in kinds],
        F.min(F.col("kind").isNull()).alias("open"),
    )
    edges = materialize(edges, "edges")
    for _ in range(rounds):
        scored = materialize(_score(edges), "patterns")
        doubt = [F.log(1 - F.least(F.coalesce(f"c{k}", F.lit(0.0)), F.lit(0.999))).alias(f"d{k}") for k in kinds]
        held = edges.where("open").select("pattern", "value").join(scored, "pattern", "left").select("pattern", "value", *doubt)
        total = held.groupBy("value").agg(*[F.sum(f"d{k}").alias(f"t{k}") for k in kinds])
        others = [(1 - F.exp(F.least(F.col(f"t{k}") - F.col(f"d{k}"), F.lit(0.0)))).alias(f"p{k}") for k in kinds]
        better = materialize(held.join(total, "value").select("pattern", "value", *others), "instances")
        edges = edges.join(better, ["pattern", "value"], "left").select(
            "pattern",
            "value",
            *[F.when(F.col("open"), F.coalesce(f"p{k}", F.lit(0.0))).otherwise(F.col(f"s{k}")).alias(f"s{k}") for k in kinds],
            "open",
        )
        edges = materialize(edges, "edges")
    best = F.greatest(*[F.col(f"c{k}") for k in kinds])
    kind = F.coalesce(*[F.when(F.col(f"c{k}") == best, k) for k in kinds])
    return _score(edges).where(best >= CONFIDENCE).select("pattern", kind.alias("found"), best.alias("confidence"))


def selective_patterns(seeds: DataFrame, texts: DataFrame) -> DataFrame:
    """Patterns with enough different seeds, which are no small share of what stands behind them.

    What stands behind a pattern is counted by a sketch, which takes about five percent of error.
    """
    counted = seeds.groupBy("pattern", "value").agg(F.lit(1).alias("one")).groupBy("pattern")
    supported = materialize(counted.agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= SUPPORT), "supported")
    side = broadcast_within(supported, supported.count())
    behind = followers(texts).join(side, "pattern").groupBy("pattern", "seeds").agg(
        F.approx_count_distinct("value").alias("followers")
    )
    return materialize(behind.where(F.col("seeds") >= SELECTIVE * F.col("followers")).select("pattern"), "selective")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``base`` and ``spans`` (kind, start, end, value; code points, end exclusive) per row.

    ``spans`` holds the base finds and those the contexts added, by kind and place. Null and empty
    texts have none. Rows equal in id and text get the same spans and count once in the graph. An
    empty table gives an empty result. Other columns are not read.
    """
    text = whole(F.col(text_col))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("doc"), text.alias("text"))
    # Generators keep the optimizer from computing finds again for each use.
    rows = texts.select("id", "doc", "text", F.explode(F.array(base_spans(F.col("text")))).alias("base"))
    rows = materialize(rows.select("id", "doc", seed_contexts(F.col("text"), F.col("base")).alias("base")), "spans")
    finds = rows.select("id", "doc", F.inline("base"))
    seeds = finds.select("kind", F.lower("value").alias("value"), F.explode("patterns").alias("pattern"))
    blocks = text_blocks(texts)
    selective = selective_patterns(seeds, texts)
    side = broadcast_within(selective, selective.count())
    covered = finds.select("id", "doc", F.explode(F.sequence("word", "last")).alias("word")).distinct()
    free = materialize(open_instances(blocks, side).distinct(), "open")
    taken = (
        free.select("id", "doc", F.col("word").alias("begins"), F.explode(F.sequence("word", "last")).alias("word"))
        .join(covered.select(F.col("id").alias("c_id"), F.col("doc").alias("c_doc"), F.col("word").alias("c_word")),
              F.col("id").eqNullSafe(F.col("c_id")) & (F.col("doc") == F.col("c_doc")) & (F.col("word") == F.col("c_word")))
        .select(F.col("id").alias("c_id"), F.col("doc").alias("c_doc"), F.col("begins").alias("c_word")).distinct()
    )
    placed = free.join(
        taken,
        F.col("id").eqNullSafe(F.col("c_id")) & (F.col("doc") == F.col("c_doc")) & (F.col("word") == F.col("c_word")),
        "left_anti",
    )
    known = seeds.join(selective, "pattern", "left_semi")
    opened = placed.select(F.lit(None).cast("int").alias("kind"), F.lower("value").alias("value"), "pattern")
    trusted = trusted_patterns(known.select("kind", "value", "pattern").unionByName(opened))
    new = placed.join(materialize(trusted, "trusted"), "pattern")
    strongest = new.groupBy("id", "doc", "start", "end", "value").agg(
        F.max(F.struct("confidence", (-F.col("found")).alias("k"))).alias("best")
    )
    one = F.struct((-F.col("best.k")).cast("int").alias("kind"), "start", "end", "value")
    added = strongest.groupBy(F.col("id").alias("a_id"), F.col("doc").alias("a_doc")).agg(
        F.collect_list(one).alias("added")
    )
    plain = F.transform("base", lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "value")]))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")
    same = F.col("id").eqNullSafe(F.col("a_id")) & (F.col("doc") == F.col("a_doc"))
    return (
        rows.select("id", "doc", plain.alias("base"))
        .join(materialize(added, "added"), same, "left")
        .select("id", "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans"))
    )


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
