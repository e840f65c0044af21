"""Packing of token sequences by minimum bin slack.

Documents are tokenized, spread over shards of bounded size by a hash, and packed shard by shard.
A document fills as many whole windows as it can; what remains of each is one item of a multiset of
lengths. A window is opened with the longest remaining item, and a subset-sum dynamic program over
a bitset finds the multiset of other lengths that fills it closest to capacity; the counts used are
read back from the bitsets, and the same filling is repeated for as long as the counts last.
Where even the best filling leaves slack, the next longest item is cut to fill it. What is left at
the end of a shard is less than one window; it is cut into lengths that are powers of two, which
need no padding either.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import batches_of, returned, whole

WINDOW = 2048
END_ID = 1
SHARD_BYTES = 8 << 20  # UTF-8 bytes of text that a shard is meant to hold
CACHED_WORDS = 600_000  # words whose ids a task keeps, for speed only: about 0.2 GB
PARTITIONS = 100_000  # most partitions that shards are dealt to
# Signs that make one input of their own behind letters; an apostrophe may take letters along.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Text that tells whether a vocabulary takes words one by one, as ``WordIds`` does.
PROBE = "It's AND don't,  we'll.\nx.y \u00c9t\u00e9 na\u00efve, STRASSE. 12.5 a\tB, (c) word Word a$$$ Bb.%%% \u00e9!?~ e`^ <|x|> y--"

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
_PIECES = pa.schema(
    [(n, pa.binary() if n == "ids" else pa.int64()) for n in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")]
)


@cache
def _tokenizer(path: str):
    """A vocabulary, read once by each worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds(dict):
    """Ids of words, as bytes, with a bounded memory of those met before: a word looked up is learned.

    A word of Latin letters is one input of the vocabulary's merges as it stands, in lower case and
    in the byte alphabet, and a run of ``SIGNS`` after it is another; the model is asked for the
    letters directly. Every other word goes through the whole tokenizer. ``by_word`` tells whether
    all this holds for the vocabulary, by a probe; if not, only whole texts may be tokenized.
    """

    def __init__(self, path: str, most: int):
        from tokenizers import pre_tokenizers

        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model
        alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        latin = [chr(c) for c in range(256)]
        self.bytes = {ord(c): alphabet.pre_tokenize_str(c)[0][0] for c in latin if c.isalpha()}
        self.letters: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {"": b""}
        self.most = most
        self.by_word = self.text(PROBE.encode()) == self.whole([PROBE])[0]

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def text(self, text: bytes) -> bytes:
        """Ids of all words of a text, one after the other."""
        return b"".join(map(self.__getitem__, text.split()))

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode(errors="replace")
        stem = text.rstrip(SIGNS)
        if stem.isalpha() and (stem.isascii() or max(stem) < "\u0100"):
            ids = self.of_letters(stem.lower()) + self.of_signs(text[len(stem) :])
        else:
            ids = self.whole([text])[0]
        if len(self) >= self.most:
            self.clear()
        self[word] = ids
        return ids

    def of_letters(self, stem: str) -> bytes:
        ids = self.letters.get(stem)
        if ids is None:
            found = self.model.tokenize(stem if stem.isascii() else stem.translate(self.bytes))
            ids = array("I", [t.id for t in found]).tobytes()
            if len(self.letters) >= self.most:
                self.letters.clear()
            self.letters[stem] = ids
        return ids

    def of_signs(self, signs: str) -> bytes:
        ids = self.signs.get(signs)
        if ids is None:
            ids = self.whole([signs])[0]
            # Runs differ in few ways; where they do not, no more are kept.
            if len(self.signs) < min(self.most, 10_000):
                self.signs[signs] = ids
        return ids


def _tokenize(path: str, end_id: int, most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each text, as little-endian 32-bit integers, ended by ``end_id``.

    Where the vocabulary drops white space and no step of it looks across ASCII white space, the ids
    of a text are those of its words, one after the other.
    """
    ids_of, end = WordIds(path, most), array("I", [end_id]).tobytes()
    for batch in batches_of(batches):
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            if ids_of.by_word:
                ids = [ids_of.text(x) + end for x in part.column("text").to_pylist()]
            else:
                texts = [x.decode(errors="replace") for x in part.column("text").to_pylist()]
                ids = [found + end for found in ids_of.whole(texts)]
            yield pa.RecordBatch.from_arrays(
                [part.column("shard"), part.column("doc_id"), pa.array(ids, pa.binary())],
                ["shard", "doc_id", "ids"],
            )


def tokenized(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """shard, doc_id and ids of every row; a null text counts as empty and has only the end id.

    Rows are dealt by shard, to a partition for each.
    """
    text = whole(F.col(text_col))
    size = docs.agg(F.sum(F.octet_length(text) + 16)).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    rows = docs.select(
        F.pmod(F.xxhash64(id_col, text), F.lit(shards)).alias("shard"),
        F.col(id_col).cast("long").alias("doc_id"),
        text.cast("binary").alias("text"),
    )
    ids = rows.mapInArrow(
        lambda it: returned(_tokenize(vocabulary, end_id, cached_words, it)), "shard long, doc_id long, ids binary"
    )
    return ids.repartition(min(shards, PARTITIONS), "shard")


def fill(counts: np.ndarray, target: int) -> dict[int, int]:
    """Lengths and how often each is taken, for the sum closest to ``target`` from below.

    Bit s of the set says that the sum s can be reached. A count is split into powers of two, so
    that each step shifts the set once; the sets before each step tell on the way back which steps
    the best sum needs.
    """
    reach, mask, steps = 1, (1 << (target + 1)) - 1, []
    for length in np.flatnonzero(counts[: target + 1])[::-1].tolist():
        left, take = min(int(counts[length]), target // length), 1
        while left and not reach >> target & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left, take = left - take, 2 * take
        if reach >> target & 1:
            break
    used: dict[int, int] = {}
    at = reach.bit_length() - 1
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= length * take
    return used


def plan(lengths: list[int], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences, as lists of pieces (document, start, length), for documents of these lengths."""
    items: dict[int, list[tuple[int, int]]] = {}
    counts = np.zeros(window, np.int64)

    def put(doc: int, start: int, length: int) -> None:
        items.setdefault(length, []).append((doc, start))
        counts[length] += 1

    def take(length: int) -> tuple[int, int, int]:
        counts[length] -= 1
        doc, start = items[length].pop()
        return doc, start, length

    for doc, length in enumerate(lengths):
        for start in range(0, length - window + 1, window):
            yield [(doc, start, window)]
        if length % window:
            put(doc, length - length % window, length % window)
    sizes = np.arange(window)
    total = int((counts * sizes).sum())
    while total >= window:
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        used = fill(counts, window - longest)
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        slack = window - sum(k * n for k, n in used.items())
        times = 1 if slack else min(int(counts[k]) // n for k, n in used.items())
        for _ in range(times):
            pieces = [take(k) for k in sorted(used, reverse=True) for _ in range(used[k])]
            if slack:
                doc, start, length = take(int(np.flatnonzero(counts)[-1]))
                pieces.append((doc, start, slack))
                put(doc, start + slack, length - slack)
            yield pieces
        total -= window * times
    rest = [take(int(k)) for k in np.flatnonzero(counts)[::-1] for _ in range(int(counts[k]))]
    while total:
        room = size = 1 << (total.bit_length() - 1)
        pieces = []
        while room:
            doc, start, length = rest.pop(0)
            cut = min(length, room)
            pieces.append((doc, start, cut))
            if cut < length:
                rest.insert(0, (doc, start + cut, length - cut))
            room -= cut
        yield pieces
        total -= size


def _pack(window: int, rows: pa.Table) -> pa.Table:
    # In Arrow an id is never a double, however large and whatever is null beside it.
    ordered = sorted(
        zip(rows.column("doc_id").to_pylist(), rows.column("ids").to_pylist(), strict=True),
        key=lambda r: (r[0] is None, r[0] or 0, r[1]),
    )
    base = rows.column("shard")[0].as_py() << 32
    out: list[list] = [[] for _ in _PIECES]
    for number, pieces in enumerate(plan([len(ids) // 4 for _, ids in ordered], window)):
        offset = 0
        for doc, start, length in pieces:
            doc_id, ids = ordered[doc]
            part = ids[4 * start : 4 * (start + length)]
            for column, value in zip(out, (doc_id, start, length, part, len(ids) // 4, base + number, offset), strict=True):
                column.append(value)
            offset += length
    return pa.table([pa.array(x, f.type) for x, f in zip(out, _PIECES, strict=True)], schema=_PIECES)


def pack(
    docs: DataFrame,
    vocabulary: str,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    cached_words: int = CACHED_WORDS,
) -> DataFrame:
    """One row per piece: where it comes from, its ids, and its place in which sequence.

    Every id of every row of ``docs`` lies in one piece; ``ids`` holds them as little-endian
    32-bit integers. Repeated rows are packed as often as they occur, rows without an id too. Null
    and empty texts hold the end id alone. An empty table gives an empty result. Other columns are
    not read. ``cached_words`` weighs memory against time and changes nothing else.
    """
    rows = tokenized(docs, vocabulary, id_col, text_col, end_id, cached_words)
    return rows.groupBy("shard").applyInArrow(lambda part: _pack(window, part), PIECES)
