import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.packing import WordIds, fill, pack, plan
from tests.llm.rows import frame, odd, prose

public_tokenizers = pytest.importorskip("public_tokenizers")


def ids_of(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_every_id_lies_in_one_piece_and_sequences_are_full(spark):
    strange = "It's AND don't, we'll. x.y É été. ÀÇ, ß. µ ½ 12.5 a<|endoftext|>b İ ﬁ é  z 日本, naïve!? A. ,. ''s"
    rows = odd() + [(10, strange), (10, strange), (11, prose(3, 5000)), *[(50 + i, prose(i, 5 + 37 * i % 900)) for i in range(80)]]
    got = pack(frame(spark, rows), public_tokenizers.path("word_bpe_49k.json"), window=256).collect()
    want = sorted(sum((ids_of(t) for _, t in rows), []))
    assert sorted(np.frombuffer(b"".join(bytes(r.ids) for r in got), "<u4").tolist()) == want
    for doc_id, text in rows:
        if doc_id != 10:
            pieces = sorted((r for r in got if r.doc_id == doc_id), key=lambda r: r.start)
            assert np.frombuffer(b"".join(bytes(r.ids) for r in pieces), "<u4").tolist() == ids_of(text)
            assert [r.start for r in pieces] == [0, *itertools.accumulate(r.length for r in pieces)][:-1]
            assert {r.doc_tokens for r in pieces} == {len(ids_of(text))}
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [0, *itertools.accumulate(n for _, n in places)][:-1]
        total = sum(n for _, n in places)
        assert total <= 256 and total & (total - 1) == 0


def test_fill_comes_as_close_as_any_choice():
    draw = random.Random(4)
    for _ in range(200):
        counts = np.zeros(40, np.int64)
        for _ in range(draw.randrange(1, 7)):
            counts[draw.randrange(1, 40)] += draw.randrange(1, 4)
        target = draw.randrange(1, 60)
        items = [k for k in range(40) for _ in range(counts[k])]
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums if s + x <= target}
        used = fill(counts, target)
        assert sum(k * n for k, n in used.items()) == max(sums)
        assert all(n <= counts[k] for k, n in used.items())


def test_plan_cuts_little():
    draw = random.Random(5)
    for longest, cuts in ((300, 0.02), (6000, 0.5)):
        lengths = [draw.randrange(1, longest) for _ in range(600)]
        pieces = [len(p) for p in plan(lengths, 2048)]
        assert sum(pieces) <= sum(-(-x // 2048) for x in lengths) + cuts * len(pieces) + 12


def test_same_sequences_however_rows_come(spark):
    rows = [(i, prose(i, 20 + i)) for i in range(100)]
    path = public_tokenizers.path("word_bpe_49k.json")
    a, b = (pack(f, path, 128).drop("ids").orderBy(F.col("sequence_id"), "offset").collect() for f in (frame(spark, rows), frame(spark, rows[::-1]).repartition(7)))
    assert a == b


def test_empty_table(spark):
    assert pack(frame(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_ids_stay_whole_numbers_beside_null(spark):
    rows = [(2**53 + 1, "a b"), (None, "c"), (2**60 + 1, None)]
    got = pack(frame(spark, rows), public_tokenizers.path("word_bpe_49k.json")).collect()
    assert {r.doc_id for r in got} == {2**53 + 1, None, 2**60 + 1}


def test_a_vocabulary_that_keeps_white_space_takes_whole_texts(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(1, "Hello  world,\nit's A test."), (2, "  x y"), (3, None)]
    tokenizer = Tokenizer.from_file(path)
    for r in pack(frame(spark, rows), path).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "ids"))).alias("p")).collect():
        want = [*tokenizer.encode(dict(rows)[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert np.frombuffer(b"".join(bytes(x.ids) for x in r.p), "<u4").tolist() == want
    assert WordIds(public_tokenizers.path("word_bpe_49k.json"), 10).by_word and not WordIds(path, 10).by_word


def test_a_run_of_signs_behind_letters_is_tokenized_once():
    path = public_tokenizers.path("word_bpe_49k.json")
    words = WordIds(path, 1000)
    text = "Heat$$$ heat$$$ are.*** Eat&&& \u00c9t\u00e9%%% x!? b-- a_ c`^ it's$$ <|endoftext|>. d.e$$$ 1$$$ $$$ q<|endoftext|>$$"
    assert np.frombuffer(words.text(text.encode()), "<u4").tolist() == ids_of(text)[:-1]
    asked = []
    words.whole = lambda texts: asked.extend(texts) or WordIds.whole(words, texts)
    many = "".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{m} " for i in range(200) for m in ("$$$", "%%%", ".###"))
    assert np.frombuffer(words.text(many.encode()), "<u4").tolist() == ids_of(many)[:-1]
    assert sorted(asked) == [".###"]


def test_no_more_words_are_kept_than_allowed():
    words = WordIds(public_tokenizers.path("word_bpe_49k.json"), 50)
    text = prose(3, 2000)
    assert np.frombuffer(words.text(text.encode()), "<u4").tolist() == ids_of(text)[:-1]
    assert len(words) <= 50 and len(words.letters) <= 50
