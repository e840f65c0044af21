import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.exact_dedup import _levels, _slots, exact_dedup
from tests.llm.rows import frame, odd, prose


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


ROWS = odd(100) + [
    (7, "a b c"), (3, "ab c"), (5, "abc\n"), (5, "abc\n"), (8, "abc  d"), (9, "ABC"), (2, prose(1, 50)), (1, prose(1, 50) + " "),
    *[(1000 + i, "the same " * (1 + i % 3)) for i in range(60)],
]


BIG = 2**53 + 1
# Rows without an id on either side of the history, longer and shorter ones, beside very large ids.
ROWS += [(BIG, "q1"), (BIG + 1, "q 1"), (None, "q  1"), (None, "q2  "), (BIG, "q2"), (None, "q3"), (None, "q 3"), (BIG + 2, "q4"), (None, "z")]


@pytest.mark.parametrize("history", ["false", "true", "doc_id % 2 = 0", "doc_id > 900", "doc_id IS NULL", "doc_id IS NOT NULL", "doc_id % 2 = 1"])
def test_groups_do_not_depend_on_what_was_seen_before(spark, history):
    got = exact_dedup(frame(spark, ROWS), F.expr(history), shard_digests=5).collect()
    assert len(got) == len(ROWS)
    groups = {}
    for doc_id, text in ROWS:
        groups.setdefault(normal(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    want = sorted(
        ((i, min(g)[3], len(g), min(g)[3] == i, hashlib.sha256(t.encode()).digest()) for t, g in groups.items() for _, _, _, i in g),
        key=str,
    )
    assert sorted(((r.id, r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in got), key=str) == want


def test_seen_marks_repeats_of_the_history(spark):
    rows = [(0, "old"), (1, "o ld"), (2, "new"), (3, "n e w")]
    got = {r.id: (r.seen, r.keep_id) for r in exact_dedup(frame(spark, rows), F.col("doc_id") == 0).collect()}
    assert got == {0: (True, 1), 1: (True, 1), 2: (False, 3), 3: (False, 3)}


def test_slots_are_minimal_and_perfect():
    import numpy as np

    keys = np.frombuffer(b"".join(hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(3000)), "<u8").reshape(-1, 4)
    assert sorted(_slots(_levels(keys), keys)) == list(range(3000))


def test_empty_table(spark):
    assert exact_dedup(frame(spark, []), F.lit(True)).count() == 0
