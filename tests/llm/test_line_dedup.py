from ledgerloom.llm.line_dedup import line_dedup
from tests.llm.rows import frame, odd, prose


def brute(rows, width=3):
    """Removed line numbers per distinct (id, text), by comparing all windows."""
    first, gone = {}, {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        gone[doc_id, text] = set()
        lines = [(i, " ".join(x.split())) for i, x in enumerate((text or "").split("\n")) if x.split()]
        for k in range(len(lines) - width + 1):
            window = tuple(t for _, t in lines[k : k + width])
            if window in first:
                gone[doc_id, text] |= set(range(lines[k][0], lines[k + width - 1][0] + 1))
            first.setdefault(window, (doc_id, k))
    return gone


def test_later_windows_go(spark):
    licence = "all rights reserved\n\n  by  nobody \nat all\nin any form"
    rows = odd() + [
        (20, f"own one\n{licence}\nown two"), (21, f"{licence}\nsomething"), (22, f"a\nb\nc\na\nb\nc\nd"), (23, "x\nx\nx\nx\nx"),
        (24, "a\nb"), (25, "a\nb"), (26, "by nobody\nat  all\nin any form\nown two\nmore"), (22, f"a\nb\nc\na\nb\nc\nd"),
        (None, f"q\n{licence}"), (27, "\n".join(prose(i % 40, 6) for i in range(4000))),
    ]
    docs = frame(spark, rows)
    out = line_dedup(docs)
    assert out.columns == [c for c in docs.columns if c != "removed_lines"] + ["removed_lines"]
    want = brute(rows)
    got = out.collect()
    assert len(got) == len(rows)
    left = {}
    for doc_id, text in rows:
        lines = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in want[doc_id, text])
        runs = sorted(want[doc_id, text])
        left.setdefault(doc_id, []).append((lines, runs))
    for r in got:
        runs = [i for x in r.removed_lines for i in range(x["first"], x["last"] + 1)]
        assert (r.text, runs) in left[r.doc_id]
        assert r.cid == "x" and r.row == "x"


def test_equal_rows_share_one_fate(spark):
    text = "one\ntwo\nthree"
    got = line_dedup(frame(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, text), (1, text), (2, "")]


def test_empty_table(spark):
    assert line_dedup(frame(spark, [])).count() == 0
