import re

from ledgerloom.llm.host_rules import host_rules
from tests.llm.rows import frame, odd, prose

WORD = r"[^\x20\x09-\x0D]+"


def measured(text):
    text = text or ""
    words = re.findall(WORD, text)
    seen, covered = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(i + k for i in places for k in range(5))
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def test_measures_equal_brute_force(spark):
    rows = odd() + [
        (20, "a b c d e f a b c d e g h i j a b c d e"), (21, "x " * 40), (22, "é # * | ok\né # * | ok\n\n  \nend"),
        (23, prose(1, 100)), (23, prose(1, 100)), (24, prose(2, 30) + " " + prose(2, 30)), (25, "a b c d e a b c d"),
    ]
    got = host_rules(frame(spark, rows)).collect()
    have = sorted(
        ((r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str
    )
    assert have == sorted(((i, *measured(t)) for i, t in rows), key=str)


def test_a_host_of_failures_takes_its_other_documents_along(spark):
    good = [(i, prose(i, 60), "en", f"good{i % 5}") for i in range(200)]
    bad = [(1000 + i, "too short", "en", "bad") for i in range(60)] + [(2000, prose(5000, 60), "en", "bad")]
    alone = [(3000, prose(5001, 60), "en", None), (3001, "short", "en", None), (3002, "short", "en", "tiny"), (3003, prose(5002, 60), "en", "tiny")]
    kept = {r.id: r.kept for r in host_rules(frame(spark, good + bad + alone)).collect()}
    assert all(kept[i] for i in range(200))
    assert not any(kept[1000 + i] for i in range(60)) and not kept[2000]
    assert kept[3000] and not kept[3001]
    # One failure of two is no record yet: the rate is shrunk towards that of all hosts.
    assert not kept[3002] and kept[3003]


def test_empty_table(spark):
    assert host_rules(frame(spark, [])).count() == 0
