import hashlib
import re

from ledgerloom.llm.pii import BLOCK, CONFIDENCE, EDGES, GROUP, GROUPS, KINDS, ROUNDS, SELECTIVE, SUPPORT, personal_data
from tests.llm.rows import frame, odd, prose

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = [True, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")), 16 <= len(digits) <= 19 and luhn(digits), 8 <= len(digits) <= 15]
            if good[kind]:
                out.append((kind, m.start(), m.end()))
    return out


STRANGE = [
    "a@b.co x@y a.b@c.d.e.f..g %@-.- a@b.co%d@e.f.g@h.i @@a@b", "1.2.3.4 256.1.1.1 001.02.3.255.9 1.2.3.4.5.6.7.8 1..2.3.4 0.0.0.0000",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111111 4111  111111111111 4111111111111111 4111111111111112 " + "1 " * 3000,
    "+1 (456) 555-2186, +49 30 1234 5678 9012 345 + 1 234 +1234567 +12345678 ++12345678 +1 (2", "é日本 a@b.co ü 😀 1.2.3.4 é +12345678",
    "a" * 30_000 + "@" + "b" * 10, "1" * 30_000, "1." * 10_000, "+" * 5000 + "1" + " " * 5000, "x" * 20_000 + "9",
]


def test_base_finds_equal_brute_force(spark):
    rows = odd() + [(20 + i, t) for i, t in enumerate(STRANGE)] + [(20, STRANGE[0])]
    got = personal_data(frame(spark, rows)).collect()
    have = sorted(((r.id, [(s.kind, s.start, s.end) for s in r.base]) for r in got), key=str)
    assert have == sorted(((i, base(t)) for i, t in rows), key=str)
    for r in got:
        assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans} and r.spans == sorted(r.spans)


def test_contexts_of_finds_discover_others(spark):
    rows = [(i, f"{prose(i, 20)} reach me by mail user{i}@host{i}.example.com or {prose(900 + i, 5)}") for i in range(12)]
    rows += [(100 + i, f"{prose(i, 9)} the number {i}000 and number {i + 7}77 as well") for i in range(12)]
    rows += [(200, "please reach me by mail user77(at)host.example, thanks"), (201, "the number 55-77 is nothing")]
    found = {r.id: r for r in personal_data(frame(spark, rows + odd(300))).collect()}
    new = [s for s in found[200].spans if s not in found[200].base]
    assert [(KINDS[s.kind], s.value) for s in new] == [("email", "user77(at)host.example")]
    text = dict(rows)[200]
    assert text[new[0].start : new[0].end] == "user77(at)host.example"
    assert not found[201].spans
    assert all(len(found[i].spans) == 1 for i in range(12))


def test_rare_contexts_discover_nothing(spark):
    rows = [(1, "by mail a1@b.co"), (2, "by mail c2@d.co"), (3, "by mail e3-at-f")]
    assert not [r for r in personal_data(frame(spark, rows)).collect() if r.id == 3 and r.spans]


def plain_contexts(words, i):
    names = [re.sub("[0-9]+", "#", w.lower()) for w in words[max(0, i - 2) : i]]
    return ([(names[-1],)] if names else []) + ([tuple(names)] if len(names) == 2 else [])


def plain_spans(rows):
    """All finds of each row, discovered ones too, without Spark and with exact counts."""
    seeds, opened, behind = {}, {}, {}
    group = re.compile(GROUP)
    texts = [(i, t or "") for i, t in rows]
    for n, (_, text) in enumerate(texts):
        marks = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
        words = [m[0] for m in marks]
        covered = set()
        for kind, start, end in base(text):
            at = [j for j, m in enumerate(marks) if m.start() < end and start < m.end()]
            covered |= set(at)
            for p in plain_contexts(words, at[0]):
                seeds.setdefault(p, {}).setdefault(text[start:end].lower(), set()).add(kind)
        for j, word in enumerate(words):
            for p in plain_contexts(words, j):
                behind.setdefault(p, set()).add(word.strip(EDGES).lower())

        def grouped(j):
            return 0 <= j < len(words) and bool(group.match(words[j].strip(",;:!?")))

        def joined(j):
            return grouped(j - 1) and grouped(j) and text[marks[j - 1].end() : marks[j].start()] == " " and words[j - 1][-1] in "0123456789)"

        for j in range(len(words)):
            if joined(j):
                continue
            last = j
            while grouped(j) and last - j < GROUPS - 1 and joined(last + 1):
                last += 1
            value = text[marks[j].start() : marks[last].end()]
            start = marks[j].start() + len(value) - len(value.lstrip(EDGES))
            if value.strip(EDGES) and not covered & set(range(j, last + 1)):
                for p in plain_contexts(words, j):
                    opened.setdefault(p, []).append((n, start, value.strip(EDGES)))
    known = [p for p in seeds if len(seeds[p]) >= SUPPORT and len(seeds[p]) >= SELECTIVE * len(behind[p])]
    edges = {(p, v): [float(k in ks) for k in range(4)] for p in known for v, ks in seeds[p].items()}
    free = {(p, v.lower()) for p in known for _, _, v in opened.get(p, [])} - set(edges)
    edges |= {e: [0.0] * 4 for e in free}

    def score():
        sums = {}
        for (p, _), s in edges.items():
            n, t = sums.get(p, (0, [0.0] * 4))
            sums[p] = (n + 1, [a + b for a, b in zip(t, s)])
        return {p: [x / (n + 0.5) if x >= SUPPORT else 0.0 for x in t] for p, (n, t) in sums.items()}

    for _ in range(ROUNDS):
        c = score()
        for p, v in free:
            doubt = [1.0] * 4
            for q, w in free:
                if w == v and q != p:
                    doubt = [d * (1 - min(x, 0.999)) for d, x in zip(doubt, c[q])]
            edges[p, v] = [1 - d for d in doubt]
    trusted = {p: (max(c), c.index(max(c))) for p, c in score().items() if max(c) >= CONFIDENCE}
    best = {}
    for p, (confidence, kind) in trusted.items():
        for n, start, value in opened.get(p, []):
            best.setdefault((n, start, value), []).append((confidence, -kind))
    out = [[i, [(k, s, e, t[s:e]) for k, s, e in base(t)]] for i, t in texts]
    for (n, start, value), found in best.items():
        out[n][1].append((-max(found)[1], start, start + len(value), value))
    return sorted([(i, sorted(spans)) for i, spans in out], key=str)


def test_all_finds_equal_a_plain_version(spark):
    rows = [(i, f"{prose(i, i % 5 * 40)} Reach me by  mail: user{i}@host{i}.example.com, or {prose(900 + i, 5)}") for i in range(14)]
    rows += [(50 + i, f"{prose(i, BLOCK - 3 + i)} please call +1 (743) 555-{3824 + i} {prose(i, 3)}\nsee 10.0.0.{i} and 10.1.0.{i}") for i in range(14)]
    rows += [
        (100, f"{prose(1, 2 * BLOCK)} reach me by mail: jane(at)host.example. {prose(2, 4)}"),
        (101, "please call 0555 123 4567, or please call (0555) 123 4567 12  99 now"), (102, "please\tcall\n0555"),
        (103, "please call " + " ".join(["12"] * 50)), (104, "please call ... and please call +1 (743) 555-9999 77"),
        (105, "mail: x é😀 mail: münchen@ü mail: (bob.at.home)"), (101, "please call 0555 123 4567, or please call (0555) 123 4567 12  99 now"),
        (None, "please call 0666 12"), (106, "please call"), (107, "please"),
    ] + odd(300)
    got = sorted(((r.id, [tuple(s) for s in r.spans]) for r in personal_data(frame(spark, rows)).collect()), key=str)
    want = plain_spans(rows)
    assert got == want
    values = {}
    for i, spans in got:
        values.setdefault(i, set()).update(v for *_, v in spans)
    assert "jane(at)host.example" in values[100]
    assert {"0555 123 4567", "0555) 123 4567 12"} <= values[101] and "0555" in values[102] and "0666 12" in values[None]


def test_empty_table(spark):
    assert personal_data(frame(spark, [])).count() == 0
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
