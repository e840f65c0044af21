import random

from pyspark.sql import functions as F

from ledgerloom.llm.revisit import canonical, resolve

SCHEMA = "record_id long, url string, ts long, full boolean, headers map<string,string>, key string, status string, refers_to long"


def records(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1) for r in rows], SCHEMA)


def test_canonical_urls(spark):
    same = [
        "http://www.Example.com/a/?b=2&a=1#top", "https://user@example.com:443/a?a=1&b=2&utm_source=x", " HTTP://EXAMPLE.com:80/a/?a=1&&b=2",
    ]
    other = ["http://example.com/A?a=1&b=2", "http://example.com/a?a=1", "http://example.com:81/a?a=1&b=2"]
    got = [r.k for r in spark.createDataFrame([(u,) for u in [*same, *other, None, ""]], "u string").select(canonical(F.col("u")).alias("k")).collect()]
    assert set(got[:3]) == {"example.com/a?a=1&b=2"}
    assert len(set(got[2:6])) == 4 and got[6] is None and got[7] == ""


def test_validators_and_headers(spark):
    stored = {"ETag": '"v1"', "Last-Modified": "monday", "Content-Type": "text/html", "Content-Length": "9", "Date": "1"}
    rows = [
        (1, "http://h/p", 10, True, stored),
        (2, "http://H/p#x", 11, False, {"etag": 'W/"v1"', "DATE": "2", "Content-Length": "0", "Set-Cookie": "c", "Expires": "3"}),
        (3, "http://h/p", 12, False, {"etag": '"v2"'}),
        (4, "http://h/p", 13, False, {"last-modified": "monday"}),
        (5, "http://h/p", 14, False, {"last-modified": "friday"}),
        (6, "http://h/p", 15, False, {"date": "4"}),
        (7, "http://h/p", 10, False, {"etag": '"v1"'}),
        (8, "http://h/q", 15, False, None),
        (9, None, 15, False, {"etag": '"v1"'}),
        (10, "http://h/p", None, False, {"etag": None}),
        (11, "http://h/p", 16, None, stored),
        (12, "http://h/r", 1, True, None),
        (13, "http://h/r", 2, False, {"etag": '"v1"'}),
        (2, "http://H/p#x", 11, False, {"etag": 'W/"v1"', "DATE": "2", "Content-Length": "0", "Set-Cookie": "c", "Expires": "3"}),
    ]
    got = {r.record_id: r for r in resolve(records(spark, rows)).collect()}
    assert {k: (r.status, r.refers_to) for k, r in got.items()} == {
        2: ("resolved", 1), 3: ("validator_mismatch", 1), 4: ("resolved", 1), 5: ("validator_mismatch", 1), 6: ("no_validator", 1),
        7: ("no_prior", None), 8: ("no_prior", None), 9: ("no_prior", None), 10: ("no_prior", None), 13: ("validator_mismatch", 12),
    }
    assert [(h.name, h.value) for h in got[2].headers] == [
        ("content-length", "9"), ("content-type", "text/html"), ("date", "2"), ("etag", 'W/"v1"'), ("expires", "3"), ("last-modified", "monday"),
    ]
    assert got[3].headers is None


def test_the_latest_earlier_response_also_of_a_hot_url(spark):
    draw = random.Random(2)
    rows = [(i, f"http://h/{'hot' if draw.random() < 0.7 else draw.randrange(20)}", draw.randrange(300), draw.random() < 0.1, {}) for i in range(3000)]
    got = {r.record_id: r.refers_to for r in resolve(records(spark, rows).repartition(6)).collect()}
    for i, url, ts, full, _ in rows:
        if not full:
            want = max(((t, k) for k, u, t, f, _ in rows if f and u == url and t < ts), default=(None, None))[1]
            assert got[i] == want


def test_empty_table(spark):
    assert resolve(records(spark, [])).count() == 0
