"""Facts of the remaining operators: frames, recovery, counters, profiling, scrubbing, order."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import frames, metrics, pit, profile, recovery, scrub
from ledgerloom.operators.scan import with_row_index, with_running_sum
from ledgerloom.operators.sinks import append_raw, write_captures, write_dataset
from ledgerloom.plans.recover import recover
from ledgerloom.sources import raw as raws

SUBS = [(1, "P1"), (2, "P2")]


def _frames(spark, *texts):
    rows = [(t if isinstance(t, str) else json.dumps(t),) for t in texts]
    return frames.classify_frames(
        spark.createDataFrame(rows, "value string").withColumn(
            "received_at", F.timestamp_seconds(F.lit(0)))
    )


def _subs(spark):
    return spark.createDataFrame(SUBS, "subscription_id bigint, program_id string")


def _log(value, subscription=1, context=None):
    return {"method": "logsNotification", "params": {
        "subscription": subscription,
        "result": {"context": {"slot": 3} if context is None else context, "value": value}}}


def _block(value, subscription=1):
    return {"method": "blockNotification", "params": {
        "subscription": subscription, "result": {"context": {"slot": 9}, "value": value}}}


def test_frame_classes(spark):
    cases = [
        (_log({"signature": "s", "err": None, "logs": []}), (True, True)),
        (_log({"signature": "s", "err": {"x": 1}, "logs": []}), (True, False)),
        (_log({"signature": "s", "logs": []}), (True, None)),
        (_log({"signature": "", "err": None}), (True, None)),
        (_block({}), (True, None)),
        ({"jsonrpc": "2.0", "id": 1, "result": 5}, (False, None)),
        ("not json", (False, None)),
        ("[]", (False, None)),
        ('"logsNotification"', (False, None)),
    ]
    rows = _frames(spark, *[c for c, _ in cases]).collect()
    assert [(r.is_notification, r.log_ok) for r in rows] == [want for _, want in cases]
    counts = metrics.arrival_counters(_frames(spark, *[c for c, _ in cases[:2]], cases[5][0]))
    row = counts.first()
    assert (row.ws_messages_received, row.ws_notifications_received,
            row.ws_notifications_enqueued, row.failed_log_notifications_skipped,
            row.ws_non_notification_messages_received) == (3, 2, 1, 1, 1)


def _entry(*signatures, **more):
    return {"transaction": {"signatures": list(signatures)}, "meta": {"n": 1.5}, **more}


def test_blocks_keep_failed_mentions_and_count_every_entry(spark):
    entries = [_entry("no", version="legacy"), _entry(), {"transaction": ["raw", "base64"]},
               _entry("yes", "other", version=0)]
    good = _block({"slot": 7, "block": {"blockTime": 5, "transactions": entries}})
    rows = frames.transactions_of_blocks(_frames(spark, good), _subs(spark), "p").collect()
    assert [(r.signature, r.transaction_index, r.slot) for r in rows] == [("no", 0, 7),
                                                                         ("yes", 3, 7)]
    doc = json.loads(rows[0].rpc_transaction)
    assert doc == {"slot": 7, "blockTime": 5, "transaction": {"signatures": ["no"]},
                   "meta": {"n": 1.5}, "version": "legacy"}
    zero = _block({"slot": 0, "block": {"transactions": [_entry("z")]}})
    row = frames.transactions_of_blocks(_frames(spark, zero), _subs(spark), "p").first()
    assert (row.slot, row.block_time) == (9, None)
    assert json.loads(row.rpc_transaction)["version"] is None
    unknown = _block({"slot": 1, "block": {"transactions": [_entry("u")]}}, 99)
    assert frames.transactions_of_blocks(_frames(spark, unknown), _subs(spark), "p").count() == 0
    for bad in ({"err": "x", "block": {"transactions": [_entry("b")]}}, {"block": None}):
        problem = _frames(spark, _block(bad)).select(frames.block_problem(F.col("doc"))).first()[0]
        assert problem.startswith("blockSubscribe error: ")
    with pytest.raises(Exception, match="blockSubscribe error"):
        frames.transactions_of_blocks(
            _frames(spark, _block({"err": "x", "block": {"transactions": [_entry("b")]}})),
            _subs(spark), "p").collect()


def test_log_rows_and_their_guards(spark):
    good = _log({"signature": "s", "err": None, "logs": ["a", "b"]}, 2, {"slot": 4, "v": 1})
    failed = _log({"signature": "f", "err": 1, "logs": []})
    row = frames.logs_of_notifications(_frames(spark, good, failed), _subs(spark), "p").collect()
    assert [(r.signature, r.source_program, r.slot, r.logs, r.err) for r in row] == [
        ("s", "P2", 4, ["a", "b"], None)]
    assert json.loads(row[0].rpc_context) == {"slot": 4, "v": 1}
    assert frames.skipped_failed(_frames(spark, good, failed)).first()[0] == 1
    for bad, match in [
        (_log({"signature": "s", "err": None, "logs": "x"}), "malformed"),
        (_log({"signature": "s", "err": None, "logs": [1]}), "malformed"),
        (_log({"err": None, "logs": []}), "malformed"),
        (_log({"signature": "s", "err": None, "logs": []}, 1, {"x": 1}), "context.slot"),
        (_log({"signature": "s", "err": None, "logs": []}, 7), "unknown subscription 7"),
    ]:
        with pytest.raises(Exception, match=match):
            frames.logs_of_notifications(_frames(spark, bad), _subs(spark), "p").collect()


def _listing(spark, rows):
    return spark.createDataFrame(
        rows, "program_id string, position bigint, signature string, slot bigint, err string")


def _marks(spark, *rows):
    return spark.createDataFrame(
        list(rows), "program_id string, last_signature string, last_slot bigint"
    ).withColumn("updated_at", F.timestamp_seconds(F.lit(0)))


def _observed(spark, *rows):
    return spark.createDataFrame(list(rows), "signature string, program_id string")


LIST = [("p", 0, "c", 12, None), ("p", 1, "bad", 11, "x"), ("p", 2, "b", 11, None),
        ("p", 3, "a", 10, None), ("p", 4, "old", 9, None)]


def test_recovery(spark):
    listing, marks = _listing(spark, LIST), _marks(spark, ("p", "old", 9))
    seen = _observed(spark, ("a", "p"), ("b", "q"))
    rows = recovery.missing_signatures(listing, marks, seen, 10)
    assert [r.signature for r in rows.orderBy("replay_rank").collect()] == ["b", "c"]
    assert recovery.missing_signatures(listing, marks, seen, 0).count() == 0
    assert recovery.missing_signatures(listing, _marks(spark), seen, 10).count() == 0
    unlisted = _marks(spark, ("p", "gone", 1))
    assert recovery.listed_counts(listing, unlisted).first().listed == 5
    counts = recovery.listed_counts(listing, marks).first()
    assert (counts.listed, counts.failed_skipped) == (4, 1)
    with pytest.raises(recovery.RecoveryLimitExceeded):  # failed ones count towards the cap
        recovery.missing_signatures(listing, marks, seen, 3)
    first = recovery.start_boundary(listing, _marks(spark)).first()
    assert (first.last_signature, first.last_slot) == ("c", 12)
    assert recovery.start_boundary(listing, marks).count() == 0


def test_recover_job_stops_before_the_checkpoint_moves(spark):
    listing, marks = _listing(spark, LIST), _marks(spark, ("p", "old", 9))
    body = '{"slot":%d,"blockTime":7,"meta":{"err":null,"logMessages":["l"]}}'
    have = [("a", body % 10), ("b", body % 11), ("c", body % 12)]

    def fetched(rows):
        return spark.createDataFrame(rows, "signature string, result string").withColumn(
            "received_at", F.timestamp_seconds(F.lit(1)))

    rows, moved = recover(listing, fetched(have), marks, _observed(spark), "p", 10)
    assert {(r.signature, r.slot, r.transaction_index) for r in rows.collect()} == {
        ("a", 10, None), ("b", 11, None), ("c", 12, None)}
    assert moved.first().last_signature == "c"
    for hole in (have[:2], [*have[:2], ("c", None)]):
        with pytest.raises(recovery.TransactionUnavailable, match="signature c"):
            recover(listing, fetched(hole), marks, _observed(spark), "p", 10)


def test_counters_merge_by_rule(spark):
    def updates(rows):
        return spark.createDataFrame(
            rows, "key string, rule string, value bigint, version bigint")

    empty = spark.createDataFrame([], "key string, rule string, value bigint")
    stored = metrics.merge_counters(empty, updates(
        [("i", "increment", 11, 0), ("g", "gauge", 40, 0), ("m", "maximum", 40, 0),
         ("zero", "increment", 0, 0)]))
    merged = metrics.merge_counters(stored, updates(
        [("i", "increment", 8, 0), ("g", "gauge", 17, 0), ("m", "maximum", 17, 0)]))
    assert {r.key: r.value for r in merged.collect()} == {"i": 19, "g": 17, "m": 40}


def test_running_sums_do_not_depend_on_the_block(spark):
    df = spark.range(0, 3000, 3).withColumn("v", F.col("id") % 7 - 3)
    want, total = [], 0
    for i in range(0, 3000, 3):
        total += i % 7 - 3
        want.append(total)
    for block in (1, 10, 64, 1 << 20):
        rows = with_running_sum(df, F.col("v"), "id", "s", block).orderBy("id").collect()
        assert [r.s for r in rows] == want
        index = with_row_index(df, "id", "i", block).orderBy("id").collect()
        assert [r.i for r in index] == list(range(1000))


def test_ema_and_backlog(spark):
    n, step = 120_000, 1000  # more flushes than one EMA block
    df = spark.range(n).select(
        "id", (F.col("id") * step + (F.col("id") % 13) * 7).alias("us"),
        ((F.col("id") / 100).cast("int") % 3 > 0).alias("ok"))
    flushes = metrics.flush_rates(df, "id", "us", "ok", started_us=0, block=1 << 14)
    got = {r.flush: r.ema_millirps for r in metrics.ema_rates(flushes).collect()}
    rate = {r.flush: r.rate for r in flushes.collect()}
    ema, want = None, {}
    for i in range(n // 100):
        ema = rate[i] if ema is None else 0.2 * rate[i] + 0.8 * ema
        want[i] = round(1000 * ema)
    assert got == want
    sized = metrics.backlog(spark.createDataFrame(
        [(1, 1), (2, 1), (3, -1), (4, 1), (5, 1)], "n bigint, change int"), "n")
    row = metrics.high_watermark(sized, "n").first()
    assert (row.ws_queue_high_watermark, row.ws_queue_current_size) == (3, 3)
    metrics.check_capacity(sized, 3)
    with pytest.raises(metrics.BacklogOverflow):
        metrics.check_capacity(sized, 2)


def test_profile(spark):
    docs = ['{"mint":"m","owner":"o","market":{"open":true},"spread":0.25,"a/b~":[{"x":1}]}',
            '{"mint":"n","market":{"open":null},"Mint":1e2,"a/b~":[1,{"x":99999999999999999999}]}',
            '7', 'broken']
    df = spark.createDataFrame([(d,) for d in docs], "payload string")
    nodes = profile.json_nodes(df).cache()
    stats = {r.path: r for r in profile.field_stats(nodes).collect()}
    assert stats["$/mint"].always_when_parent_is_object and stats["$/owner"].missing == 1
    flag = stats["$/market/open"]
    assert (flag.n_boolean, flag.n_null, flag.parent_object_occurrences) == (1, 1, 2)
    assert stats["$/spread"].n_number == 1 and stats["$/Mint"].n_number == 1
    assert stats["$/a~1b~0/*/x"].n_integer == 2
    assert {r.json_type: r.documents for r in profile.root_types(nodes).collect()} == {
        "object": 2, "integer": 1}
    found = {r.name: r.paths for r in profile.requested_fields(nodes).collect()}
    assert found["mint"] == ["$/Mint", "$/mint"] and found["signature"] == []
    shapes = profile.top_level_shapes(df).collect()
    assert sorted(r.keys for r in shapes)[0] == ["Mint", "a/b~", "market", "mint"]
    frames_ = spark.createDataFrame(
        [(bytearray(b'{"a": 1}'),), (bytearray(b"\xc3\x28"),), (bytearray(b"{"),)], "raw binary")
    assert [r.problem for r in profile.validate_frames(frames_).collect()] == [
        None, "received a non-UTF-8 binary frame", "received a frame that is not valid JSON"]


def test_captures_are_verbatim_and_never_overwritten(spark, tmp_path):
    text = '{ "a" : 1.0,  "b":"é" }'
    df = spark.createDataFrame([(text,)], "payload string").withColumn(
        "received_at", F.timestamp_seconds(F.lit(1)))
    path = str(tmp_path / "cap")
    write_captures(df, path)
    got = raws.read_captures(spark, path)
    assert got.first().payload == text
    assert profile.capture_totals(got).first().bytes_received == len(text.encode())
    with pytest.raises(Exception, match="already exists"):
        write_captures(df, path)


def _one(spark, text, fn):
    return spark.createDataFrame([(text,)], "u string").select(fn(F.col("u"))).first()[0]


@pytest.mark.parametrize(("url", "want"), [
    ("https://h/?api-key=hush42", "https://h/?api-key=REDACTED"),
    ("https://h/v2/hush42", "https://h/v2/REDACTED"),
    ("HTTPS://h/p?b=2&TOKEN=x&a=%41+z&flag&a=#f", "https://h/p?b=2&TOKEN=REDACTED&a=A z&flag=&a=#f"),
    ("wss://u:p@h:8/v2/k?", "wss://u:p@h:8/v2/REDACTED"),
    ("v2/k", "v2/k"),
    ("https://h/v2/", "https://h/v2/"),
    ("/x?key=1&&q=100%", "/x?key=REDACTED&q=100%"),
    ("https:///x", "https:///x"),
])
def test_redact_url(spark, url, want):
    assert _one(spark, url, scrub.redact_url) == want


def test_redact_text_and_nested_values(spark):
    text = "GET https://h/v2/abc?x=1 and \"wss://h?API_KEY=s3cret&y=2#z\" 'k?token=a b'"
    want = "GET https://h/v2/REDACTED?x=1 and \"wss://h?API_KEY=REDACTED&y=2#z\" 'k?token=REDACTED b'"
    assert _one(spark, text, scrub.redact_text) == want
    df = spark.createDataFrame(
        [(1, ["?key=a", None], {"?key=k": "?key=v"}, ("?key=s", 2), None)],
        "n int, a array<string>, m map<string,string>, s struct<t: string, i: int>, z struct<t: string>")
    row = scrub.redact_columns(df, "n", "a", "m", "s", "z").first()
    assert (row.n, row.a, row.m, tuple(row.s), row.z) == (
        1, ["?key=REDACTED", None], {"?key=k": "?key=REDACTED"}, ("?key=REDACTED", 2), None)


def test_known_secrets(spark):
    urls = spark.createDataFrame(
        [("https://h/v2/path77?api-key=sek%20ret&x=1",), ("",), (None,)], "url string")
    secrets = scrub.known_secrets(urls)
    clean = _one(spark, "sek ret path77 https://h/v2/path77?x keep",
                 lambda c: scrub.remove_known_secrets(c, secrets))
    assert clean == "REDACTED REDACTED https://h/v2/REDACTED?x keep"
    nested = spark.createDataFrame([("https://h?key=ab",), ("https://h?key=abcd",)], "url string")
    for parts in (1, 3):
        inner = scrub.known_secrets(nested.repartition(parts))
        assert _one(spark, "abcd ab", lambda c: scrub.remove_known_secrets(c, inner)) == "REDACTED REDACTED"
    many = [(f"secret-{i}", "*") for i in range(10_000)]
    assert _one(spark, "a secret-9999 b", lambda c: scrub.remove_known_secrets(c, many)) in ("a * b", "a *999 b", "a *9999 b", "a *99 b", "a *9 b")


@pytest.mark.parametrize(("url", "websocket", "problem"), [
    ("https://h", False, None), ("http://h", False, "https"), ("wss://h/x", True, None),
    ("ws://h", True, "wss"), ("https://", False, "hostname"), ("https://:80", False, "hostname"),
    ("https://u@h", False, "userinfo"), ("https://[::1]:8", False, None), ("h", False, "https"),
])
def test_url_problems(spark, url, websocket, problem):
    got = _one(spark, url, lambda c: scrub.url_problem(c, websocket))
    assert got is None if problem is None else problem in got


def test_asof_join_equals_brute_force_for_any_block(spark):
    import random

    rng = random.Random(3)
    left = [(i, rng.choice("aab"), rng.randrange(200)) for i in range(300)]
    right = [(k, o, f"{k}{o}") for k in "ab" for o in rng.sample(range(200), 25)]
    ldf = spark.createDataFrame(left, "i int, k string, o bigint")
    rdf = spark.createDataFrame(right, "k string, o bigint, v string")
    want = {}
    for i, k, o in left:
        known = [(ro, v) for rk, ro, v in right if rk == k and ro <= o]
        want[i] = max(known)[1] if known else None
    for block in (1, 16, 1000):
        got = {r.i: r.v for r in pit.asof_join(ldf, rdf, "k", "o", "v", block).collect()}
        assert got == want


def test_units_are_exact(spark):
    df = spark.createDataFrame([("18446744073709551615", 9), ("1", 18)], "r string, d int")
    rows = df.select(pit.unit_amount(F.col("r").cast("decimal(20,0)"), F.col("d"))).collect()
    assert [f"{r[0]:f}" for r in rows] == [
        "18446744073.709551615000000000", "0.000000000000000001"]
    far = spark.createDataFrame([("120", 30), ("7", 0), ("1234", 2), (None, 3), ("5", None)], "r string, d int")
    raw = F.col("r").cast("decimal(20,0)")
    got = far.select(pit.unit_amount(raw, F.col("d")), pit.unit_text(raw, F.col("d"))).collect()
    assert got[0][0] is None and [r[1] for r in got] == [
        "0." + "0" * 27 + "120", "7", "12.34", None, None]


def test_raw_append_and_datasets(spark, tmp_path):
    row = {"source_provider": "p", "source_mode": "logs", "source_program": "x", "slot": 1,
           "signature": "s", "err": None, "logs": ['a "q"', "b"], "subscription_id": None,
           "rpc_context": '{"slot": 1.0}'}
    df = spark.createDataFrame(
        [tuple(row.values())],
        "source_provider string, source_mode string, source_program string, slot bigint, "
        "signature string, err string, logs array<string>, subscription_id bigint, "
        "rpc_context string").withColumn("received_at", F.timestamp_micros(F.lit(3_600_000_001)))
    root = str(tmp_path / "raw")
    append_raw(df, root, "logs")
    append_raw(df, root, "logs")  # duplicates are legal in RAW
    text = spark.read.text(f"{root}/logs/date=1970-01-01/hour=01").first().value
    assert '"rpc_context":{"slot": 1.0}' in text and '"err":null' in text
    back = raws.read_logs(spark, root, "parts").collect()
    assert len(back) == 2 and back[0].logs == row["logs"]
    assert back[0].replay_order.received_us == 3_600_000_001
    target = str(tmp_path / "derived")
    write_dataset(df.drop("logs"), target, "events")
    with pytest.raises(Exception, match="already exists"):
        write_dataset(df.drop("logs"), target, "events")
    stats = metrics.file_statistics(spark, {"parquet": f"{target}/*/*/*.parquet"}).first()
    assert stats.files == 1 and stats.bytes > 0
