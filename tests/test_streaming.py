import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.frames import classify_frames
from ledgerloom.operators.metrics import arrival_counters
from ledgerloom.plans.rebuild import rebuild
from ledgerloom.sources.derived import current_version, read_dataset
from ledgerloom.streaming.collect import Collector
from ledgerloom.streaming.sources import stream_captures
from ledgerloom.streaming.stateful import CheckpointState, QueueState, arrival_windows, stream_dedupe
from tests.helpers import PUMP, SWAP, logs_of, payload


def _frame(signature, logs, slot=5, subscription=1, err=None):
    return {
        "jsonrpc": "2.0",
        "method": "logsNotification",
        "params": {
            "subscription": subscription,
            "result": {
                "context": {"slot": slot},
                "value": {"signature": signature, "err": err, "logs": logs},
            },
        },
    }


def _capture(folder, name, frames, minute):
    folder.mkdir(exist_ok=True)
    lines = [
        f'{{"received_at":"2025-03-04T08:{minute:02d}:{i:02d}Z","payload":{json.dumps(f)}}}'
        for i, f in enumerate(frames)
    ]
    (folder / name).write_text("\n".join(lines) + "\n")


def _collector(spark, tmp_path, catalog, mode="logs"):
    subscriptions = spark.createDataFrame(
        [(1, PUMP), (2, SWAP)], "subscription_id bigint, program_id string"
    )
    return Collector(str(tmp_path / "live"), catalog, subscriptions, "test", mode)


def test_collection_equals_rebuild_and_survives_a_restart(spark, tmp_path, catalog):
    trade = logs_of(PUMP, payload("pump", "TradeEvent"))
    pool = logs_of(PUMP, payload("pump", "CompleteEvent")) + logs_of(
        SWAP, payload("pumpswap", "CreatePoolEvent"))
    frames = tmp_path / "frames"
    _capture(frames, "a.txt", [
        _frame("s1", trade, 20), _frame("s2", trade, 19), {"jsonrpc": "2.0", "id": 1},
        _frame("bad", trade, 30, err={"x": 1}), _frame("s1", [], 20),
    ], 1)
    collector = _collector(spark, tmp_path, catalog)
    collector.start(stream_captures(spark, str(frames), 1)).awaitTermination()
    assert collector.dataset(spark, "trades").count() == 2

    _capture(frames, "b.txt", [
        _frame("s1", trade, 20, 2), _frame("mig", pool, 21), _frame("mig", pool, 21, 2),
    ], 2)
    collector.start(stream_captures(spark, str(frames), 1)).awaitTermination()

    points = {r.program_id: (r.last_signature, r.last_slot)
              for r in collector.latest(spark, "checkpoints").collect()}
    assert points == {PUMP: ("mig", 21), SWAP: ("mig", 21)}
    assert collector.state(spark, "transactions").count() == 3
    assert collector.state(spark, "observations").count() == 5
    counters = {r.key: r.value for r in collector.latest(spark, "counters").collect()}
    assert counters["ws_messages_received"] == 8
    assert counters["ws_notifications_received"] == 7
    assert counters["ws_notifications_enqueued"] == 6
    assert counters["failed_log_notifications_skipped"] == 1
    assert counters["ws_non_notification_messages_received"] == 1
    assert (counters["transactions"], counters["duplicate_transactions"]) == (3, 3)

    out = str(tmp_path / "out")
    summary = _rebuild(spark, collector, out, catalog)
    assert summary["raw_rows"] == 6 and summary["unique_transactions"] == 3
    version = current_version(spark, out)
    for name in ("events", "trades", "completions", "pools"):
        live = sorted(map(tuple, collector.dataset(spark, name).collect()), key=str)
        rebuilt = sorted(map(tuple, read_dataset(spark, version, name).collect()), key=str)
        assert live == rebuilt and live


def _rebuild(spark, collector, out, catalog):
    return rebuild(spark, collector.path("raw"), out, catalog, layout="parts")


def test_unknown_subscription_and_malformed_logs_stop_the_stream(spark, tmp_path, catalog):
    for i, frame in enumerate([_frame("s", [], subscription=9), _frame("s", "nolist")]):
        frames = tmp_path / f"frames{i}"
        _capture(frames, "a.txt", [frame], 1)
        collector = _collector(spark, tmp_path / str(i), catalog)
        (tmp_path / str(i)).mkdir()
        with pytest.raises(Exception, match="unknown subscription|malformed"):
            collector.start(stream_captures(spark, str(frames))).awaitTermination()
        assert collector.state(spark, "checkpoints").count() == 0


def test_blocks_are_archived_once(spark, tmp_path, catalog):
    trade = logs_of(PUMP, payload("pump", "TradeEvent"))
    entry = {"transaction": {"signatures": ["t1"]}, "meta": {"err": None, "logMessages": trade},
             "version": "legacy"}
    block = {"method": "blockNotification", "params": {"subscription": 1, "result": {
        "context": {"slot": 7}, "value": {"slot": 7, "err": None, "block": {
            "blockTime": 1740900000, "transactions": [entry, entry]}}}}}
    frames = tmp_path / "frames"
    _capture(frames, "a.txt", [block], 1)
    _capture(frames, "b.txt", [block], 2)
    collector = _collector(spark, tmp_path, catalog, "block")
    collector.start(stream_captures(spark, str(frames), 1)).awaitTermination()
    assert spark.read.text(collector.path("raw", "transactions")).count() == 1
    assert collector.dataset(spark, "trades").first().block_time == 1740900000
    counters = {r.key: r.value for r in collector.latest(spark, "counters").collect()}
    assert counters["duplicate_transactions"] == 3


def _run(query, spark, name, mode):
    q = query.writeStream.format("memory").queryName(name).outputMode(mode).trigger(
        availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def test_stateful_operators_match_batch(spark, tmp_path):
    frames = tmp_path / "frames"
    _capture(frames, "a.txt", [_frame("s1", [], 20), _frame("s1", [], 20), {"id": 1}], 1)
    _capture(frames, "b.txt", [_frame("s2", [], 20), _frame("s3", [], 19, err=1)], 2)
    stream = classify_frames(stream_captures(spark, str(frames), 1))
    value = stream.filter("is_notification").select(
        "received_at",
        F.get_json_object("value", "$.params.result.value.signature").alias("signature"),
        F.get_json_object("value", "$.params.result.context.slot").cast("bigint").alias("slot"),
        F.lit("p").alias("program"),
    )
    once = _run(stream_dedupe(value), spark, "once", "append")
    assert sorted(r.signature for r in once.collect()) == ["s1", "s2", "s3"]
    bounded = _run(
        stream_dedupe(value, "signature", "received_at", "1 hour"), spark, "bounded", "append")
    assert bounded.count() == 3
    windows = _run(arrival_windows(stream, "1 minute", "10 minutes"), spark, "windows", "complete")
    batch = classify_frames(
        spark.read.text(str(frames)).select(F.get_json_object("value", "$.payload").alias("value"))
    )
    whole = arrival_counters(batch).first()
    assert windows.agg(F.sum("ws_messages_received")).first()[0] == whole.ws_messages_received == 5
    assert windows.agg(F.sum("failed_log_notifications")).first()[0] == 1


def test_repeated_observations_move_no_checkpoint(spark, tmp_path):
    def rows(*values):
        return spark.createDataFrame(
            [(s, "p", slot, n) for s, slot, n in values],
            "signature string, source_program string, slot bigint, n int",
        ).select("*", F.timestamp_seconds("n").alias("received_at"), F.col("n").alias("replay_order"))

    state = CheckpointState(str(tmp_path / "marks"))
    first, second = rows(("a", 5, 1), ("b", 7, 2), ("a", 90, 3)), rows(("b", 99, 4), ("c", 6, 5))
    for batch_id, batch in ((0, first), (1, second), (1, second)):
        state.process(batch, batch_id)
    assert [(r.last_signature, r.last_slot) for r in state.latest(spark).collect()] == [("b", 7)]
    state.process(rows(("c", 100, 6), ("d", 7, 7)), 2)
    assert [(r.last_signature, r.last_slot) for r in state.latest(spark).collect()] == [("d", 7)]


def test_a_retried_batch_leaves_raw_as_it_was(spark, tmp_path, catalog):
    trade = logs_of(PUMP, payload("pump", "TradeEvent"))
    frames = tmp_path / "frames"
    _capture(frames, "a.txt", [_frame("s1", trade), _frame("s2", trade)], 1)
    lines = spark.read.text(str(frames)).select(
        F.timestamp_seconds(F.lit(1)).alias("received_at"),
        F.get_json_object("value", "$.payload").alias("value"),
    )
    collector = _collector(spark, tmp_path, catalog)
    for _ in range(2):
        collector.process(lines, 0)
    assert spark.read.text(collector.path("raw", "logs")).count() == 2


def test_a_frame_that_repeats_a_key_is_kept(spark):
    text = (
        '{"method":"logsNotification","method":"logsNotification","params":{"subscription":1,'
        '"result":{"context":{"slot":1,"slot":2},"value":{"signature":"s","err":null,"logs":[]}}}}'
    )
    df = spark.createDataFrame([(text,)], "value string")
    assert classify_frames(df).first().is_notification


def _batches_of(spark, folder, schema, batches, start):
    """Run a stream over a folder that grows by one batch of rows before each start."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        start(spark.readStream.schema(schema).parquet(folder)).awaitTermination()


def test_later_batches_need_no_history_to_know_a_repeat(spark, tmp_path, catalog):
    """Earlier batches' state is taken away between starts; first copies stay exact all the same."""
    trade = logs_of(PUMP, payload("pump", "TradeEvent"))
    collector, frames = _collector(spark, tmp_path, catalog), tmp_path / "frames"
    for n in range(4):
        _capture(frames, f"{n}.txt", [
            *[_frame(f"s{k}", [] if n > k else trade, 10 + k, 1) for k in range(n + 1)],
            _frame("s0", [], 99, 2),
        ], n)
        collector.start(stream_captures(spark, str(frames))).awaitTermination()
        if n < 3:
            for name in ("transactions", "observations"):
                shutil.move(collector.path("state", name, f"batch={n}"), tmp_path / f"{name}-{n}")
    assert sorted(r.signature for r in collector.dataset(spark, "trades").collect()) == ["s0", "s1", "s2", "s3"]
    points = {r.program_id: (r.last_signature, r.last_slot) for r in collector.latest(spark, "checkpoints").collect()}
    assert points == {PUMP: ("s3", 13), SWAP: ("s0", 99)}
    counters = {r.key: r.value for r in collector.latest(spark, "counters").collect()}
    assert (counters["transactions"], counters["duplicate_transactions"]) == (4, 10)
    assert (counters["trades"], counters["events_decoded"]) == (4, 4)
    assert collector.state(spark, "observations").count() == 1  # s3 alone is new with the last batch


def test_a_batch_that_fails_half_way_is_done_again(spark, tmp_path, catalog, monkeypatch):
    from ledgerloom.streaming import collect

    trade = logs_of(PUMP, payload("pump", "TradeEvent"))
    collector, frames = _collector(spark, tmp_path, catalog), tmp_path / "frames"
    _capture(frames, "a.txt", [_frame("a", trade, 5)], 1)
    collector.start(stream_captures(spark, str(frames))).awaitTermination()
    _capture(frames, "b.txt", [_frame("a", trade, 5), _frame("b", trade, 6)], 2)

    def broken(*_):
        raise OSError("no space left")

    with monkeypatch.context() as patch:
        patch.setattr(collect, "merge_checkpoints", broken)
        with pytest.raises(Exception, match="no space left"):
            collector.start(stream_captures(spark, str(frames))).awaitTermination()
    collector.start(stream_captures(spark, str(frames))).awaitTermination()
    assert sorted(r.signature for r in collector.dataset(spark, "trades").collect()) == ["a", "b"]
    counters = {r.key: r.value for r in collector.latest(spark, "counters").collect()}
    assert (counters["transactions"], counters["duplicate_transactions"], counters["ws_messages_received"]) == (2, 1, 3)
    assert spark.read.text(collector.path("raw", "logs")).count() == 3


def test_logs_and_blocks_in_one_collection(spark, tmp_path, catalog):
    trade = logs_of(PUMP, payload("pump", "TradeEvent"))
    entry = {"transaction": {"signatures": ["t1"]}, "meta": {"err": None, "logMessages": trade}, "version": 0}
    other = {**entry, "transaction": {"signatures": ["t2"]}}
    block = {"method": "blockNotification", "params": {"subscription": 1, "result": {
        "context": {"slot": 7}, "value": {"slot": 7, "err": None, "block": {
            "blockTime": 1740900000, "transactions": [entry, other]}}}}}
    frames = tmp_path / "frames"
    _capture(frames, "a.txt", [_frame("t1", trade, 7), block, _frame("t3", trade, 8)], 1)
    collector = _collector(spark, tmp_path, catalog, "all")
    collector.start(stream_captures(spark, str(frames))).awaitTermination()
    _capture(frames, "b.txt", [block, _frame("t2", trade, 9)], 2)
    collector.start(stream_captures(spark, str(frames))).awaitTermination()
    times = {r.signature: r.block_time for r in collector.dataset(spark, "trades").collect()}
    assert times == {"t1": None, "t2": 1740900000, "t3": None}
    assert spark.read.text(collector.path("raw", "logs")).count() == 3
    assert spark.read.text(collector.path("raw", "transactions")).count() == 1


def test_checkpoints_over_micro_batches_equal_batch(spark, tmp_path):
    import random

    from ledgerloom.operators import dedupe

    draw = random.Random(3)
    rows = [(f"s{draw.randrange(40)}", f"p{draw.randrange(3)}", draw.randrange(50), n) for n in range(200)]
    schema = "signature string, source_program string, slot bigint, n int"

    def placed(df):
        return df.select("*", F.timestamp_seconds("n").alias("received_at"), F.col("n").alias("replay_order"))

    state = CheckpointState(str(tmp_path / "marks"))
    _batches_of(spark, str(tmp_path / "rows"), schema, [rows[i : i + 50] for i in range(0, 200, 50)],
                lambda stream: state.start(placed(stream)))
    whole = dedupe.checkpoints(dedupe.observations(placed(spark.createDataFrame(rows, schema))))
    assert sorted(map(tuple, state.latest(spark).collect())) == sorted(map(tuple, whole.collect()))
    assert len(os.listdir(tmp_path / "marks" / "checkpoints")) == 4


def test_queue_size_is_carried_and_fails_closed(spark, tmp_path):
    import random

    from ledgerloom.operators import metrics

    draw = random.Random(4)
    rows = [(3 * i, draw.choice([1, 1, -1])) for i in range(200)]
    parts = [rows[:70], rows[70:71], rows[71:150], rows[150:]]
    schema = "id long, change int"
    queue = QueueState(str(tmp_path / "queue"), "id")
    _batches_of(spark, str(tmp_path / "changes"), schema, parts, queue.start)
    whole = metrics.backlog(spark.createDataFrame(rows, schema), "id")
    got = {r.id: r.backlog for r in queue.sized(spark).collect()}
    assert got == {r.id: r.backlog for r in whole.collect()} and len(got) == 200
    top = metrics.high_watermark(whole, "id").first()
    assert queue.watermark(spark).first() == top

    queue.process(spark.createDataFrame(parts[3], schema), 3)  # a retry changes nothing
    assert queue.watermark(spark).first() == top and queue.sized(spark).count() == 200
    with pytest.raises(ValueError, match="comes after"):
        queue.process(spark.createDataFrame([(5, 1)], schema), 4)

    size = max(got[i] for i, _ in rows[:70])
    tight = QueueState(str(tmp_path / "tight"), "id", size)
    tight.process(spark.createDataFrame(rows[:70], schema), 0)
    with pytest.raises(metrics.BacklogOverflow):
        tight.process(spark.createDataFrame([(1000 + i, 1) for i in range(size + 1)], schema), 1)
    assert tight.sized(spark).count() == 70
    assert QueueState(str(tmp_path / "none"), "id").watermark(spark).first() == (0, 0)
