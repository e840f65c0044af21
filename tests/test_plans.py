"""Plans at scale: where shuffles, sorts and Python hops may be, and hot keys."""

import re

from pyspark.sql import functions as F

from ledgerloom.operators import dedupe
from ledgerloom.operators.decode import decode, decoded_rows, events_of
from ledgerloom.operators.normalize import ROUTES, normalize, normalize_errors, with_typed_rows
from ledgerloom.sources.raw import read_envelopes, read_logs
from ledgerloom.schemas import DERIVED
from tests.helpers import PUMP, logs_of, notification, payload, transaction, write_archive


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _count(plan, operator):
    return len(re.findall(rf"\b{operator}\b", plan))


def test_pipeline_has_one_shuffle_and_one_python_hop(spark, tmp_path, catalog):
    root = write_archive(tmp_path / "raw", [
        transaction("a", logs_of(PUMP, payload("pump", "TradeEvent"))), notification("b", [])])
    first = dedupe.dedupe_transactions(read_envelopes(spark, root))
    plan = _plan(normalize(events_of(decode(first, catalog)), "trades"))
    # few files are shared out by round robin; beyond that there is the one shuffle by signature
    assert plan.count("hashpartitioning") == plan.count("hashpartitioning(signature") == 1
    assert _count(plan, "ArrowEvalPython") == 1
    assert _count(plan, "BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert "Window" not in plan and "CartesianProduct" not in plan
    assert plan.count("from_json") == 1


def test_raw_scan_prunes_partitions_and_parses_once(spark, tmp_path):
    root = write_archive(tmp_path / "raw", [notification("b", [])])
    rows = read_logs(spark, root).filter("replay_order.date = '2025-03-04'")
    assert _plan(rows).count("parseJson") <= 1


def test_a_hot_signature_is_combined_before_the_shuffle(spark):
    n = 60_000
    rows = spark.range(0, n, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("signature"),
        F.col("id").alias("replay_order"),
        F.lit("p").alias("source_program"),
        F.lit(1).cast("bigint").alias("slot"),
        F.timestamp_seconds("id").alias("received_at"),
    )
    once = dedupe.dedupe_transactions(rows)
    assert "partial_min_by" in _plan(once)
    assert once.filter("signature = 'hot'").first().replay_order == 0
    assert once.count() == n - n // 3 + 1
    seen = dedupe.observations(rows)
    assert "partial_min_by" in _plan(seen) and "Window" not in _plan(seen)
    assert dedupe.checkpoints(seen).first().last_signature == str(n - 1)


def test_typed_rows_come_from_one_pass_over_the_decoded_ones(spark, tmp_path, catalog):
    root = write_archive(tmp_path / "raw", [
        transaction("a", logs_of(PUMP, payload("pump", "TradeEvent"))), notification("b", logs_of(PUMP, payload("pump", "TradeEvent")))])
    rows = decoded_rows(decode(dedupe.dedupe_transactions(read_envelopes(spark, root)), catalog))
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    broken = stored.withColumns({
        "payload_json": F.regexp_replace("payload_json", '"mint":"[^"]*"', '"mint":null'),
        "event_id": F.concat("event_id", F.lit("x")),
    })
    both = stored.unionByName(broken)
    one = with_typed_rows(stored)
    plan = _plan(one)
    assert plan.count("FileScan") == 1 and plan.count("from_json") == 1 and "Exchange" not in plan

    whole, events = with_typed_rows(both), both.filter("dataset = 'events'")

    def rows_of(df):
        return sorted(map(str, df.collect()))

    for dataset in ROUTES:
        got = whole.filter(F.col("dataset") == dataset).select(*DERIVED[dataset].fieldNames())
        assert rows_of(got) == rows_of(normalize(events, dataset))
    names = DERIVED["unknown_program_data"].fieldNames()
    wrong = whole.filter("dataset = 'unknown_program_data' AND reason LIKE 'normalize-error%'").select(*names)
    assert rows_of(wrong) == rows_of(normalize_errors(events).select(*names)) and wrong.count() == 2
    assert rows_of(whole.filter("dataset = 'events'").select("event_id")) == rows_of(events.select("event_id"))
