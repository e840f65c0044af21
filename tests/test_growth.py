"""Steps that must not grow faster than their input."""

import json
import os

from ledgerloom.functions.borsh import canonical_json, decode_columns
from ledgerloom.functions.loglines import data_lines, strict_base64


def test_log_lines_are_read_in_batches_with_strict_base64():
    assert strict_base64("YQ==") == b"a" and strict_base64("") == b""
    assert [strict_base64(t) for t in ("YQ=", "Y Q==", "YQ==YQ==", "Y===", "é===")] == [None] * 5
    logs = [
        "Program data: YQ==", "Program A invoke [1]", None, "Program B invoke [٢]\n", "Program data: Yg==",
        "Program C success", "Program A failed: x", "Program data: Yw==",
    ]
    assert data_lines(logs) == [(4, "B", b"b")]


def test_json_by_column_is_canonical():
    fields = [("b", "string"), ("a", "u64"), ("c%", {"option": "bool"})]
    text = 'é"\n'.encode()
    raw = len(text).to_bytes(4, "little") + text + (2**64 - 1).to_bytes(8, "little") + b"\1\1"
    texts, errors, left = decode_columns("E", [raw, b"\1"], {"E": ("struct", fields)})
    assert texts[0] == canonical_json({"b": 'é"\n', "a": 2**64 - 1, "c%": True}) and json.loads(texts[0])["a"] == 2**64 - 1
    assert texts[1] is None and errors[1].startswith("buffer underrun") and left == [0, None]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_first_copies_are_chosen_before_logs_are_written(spark):
    from ledgerloom.plans import queries

    for first in (queries._first_trades, queries._first_lifecycles):
        plan = _plan(first(spark, "/root/testdata/sf0.001"))
        grouped = plan[plan.index("Aggregate") :]
        assert "Program data: " in plan and "Program data: " not in grouped


def test_decoded_rows_are_written_without_a_shuffle_of_their_own(spark, tmp_path):
    from ledgerloom.plans import queries, views
    from ledgerloom.plans.rebuild import derive_first, write_version

    first = queries._first_lifecycles(spark, "/root/testdata/sf0.001")
    rows = derive_first(first, views.ledger_catalog(spark))
    plan = _plan(rows)
    assert "RebalancePartitions" in plan[plan.index("_hits") :]
    write_version(spark, rows, str(tmp_path / "v"))
    written = spark.read.parquet(str(tmp_path / "v"))
    assert written.filter("dataset = 'tokens'").count() == first.filter("NOT failed").count()


def test_known_secrets_are_replaced_in_turn_outside_the_expression_fold(spark):
    from pyspark.sql import functions as F

    from ledgerloom.operators import scrub

    texts = spark.createDataFrame([("ab DE b",), ("",), (None,)], "t string")
    clean = texts.select(scrub.remove_known_secrets(F.col("t"), [("ab", "D"), ("", "x"), ("D", "<D>"), ("b", "c")]).alias("c"))
    assert "aggregate(" not in _plan(clean)
    assert [r.c for r in clean.collect()] == ["<D> <D>E c", "", None]


def test_a_batch_of_a_stream_is_planned_as_an_ordinary_job(spark, tmp_path):
    from pyspark.sql import functions as F

    from ledgerloom.streaming.firsts import keys_of, run, with_new_keys

    spark.range(400).select(F.col("id").cast("string").alias("k")).repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string").parquet(str(tmp_path / "in"))
    names = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    outside, seen = [spark.conf.get(n) for n in names], []

    def process(rows, batch_id, batch):
        seen.append(([rows.sparkSession.conf.get(n) for n in names], batch.filter("_kind = 'x'").count()))
        folder = rows.withColumn("p", F.col("k").cast("int") % 2)
        folder.repartition(8).hint("rebalance", "p").write.partitionBy("p").parquet(str(tmp_path / f"out{batch_id}"))

    run(with_new_keys(stream, keys_of(stream, {"x": ["k"]})), process, str(tmp_path / "offsets")).awaitTermination()
    assert seen == [(["true", outside[1]], 400)]
    assert [spark.conf.get(n) for n in names] == outside
    assert len(list((tmp_path / "out0").rglob("*.parquet"))) == 2
    # keyed state has as many partitions as cores ask for, whatever jobs shuffle into
    stores = [p for p in (tmp_path / "offsets" / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(stores) == 2 * spark.sparkContext.defaultParallelism


def test_tasks_stay_small_when_logs_are_decoded(spark):
    from ledgerloom.session import prepare

    conf = prepare(spark).conf
    assert conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "2m"
    assert conf.get("spark.sql.files.maxPartitionBytes") == "32m"


def test_first_copies_are_chosen_among_plain_columns_only(spark):
    from ledgerloom.plans import queries

    for first, derived in ((queries._first_trades, "user_key"), (queries._first_lifecycles, "pool_key")):
        plan = _plan(first(spark, "/root/testdata/sf0.001"))
        grouped = plan[plan.index("Aggregate") :]
        assert derived in plan and derived not in grouped
        # the key travels beside the row that is kept, not in it as well
        assert "min_by(struct(signature" not in grouped and "named_struct(signature" not in grouped


def test_logs_are_read_once_and_rows_are_doubled_after_they_are_typed(spark, tmp_path):
    from ledgerloom.operators.normalize import with_typed_rows
    from ledgerloom.plans import queries, views
    from ledgerloom.plans.rebuild import derive_first, write_version

    first = queries._first_lifecycles(spark, "/root/testdata/sf0.001")
    rows = with_typed_rows(derive_first(first, views.ledger_catalog(spark)))
    plan = _plan(rows)
    assert plan.count("ArrowEvalPython") == 1 and plan.count("Generate ") == 2
    # a question about the result does not move the parsing of payloads
    asked = _plan(rows.filter("dataset = 'tokens' AND mint IS NOT NULL"))
    assert asked.count("from_json") == plan.count("from_json") == 1
    write_version(spark, derive_first(first, views.ledger_catalog(spark)), str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v")).count() == rows.count()


class _Ended:
    def awaitTermination(self):
        pass


def test_rows_of_a_growing_table_are_made_once(spark):
    from pyspark.sql import functions as F

    from ledgerloom.plans.queries import _run_in_parts

    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(value):
        made.add(1)
        return value

    rows = spark.range(40).select(counted("id").alias("n"))
    tables = []
    _run_in_parts(spark, rows, "n", "grown", lambda stream: tables.append(stream) or _Ended())
    assert made.value == 40 and len(tables) == 4 and all(t.isStreaming for t in tables)


def test_captured_frames_are_kept_compressed_in_files_of_one_task(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from ledgerloom.operators import sinks
    from ledgerloom.sources.raw import read_captures

    monkeypatch.setattr(sinks, "_CAPTURED", 10)
    rows = spark.range(0, 35, 1, 1).select(
        F.timestamp_seconds("id").alias("received_at"), F.to_json(F.struct("id")).alias("payload"))
    sinks.write_captures(rows, str(tmp_path / "cap"))
    assert len(list((tmp_path / "cap").glob("*.txt.gz"))) == 4 and not list((tmp_path / "cap").glob("*.txt"))
    assert sorted(read_captures(spark, str(tmp_path / "cap")).collect()) == sorted(rows.collect())


def test_a_batch_of_a_stream_is_held_in_files_while_it_is_processed(spark, tmp_path):
    from ledgerloom.session import scratch_root
    from ledgerloom.streaming.firsts import keys_of, new_keys, run, with_new_keys

    root = scratch_root(spark).removeprefix("file:") + "/ledgerloom"
    spark.createDataFrame([("a",), ("a",), ("b",)], "k string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string").parquet(str(tmp_path / "in"))
    seen = []

    def process(rows, batch_id, batch):
        # read from the files, nothing is cached whole
        assert not batch.storageLevel.useMemory and not batch.storageLevel.useDisk
        files = batch.inputFiles()
        assert files and all(f"{root}/batch-" in f for f in files)
        seen.append((sorted(r.k for r in rows.collect()), sorted(r.k for r in new_keys(batch, "x", "k").collect()), files))

    run(with_new_keys(stream, keys_of(stream, {"x": ["k"]})), process, str(tmp_path / "offsets")).awaitTermination()
    (rows, keys, files), = seen
    assert rows == ["a", "a", "b"] and keys == ["a", "b"]
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
