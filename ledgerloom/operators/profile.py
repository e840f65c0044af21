"""Structure of JSON documents: paths, types, presence, shapes."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# JSON type names, and the field names asked for by default.
JSON_TYPES = ("null", "boolean", "integer", "number", "string", "array", "object")
REQUESTED = ("mint", "signature", "creator", "user", "timestamp")

NODES = (
    "path string, key string, folded_key string, parent string, json_type string, n bigint"
)


def _json_type(value) -> str:
    """Integer and number differ by how the text was written, so Python's own parse decides."""
    names = {bool: "boolean", int: "integer", float: "number", str: "string", list: "array",
             dict: "object"}
    return names.get(type(value), "null")


def _nodes(document) -> Iterator[tuple]:
    """(path, key, parent, type) of every value, parents first. Deep documents need no recursion."""
    todo = [("$", None, None, document)]
    while todo:
        path, key, parent, value = todo.pop()
        yield path, key, parent, _json_type(value)
        if isinstance(value, dict):
            for name, child in value.items():
                escaped = name.replace("~", "~0").replace("/", "~1")
                todo.append((f"{path}/{escaped}", name, path, child))
        elif isinstance(value, list):
            todo.extend((f"{path}/*", None, None, child) for child in value)


def json_nodes(documents: DataFrame, text: str = "payload") -> DataFrame:
    """Node counts by path and type, already summed per Arrow batch; texts that do not parse are
    left out (see ``invalid_frames``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for document in batch.column(0).to_pylist():
                try:
                    seen.update(_nodes(json.loads(document)))
                except (TypeError, ValueError):
                    continue
            rows = [
                {"path": p, "key": k, "folded_key": k.casefold() if k is not None else None,
                 "parent": up, "json_type": t, "n": n}
                for (p, k, up, t), n in seen.items()
            ]
            yield pa.RecordBatch.from_pylist(
                rows,
                schema=pa.schema(
                    [(c, pa.string()) for c in
                     ("path", "key", "folded_key", "parent", "json_type")] + [("n", pa.int64())]
                ),
            )

    return documents.select(text).mapInArrow(count, NODES)


def field_stats(nodes: DataFrame) -> DataFrame:
    """Per field: presence against its parent objects, and a type histogram."""
    fields = (
        nodes.filter("key IS NOT NULL")
        .groupBy("path", "key", "parent")
        .agg(
            F.sum("n").alias("present"),
            *[
                F.sum(F.when(F.col("json_type") == t, F.col("n")).otherwise(0)).alias(f"n_{t}")
                for t in JSON_TYPES
            ],
        )
    )
    objects = (
        nodes.filter("json_type = 'object'")
        .groupBy(F.col("path").alias("parent"))
        .agg(F.sum("n").alias("parent_object_occurrences"))
    )
    missing = F.col("parent_object_occurrences") - F.col("present")
    return (
        fields.join(objects, "parent")
        .withColumn("missing", missing)
        .withColumn("always_when_parent_is_object", F.col("missing") == 0)
        .withColumn("optional_when_parent_is_object", F.col("missing") > 0)
    )


def root_types(nodes: DataFrame) -> DataFrame:
    """Documents by the type of their root."""
    return nodes.filter("path = '$'").groupBy("json_type").agg(F.sum("n").alias("documents"))


def top_level_shapes(documents: DataFrame, text: str = "payload") -> DataFrame:
    """Sorted key sets of object documents with their counts: most frequent first, then by keys."""
    keys = F.array_sort(F.array_distinct(F.json_object_keys(text)))
    return (
        documents.select(keys.alias("keys"))
        .filter("keys IS NOT NULL")
        .groupBy("keys")
        .agg(F.count("*").alias("messages"))
        .orderBy(F.desc("messages"), "keys")
    )


def requested_fields(nodes: DataFrame, names: tuple[str, ...] = REQUESTED) -> DataFrame:
    """For each wanted name, whether and under which paths a key matches it, ignoring case."""
    spark = nodes.sparkSession
    wanted = spark.createDataFrame([(n,) for n in names], "name string")
    paths = nodes.filter("key IS NOT NULL").select("folded_key", "path").distinct()
    return (
        F.broadcast(wanted)
        .join(paths, wanted["name"] == paths["folded_key"], "left")
        .groupBy("name")
        .agg(F.array_sort(F.collect_list("path")).alias("paths"))
        .withColumn("exists", F.size("paths") > 0)
    )


def validate_frames(frames: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``problem``: bytes that are not UTF-8 or not JSON; null for good frames."""
    text = F.col(raw).cast("string")
    return frames.withColumn(
        "problem",
        F.when(~F.is_valid_utf8(text), "received a non-UTF-8 binary frame").when(
            F.try_parse_json(text).isNull(), "received a frame that is not valid JSON"
        ),
    )


def capture_totals(captures: DataFrame, text: str = "payload") -> DataFrame:
    """Messages, payload bytes and the time span of a capture."""
    return captures.agg(
        F.count("*").alias("messages_received"),
        F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes_received"),
        F.min("received_at").alias("started_at"),
        F.max("received_at").alias("finished_at"),
    )
