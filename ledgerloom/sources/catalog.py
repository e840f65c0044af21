"""Schema catalog: event discriminators and field layouts as two small tables."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import EVENT_CATALOG, FIELD_CATALOG, PROTOCOLS

_DOCUMENT = (
    "address string, "
    "types array<struct<name: string, type: struct<kind: string, fields: array<variant>, "
    "variants: array<struct<name: string, fields: variant>>>>>, "
    "events array<struct<name: string, discriminator: array<int>>>"
)


def parse_documents(files: DataFrame) -> DataFrame:
    """(protocol, path, content) to protocol, path, sha256 and the parsed body."""
    return files.select(
        "protocol",
        "path",
        F.sha2("content", 256).alias("sha256"),
        F.from_json(F.col("content").cast("string"), _DOCUMENT).alias("doc"),
    )


def read_catalog_documents(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per schema document."""
    frames = [
        spark.read.format("binaryFile")
        .load(path)
        .select(F.lit(protocol).alias("protocol"), "path", "content")
        for protocol, path in paths.items()
    ]
    files = frames[0]
    for frame in frames[1:]:
        files = files.unionByName(frame)
    return parse_documents(files)


def event_rows(documents: DataFrame) -> DataFrame:
    """One row per event, discriminator as BINARY."""
    event = documents.select(
        "protocol", F.col("doc.address").alias("program_id"), F.explode("doc.events").alias("e")
    )
    hex_bytes = F.transform("e.discriminator", lambda b: F.lpad(F.hex(b.cast("bigint")), 2, "0"))
    return event.select(
        "protocol",
        "program_id",
        F.col("e.name").alias("event_type"),
        F.unhex(F.array_join(hex_bytes, "")).alias("discriminator"),
    )


def field_rows(documents: DataFrame) -> DataFrame:
    """One row per struct field or enum variant; the type stays JSON text.

    Unnamed struct fields (tuple structs) have a null ``field_name``. A type without members
    keeps one row with a null position.
    """
    types = documents.select(
        F.col("doc.address").alias("program_id"), F.explode("doc.types").alias("t")
    ).select(
        "program_id",
        F.col("t.name").alias("type_name"),
        F.col("t.type.kind").alias("kind"),
        F.col("t.type.fields").alias("fields"),
        F.col("t.type.variants").alias("variants"),
    )
    key = ["program_id", "type_name", "kind"]
    named = F.try_variant_get("member", "$.name", "string")
    members = (
        types.filter("kind = 'struct'")
        .select(*key, F.posexplode_outer("fields").alias("position", "member"))
        .select(
            *key,
            "position",
            named.alias("field_name"),
            F.when(named.isNull(), F.to_json("member"))
            .otherwise(F.to_json(F.try_variant_get("member", "$.type", "variant")))
            .alias("field_type"),
        )
    )
    variants = (
        types.filter("kind = 'enum'")
        .select(*key, F.posexplode_outer("variants").alias("position", "member"))
        .select(
            *key,
            "position",
            F.col("member.name").alias("field_name"),
            F.to_json("member.fields").alias("field_type"),
        )
    )
    other = types.filter("kind NOT IN ('struct', 'enum')").select(
        *key,
        F.lit(None).cast("int").alias("position"),
        F.lit(None).cast("string").alias("field_name"),
        F.lit(None).cast("string").alias("field_type"),
    )
    return members.unionByName(variants).unionByName(other)


def catalog_inventory(documents: DataFrame) -> DataFrame:
    """Program, path, content hash and sorted event names per document."""
    return documents.select(
        "protocol",
        F.col("doc.address").alias("program_id"),
        "path",
        "sha256",
        F.array_sort(F.transform("doc.events", lambda e: e["name"])).alias("events"),
    )


@dataclass(frozen=True)
class Catalog:
    """The two tables, plus layouts and names (by first bytes) in the form the decode job reads."""

    events: DataFrame
    programs: DataFrame
    layouts: dict[str, dict]
    names: dict[str, dict[bytes, str]]


def build_catalog(
    events: DataFrame, fields: DataFrame, programs: DataFrame | None = None
) -> Catalog:
    """Collect the catalog tables once; they are configuration, not data.

    ``programs`` (protocol, program_id) names programs that may have no events.
    """
    named = events if programs is None else programs
    return catalog_of(
        events.sparkSession,
        events.select(*EVENT_CATALOG.fieldNames()).collect(),
        fields.select(*FIELD_CATALOG.fieldNames()).collect(),
        named.select("protocol", "program_id").distinct().collect(),
    )


def catalog_of(
    spark: SparkSession, events: list, fields: list, programs: list | None = None
) -> Catalog:
    """Catalog from rows of the two tables, in the column order of their schemas.

    Of several events of one program with the same discriminator, the last by name counts.
    """
    named = {(program, protocol) for protocol, program, _, _ in events}
    named |= {(program, protocol) for protocol, program in programs or []}
    ordered_events = sorted(map(tuple, events), key=lambda e: (e[1], e[2]))
    events = list({(e[1], bytes(e[3])): e for e in ordered_events}.values())
    layouts: dict[str, dict] = {program: {} for program, _ in named}
    ordered = sorted(fields, key=lambda row: (row[0], row[1], row[3] or 0))
    for program, type_name, type_kind, position, field_name, field_type in ordered:
        kind, members = layouts.setdefault(program, {}).setdefault(type_name, (type_kind, []))
        if position is None:
            continue
        spec = json.loads(field_type) if field_type else None
        if kind == "enum":
            spec = [_member(m) for m in spec or []]
        members.append((field_name, spec))
    names: dict[str, dict[bytes, str]] = {}
    for _, program, event, first in events:
        names.setdefault(program, {})[bytes(first)] = event
    return Catalog(
        events=spark.createDataFrame([tuple(e) for e in events], EVENT_CATALOG),
        programs=spark.createDataFrame(sorted(named), "program_id string, protocol string"),
        layouts=layouts,
        names=names,
    )


def load_catalog(spark: SparkSession, paths: dict[str, str]) -> Catalog:
    """Catalog from schema documents, one per protocol."""
    documents = read_catalog_documents(spark, paths)
    programs = documents.select("protocol", F.col("doc.address").alias("program_id"))
    return build_catalog(event_rows(documents), field_rows(documents), programs)


def select_protocols(names: str, known: tuple[str, ...] = PROTOCOLS) -> tuple[str, ...]:
    """Comma list to protocol names; empty or unknown entries are an error."""
    wanted = tuple(n.strip().lower() for n in names.split(",") if n.strip())
    unknown = sorted(set(wanted) - set(known))
    if not wanted or unknown:
        raise ValueError(f"protocols must be some of {', '.join(known)}; invalid={unknown}")
    return wanted


def diff_catalogs(old: DataFrame, new: DataFrame) -> DataFrame:
    """Field rows added, removed or changed between two field catalogs."""
    key = ["program_id", "type_name", "position"]
    body = F.struct("kind", "field_name", "field_type")
    left = old.select(*key, body.alias("old"))
    right = new.select(*key, body.alias("new"))
    return (
        left.join(right, key, "full_outer")
        .withColumn(
            "change",
            F.when(F.col("old").isNull(), "added")
            .when(F.col("new").isNull(), "removed")
            .when(~F.col("old").eqNullSafe(F.col("new")), "changed"),
        )
        .filter("change IS NOT NULL")
    )


def _member(spec) -> tuple:
    """Enum member: named when it is an object with a name, positional otherwise."""
    if isinstance(spec, dict) and "name" in spec:
        return spec["name"], spec["type"]
    return None, spec
