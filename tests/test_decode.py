import json

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.functions.borsh import decode_payloads
from ledgerloom.operators.attribution import attribute
from ledgerloom.operators.decode import decode, decode_fixed, decode_typed, events_of, quarantine_of
from ledgerloom.sources.catalog import (
    catalog_inventory,
    diff_catalogs,
    event_rows,
    field_rows,
    read_catalog_documents,
    select_protocols,
)
from tests.helpers import PUMP, SWAP, data_line, logs_of, payload

EVERY = {
    "u8": 255, "u16": 65535, "u32": 2**32 - 1, "u64": 2**64 - 1, "u128": 2**128 - 1,
    "i8": -128, "i16": -2, "i32": -(2**31), "i64": -(2**63), "i128": -(2**127),
    "bool": True, "pubkey": b"\0" * 31 + b"\1", "string": "héllo", "bytes": b"\xde\xad",
    "option": 5, "vec": ["a", "", "ç"], "array": [1, 2, 3], "pair": [9, "z"],
    "share": {"owner": b"\0" * 32, "bps": 7}, "unnamed": [4, True], "choice": (1, [8]),
}
EVERY_OUT = {
    **EVERY, "pubkey": "1" * 31 + "2", "bytes": "dead",
    "share": {"owner": "1" * 32, "bps": 7}, "choice": {"variant": "Named", "fields": {"a": 8}},
}


def _frame(spark, rows):
    """(signature, failed, logs) to envelopes."""
    return spark.createDataFrame(
        rows, "signature string, failed boolean, logs array<string>"
    ).select(
        "*",
        F.lit(5).cast("bigint").alias("slot"),
        F.lit(None).cast("bigint").alias("block_time"),
        F.lit(None).cast("int").alias("transaction_index"),
        F.timestamp_seconds(F.lit(0)).alias("received_at"),
    )


def _hits(spark, logs):
    rows = attribute(_frame(spark, [("s", False, logs)])).orderBy("log_index").collect()
    return [(r.log_index, r.program_id, bytes(r.raw)) for r in rows]


def test_attribution_follows_the_stack(spark):
    a, b = "AAA", "BBB"
    logs = [f"Program {a} invoke [1]", data_line(b"a"), f"Program {b} invoke [2]",
            data_line(b"b"), f"Program {b} success", data_line(b"a2"), f"Program {a} success",
            data_line(b"none")]
    assert _hits(spark, logs) == [(1, a, b"a"), (3, b, b"b"), (5, a, b"a2")]


def test_attribution_of_broken_logs(spark):
    logs = ["Program AAA invoke [1]", "Program BBB invoke [2]", "Program AAA failed: x",
            data_line(b"x")]
    assert _hits(spark, logs) == []
    logs = ["Program AAA invoke [1]", "Program CCC success", "Program log: hi",
            "Program data: YQ", "Program data: Y Q==", "Program data: ", data_line(b"ok")]
    assert _hits(spark, logs) == [(5, "AAA", b""), (6, "AAA", b"ok")]


def _model(logs):
    """Plain-Python attribution, for comparison on random logs."""
    stack, out = [], []
    for i, line in enumerate(logs):
        words = line.split(" ")
        if line.endswith("invoke [1]"):
            stack.append(words[1])
        elif line.endswith(" success") or " failed: " in line:
            if words[1] in stack:
                while stack.pop() != words[1]:
                    pass
        elif line.startswith("Program data: ") and stack:
            out.append((i, stack[-1], b"a"))
    return out


def test_attribution_equals_a_plain_model_on_random_logs(spark):
    import random

    rng = random.Random(7)
    kinds = ["Program {} invoke [1]", "Program {} success", "Program {} failed: oops",
             "Program data: YQ==", "Program log: {}"]
    cases = [
        [rng.choice(kinds).format(rng.choice("ABC")) for _ in range(rng.randrange(30))]
        for _ in range(150)
    ]
    rows = attribute(
        _frame(spark, [(str(i), False, logs) for i, logs in enumerate(cases)])
    ).collect()
    got = sorted((int(r.signature), r.log_index, r.program_id, bytes(r.raw)) for r in rows)
    assert got == sorted((i, *hit) for i, logs in enumerate(cases) for hit in _model(logs))


def test_base64_is_as_strict_as_the_wire_format(spark):
    import base64
    import random

    rng = random.Random(11)
    texts = ["", "=", "==", "YQ", "YQ==", "YQ= =", "Y Q==", "YQ==YQ==", "YR==", "A===", "YWJj",
             "YWJj\n", "YWJj\r\n", "YWJjZA=\t", "YW Jj", "YWJjYW\nJj", "Y-_j", "é===", "YWJ\u00a0"]
    texts += ["".join(rng.choice("AZaz09+/= \n") for _ in range(rng.randrange(13)))
              for _ in range(3000)]
    texts += [base64.b64encode(rng.randbytes(n)).decode() for n in (1, 2, 3, 300, 9000)]

    def strict(text):
        try:
            return base64.b64decode(text, validate=True)
        except ValueError:
            return None

    logs = ["Program AAA invoke [1]", *["Program data: " + t for t in texts]]
    want = [(i + 1, "AAA", strict(t)) for i, t in enumerate(texts) if strict(t) is not None]
    assert _hits(spark, logs) == want


def test_every_type_round_trips(spark, catalog):
    logs = logs_of(PUMP, payload("pump", "EveryType", EVERY))
    row = events_of(decode(_frame(spark, [("s", False, logs)]), catalog)).first()
    assert json.loads(row.payload_json) == EVERY_OUT
    keys = list(json.loads(row.payload_json))
    assert keys == sorted(keys)
    assert " " not in row.payload_json and "héllo" in row.payload_json
    import hashlib

    assert row.event_id == hashlib.sha256(f"s|{PUMP}|1|EveryType".encode()).hexdigest()


def test_quarantine_reasons(spark, catalog):
    import hashlib

    good = payload("pump", "CompleteEvent")
    every = payload("pump", "EveryType", EVERY)
    cases = [
        (b"abc", "unknown-discriminator"),
        (b"\xff" * 20, "unknown-discriminator"),
        (good[:-1], "decode-error: buffer underrun: need 8 bytes at offset 96, only 7 remain"),
        (good + b"\0\0", "schema-drift-trailing-bytes:2"),
        (payload("pump", "Admin")[:-1] + b"\2", "decode-error: invalid bool byte 2"),
        (payload("pump", "NotAStruct", (0, [])),
         "decode-error: event NotAStruct did not decode to a struct"),
        (bytes([9, 0, 255, 7, 1, 2, 3, 9]), "decode-error: IDL type 'Undefined' not found"),
        (every.replace("héllo".encode(), b"h\xff\xfello"),
         "decode-error: invalid UTF-8 in string"),
    ]
    logs = logs_of(PUMP, *[raw for raw, _ in cases], good)
    decoded = decode(_frame(spark, [("s", False, logs), ("f", True, logs)]), catalog)
    bad = quarantine_of(decoded).orderBy("log_index").collect()
    assert [r.reason for r in bad] == [reason for _, reason in cases]
    assert [r.payload_size for r in bad] == [len(raw) for raw, _ in cases]
    assert bad[0].discriminator_hex == b"abc".hex()
    assert bad[0].event_id == hashlib.sha256(f"s|{PUMP}|1|program-data".encode()).hexdigest()
    assert [r.event_type for r in events_of(decoded).collect()] == ["CompleteEvent"]


def test_unknown_programs_are_ignored_and_each_program_has_its_own_layouts(spark, catalog):
    logs = logs_of("Other", payload("pump", "CompleteEvent")) + logs_of(
        SWAP, payload("pumpswap", "CreatePoolEvent")
    )
    rows = events_of(decode(_frame(spark, [("s", False, logs)]), catalog)).collect()
    assert [(r.protocol, r.event_type) for r in rows] == [("pumpswap", "CreatePoolEvent")]


def test_codec_errors_row_by_row(catalog):
    types = {"E": ("struct", [("o", {"option": "u8"}), ("v", {"vec": "u8"}), ("s", "string")])}
    good = b"\1\5" + b"\2\0\0\0\7\x08" + b"\1\0\0\0k"
    rows = [
        good,
        b"\2",
        b"\0" + (1_000_001).to_bytes(4, "little"),
        b"\0\3\0\0\0\1",
        b"\0\0\0\0\0\x09\0\0\0ab",
        good + b"!",
    ]
    out = decode_payloads("E", rows, types)
    assert json.loads(out[0]["payload_json"]) == {"o": 5, "v": [7, 8], "s": "k"}
    assert [r["error"] for r in out[1:5]] == [
        "invalid Option tag 2",
        "refusing implausible vector length 1000001",
        "buffer underrun: need 1 bytes at offset 6, only 0 remain",
        "string length 9 exceeds remaining buffer",
    ]
    assert out[5]["trailing_bytes"] == 1
    bad = {"E": ("struct", [("x", "f32")]), "C": ("struct", [("x", {"map": 1})])}
    assert decode_payloads("E", [b""], bad)[0]["error"] == "unsupported primitive type 'f32'"
    assert "unsupported compound type" in decode_payloads("C", [b""], bad)[0]["error"]
    enum = {"E": ("struct", [("c", {"defined": "K"})]), "K": ("enum", [("A", [])])}
    assert decode_payloads("E", [b"\1"], enum)[0]["error"] == "enum K: invalid variant 1"


def test_fixed_width_path_equals_the_codec(spark):
    layout = [("a", "u64"), ("b", "i64"), ("c", "u8"), ("d", "i16"), ("e", "bool")]
    types = {"E": ("struct", layout)}
    values = [(2**64 - 1, -1, 255, -2, 1), (0, -(2**63), 0, 32767, 0), (1, 2**63 - 1, 7, -1, 1)]
    raws = [
        a.to_bytes(8, "little") + b.to_bytes(8, "little", signed=True) + bytes([c])
        + d.to_bytes(2, "little", signed=True) + bytes([e])
        for a, b, c, d, e in values
    ]
    df = spark.createDataFrame([(bytearray(b"DISCRIMI" + r),) for r in raws], "raw binary")
    got = [tuple(int(x) for x in r) for r in decode_fixed(df, layout).drop("raw").collect()]
    assert sorted(got) == sorted(values)
    assert [json.loads(r["payload_json"])["b"] for r in decode_payloads("E", raws, types)] == [
        v[1] for v in values
    ]
    short = spark.createDataFrame([(bytearray(b"DISCRIMI" + raws[0] + b"x"),)], "raw binary")
    assert decode_fixed(short, layout).first().a is None


def test_catalog_tables(spark, catalog_paths, catalog):
    documents = read_catalog_documents(spark, catalog_paths)
    events = {r.event_type: bytes(r.discriminator) for r in event_rows(documents).collect()}
    assert events["TradeEvent"] == bytes([2, 0, 255, 7, 1, 2, 3, 2])
    fields = field_rows(documents)
    trade = fields.filter("type_name = 'TradeEvent'").orderBy("position").collect()
    assert [r.field_name for r in trade[:2]] == ["mint", "sol_amount"]
    assert catalog.layouts[PUMP]["Choice"][1][2] == ("Plain", [(None, "u16"), (None, "bool")])
    import hashlib

    inventory = {r.protocol: r for r in catalog_inventory(documents).collect()}
    body = open(catalog_paths["pumpswap"], "rb").read()
    assert inventory["pumpswap"].sha256 == hashlib.sha256(body).hexdigest()
    assert inventory["pumpswap"].events == ["BuyEvent", "CreatePoolEvent", "SellEvent"]
    changed = fields.withColumn(
        "field_type",
        F.when(F.col("field_name") == "bps", F.lit('"u32"')).otherwise(F.col("field_type")),
    ).filter("type_name <> 'Admin'")
    diff = {(r.type_name, r.change) for r in diff_catalogs(fields, changed).collect()}
    assert diff == {("Share", "changed"), ("Admin", "removed")}


def test_protocol_selection():
    import pytest

    assert select_protocols(" Pump, pumpswap ") == ("pump", "pumpswap")
    for bad in ("", " , ", "pump,other"):
        with pytest.raises(ValueError):
            select_protocols(bad)


def _flat(value, spec, types):
    """A typed value in the form of the codec's JSON."""
    if value is None:
        return None
    if isinstance(spec, str):
        if spec in ("u128", "i128"):
            return (int(value["high"]) << 64) + int(value["low"])
        if spec in ("bytes", "pubkey"):
            return bytes(value).hex() if spec == "bytes" else b58(bytes(value))
        return int(value) if spec[0] in "ui" else value
    if "option" in spec:
        return _flat(value, spec["option"], types)
    if "vec" in spec or "array" in spec:
        inner = spec["vec"] if "vec" in spec else spec["array"][0]
        return [_flat(v, inner, types) for v in value]
    if "tuple" in spec:
        return [_flat(v, s, types) for v, s in zip(value, spec["tuple"], strict=True)]
    kind, members = types[spec["defined"]["name"] if isinstance(spec["defined"], dict) else spec["defined"]]
    if kind == "struct":
        return _members(value, members, types)
    fields = dict(members)[value["variant"]]
    out = {"variant": value["variant"]}
    return out | ({"fields": _members(value[value["variant"]], fields, types)} if fields else {})


def _members(value, members, types):
    if members and members[0][0] is None:
        return [_flat(v, t, types) for v, (_, t) in zip(value, members, strict=True)]
    return {n: _flat(value[n], t, types) for n, t in members}


def b58(raw):
    from ledgerloom.functions.base58 import encode_matrix

    return encode_matrix(np.frombuffer(raw, dtype=np.uint8).reshape(1, -1))[0]


def _typed(spark, event, types, bodies):
    """(JSON value or None, reason) for each payload."""
    df = spark.createDataFrame([(i, bytearray(b"DISCRIMI" + b)) for i, b in enumerate(bodies)], "i int, raw binary")
    rows = sorted(decode_typed(df, event, types).collect(), key=lambda r: r.i)
    members = types[event][1]
    return [(None if r.reason else _members(r, members, types), r.reason) for r in rows]


def _codec(event, types, bodies):
    out = []
    for r in decode_payloads(event, bodies, types):
        if r["error"] is not None:
            out.append((None, f"decode-error: {r['error']}"))
        elif r["trailing_bytes"]:
            out.append((None, f"schema-drift-trailing-bytes:{r['trailing_bytes']}"))
        else:
            out.append((json.loads(r["payload_json"]), None))
    return out


def test_typed_columns_equal_the_codec_on_every_type_and_every_cut(spark, catalog):
    types = catalog.layouts[PUMP]
    whole = payload("pump", "EveryType", EVERY)[8:]
    bodies = [whole[:n] for n in range(len(whole) + 1)] + [whole + b"!", whole.replace("é".encode(), b"\xff\xfe")]
    got = _typed(spark, "EveryType", types, bodies)
    assert got == _codec("EveryType", types, bodies)
    assert got[len(whole)][0] == EVERY_OUT


def test_typed_columns_equal_the_codec_on_broken_bytes(spark, catalog):
    import random

    rng = random.Random(11)
    types = catalog.layouts[PUMP]
    whole = payload("pump", "EveryType", EVERY)[8:]
    bodies = []
    for _ in range(400):
        body = bytearray(whole)
        for _ in range(rng.randrange(1, 4)):
            body[rng.randrange(len(body))] = rng.choice((0, 1, 2, 9, 128, 255))
        bodies.append(bytes(body))
    assert _typed(spark, "EveryType", types, bodies) == _codec("EveryType", types, bodies)


def test_typed_columns_of_odd_layouts(spark):
    import pytest

    types = {
        "E": ("struct", [("a", {"vec": {"option": {"tuple": ["u8", "bool"]}}}), ("b", {"vec": "u64"}), ("c", {"vec": {"defined": "N"}})]),
        "N": ("struct", []),
        "X": ("struct", [("f", "f32")]), "Y": ("struct", [("m", {"map": 1})]), "Z": ("struct", [("d", {"defined": "Gone"})]),
        "L": ("struct", [("next", {"option": {"defined": "L"}})]),
    }
    four = [n.to_bytes(4, "little") for n in range(4)]
    bodies = [
        b"", four[0] * 3, four[2] + b"\0\1\5\1" + four[1] + b"\xff" * 8 + four[3], four[2] + b"\0\1\5\7",
        four[0] + four[3] + b"\1" * 17, four[0] * 2 + (1_000_001).to_bytes(4, "little"), b"\xff" * 4, four[3] + b"\0\0",
    ]
    fine = _typed(spark, "E", types, bodies)
    want = _codec("E", types, bodies)
    assert [r for _, r in fine] == [r for _, r in want]
    df = spark.createDataFrame([(bytearray(b"DISCRIMI" + bodies[2]),), (None,)], "raw binary")
    full, none = sorted(decode_typed(df, "E", types).collect(), key=lambda r: r.raw is None)
    assert full.a == [None, (5, True)] and [int(v) for v in full.b] == [2**64 - 1] and full.c == [True] * 3
    assert (none.a, none.b, none.c, none.reason) == (None,) * 4
    for event in "XYZ":
        assert [r for _, r in _typed(spark, event, types, [b""])] == [r for _, r in _codec(event, types, [b""])]
    with pytest.raises(ValueError, match="holds itself"):
        decode_typed(df, "L", types)
    assert "Python" not in decode_typed(df, "E", types)._jdf.queryExecution().toString()
