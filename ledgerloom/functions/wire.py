"""Payload layouts of any length as typed columns, made of built-in functions only.

The layout is known when the plan is made, so it becomes one expression: each read takes the place
where the last one ended and gives its value, the next place and the first broken rule. Runs of
fields of fixed width are checked and placed at once; only text, options, vectors and enums move
the place at run time. Messages are those of the codec in ``borsh``.

Wire types become: integers below 64 bits and ``i64`` BIGINT, ``u64`` DECIMAL(20,0), 128 bits
``struct<high, low>`` of two DECIMAL(20,0) (value: high * 2^64 + low), keys and bytes BINARY, options
null or their value, vectors and arrays ARRAY, tuples and structs STRUCT (``_0``, ``_1``, … without
names), enums ``struct<variant, …>`` with one nullable struct for each variant that has fields.
A struct without fields is the BOOLEAN true.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.borsh import INTEGERS, MAX_VECTOR

_SIZES = {name: size for name, (size, _) in INTEGERS.items()} | {"bool": 1, "pubkey": 32}
_NIBBLES = 0x0F0F0F0F0F0F0F0F


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bigint(raw: Column, at: Column, size: int) -> Column:
    """Up to eight little-endian bytes as the BIGINT with these bits."""
    digits = F.reverse(F.hex(F.substring(raw, at + 1, F.lit(size))))
    swapped = F.conv(digits, 16, -10).cast("bigint")
    low = F.shiftleft(swapped.bitwiseAND(F.lit(_NIBBLES)), 4)
    return low.bitwiseOR(F.shiftrightunsigned(swapped, 4).bitwiseAND(F.lit(_NIBBLES)))


def _unsigned(bits: Column) -> Column:
    wide = bits.cast("decimal(20,0)")
    two = F.when(bits < 0, F.lit(str(1 << 64))).otherwise("0").cast("decimal(20,0)")
    return (wide + two).cast("decimal(20,0)")


def _primitive(kind: str, raw: Column, at: Column) -> Column:
    if kind == "pubkey":
        return F.substring(raw, at + 1, F.lit(32))
    size = _SIZES[kind]
    if size == 16:
        high = _bigint(raw, at + 8, 8)
        top = _unsigned(high) if kind == "u128" else high.cast("decimal(20,0)")
        return F.struct(top.alias("high"), _unsigned(_bigint(raw, at, 8)).alias("low"))
    bits = _bigint(raw, at, size)
    if kind == "bool":
        return bits == 1
    if kind.startswith("i"):
        return F.shiftright(F.shiftleft(bits, 64 - 8 * size), 64 - 8 * size)
    return _unsigned(bits) if size == 8 else bits


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _result(value: Column, at: Column, error: Column) -> Column:
    return F.struct(value.alias("value"), at.alias("at"), error.alias("error"))


class Layout:
    """Types of one program, as ``Catalog.layouts`` holds them, read from the column ``raw``."""

    def __init__(self, types: dict, raw: Column):
        self.types = types
        self.raw = raw
        self.end = F.octet_length(raw)

    def fields_of(self, spec) -> list | None:
        """(name, type) pairs of a tuple or struct; None for any other type."""
        if isinstance(spec, dict) and "tuple" in spec:
            return [(None, s) for s in spec["tuple"]]
        kind, members = self.defined(spec)
        return members if kind == "struct" else None

    def defined(self, spec) -> tuple:
        if not isinstance(spec, dict) or "defined" not in spec:
            return None, []
        name = spec["defined"]
        return self.types.get(name["name"] if isinstance(name, dict) else name, (None, []))

    def sql_type(self, spec, path: tuple = ()) -> str:
        """The type of the column that ``spec`` becomes. Types that hold themselves are refused."""
        if isinstance(spec, str):
            if spec in ("u128", "i128"):
                return "struct<high: decimal(20,0), low: decimal(20,0)>"
            return {"u64": "decimal(20,0)", "bool": "boolean", "pubkey": "binary", "bytes": "binary"}.get(
                spec, "bigint" if spec in INTEGERS else "string"
            )
        if repr(spec) in path:
            raise ValueError(f"{spec!r} holds itself: no column type fits")
        path = (*path, repr(spec))
        if "option" in spec:
            return self.sql_type(spec["option"], path)
        if "vec" in spec or "array" in spec:
            inner = spec["vec"] if "vec" in spec else spec["array"][0]
            return f"array<{self.sql_type(inner, path)}>"
        kind, members = self.defined(spec)
        if kind == "enum":
            bodies = [(v, self.struct_type(fields, path)) for v, fields in members if fields]
            return f"struct<{', '.join(['variant: string', *[f'`{v}`: {t}' for v, t in bodies]])}>"
        fields = self.fields_of(spec)
        return "string" if fields is None else self.struct_type(fields, path)

    def struct_type(self, fields: list, path: tuple) -> str:
        parts = [f"`{n or f'_{i}'}`: {self.sql_type(t, path)}" for i, (n, t) in enumerate(fields)]
        return f"struct<{', '.join(parts)}>" if parts else "boolean"

    def smallest(self, spec) -> int:
        """A lower bound of the bytes a value takes."""
        if isinstance(spec, str):
            return _SIZES.get(spec, 4)
        fields = self.fields_of(spec)
        if fields is not None:
            return sum(self.smallest(t) for _, t in fields)
        return int(spec["array"][1]) * self.smallest(spec["array"][0]) if "array" in spec else 1

    def short(self, at: Column, size: Column | int) -> Column:
        """The message when ``size`` bytes do not follow, else null."""
        size = F.lit(size) if isinstance(size, int) else size
        message = _text("buffer underrun: need ", size, " bytes at offset ", at, ", only ", self.end - at, " remain")
        return F.when(size > self.end - at, message)

    def read(self, spec, at: Column, error: Column) -> Column:
        """``struct<value, at, error>``; what follows an error is null and moves nothing."""
        if isinstance(spec, str) and spec in _SIZES:
            return self.read_fields([(None, spec)], at, error, lambda v: v[0])
        if spec in ("string", "bytes"):
            return self.read_bytes(spec, at, error)
        if isinstance(spec, str):
            return self.reject(spec, at, error, f"unsupported primitive type {spec!r}")
        if "option" in spec:
            return self.read_option(spec["option"], at, error)
        if "vec" in spec:
            return self.read_vector(spec["vec"], at, error)
        if "array" in spec:
            inner, count = spec["array"]
            return self.read_many(inner, F.lit(int(count)), at, error)
        kind, members = self.defined(spec)
        if kind == "enum":
            return self.read_enum(spec, members, at, error)
        fields = self.fields_of(spec)
        if fields is not None:
            return self.read_struct(fields, at, error)
        if "defined" not in spec:
            return self.reject(spec, at, error, f"unsupported compound type {spec!r}")
        name = spec["defined"]["name"] if isinstance(spec["defined"], dict) else spec["defined"]
        known = f"unsupported IDL kind {kind!r}" if kind else f"IDL type {name!r} not found"
        return self.reject(spec, at, error, known)

    def reject(self, spec, at: Column, error: Column, message: str) -> Column:
        return _result(F.lit(None).cast(self.sql_type(spec)), at, F.coalesce(error, F.lit(message)))

    def read_struct(self, fields: list, at: Column, error: Column) -> Column:
        def build(values: list[Column]) -> Column:
            named = [v.alias(n or f"_{i}") for i, (v, (n, _)) in enumerate(zip(values, fields, strict=True))]
            return F.struct(*named) if named else F.lit(True)

        return self.read_fields(fields, at, error, build)

    def read_fields(self, fields: list, at: Column, error: Column, build, done: tuple = ()) -> Column:
        """Fields in order, then ``build`` of their values; null if any of them is broken."""
        rest = fields[len(done) :]
        if not rest:
            return _result(F.when(error.isNull(), build(list(done))), at, error)
        run = 0
        while run < len(rest) and isinstance(rest[run][1], str) and rest[run][1] in _SIZES:
            run += 1
        if run == 0:
            step = self.read(rest[0][1], at, error)
            return _let(
                step, lambda s: self.read_fields(fields, s["at"], s["error"], build, (*done, s["value"]))
            )
        checks, places, place = [error], [], at
        for _, kind in rest[:run]:
            checks.append(self.short(place, _SIZES[kind]))
            if kind == "bool":
                byte = _bigint(self.raw, place, 1)
                checks.append(F.when(byte > 1, _text("invalid bool byte ", byte)))
            places.append(place)
            place = place + _SIZES[kind]
        step = _let(
            F.coalesce(*checks),
            lambda e: F.struct(F.when(e.isNull(), place).otherwise(at).alias("at"), e.alias("error")),
        )
        values = [
            F.when(error.isNull(), _primitive(kind, self.raw, where))
            for (_, kind), where in zip(rest[:run], places, strict=True)
        ]
        return _let(step, lambda s: self.read_fields(fields, s["at"], s["error"], build, (*done, *values)))

    def read_bytes(self, kind: str, at: Column, error: Column) -> Column:
        def body(head: Column) -> Column:
            start, length = head["at"], head["value"]
            content = F.substring(self.raw, start + 1, length.cast("int"))
            if kind == "bytes":
                bad = self.short(start, length)
                value = content
            else:
                value = content.cast("string")
                message = _text("string length ", length, " exceeds remaining buffer")
                bad = F.when(length > self.end - start, message).when(
                    ~F.is_valid_utf8(value), "invalid UTF-8 in string"
                )
            return _let(
                F.coalesce(head["error"], bad),
                lambda e: _result(
                    F.when(e.isNull(), value),
                    F.when(e.isNull(), start + length.cast("int")).otherwise(start),
                    e,
                ),
            )

        return _let(self.read("u32", at, error), body)

    def read_option(self, inner, at: Column, error: Column) -> Column:
        def body(tag: Column) -> Column:
            bad = F.when(tag["value"] > 1, _text("invalid Option tag ", tag["value"]))
            some = self.read(inner, tag["at"], tag["error"])
            none = _result(
                F.lit(None).cast(self.sql_type(inner)), tag["at"], F.coalesce(tag["error"], bad)
            )
            return F.when(tag["value"] == 1, some).otherwise(none)

        return _let(self.read("u8", at, error), body)

    def read_vector(self, inner, at: Column, error: Column) -> Column:
        def body(head: Column) -> Column:
            message = _text("refusing implausible vector length ", head["value"])
            bad = F.coalesce(head["error"], F.when(head["value"] > MAX_VECTOR, message))
            return _let(bad, lambda e: self.read_many(inner, head["value"].cast("int"), head["at"], e))

        return _let(self.read("u32", at, error), body)

    def read_many(self, inner, count: Column, at: Column, error: Column) -> Column:
        """``count`` values in order.

        Numbers and keys are placed by their index. Others are folded: the values read so far are
        copied by each step, which payloads bounded by a transaction's size allow.
        """
        kind = f"array<{self.sql_type(inner)}>"
        size = _SIZES.get(inner) if isinstance(inner, str) and inner != "bool" else None
        if size:
            fit = F.floor((self.end - at) / F.lit(size)).cast("int")
            bad = F.when(fit < count, self.short(at + fit * size, size))
            numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
            return _let(
                F.coalesce(error, bad),
                lambda e: _result(
                    F.when(e.isNull(), F.transform(numbers, lambda i: _primitive(inner, self.raw, at + i * size))),
                    F.when(e.isNull(), at + count * size).otherwise(at),
                    e,
                ),
            )
        # A step past the end is broken, so no more of them are needed than bytes are left.
        steps = F.least(count, self.end - at + 1) if self.smallest(inner) else count
        turns = F.when(error.isNull() & (steps > 0), F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
        start = _result(F.array().cast(kind), at, error)

        def step(state: Column, _turn: Column) -> Column:
            return _let(
                self.read(inner, state["at"], state["error"]),
                lambda r: _result(
                    F.when(r["error"].isNull(), F.concat(state["value"], F.array(r["value"]))).otherwise(state["value"]),
                    r["at"],
                    r["error"],
                ),
            )

        return F.aggregate(turns, start, step)

    def read_enum(self, spec, variants: list, at: Column, error: Column) -> Column:
        name = spec["defined"]["name"] if isinstance(spec["defined"], dict) else spec["defined"]
        kind = self.sql_type(spec)
        with_fields = [(v, fields) for v, fields in variants if fields]

        def value(label: str, content: Column | None) -> Column:
            bodies = [
                (content if v == label else F.lit(None)).cast(self.struct_type(fields, ())).alias(v)
                for v, fields in with_fields
            ]
            return F.struct(F.lit(label).alias("variant"), *bodies).cast(kind)

        def named(label: str) -> Callable[[Column], Column]:
            return lambda r: _result(F.when(r["error"].isNull(), value(label, r["value"])), r["at"], r["error"])

        def body(index: Column) -> Column:
            bad = _text(f"enum {name}: invalid variant ", index["value"])
            out = F.when(index["error"].isNotNull(), _result(F.lit(None).cast(kind), index["at"], index["error"]))
            for i, (label, fields) in enumerate(variants):
                if fields:
                    found = _let(self.read_struct(fields, index["at"], index["error"]), named(label))
                else:
                    found = _result(value(label, None), index["at"], index["error"])
                out = out.when(index["value"] == i, found)
            return out.otherwise(_result(F.lit(None).cast(kind), index["at"], bad))

        return _let(self.read("u8", at, error), body)


def typed_payload(raw: Column, event_type: str, types: dict, skip: int = 8) -> Column:
    """``struct<value, error, trailing_bytes>`` of a whole payload after ``skip`` bytes; null for null."""
    kind, members = types.get(event_type, ("struct", None))
    Layout(types, raw).sql_type({"defined": event_type})  # refuses layouts that hold themselves
    body = F.substring(raw, F.lit(skip + 1), F.greatest(F.octet_length(raw) - skip, F.lit(0)))
    if members is None:
        raise ValueError(f"no layout of {event_type}")
    if kind != "struct":
        raise ValueError(f"event {event_type} did not decode to a struct")

    def whole(payload: Column) -> Column:
        layout = Layout(types, payload)
        result = layout.read_struct(members, F.lit(0), F.lit(None).cast("string"))
        return _let(
            result,
            lambda r: F.struct(
                r["value"].alias("value"),
                r["error"].alias("error"),
                F.when(r["error"].isNull(), layout.end - r["at"]).alias("trailing_bytes"),
            ),
        )

    return F.when(raw.isNotNull(), _let(body, whole))
