"""Which program emitted each ``Program data:`` line, over Arrow batches of whole logs."""

from __future__ import annotations

import re
from binascii import Error, a2b_base64
from collections.abc import Callable, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Log line formats.
DATA_PREFIX = "Program data: "
_KEY = "[1-9A-HJ-NP-Za-km-z]+"
_INVOKE = re.compile(rf"Program ({_KEY}) invoke \[\d+\]\n?\Z")
_EXIT = re.compile(rf"Program ({_KEY}) (?:success|failed: [^\n]+)\n?\Z")

HIT = "log_index: int, program_id: string, raw: binary"
_HIT = [pa.field("log_index", pa.int32()), pa.field("program_id", pa.string()), pa.field("raw", pa.binary())]
_SLICE = 2000  # transactions whose lines are Python objects at a time
Decoded = Callable[[Sequence[str], Sequence[bytes]], pa.Array]


def strict_base64(text: str) -> bytes | None:
    """Bytes of padded base64; null when a character or the padding is wrong."""
    try:
        return a2b_base64(text, strict_mode=True)
    except (Error, ValueError):
        return None


@lru_cache(maxsize=1 << 14)
def _move(line: str) -> tuple[str, bool] | None:
    """The program a line enters (true) or leaves; null for any other line. Such lines repeat."""
    if entered := _INVOKE.match(line):
        return entered[1], True
    left = _EXIT.match(line)
    return (left[1], False) if left else None


def data_lines(logs: list[str | None]) -> list[tuple[int, str, bytes]]:
    """(log_index, program_id, raw) of one transaction's data lines."""
    stack, hits = [], []
    for i, line in enumerate(logs):
        if line is None or not line.startswith("Program "):
            continue
        if line.startswith(DATA_PREFIX):
            raw = strict_base64(line[len(DATA_PREFIX) :]) if stack else None
            if raw is not None:
                hits.append((i, stack[-1], raw))
        elif (" invoke [" in line or " success" in line or " failed: " in line) and (move := _move(line)):
            program, enters = move
            if enters:
                stack.append(program)
            elif program in stack:
                while stack.pop() != program:
                    pass
    return hits


def data_reader(decoded: Decoded | None = None, kind: str = ""):
    """Arrow UDF ``logs -> array<struct<HIT>>``; null logs give an empty array.

    With ``decoded``, which makes an array of the type ``kind`` out of programs and payloads, each hit
    has it as ``decoded``. Marked non-deterministic: Spark drops empty arrays below the generator that
    opens them, and would read all logs for that once more.
    """
    hit = f"{HIT}, decoded: {kind}" if decoded else HIT

    @F.arrow_udf(f"array<struct<{hit}>>")
    def read(logs: pa.Array) -> pa.Array:
        parts = [_read(logs.slice(i, _SLICE), decoded) for i in range(0, len(logs), _SLICE)]
        return pa.concat_arrays(parts) if parts else _read(logs, decoded)

    udf = read.asNondeterministic()

    def call(logs: Column) -> Column:
        return udf(logs)

    return call


def _read(logs: pa.Array, decoded: Decoded | None) -> pa.Array:
    """The hits of each transaction."""
    lines = logs.flatten().to_numpy(zero_copy_only=False).tolist()
    begin, ends, hits = 0, [0], []
    for size in logs.value_lengths().fill_null(0).to_pylist():
        hits += data_lines(lines[begin : begin + size])
        begin += size
        ends.append(len(hits))
    columns = list(zip(*hits, strict=True)) if hits else [(), (), ()]
    values, fields = [pa.array(c, f.type) for c, f in zip(columns, _HIT, strict=True)], list(_HIT)
    if decoded:
        values.append(decoded(*columns[1:]))
        fields.append(pa.field("decoded", values[-1].type))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(values, fields=fields))
