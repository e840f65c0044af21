"""Base58 text of binary keys, one numpy pass per Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the base58 alphabet (no 0, O, I, l).
ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"

_SYMBOLS = np.frombuffer(ALPHABET.encode(), dtype=np.uint8)
_GROUP = 5  # 58**5 is the largest power that fits a 32-bit remainder
_BASE = np.uint64(58**_GROUP)


def encode_matrix(keys: np.ndarray, lengths: np.ndarray | None = None) -> list[str]:
    """Encode the rows of an ``(n, width)`` byte matrix.

    Rows shorter than ``width`` are right-aligned, with their true size in ``lengths``. Every
    row is divided by 58**5 limb by limb; the loops run over the width, never over rows.
    """
    n, width = keys.shape
    if lengths is None:
        lengths = np.full(n, width)
    padded = np.zeros((n, -(-max(width, 1) // 4) * 4), dtype=np.uint8)
    if width:
        padded[:, -width:] = keys
    limbs = np.ascontiguousarray(padded.view(">u4").astype(np.uint64).T)
    groups, lead = int(padded.shape[1] * 8 / (_GROUP * np.log2(58))) + 1, 0
    digits = np.zeros((n, groups * _GROUP), dtype=np.uint8)
    for g in range(groups):
        rest = np.zeros(n, dtype=np.uint64)
        # Limbs that are zero in every row stay so.
        while lead < len(limbs) and not limbs[lead].any():
            lead += 1
        for j in range(lead, len(limbs)):
            current = (rest << np.uint64(32)) | limbs[j]
            limbs[j] = current // _BASE
            rest = current - limbs[j] * _BASE
        small = rest.astype(np.uint32)
        for d in range(_GROUP):
            whole = small // np.uint32(58)
            digits[:, -1 - g * _GROUP - d] = small - whole * np.uint32(58)
            small = whole
    text = _SYMBOLS[digits].tobytes().decode("ascii")
    size = digits.shape[1]
    first = np.where(digits.any(axis=1), (digits != 0).argmax(axis=1), size)
    used = np.where(padded.any(axis=1), (padded != 0).argmax(axis=1), padded.shape[1])
    zeros = lengths - (padded.shape[1] - used)
    return [
        "1" * z + text[i * size + f : (i + 1) * size]
        for i, (z, f) in enumerate(zip(zeros.tolist(), first.tolist(), strict=True))
    ]


def encode_array(keys: pa.Array) -> pa.Array:
    """Encode a binary Arrow array; null stays null."""
    values = keys.to_pylist()
    raw = [v or b"" for v in values]
    lengths = np.array([len(v) for v in raw], dtype=np.int64)
    width = int(lengths.max()) if len(raw) else 0
    matrix = np.frombuffer(b"".join(v.rjust(width, b"\0") for v in raw), dtype=np.uint8)
    texts = encode_matrix(matrix.reshape(len(raw), width), lengths)
    return pa.array(
        [None if v is None else t for v, t in zip(values, texts, strict=True)], pa.string()
    )


def b58encode(col: Column) -> Column:
    """Base58 of a binary column."""

    @F.arrow_udf("string")
    def encode(keys: pa.Array) -> pa.Array:
        return encode_array(keys)

    return encode(col)
