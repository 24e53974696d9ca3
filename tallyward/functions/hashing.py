"""Deterministic pseudo-random draws.

A draw is a function of a row key and a stream name, so it does not depend on
partitioning, retries or speculative tasks, and SQL can reproduce it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_unit(key: Column, stream: str | int) -> Column:
    """Uniform number in [0, 1) from the first 52 bits of ``md5(key:stream)``."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{stream}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def json_number(value: Column) -> Column:
    """A double as plain decimal text (``12.0``), also where Spark would use an exponent."""
    plain = F.regexp_replace(value.cast("decimal(38,10)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    shown = value.cast("string")
    return F.when(shown.contains("E"), plain).otherwise(shown)


def canonical_json(fields: dict[str, Column]) -> Column:
    """JSON object text with sorted keys; values must already be JSON text."""
    parts: list[Column] = []
    for i, key in enumerate(sorted(fields)):
        parts.append(F.lit(("{" if i == 0 else ", ") + f'"{key}": '))
        parts.append(F.coalesce(fields[key], F.lit("null")))
    return F.concat(*parts, F.lit("}"))


def fingerprint(fields: dict[str, Column]) -> Column:
    """First 16 hex digits of SHA-256 over the canonical JSON text."""
    return F.substring(F.sha2(canonical_json(fields).cast("binary"), 256), 1, 16)


def prediction_key(transaction_id: Column, features_hash: Column) -> Column:
    return F.concat(F.lit("prediction:"), transaction_id.cast("string"), F.lit(":"), features_hash)


# Spark's xxhash64 over arrays: ``xxhash64(a, b)`` hashes b with the hash of a as its seed, so a hash
# of the first columns, taken in Spark, is carried on here over the last ones.

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
# By width in bytes: factor of the value, bits to turn, factor and term after it.
_WORDS = {8: (_P1, 27, _P1, _P4), 4: (_P1, 23, _P2, _P3), 1: (_P5, 11, _P1, np.uint64(0))}


def _turned(h: np.ndarray, bits: int, spare: np.ndarray) -> None:
    """Rotate left, in place."""
    np.left_shift(h, bits, out=spare)
    np.right_shift(h, 64 - bits, out=h)
    np.bitwise_or(h, spare, out=h)


def _mixed(h: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The last step of every hash, in place."""
    for shift, prime in ((33, _P2), (29, _P3), (32, None)):
        np.right_shift(h, shift, out=spare)
        np.bitwise_xor(h, spare, out=h)
        if prime is not None:
            np.multiply(h, prime, out=h)
    return h


def _taken(h: np.ndarray, unit: tuple[int, int], spare: np.ndarray) -> None:
    """One word, half word or byte of a text, in place."""
    width, value = unit
    by, turn, times, plus = _WORDS[width]
    if width == 8:
        k = value * int(_P2) & (1 << 64) - 1
        value = (k << 31 | k >> 33) & (1 << 64) - 1
    np.bitwise_xor(h, np.uint64(value * int(by) & (1 << 64) - 1), out=h)
    _turned(h, turn, spare)
    np.multiply(h, times, out=h)
    if plus:
        np.add(h, plus, out=h)


def _units(data: bytes) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(data):
        width = next(w for w in (8, 4, 1) if len(data) - at >= w)
        yield width, int.from_bytes(data[at : at + width], "little")
        at += width


def carried_int(value: np.ndarray | int, seed: np.ndarray) -> np.ndarray:
    """``xxhash64(..., value)`` of 32-bit whole numbers, where ``seed`` is the hash of what comes before."""
    h = np.bitwise_xor(seed + (_P5 + np.uint64(4)), (np.asarray(value).astype(np.int64) & 0xFFFFFFFF).astype(np.uint64) * _P1)
    spare = np.empty_like(h)
    _turned(h, 23, spare)
    np.multiply(h, _P2, out=h)
    np.add(h, _P3, out=h)
    return _mixed(h, spare)


def carried_texts(texts: Sequence[str], seed: np.ndarray, spare: np.ndarray) -> Iterator[np.ndarray]:
    """``xxhash64(..., text)`` for each of some texts of one length under 32 bytes; their common beginning is hashed once."""
    units = [list(_units(t.encode())) for t in texts]
    size = {len(t.encode()) for t in texts}
    if len(size) != 1 or max(size) >= 32:
        raise ValueError("texts of one length, under 32 bytes")
    shared = 0
    while shared < len(units[0]) and len({tuple(u[: shared + 1]) for u in units}) == 1:
        shared += 1
    with np.errstate(over="ignore"):
        begun = seed + np.uint64((int(_P5) + size.pop()) & (1 << 64) - 1)
        for u in units[0][:shared]:
            _taken(begun, u, spare)
        for i, rest in enumerate(units):
            h = begun.copy() if i + 1 < len(units) else begun
            for u in rest[shared:]:
                _taken(h, u, spare)
            yield _mixed(h, spare)
