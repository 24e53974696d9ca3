"""Pieces shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: The white space of the contracts: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of this subpackage; ``sql`` is its DuckDB twin."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    # For plain ASCII the two agree, and lower() has a fast path for it.
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hash128(value: Column, name: str) -> list[Column]:
    """Two independent 64-bit hashes of a value, as columns ``name_1`` and ``name_2``."""
    return [F.xxhash64(value).alias(f"{name}_1"), F.xxhash64(F.lit(7), value).alias(f"{name}_2")]


#: Key tables are broadcast up to so many rows, which are counted before.
BROADCAST_ROWS = 500_000


def checked(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has been counted to be small enough; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
