"""Finding the few keys that hold so many rows that they must be split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Heavy:
    """When a key counts as heavy: more than ``share`` of all rows and at least ``min_rows``.

    At most ``1 / share`` keys can hold more than ``share`` of the rows, so the
    list of heavy keys has a proven bound and may be broadcast.
    """

    share: float = 1e-5
    min_rows: int = 1_000_000


def heavy_keys(df: DataFrame, keys: Sequence[str], rule: Heavy = Heavy()) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("n")).scalar()  # the same counts, no further scan
    bar = F.greatest(total * F.lit(rule.share), F.lit(float(rule.min_rows)))
    return counts.where(F.col("__n") > bar).select(*keys)


def split_heavy(df: DataFrame, keys: Sequence[str], rule: Heavy = Heavy()) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of heavy keys).

    Rows without a key count as ordinary.  With no heavy key, adaptive execution
    finds the second part empty and skips its scan.
    """
    heavy = F.broadcast(heavy_keys(df, keys, rule))
    return df.join(heavy, list(keys), "left_anti"), df.join(heavy, list(keys))


def chunk_of(at: Column, width: int) -> Column:
    """Time slice number."""
    return F.floor(at / F.lit(width))
