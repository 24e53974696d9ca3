"""Synthetic minority rows from hash draws."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.hashing import hash_unit
from tallyward.operators.neighbours import nearest_neighbours
from tallyward.operators.ordering import ordinals
from tallyward.session import settle


def new_row_count(df: DataFrame, label: str, ratio: float) -> tuple[int, int]:
    """(new rows, minority rows) for the wanted minority / majority ratio."""
    c = df.agg(F.count_if(F.col(label) == 1).alias("n1"), F.count_if(F.col(label) == 0).alias("n0")).first()
    wanted = math.floor(ratio * c["n0"]) - c["n1"]
    if wanted < 0:
        raise ValueError("the minority is already larger than the wanted ratio")
    return wanted, c["n1"]


def _between(x: Column, other: Column, u: Column) -> Column:
    return F.zip_with(x, other, lambda a, b: a + u * (b - a))


def _finish(draws: DataFrame, near: DataFrame, rare: DataFrame, row: str, features: str) -> DataFrame:
    """Interpolate from (draw, base, pick, u): base row towards its pick-th neighbour.

    Vectors are joined by a shuffle: the size of their file says little about
    their size in memory, and a broadcast passes the driver.
    """
    base = rare.select(F.col(row).alias("base"), F.col(features).alias("x")).hint("merge")
    other = rare.select(F.col(row).alias("neighbour"), F.col(features).alias("y")).hint("merge")
    chosen = near.select(F.col("row_id").alias("base"), F.col("rank").alias("pick"), "neighbour")
    return (
        draws.join(chosen, ["base", "pick"]).join(base, "base").join(other, "neighbour")
        .select("draw", "base", "neighbour", _between(F.col("x"), F.col("y"), F.col("u")).alias(features))
    )


def smote(
    df: DataFrame, label: str = "label", ratio: float = 0.1, k: int = 5, seed: int = 42,
    row: str = "row_id", features: str = "features",
) -> DataFrame:
    """New minority rows (draw, base, neighbour, features).

    Draw j takes its base row, its neighbour and its weight from three hash
    streams of j, so any executor makes the same rows.
    """
    wanted, minority = new_row_count(df, label, ratio)
    rare = df.where(F.col(label) == 1).select(row, features)
    near = settle(nearest_neighbours(rare, rare, k, row, features, exclude_self=True))
    numbered = ordinals(rare.select(row), row, row).select(F.col("ordinal").alias("at"), F.col(row).alias("base"))
    j = F.col("draw")
    draws = df.sparkSession.range(wanted).select(F.col("id").alias("draw")).select(
        "draw",
        F.floor(hash_unit(j, f"{seed}:base") * minority).cast("bigint").alias("at"),
        (F.floor(hash_unit(j, f"{seed}:pick") * min(k, minority - 1)) + 1).cast("int").alias("pick"),
        hash_unit(j, f"{seed}:u").alias("u"),
    )
    return _finish(draws.join(numbered, "at").drop("at"), near, rare, row, features)


def adasyn(
    df: DataFrame, label: str = "label", ratio: float = 0.1, k: int = 5, seed: int = 42,
    row: str = "row_id", features: str = "features",
) -> DataFrame:
    """New minority rows, more of them where the neighbourhood is mostly majority."""
    wanted, minority = new_row_count(df, label, ratio)
    rare = df.where(F.col(label) == 1).select(row, features)
    around = nearest_neighbours(rare, df, k, row, features, exclude_self=True)
    kinds = df.select(F.col(row).alias("neighbour"), (F.col(label) == 0).cast("double").alias("other"))
    # one row per minority row, written once: the search serves the total and the copies
    share = settle(around.join(kinds, "neighbour").groupBy(F.col("row_id").alias("base")).agg(F.avg("other").alias("r")))
    total = share.agg(
        F.when(F.sum("r") > 0, F.sum("r")).otherwise(F.raise_error(F.lit("no minority row has majority neighbours")).cast("double")).alias("s")
    ).scalar()
    copies = F.round(F.col("r") / total * F.lit(float(wanted))).cast("int")
    key = F.concat_ws("-", F.col("base"), F.col("copy"))
    draws = (
        share.withColumn("copies", copies).where(F.col("copies") > 0)
        .select("base", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select(
            key.alias("draw"), "base",
            (F.floor(hash_unit(key, f"{seed}:pick") * min(k, minority - 1)) + 1).cast("int").alias("pick"),
            hash_unit(key, f"{seed}:u").alias("u"),
        )
    )
    near = settle(nearest_neighbours(rare, rare, k, row, features, exclude_self=True))
    return _finish(draws, near, rare, row, features)


def with_synthetic(df: DataFrame, new: DataFrame, label: str = "label", features: str = "features") -> DataFrame:
    """Original rows and synthetic ones in one table: (features, label, synthetic)."""
    return df.select(features, label, F.lit(False).alias("synthetic")).unionByName(
        new.select(features, F.lit(1).cast(df.schema[label].dataType).alias(label), F.lit(True).alias("synthetic"))
    )
