"""Deviation of a row from its user's recent history, with a global fallback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.ordering import exact_quantiles

QUARTILES = ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))


def last_n(df: DataFrame, user_col: str, order: Sequence[str], n: int) -> DataFrame:
    """Last ``n`` rows per user.

    Spark turns ``row_number <= n`` into a limit that already runs before the
    shuffle, so a heavy user sends at most ``n`` rows per input task.
    """
    w = Window.partitionBy(user_col).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def global_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, mean, std, q25, q50, q75) over the whole table."""
    rows = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(f"__{f}.mean").alias("mean"), F.col(f"__{f}.std").alias("std"))
            for f in features
        ]
    )
    basic = df.agg(
        *[F.struct(F.avg(f).alias("mean"), F.stddev_samp(f).alias("std")).alias(f"__{f}") for f in features]
    ).select(F.inline(rows))
    q = exact_quantiles(df, features, [s for s, _ in QUARTILES]).groupBy(F.col("column").alias("feature")).agg(
        *[F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for s, n in QUARTILES]
    )
    return basic.join(q, "feature", "left")


def global_moments(df: DataFrame, features: Sequence[str]) -> Column:
    """One scalar-subquery struct with ``{feature}_mean`` and ``{feature}_std``."""
    fields = []
    for f in features:
        fields += [F.avg(f).alias(f"{f}_mean"), F.stddev_samp(f).alias(f"{f}_std")]
    return df.agg(F.struct(*fields).alias("s")).scalar()


def user_stats(
    df: DataFrame, features: Sequence[str], user_col: str = "user_id",
    order: Sequence[str] = ("timestamp", "transaction_id"), window_size: int | None = 30, quantiles: bool = False,
) -> DataFrame:
    """Per user: ``n`` and per feature mean and std over the last rows (or all, ``window_size=None``).

    Quartiles use the in-memory percentile only because a history has at most
    ``window_size`` rows.
    """
    rows = df if window_size is None else last_n(df.select(user_col, *order, *[f for f in features if f not in order]), user_col, order, window_size)
    aggs = [F.count(F.lit(1)).alias("n")]
    for f in features:
        aggs += [F.avg(f).alias(f"{f}_mean"), F.stddev_samp(f).alias(f"{f}_std")]
        if quantiles:
            if window_size is None:
                raise ValueError("quartiles need a bounded history")
            aggs += [F.percentile(F.col(f), s).alias(f"{f}_{n}") for s, n in QUARTILES]
    return rows.groupBy(user_col).agg(*aggs)


def deviation(
    df: DataFrame, stats: DataFrame, moments: Column, features: Sequence[str],
    user_col: str = "user_id", min_transactions: int = 3, preset: str = "recent",
) -> DataFrame:
    """Add ``deviation_{f}_zscore`` and ``deviation_{f}_ratio``.

    ``recent``: short or unknown histories use the global statistics; a zero or
    missing std falls back to the global std, then to 1.
    ``full_history``: a zero or missing std or a zero mean becomes 1.
    """
    side = stats.select(
        user_col, F.col("n").alias("__n"),
        *[F.col(f"{f}_{s}").alias(f"__{f}_{s}") for f in features for s in ("mean", "std")],
    )
    joined = df.join(side, user_col, "left").withColumn("__g", moments)
    known = F.coalesce(F.col("__n"), F.lit(0)) >= F.lit(max(min_transactions, 1))
    out = []
    for f in features:
        v = F.col(f)
        if preset == "full_history":
            mean = F.coalesce(F.nullif(F.col(f"__{f}_mean"), F.lit(0.0)), F.lit(1.0))
            std = F.coalesce(F.nullif(F.col(f"__{f}_std"), F.lit(0.0)), F.lit(1.0))
            z = (v - F.col(f"__{f}_mean")) / std
            ratio = v / mean
        else:
            mean = F.when(known, F.col(f"__{f}_mean")).otherwise(F.col(f"__g.{f}_mean"))
            std = F.coalesce(
                F.nullif(F.when(known, F.col(f"__{f}_std")), F.lit(0.0)),
                F.nullif(F.col(f"__g.{f}_std"), F.lit(0.0)),
                F.lit(1.0),
            )
            z = (v - mean) / std
            ratio = F.when(mean != 0, F.try_divide(v.cast("double"), mean)).when(v == 0, F.lit(1.0)).when(v.isNotNull() & (mean == 0), F.lit(float("inf")))
        out += [z.alias(f"deviation_{f}_zscore"), ratio.alias(f"deviation_{f}_ratio")]
    return joined.select(*[F.col(c) for c in df.columns], *out)
