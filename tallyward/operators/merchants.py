"""Merchant risk: counts, smoothed rates, lookup with a default for unseen keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merchant_stats(
    df: DataFrame, merchant_col: str = "merchant_id", label_col: str = "is_fraud",
    alpha: float = 1.0, beta: float = 1.0, global_rate_weight: float = 0.5,
    preset: str = "bayes", m: float = 10.0,
) -> DataFrame:
    """Per merchant: counts, raw rate, smoothed rate and the rate that is used.

    ``bayes``: ``w * global + (1 - w) * (f + alpha) / (n + alpha + beta)``.
    ``m_estimate``: ``(f + global * m) / (n + m)``.
    """
    counts = df.groupBy(merchant_col).agg(
        F.sum(F.col(label_col).cast("bigint")).alias("fraud_count"), F.count(label_col).alias("total_count")
    )
    overall = global_rate(df, label_col)
    f, n = F.col("fraud_count"), F.col("total_count")
    if preset == "m_estimate":
        smoothed = rate = (f + overall * m) / (n + m)
    elif preset == "bayes":
        smoothed = (f + alpha) / (n + (alpha + beta))
        rate = global_rate_weight * overall + (1.0 - global_rate_weight) * smoothed
    else:
        raise ValueError(f"Unknown preset: {preset}")
    return counts.select(
        merchant_col, "fraud_count", "total_count", F.try_divide(f, n).alias("raw_rate"),
        smoothed.alias("smoothed_rate"), rate.alias("rate"),
    )


def global_rate(df: DataFrame, label_col: str = "is_fraud") -> Column:
    """Overall fraud rate as a scalar subquery: computed once, no join."""
    return df.agg(F.avg(label_col).alias("r")).scalar()


def merchant_features(
    df: DataFrame, stats: DataFrame, overall: Column, merchant_col: str = "merchant_id"
) -> DataFrame:
    """Add merchant_fraud_rate, _count and _total_count; unseen merchants get 0, 0 and the global rate.

    No broadcast hint: Spark broadcasts the statistics when their measured size
    is small, and splits skewed merchants otherwise.
    """
    side = stats.select(
        merchant_col, F.col("rate").alias("__r"), F.col("fraud_count").alias("__f"), F.col("total_count").alias("__n")
    )
    return df.join(side, merchant_col, "left").select(
        *[df[c] if c != merchant_col else F.col(c) for c in df.columns],
        F.coalesce(F.col("__r"), overall).alias("merchant_fraud_rate"),
        F.coalesce(F.col("__f"), F.lit(0)).cast("bigint").alias("merchant_fraud_count"),
        F.coalesce(F.col("__n"), F.lit(0)).cast("bigint").alias("merchant_total_count"),
    )


def unseen_keys(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Keys that fall back to defaults, with their row counts.

    Keys are counted before the anti join, so a hot key costs one row.
    """
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).join(stats.select(key), key, "left_anti")
