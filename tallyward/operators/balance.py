"""Class balance: distribution, ratios and weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counts(label: str) -> tuple[Column, Column, Column]:
    return F.count(label), F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """(class, count, percent) for both classes, 0 where a class is empty."""
    n, n0, n1 = _counts(label)
    once = df.agg(n.alias("n"), n0.alias("n0"), n1.alias("n1"))
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"), F.col(f"n{c}").alias("count"),
                F.coalesce(F.round(F.try_divide(F.col(f"n{c}") * 100.0, F.col("n")), 2), F.lit(0.0)).alias("percent"),
            )
            for c in (0, 1)
        ]
    )
    return once.select(F.inline(rows))


def imbalance_ratio(df: DataFrame, label: str) -> DataFrame:
    _, n0, n1 = _counts(label)
    return df.agg(n0.alias("legitimate"), n1.alias("fraud"), F.try_divide(n0, n1).alias("ratio"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """One row: ``n / (2 * n_c)`` per class, 1 for an empty class."""
    n, n0, n1 = _counts(label)
    return df.agg(
        F.coalesce(F.try_divide(n, 2.0 * n0), F.lit(1.0)).alias("weight_0"),
        F.coalesce(F.try_divide(n, 2.0 * n1), F.lit(1.0)).alias("weight_1"),
    )


def positive_weight(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives per positive, 1 without positives."""
    _, n0, n1 = _counts(label)
    return df.agg(F.coalesce(F.try_divide(n0, n1), F.lit(1.0)).alias("positive_weight"))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    w = class_weights(df, label).select(F.struct("weight_0", "weight_1").alias("w")).scalar()
    return df.withColumn("__cw", w).withColumn(
        out, F.when(F.col(label) == 1, F.col("__cw.weight_1")).otherwise(F.col("__cw.weight_0"))
    ).drop("__cw")
