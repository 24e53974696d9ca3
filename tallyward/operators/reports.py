"""Explanation tables as people read them: names, impact, shares, report rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.columns import percent_text, readable_name
from tallyward.functions.scoring import impact_level, risk_colour, risk_tier


def describe_features(features: DataFrame, custom: DataFrame | None = None) -> DataFrame:
    """(feature, description): a given description, else the readable name."""
    if custom is None:
        return features.select("feature", readable_name(F.col("feature")).alias("description"))
    side = custom.select("feature", F.col("description").alias("__d"))
    return features.join(side, "feature", "left").select(
        "feature", F.coalesce("__d", readable_name(F.col("feature"))).alias("description")
    )


def top_per_row(contrib: DataFrame, n: int, row: str = "transaction_id") -> DataFrame:
    """Top ``n`` contributions per row by absolute value; ties by feature name."""
    w = Window.partitionBy(row).orderBy(F.abs("contribution").desc(), "feature")
    return contrib.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def risk_factors(contrib: DataFrame, n: int = 5, row: str = "transaction_id") -> DataFrame:
    """Top factors per row with description, direction and impact level."""
    size = F.abs("contribution")
    return top_per_row(contrib, n, row).select(
        row, "rank", "feature", readable_name(F.col("feature")).alias("description"),
        F.col("contribution").alias("importance"), size.alias("abs_importance"),
        F.when(F.col("contribution") > 0, "increases").otherwise("decreases").alias("direction"),
        impact_level(size).alias("impact_level"),
    )


def importance_shares(contrib: DataFrame, row: str = "transaction_id") -> DataFrame:
    """Share of each contribution in its row's absolute total, with display text."""
    total = F.sum(F.abs("contribution")).over(Window.partitionBy(row))
    share = F.coalesce(F.try_divide(F.abs("contribution"), total), F.lit(0.0))
    return contrib.select(row, "feature", "contribution", share.alias("share"), percent_text(share).alias("text"))


def report_rows(scores: DataFrame, factors: DataFrame, row: str = "transaction_id") -> DataFrame:
    """One report row per scored transaction, factors ordered by rank.

    ``scores`` has (row, probability, predicted_class); a row has a handful of
    factors, so the collected list is small.
    """
    lists = factors.groupBy(row).agg(
        F.array_sort(F.collect_list(F.struct("rank", "feature", "importance", "direction"))).alias("risk_factors")
    )
    level = risk_tier(F.col("probability"), "report")
    return scores.join(lists, row, "left").select(
        row, "probability", percent_text(F.col("probability"), 2).alias("probability_text"), "predicted_class",
        level.alias("risk_level"), risk_colour(level).alias("risk_colour"), "risk_factors",
    )
