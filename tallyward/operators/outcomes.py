"""Outcomes of thresholded scores: failure tables and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.scoring import outcome_type, over_threshold


def with_outcome(df: DataFrame, threshold: Column | float, label: str = "label", score: str = "score") -> DataFrame:
    predicted = over_threshold(F.col(score), threshold)
    return df.withColumn("predicted", predicted).withColumn("outcome", outcome_type(F.col(label), F.col("predicted")))


def failures(df: DataFrame, threshold: Column | float, label: str = "label", score: str = "score") -> DataFrame:
    return with_outcome(df, threshold, label, score).where(F.col("outcome").isin("FP", "FN"))


def failure_summary(outcomes: DataFrame, by: Sequence[str] = (), score: str = "score") -> DataFrame:
    """Totals and mean scores of failures, per ``by`` group."""
    kind = F.col("outcome")
    return outcomes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(kind.isin("FP", "FN")).alias("failures"),
        F.count_if(kind == "FP").alias("false_positives"),
        F.count_if(kind == "FN").alias("false_negatives"),
        F.avg(F.when(kind == "FP", F.col(score))).alias("mean_score_fp"),
        F.avg(F.when(kind == "FN", F.col(score))).alias("mean_score_fn"),
    )


def failure_profile(outcomes: DataFrame, features: Sequence[str], top_n: int = 10) -> DataFrame:
    """Per feature and failure type: mean and mean absolute value, for the ``top_n``
    features by summed mean absolute value."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])
    rows = outcomes.where(F.col("outcome").isin("FP", "FN")).select("outcome", F.inline(pairs))
    means = rows.groupBy("feature", "outcome").agg(F.avg("v").alias("mean"), F.avg(F.abs("v")).alias("mean_abs"))
    top = (
        means.groupBy("feature").agg(F.sum("mean_abs").alias("total"))
        .orderBy(F.col("total").desc(), "feature").limit(top_n)
    )
    return means.join(F.broadcast(top), "feature").select("feature", "outcome", "mean", "mean_abs", "total")
