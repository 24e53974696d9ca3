"""Combining several models' scores of the same rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.scoring import normalised_weights


def long_scores(df: DataFrame, row: str, models: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """(row, model, score) from score columns, without a join."""
    items = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("score")) for m, c in models.items()])
    return df.select(row, *keep, F.inline(items))


def align_scores(long: DataFrame, row: str, models: Sequence[str]) -> DataFrame:
    """One row per id with a column per model."""
    return long.groupBy(row).agg(*[F.max(F.when(F.col("model") == m, F.col("score"))).alias(m) for m in models])


def score_ranges(df: DataFrame, models: Sequence[str]) -> Column:
    """Scalar-subquery struct with ``{model}_min`` and ``{model}_max``."""
    fields = []
    for m in models:
        fields += [F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
    return df.agg(F.struct(*fields).alias("r")).scalar()


def _sum(parts: Sequence[Column]) -> Column:
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def vote_average(models: Sequence[str], weights: Mapping[str, float] | None = None) -> Column:
    if weights is None:
        return _sum([F.col(m) for m in models]) / F.lit(float(len(models)))
    total = float(sum(weights[m] for m in models)) or 1.0
    return _sum([F.col(m) * F.lit(weights[m] / total) for m in models])


def scaled(df: DataFrame, models: Sequence[str], epsilon: float = 0.0, fitted_on: DataFrame | None = None) -> DataFrame:
    """Min-max scale score columns in place; a zero range gives 0."""
    out = df.withColumn("__r", score_ranges(fitted_on if fitted_on is not None else df, models))
    cols = {
        m: F.coalesce(
            F.try_divide(F.col(m) - F.col(f"__r.{m}_min"), F.col(f"__r.{m}_max") - F.col(f"__r.{m}_min") + F.lit(epsilon)),
            F.lit(0.0),
        )
        for m in models
    }
    return out.withColumns(cols).drop("__r")


def vote_majority(df: DataFrame, models: Sequence[str], out: str = "ensemble") -> DataFrame:
    """Min-max each model, vote at 0.5, mean of the votes."""
    votes = scaled(df, models, epsilon=1e-10).withColumn(
        out, _sum([F.when(F.col(m) >= 0.5, 1.0).otherwise(0.0) for m in models]) / F.lit(float(len(models)))
    )
    return votes.drop(*models)


def vote_binary(predictions: Sequence[str], weights: Mapping[str, float] | None = None) -> Column:
    """Majority of 0/1 predictions; a tie counts as anomaly."""
    if weights is None:
        return (_sum([F.col(p) for p in predictions]) >= F.lit(len(predictions) / 2.0)).cast("int")
    total = float(sum(weights[p] for p in predictions)) or 1.0
    return (_sum([F.col(p) * F.lit(weights[p] / total) for p in predictions]) >= 0.5).cast("int")


def scaled_average(df: DataFrame, models: Sequence[str], out: str = "ensemble") -> DataFrame:
    return scaled(df, models).withColumn(out, vote_average(models)).drop(*models)
