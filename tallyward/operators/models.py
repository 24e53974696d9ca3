"""Classifiers on Spark ML and their score columns."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.balance import positive_weight, with_class_weight
from tallyward.operators.ensemble import scaled
from tallyward.operators.gradient import partition_sums
from tallyward.operators.splits import fold_of
from tallyward.session import settle

Scorer = Callable[[DataFrame], DataFrame]


def as_features(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Pack numeric columns into one array column."""
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in columns]))


def _prepared(df: DataFrame, features: str, label: str) -> DataFrame:
    return df.withColumn("__x", array_to_vector(features)).withColumn("__y", F.col(label).cast("double"))


def _scorer(model, features: str, out: str) -> Scorer:
    def score(df: DataFrame) -> DataFrame:
        ready = df.withColumn("__x", array_to_vector(features))
        done = model.transform(ready).withColumn(out, vector_to_array("probability")[1])
        return done.select(*df.columns, out)

    return score


def fit_logistic(
    df: DataFrame, features: str = "features", label: str = "label", balanced: bool = False, out: str = "score",
    max_iter: int = 100,
):
    """L2 logistic regression with unit inverse strength; (model, scorer)."""
    rows = with_class_weight(df, label, "__w") if balanced else df.withColumn("__w", F.lit(1.0))
    n = df.count()
    model = LogisticRegression(
        featuresCol="__x", labelCol="__y", weightCol="__w", standardization=False, elasticNetParam=0.0,
        regParam=1.0 / max(n, 1), maxIter=max_iter,
    ).fit(_prepared(rows, features, label))
    return model, _scorer(model, features, out)


def fit_forest(
    df: DataFrame, features: str = "features", label: str = "label", balanced: bool = False, out: str = "score",
    trees: int = 100, depth: int = 10, seed: int = 42,
):
    """Random forest; each row's node in every tree is kept between levels, not found again from the root."""
    rows = with_class_weight(df, label, "__w") if balanced else df.withColumn("__w", F.lit(1.0))
    model = RandomForestClassifier(
        featuresCol="__x", labelCol="__y", weightCol="__w", numTrees=trees, maxDepth=depth, seed=seed,
        cacheNodeIds=True, checkpointInterval=-1,
    ).fit(_prepared(rows, features, label))
    scorer = _scorer(model, features, out)
    scorer.table = lambda spark, points: _score_table(model, scorer, spark, features, out, points)
    return model, scorer


@dataclass(frozen=True)
class ScoreTable:
    """All scores of a forest: it sees of a feature only which thresholds it passes, at most 31 (``maxBins`` - 1).

    A point's score is the one at the sum of its features' ``parts``.
    """

    thresholds: list[np.ndarray]
    steps: list[int]
    scores: np.ndarray

    def parts(self, x: np.ndarray) -> np.ndarray:
        """One number per row and feature; a row goes left at a threshold it does not exceed, NaN goes right."""
        return np.column_stack([np.searchsorted(t, x[:, i], side="left") * n for i, (t, n) in enumerate(zip(self.thresholds, self.steps))])


# Cells of a score table at most: four features of 32 bins.
TABLE_CELLS = 1 << 20


def _score_table(model, scorer: Scorer, spark, features: str, out: str, points: int) -> ScoreTable | None:
    """The forest's scores in every cell, if there are no more cells than ``points`` to score (and ``TABLE_CELLS``)."""
    text = model.toDebugString
    if re.search(r"\(feature \d+ (?!<=|>)", text):  # a categorical split
        return None
    used: list[set[float]] = [set() for _ in range(model.numFeatures)]
    for i, t in re.findall(r"If \(feature (\d+) <= (\S+)\)", text):
        used[int(i)].add(float(t))
    thresholds = [np.array(sorted(u)) for u in used]
    sizes = [len(t) + 1 for t in thresholds]
    cells = math.prod(sizes)
    if cells > min(TABLE_CELLS, points):
        return None
    steps = [math.prod(sizes[:i]) for i in range(len(sizes))]
    # the largest value of each cell stands for all of it
    value = [
        F.get(F.array(*[F.lit(float(v)) for v in [*t, math.inf]]), F.pmod(F.floor(F.col("id") / F.lit(n)), F.lit(len(t) + 1)).cast("int"))
        for t, n in zip(thresholds, steps)
    ]
    every = spark.range(0, cells, 1, 4 * spark.sparkContext.defaultParallelism).withColumn(features, F.array(*value))
    found = scorer(every).select("id", out).toArrow()
    scores = np.empty(cells)
    scores[found.column("id").to_numpy()] = found.column(out).to_numpy()
    return ScoreTable(thresholds, steps, scores)


def fit_boosting(
    df: DataFrame, features: str = "features", label: str = "label", out: str = "score",
    rounds: int = 100, depth: int = 6, step: float = 0.1, seed: int = 42,
):
    """Gradient boosting; positives weigh negatives / positives."""
    w = positive_weight(df, label).scalar()
    rows = df.withColumn("__w", F.when(F.col(label) == 1, w).otherwise(F.lit(1.0)))
    model = GBTClassifier(
        featuresCol="__x", labelCol="__y", weightCol="__w", maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed
    ).fit(_prepared(rows, features, label))
    return model, _scorer(model, features, out)


def fit_perceptron(
    df: DataFrame, width: int, features: str = "features", label: str = "label", out: str = "score",
    hidden: Sequence[int] = (128, 64), max_iter: int = 100, seed: int = 42,
):
    """Single-transaction network; it has no row weights, so balance the rows beforehand."""
    model = MultilayerPerceptronClassifier(
        featuresCol="__x", labelCol="__y", layers=[width, *hidden, 2], maxIter=max_iter, seed=seed
    ).fit(_prepared(df, features, label))
    return model, _scorer(model, features, out)


def fit_focal(
    df: DataFrame, width: int, features: str = "features", label: str = "label", out: str = "score",
    alpha: float = 0.25, gamma: float = 2.0, rounds: int = 60, step: float = 0.1,
):
    """Linear model under focal loss: ((weights, bias), scorer).

    Each round sums the gradient per partition; only ``width + 1`` numbers reach
    the driver.
    """
    rows = settle(df.select(F.col(features).alias("x"), F.col(label).cast("double").alias("y")))
    n = max(rows.count(), 1)
    theta = np.zeros(width + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        grad = partition_sums(rows, _focal_gradient(theta.copy(), alpha, gamma), width + 1) / n
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - step * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    weights, bias = [float(x) for x in theta[:-1]], float(theta[-1])

    def score(data: DataFrame) -> DataFrame:
        w = F.array(*[F.lit(x) for x in weights])
        z = F.aggregate(F.zip_with(features, w, lambda a, b: a * b), F.lit(bias), lambda s, t: s + t)
        return data.withColumn(out, 1.0 / (1.0 + F.exp(-z)))

    return (weights, bias), score


def _focal_gradient(theta: np.ndarray, alpha: float, gamma: float):
    def grad(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = x @ theta[:-1] + theta[-1]
        s = np.where(y == 1, 1.0, -1.0)
        p = np.clip(1.0 / (1.0 + np.exp(-s * z)), 1e-12, 1 - 1e-12)  # probability of the true class
        a = np.where(y == 1, alpha, 1.0 - alpha)
        dz = a * s * (1 - p) ** gamma * (gamma * p * np.log(p) - (1 - p))
        return np.append(x.T @ dz, dz.sum())

    return grad


def importances(names: Sequence[str], values: Sequence[float], df: DataFrame) -> DataFrame:
    """(feature, value, rank) for impurity importances or signed coefficients, by absolute value.

    One row per feature.
    """
    rows = sorted(zip(names, (float(v) for v in values)), key=lambda x: (-abs(x[1]), x[0]))
    data = [(n, v, i + 1) for i, (n, v) in enumerate(rows)]
    return df.sparkSession.createDataFrame(data, "feature string, value double, rank int")


def stack_models(
    train: DataFrame, test: DataFrame, scores: Sequence[str], label: str = "label", meta: str = "logistic",
    out: str = "stacked",
) -> DataFrame:
    """Meta-model over given base-score columns, balanced."""
    fit = {"logistic": fit_logistic, "forest": fit_forest}[meta]
    _, scorer = fit(as_features(train, scores, "__s"), "__s", label, balanced=True, out=out)
    return scorer(as_features(test, scores, "__s")).drop("__s")


def out_of_fold(
    df: DataFrame, fits: dict[str, Callable[[DataFrame], Scorer]], key: str, folds: int = 5
) -> DataFrame:
    """Score every row with base models fitted on the other folds: ``df`` plus one column per model."""
    rows = settle(df.withColumn("__fold", fold_of(F.col(key), folds, "oof")))
    out = None
    for i in range(folds):
        train, held = rows.where(F.col("__fold") != i), rows.where(F.col("__fold") == i)
        for fit in fits.values():
            held = fit(train)(held)
        out = held if out is None else out.unionByName(held)
    return out.drop("__fold")


def stack_out_of_fold(
    train: DataFrame, test: DataFrame, fits: dict[str, Callable[[DataFrame], Scorer]], key: str,
    label: str = "label", folds: int = 5, meta: str = "logistic", out: str = "stacked",
) -> DataFrame:
    """Stacking on out-of-fold base scores, min-max scaled by the training range."""
    names = list(fits)
    inner = settle(out_of_fold(train, fits, key, folds))
    outer = test
    for fit in fits.values():
        outer = fit(train)(outer)
    return stack_models(scaled(inner, names), scaled(outer, names, fitted_on=inner), names, label, meta, out)
