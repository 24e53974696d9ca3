"""Thresholds, ROC and precision-recall curves, exact and without a global sort task.

Everything starts from one table of cumulative counts per distinct score.
Repeated scores are counted before the shuffle; the running sums are split by
score range (see ``ordering``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.columns import literal_rows
from tallyward.operators.metrics import f1, ratio
from tallyward.operators.ordering import exact_quantiles, running_totals
from tallyward.session import settle

GRID_100 = [float(x) for x in np.linspace(0.0, 1.0, 100)]


def cumulative_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, n, pos, tp, fp, p, q): rows at or above each distinct score.

    ``n``/``pos`` are rows and positives at the score, ``tp``/``fp`` the inclusive
    running counts from the top, ``p``/``q`` all positives and negatives.
    """
    counts = settle(
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("score"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"))
    )
    ranked = running_totals(
        counts.withColumns({"tp": F.col("pos"), "fp": F.col("n") - F.col("pos")}), "score",
        {"tp": "tp", "fp": "fp"}, by=by, descending=True,
    )
    totals = [F.sum("pos").alias("p"), F.sum(F.col("n") - F.col("pos")).alias("q")]
    if by:
        return ranked.join(counts.groupBy(*by).agg(*totals), list(by))
    return ranked.withColumn("__t", counts.agg(F.struct(*totals).alias("t")).scalar()).select(
        *ranked.columns, F.col("__t.p").alias("p"), F.col("__t.q").alias("q")
    )


def _points() -> dict[str, Column]:
    tp, fp, p, q = (F.col(c) for c in ("tp", "fp", "p", "q"))
    tp0, fp0 = tp - F.col("pos"), fp - (F.col("n") - F.col("pos"))
    return {
        "tpr": ratio(tp, p), "fpr": ratio(fp, q), "precision": ratio(tp, tp + fp),
        "tpr0": ratio(tp0, p), "fpr0": ratio(fp0, q),
        "precision0": F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(ratio(tp0, tp0 + fp0)),
    }


def roc_points(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, fpr, tpr) for every distinct score, plus (0, 0) at infinity."""
    c = _points()
    body = counts.select(*by, F.col("score").alias("threshold"), c["fpr"].alias("fpr"), c["tpr"].alias("tpr"))
    start = counts.groupBy(*by).agg(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return body.unionByName(start)


def pr_points(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, precision, recall), plus recall 0 at precision 1."""
    c = _points()
    body = counts.select(*by, F.col("score").alias("threshold"), c["precision"].alias("precision"), c["tpr"].alias("recall"))
    end = counts.groupBy(*by).agg(
        F.lit(float("inf")).alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return body.unionByName(end)


def _areas(max_fpr: float) -> dict[str, Column]:
    c = _points()
    return {
        "auroc": F.sum((c["fpr"] - c["fpr0"]) * (c["tpr"] + c["tpr0"]) / 2.0),
        "pr_auc": F.sum((c["tpr"] - c["tpr0"]) * (c["precision"] + c["precision0"]) / 2.0),
        "average_precision": F.sum((c["tpr"] - c["tpr0"]) * c["precision"]),
        "recall_at_fpr": F.coalesce(F.max(F.when(c["fpr"] <= max_fpr, c["tpr"])), F.lit(0.0)),
    }


def curve_areas(counts: DataFrame, by: Sequence[str] = (), max_fpr: float = 0.01) -> DataFrame:
    """AUROC (ties averaged), PR AUC (trapezoid), average precision (steps), recall at a false-positive rate."""
    return counts.groupBy(*by).agg(*[e.alias(n) for n, e in _areas(max_fpr).items()])


def best_f1_threshold(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, f1): best F1 over all distinct scores; ties take the lowest threshold."""
    c = _points()
    value = 2.0 * c["precision"] * c["tpr"] / (c["precision"] + c["tpr"] + F.lit(1e-10))
    scored = counts.withColumn("__f", value)
    return scored.groupBy(*by).agg(
        F.max_by("score", F.struct(F.col("__f"), -F.col("score"))).alias("threshold"), F.max("__f").alias("f1")
    )


def grid_threshold(
    df: DataFrame, label: str, score: str, grid: Sequence[float] = tuple(GRID_100), metric: str = "f1"
) -> DataFrame:
    """All grid thresholds with their metric and whether they are chosen (first maximum).

    Scores are counted per grid cell, so the rows are read once and no row meets
    more than one grid point.
    """
    if metric not in ("f1", "precision", "recall", "accuracy"):
        raise ValueError(f"Unknown metric: {metric}")
    grid = sorted(set(float(g) for g in grid))
    splits = [float("-inf"), *grid, float("inf")]
    probe = df.where(F.col(score).isNotNull()).select(F.col(label).alias("__y"), F.col(score).cast("double").alias("__s"))
    cells = Bucketizer(splits=splits, inputCol="__s", outputCol="__cell").transform(probe)
    counts = cells.groupBy(F.col("__cell").cast("int").alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("__y").cast("bigint")).alias("pos")
    )
    # at most len(grid) + 1 rows from here on
    packed = counts.agg(F.collect_list(F.struct("cell", "n", "pos")).alias("cells"))

    def total(field: str, at_least: Column | None) -> Column:
        part = F.col("cells") if at_least is None else F.filter("cells", lambda x: x["cell"] >= at_least)
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: a + x[field])

    items = literal_rows([{"i": i + 1, "threshold": g} for i, g in enumerate(grid)], "i: int, threshold: double")
    rows = packed.select("cells", F.inline(items))
    tp, hits = total("pos", F.col("i")), total("n", F.col("i"))
    p, n = total("pos", None), total("n", None)
    precision, recall = ratio(tp, hits), ratio(tp, p)
    value = {
        "f1": f1(precision, recall), "precision": precision, "recall": recall,
        "accuracy": ratio(tp + (n - p) - (hits - tp), n),
    }[metric]
    table = rows.select("threshold", value.alias("value"))
    best = table.agg(F.max_by("threshold", F.struct(F.col("value"), -F.col("threshold"))).alias("t")).scalar()
    return table.withColumn("chosen", F.col("threshold") == best)


def quantile_threshold(df: DataFrame, score: str, share: float) -> DataFrame:
    """One row (threshold): exact quantile of a score column; an error if there are no rows."""
    found = exact_quantiles(df, [score], [share]).agg(F.max("value").alias("threshold"))
    missing = F.raise_error(F.lit("no rows to take a threshold from")).cast("double")
    return found.select(F.coalesce("threshold", missing).alias("threshold"))


def fpr_threshold(df: DataFrame, label: str, score: str, max_fpr: float = 0.01) -> DataFrame:
    """Threshold that only ``max_fpr`` of the normal rows exceed."""
    return quantile_threshold(df.where(F.col(label) == 0), score, 1.0 - max_fpr)


def share_threshold(df: DataFrame, score: str, contamination: float) -> DataFrame:
    """Threshold from the expected share of anomalies."""
    return quantile_threshold(df, score, 1.0 - contamination)


def tune_share(
    train: DataFrame, validation: DataFrame, score: str, candidates: Sequence[float], target: float
) -> DataFrame:
    """(contamination, threshold, achieved, chosen): the candidate whose achieved rate is nearest the target."""
    cuts = exact_quantiles(train, [score], [1.0 - c for c in candidates])
    packed = cuts.agg(F.array_sort(F.collect_list(F.struct("share", "value"))).alias("c")).scalar()
    order = sorted(candidates, reverse=True)
    counted = validation.withColumn("__c", packed).agg(
        F.count(score).alias("n"), F.max("__c").alias("c"),
        *[F.count_if(F.col(score) > F.col("__c")[i]["value"]).alias(f"h{i}") for i in range(len(order))],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(float(s)).alias("contamination"), F.col("c")[i]["value"].alias("threshold"),
                ratio(F.col(f"h{i}"), F.col("n")).alias("achieved"),
            )
            for i, s in enumerate(order)
        ]
    )
    table = counted.select(F.inline(rows))
    best = table.agg(
        F.min_by("contamination", F.struct(F.abs(F.col("achieved") - target), F.col("contamination"))).alias("b")
    ).scalar()
    return table.withColumn("chosen", F.col("contamination") == best)


def all_metrics(
    df: DataFrame, label: str, score: str, threshold: Column | float = 0.5, by: Sequence[str] = (), max_fpr: float = 0.01
) -> DataFrame:
    """Thresholded and ranking metrics of each model in one row, from one counts table."""
    counts = cumulative_counts(df, label, score, by)
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    hit = F.col("score") >= cut
    neg = F.col("n") - F.col("pos")
    wide = counts.withColumn("__hit", hit).groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("__hit"), F.col("pos"))), F.lit(0)).alias("__tp"),
        F.coalesce(F.sum(F.when(F.col("__hit"), neg)), F.lit(0)).alias("__fp"),
        F.sum("pos").alias("__p"), F.sum(neg).alias("__q"),
        *[e.alias(n) for n, e in _areas(max_fpr).items()],
    )
    tp, fp, p, q = (F.col(f"__{c}") for c in ("tp", "fp", "p", "q"))
    precision, recall = ratio(tp, tp + fp), ratio(tp, p)
    return wide.select(
        *by, ratio(tp + q - fp, p + q).alias("accuracy"), precision.alias("precision"), recall.alias("recall"),
        f1(precision, recall).alias("f1"), ratio(fp, q).alias("false_positive_rate"),
        "auroc", "pr_auc", "average_precision", "recall_at_fpr",
    )
