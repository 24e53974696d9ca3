"""Driver loops over Spark jobs: cross-validation, detector and technique comparisons.

Only fold and technique names are iterated on the driver; every step on rows is
a Spark job and only metric rows are stacked.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators import curves as Cu
from tallyward.operators.detectors import Detector
from tallyward.operators.ensemble import vote_average
from tallyward.operators.models import fit_focal, fit_logistic
from tallyward.operators.resample import adasyn, smote, with_synthetic
from tallyward.operators.splits import class_split, stratified_folds, undersample
from tallyward.session import settle

Resampler = Callable[[DataFrame], DataFrame]
METRICS = ["accuracy", "precision", "recall", "f1", "auroc", "average_precision", "recall_at_fpr"]


def stack_rows(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fold_scores(
    rows: DataFrame, fit: Callable, technique: str, folds: int, label: str = "label", resample: Resampler | None = None
) -> DataFrame:
    """(technique, fold, label, score) of held-out rows.  Only the training folds are resampled.

    Scores are written, so a later plan holds neither the models nor the folds.
    """
    parts = []
    for i in range(folds):
        train, held = rows.where(F.col("fold") != i).drop("fold"), rows.where(F.col("fold") == i)
        if resample is not None:
            train = settle(resample(train))
        _, scorer = fit(train)
        parts.append(scorer(held).select(F.lit(technique).alias("technique"), "fold", F.col(label).alias("label"), "score"))
    return settle(stack_rows(parts))


def fold_metrics(scores: DataFrame) -> DataFrame:
    """(technique, fold, metric, value): all folds of all techniques in one pass."""
    m = Cu.all_metrics(scores, "label", "score", 0.5, ["technique", "fold"])
    return m.select("technique", "fold", *METRICS).unpivot(["technique", "fold"], METRICS, "metric", "value")


def cross_validate(
    df: DataFrame, fit: Callable, technique: str, key: str = "row_id", label: str = "label", folds: int = 5,
    resample: Resampler | None = None,
) -> DataFrame:
    """(technique, fold, metric, value) by stratified k-fold."""
    rows = settle(stratified_folds(df, key, label, folds))
    return fold_metrics(fold_scores(rows, fit, technique, folds, label, resample))


def imbalance_techniques(width: int, ratio: float = 0.5) -> dict[str, tuple[Callable, Resampler | None]]:
    """The six techniques: (fit function, resampler of the training rows)."""

    def plain(df: DataFrame):
        return fit_logistic(df)

    return {
        "baseline": (plain, None),
        "random_undersampling": (plain, lambda d: undersample(d, "row_id", "label", ratio)),
        "smote": (plain, lambda d: with_synthetic(d, smote(d, ratio=ratio)).select("features", "label")),
        "adasyn": (plain, lambda d: with_synthetic(d, adasyn(d, ratio=ratio)).select("features", "label")),
        "class_weight": (lambda d: fit_logistic(d, balanced=True), None),
        "focal_loss": (lambda d: fit_focal(d, width), None),
    }


def imbalance_benchmark(
    df: DataFrame, width: int, folds: int = 5, techniques: Sequence[str] | None = None, ratio: float = 0.5
) -> DataFrame:
    """(technique, fold, metric, value) over all techniques."""
    table = imbalance_techniques(width, ratio)
    rows = settle(stratified_folds(df, "row_id", "label", folds))
    chosen = {n: t for n, t in table.items() if techniques is None or n in techniques}
    return fold_metrics(
        stack_rows([fold_scores(rows, fit, name, folds, resample=resample) for name, (fit, resample) in chosen.items()])
    )


def detector_scores(df: DataFrame, detector: Detector) -> DataFrame:
    """All splits scored by a detector fitted on normal training rows: (split, label, score)."""
    rows = class_split(df, "row_id", "label")
    detector.fit(rows.where(F.col("split") == "train").drop("split"))
    return settle(detector.score(rows).select("row_id", "split", "label", "score"))


def evaluate(scores: DataFrame, model: str, max_fpr: float = 0.01, seconds: float | None = None) -> DataFrame:
    """Test metrics at the threshold that ``max_fpr`` of normal validation rows exceed."""
    cut = Cu.fpr_threshold(scores.where(F.col("split") == "validation"), "label", "score", max_fpr)
    cut_value = cut.first()["threshold"]
    m = Cu.all_metrics(scores.where(F.col("split") == "test"), "label", "score", cut_value)
    return m.select(
        F.lit(model).alias("model"), F.lit(cut_value).alias("threshold"), "*",
        F.lit(seconds).cast("double").alias("fit_and_score_s"),
    )


def detector_benchmark(df: DataFrame, width: int, kinds: Sequence[str] = Detector.KINDS, ensemble: bool = True) -> DataFrame:
    """One row of test metrics per detector, and one for their averaged ensemble."""
    parts, aligned = [], None
    for kind in kinds:
        start = time.time()
        scores = detector_scores(df, Detector(kind, width))
        parts.append(evaluate(scores, kind, seconds=time.time() - start))
        part = scores.select("row_id", "split", "label", F.col("score").alias(kind))
        aligned = part if aligned is None else aligned.join(part.select("row_id", kind), "row_id")
    if ensemble and len(kinds) > 1:
        both = settle(aligned.withColumn("score", vote_average(list(kinds))))
        parts.append(evaluate(both, "ensemble"))
    return stack_rows(parts)
