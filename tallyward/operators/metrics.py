"""Classification metrics from labels and predictions, always as one aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Column order of a result table.
METRIC_ORDER = ["accuracy", "precision", "recall", "f1", "auprc", "auroc", "recall_at_fpr_1pct"]


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def f1(precision: Column, recall: Column) -> Column:
    return ratio(2.0 * precision * recall, precision + recall)


def confusion_counts(label: Column, predicted: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if((label == 1) & (predicted == 1)),
        "fp": F.count_if((label == 0) & (predicted == 1)),
        "fn": F.count_if((label == 1) & (predicted == 0)),
        "tn": F.count_if((label == 0) & (predicted == 0)),
    }


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": precision,
        "recall": recall,
        "f1": f1(precision, recall),
        "false_positive_rate": ratio(fp, fp + tn),
    }


def detection_metrics(
    df: DataFrame, threshold: Column | float, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts and rates of ``score >= threshold``, per ``by`` group."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    rows = df.withColumn("__hit", (F.col(score) >= cut).cast("int"))
    counted = rows.groupBy(*by).agg(
        *[c.alias(n) for n, c in confusion_counts(F.col(label), F.col("__hit")).items()]
    )
    r = rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    return counted.select(
        *by, "tp", "fp", "fn", "tn", r["recall"].alias("detection_rate"), r["false_positive_rate"].alias("false_positive_rate"),
        r["precision"].alias("precision"), r["recall"].alias("recall"), r["f1"].alias("f1"),
    )


def classification_metrics(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    counted = df.groupBy(*by).agg(
        *[c.alias(n) for n, c in confusion_counts(F.col(label), F.col(predicted)).items()]
    )
    r = rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    return counted.select(*by, *[r[n].alias(n) for n in ("accuracy", "precision", "recall", "f1")])


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """(class, precision, recall, f1, support) for 0, 1, macro and weighted averages."""
    once = df.agg(*[c.alias(n) for n, c in confusion_counts(F.col(label), F.col(predicted)).items()])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    one = {"p": ratio(tp, tp + fp), "r": ratio(tp, tp + fn), "n": tp + fn}
    zero = {"p": ratio(tn, tn + fn), "r": ratio(tn, tn + fp), "n": tn + fp}
    for side in (one, zero):
        side["f"] = f1(side["p"], side["r"])
    total = one["n"] + zero["n"]

    def row(name: str, p: Column, r: Column, f: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), n.alias("support")
        )

    macro = [(zero[k] + one[k]) / 2.0 for k in "prf"]
    weighted = [ratio(zero[k] * zero["n"] + one[k] * one["n"], total) for k in "prf"]
    rows = [row("0", zero["p"], zero["r"], zero["f"], zero["n"]), row("1", one["p"], one["r"], one["f"], one["n"])]
    rows += [row("macro avg", *macro, total), row("weighted avg", *weighted, total)]
    return once.select(F.inline(F.array(*rows)))


def fold_summary(long: DataFrame, by: Sequence[str] = ("technique", "metric")) -> DataFrame:
    """Mean and population std over folds of a long (technique, fold, metric, value) table."""
    return long.groupBy(*by).agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def result_table(summary: DataFrame, metrics: Sequence[str] = tuple(METRIC_ORDER)) -> DataFrame:
    """Technique x metric with ``mean ± std`` text, in the fixed metric order."""
    text = F.format_string("%.4f ± %.4f", F.col("mean"), F.col("std"))
    return summary.withColumn("__t", text).groupBy("technique").pivot("metric", list(metrics)).agg(F.first("__t"))


def rank_techniques(summary: DataFrame) -> DataFrame:
    """Techniques ranked by mean F1, shown with their AUPRC.  One row per technique."""
    wide = summary.groupBy("technique").agg(
        F.max(F.when(F.col("metric") == "f1", F.col("mean"))).alias("f1"),
        F.max(F.when(F.col("metric") == "auprc", F.col("mean"))).alias("auprc"),
    )
    return wide.withColumn("rank", F.rank().over(Window.orderBy(F.col("f1").desc())))
