import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyward.operators import balance as B
from tallyward.operators import curves as Cu
from tallyward.operators import metrics as Me
from tallyward.operators import profile as P


def scored(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "label int, score double")


def areas(spark, pairs):
    return Cu.curve_areas(Cu.cumulative_counts(scored(spark, pairs), "label", "score")).first()


def test_perfect_and_reversed(spark):
    good = [(0, 0.01)] * 100 + [(1, 0.9)] * 10
    a = areas(spark, good)
    assert (a["auroc"], a["average_precision"], a["recall_at_fpr"]) == (1.0, 1.0, 1.0)
    assert areas(spark, [(1 - y, s) for y, s in good])["auroc"] == 0.0


def test_constant_scores(spark):
    a = areas(spark, [(0, 0.5)] * 9 + [(1, 0.5)])
    assert a["recall_at_fpr"] == 0.0 and a["auroc"] == 0.5


def test_auroc_is_the_probability_of_a_right_order(spark):
    rng = np.random.default_rng(5)
    y = rng.random(300) < 0.3
    s = np.round(rng.random(300) + 0.3 * y, 2)  # many ties
    diff = s[y][:, None] - s[~y][None, :]
    assert areas(spark, zip(y, s))["auroc"] == pytest.approx(((diff > 0) + 0.5 * (diff == 0)).mean())


def test_small_classification(spark):
    y, p, s = [0, 0, 1, 1, 0, 1], [0, 0, 1, 1, 0, 1], [0.1, 0.2, 0.9, 0.8, 0.3, 0.6]
    df = spark.createDataFrame(list(zip(y, p)), "label int, predicted int")
    assert list(Me.classification_metrics(df, "label", "predicted").first()) == [1.0, 1.0, 1.0, 1.0]
    m = Cu.all_metrics(scored(spark, zip(y, s)), "label", "score", 0.5).first()
    assert m["f1"] == 1.0 and m["auroc"] == 1.0


def test_no_predictions_give_zero_not_error(spark):
    m = Me.detection_metrics(scored(spark, [(0, 0.1), (1, 0.2)]), 0.9).first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)


def test_threshold_needs_normal_rows(spark):
    df = scored(spark, [(0, float(i)) for i in range(101)] + [(1, 500.0)])
    assert Cu.fpr_threshold(df, "label", "score", 0.01).first()["threshold"] == 99.0
    with pytest.raises(PySparkException):
        Cu.fpr_threshold(scored(spark, [(1, 0.5)]), "label", "score").collect()


def test_best_f1_takes_the_lowest_threshold(spark):
    counts = Cu.cumulative_counts(scored(spark, [(1, 0.9), (1, 0.8), (0, 0.2)]), "label", "score")
    assert Cu.best_f1_threshold(counts).first()["threshold"] == 0.8


def test_grid_threshold_first_maximum(spark):
    df = scored(spark, [(1, 0.9), (1, 0.8), (0, 0.2)])
    chosen = Cu.grid_threshold(df, "label", "score").where("chosen").collect()
    assert len(chosen) == 1 and chosen[0]["threshold"] == pytest.approx(20 / 99)
    with pytest.raises(ValueError):
        Cu.grid_threshold(df, "label", "score", metric="auc")


def test_summary_of_an_empty_range(spark):
    df = spark.createDataFrame([(1, 100.0), (0, 200.0)], "Class int, Amount double")
    r = P.range_summary(df, "Class", "Amount", 1, 1000, 2000).first()
    assert r["total"] == r["fraud"] == 0 and r["fraud_percent"] == 0.0 and r["avg_amount"] == 0.0


def test_summary_and_distribution(spark):
    df = spark.createDataFrame([(0, 100.0), (1, 200.0), (0, 150.0), (0, 50.0)], "Class int, Amount double")
    r = P.summary(df, "Class", "Amount", 2).first()
    assert (r["total"], r["fraud"], r["fraud_percent"], r["avg_fraud_amount"]) == (4, 1, 25.0, 200.0)
    only = B.class_distribution(df.where("Class = 0"), "Class").orderBy("class").collect()
    assert [(x["count"], x["percent"]) for x in only] == [(3, 100.0), (0, 0.0)]


def test_weights_of_an_empty_class(spark):
    df = spark.createDataFrame([(0,), (0,)], "y int")
    assert list(B.class_weights(df, "y").first()) == [0.5, 1.0]
    assert B.positive_weight(df, "y").first()[0] == 1.0


def test_correlation_drops_nulls_by_pair(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, 3.0), (4.0, 8.0, 2.0)], "a double, b double, c double")
    c = {(r["a"], r["b"]): r["corr"] for r in P.correlations(df, ["a", "b", "c"]).collect()}
    assert c["a", "b"] == pytest.approx(1.0) and c["a", "c"] == pytest.approx(0.5) and len(c) == 9


def test_sample_is_repeatable(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    a = {r["id"] for r in P.sample_rows(df, 100, "id").collect()}
    assert len(a) == 100 and a == {r["id"] for r in P.sample_rows(df.repartition(7), 100, "id").collect()}


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    c = {(r["a"], r["b"]): r["corr"] for r in P.correlations(df, ["a", "b"]).collect()}
    assert c["a", "b"] is None and c["b", "b"] == 1.0
