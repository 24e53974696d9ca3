"""Fold scores are written: a later plan holds no model."""

from pyspark.sql import functions as F

from tallyward.operators import models as Mo
from tallyward.plans import benchmarks as Be


def test_fold_scores_are_written(spark):
    rows = spark.range(60).select(
        F.array(F.col("id") * 1.0, F.lit(1.0)).alias("features"), (F.col("id") > 30).cast("int").alias("label"),
        (F.col("id") % 3).cast("int").alias("fold"),
    )
    out = Be.fold_scores(rows, Mo.fit_logistic, "plain", 3)
    assert "UDF" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["fold"], r["count"]) for r in out.groupBy("fold").count().collect()} == {(0, 20), (1, 20), (2, 20)}
