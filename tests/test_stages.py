"""Detector stages: fit, save, load in another session, same scores inside a Pipeline."""

import numpy as np
from pyspark.ml import Pipeline, PipelineModel

from tallyward.operators import stages as St
from tallyward.session import fresh_path


def frame(spark, n=300, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    x[:5] += 8  # a few far rows
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "row_id long, features array<double>")


def test_forest_pipeline_round_trip(spark):
    df = frame(spark)
    fitted = Pipeline(stages=[St.IsolationForestDetector(trees=20, sample=64), St.ShareThreshold(contamination=0.02)]).fit(df)
    before = {r.row_id: (r.score, r.predicted) for r in fitted.transform(df).collect()}
    path = fresh_path(spark, "stage-test")
    fitted.save(path)
    other = spark.newSession()
    loaded = PipelineModel.load(path)
    after = {r.row_id: (r.score, r.predicted) for r in loaded.transform(other.createDataFrame(df.collect(), df.schema)).collect()}
    assert before == after
    assert {i for i, (_, p) in after.items() if p == 1} >= {0, 1, 2, 3, 4}
    assert len(loaded.stages[0].nodes) <= 20 * 2 * 64
    assert loaded.stages[1].getOrDefault("threshold") == fitted.stages[1].getOrDefault("threshold")


def test_threshold_stage_alone_and_null_scores(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.9), (3, None)], "row_id long, score double")
    model = St.ShareThreshold(contamination=0.5).fit(df)
    path = fresh_path(spark, "threshold-test")
    model.save(path)
    out = {r.row_id: r.predicted for r in St.ThresholdModel.load(path).transform(df).collect()}
    assert out[3] is None and out[2] == 1
