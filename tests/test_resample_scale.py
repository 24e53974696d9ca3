"""Resampling searches once, and later plans hold neither searches nor models."""

import numpy as np

from tallyward.operators import neighbours as N
from tallyward.operators import resample as Rs


def mixed(spark, n=200):
    x = np.random.default_rng(8).normal(size=(n, 3))
    return spark.createDataFrame(
        [(i, v.tolist(), int(i % 8 == 0)) for i, v in enumerate(x)], "row_id long, features array<double>, label int"
    )


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_adasyn_searches_are_written_once(spark):
    new = Rs.adasyn(mixed(spark), ratio=0.5)
    assert "CoGroup" not in plan(new)
    assert new.count() > 0


def test_vectors_are_not_broadcast(spark):
    df = mixed(spark)
    new = Rs.smote(df, ratio=0.5)
    found = N.nearest_neighbours(df, df, 3)
    for out, joins in ((new, 2), (found, 1)):
        assert plan(out).count("strategy=merge") >= joins
    assert new.count() > 0 and found.count() == 600
