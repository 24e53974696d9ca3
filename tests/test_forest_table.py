"""A forest's scores looked up by cell are those of its trees, at every step of every row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.operators import explain as Ex
from tallyward.operators import models as Mo

NAMES = ["a", "b", "c"]


def table(spark, n=300):
    rng = np.random.default_rng(8)
    data = [(i if i % 9 else i // 18, float(rng.normal()), float(rng.integers(0, 3)), float(rng.normal()), int(rng.random() < 0.4)) for i in range(n)]
    data[4] = (None, *data[4][1:])
    data[5] = (None, *data[5][1:])
    return spark.createDataFrame(data, "transaction_id long, a double, b double, c double, label int").repartition(3)


def forest(df):
    return Mo.fit_forest(Mo.as_features(df, NAMES), trees=4, depth=4)


def test_a_table_holds_the_score_of_every_point(spark):
    model, scorer = forest(table(spark))
    cells = scorer.table(spark, 10**9)
    assert scorer.table(spark, len(cells.scores) - 1) is None  # more cells than points
    edges = [float(t) for t in cells.thresholds[0]]
    x = [(u, v, w) for u in [*edges, *np.nextafter(edges, np.inf).tolist(), -np.inf, np.inf, np.nan] for v in (0.0, 1.0, 1.5, np.nan) for w in (-0.3, 0.4)]
    got = scorer(Mo.as_features(spark.createDataFrame(x, "a double, b double, c double"), NAMES)).collect()
    at = cells.parts(np.array([[r.a, r.b, r.c] for r in got])).sum(axis=1)
    assert [r.score for r in got] == list(cells.scores[at])


def test_contributions_are_those_of_scored_steps(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = table(spark)
    _, scorer = forest(df)
    asked = []

    def plain(rows):
        asked.append(rows)
        return scorer(rows)

    def looked_up(rows):
        asked.append(rows)
        return scorer(rows)

    looked_up.table = scorer.table
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # a key's records come in several batches
    try:
        want = {(r[0], r[1]): r[2] for r in Ex.model_shapley(df, df, NAMES, plain, draws=5).collect()}
        steps = len(asked)
        got = Ex.model_shapley(df, df, NAMES, looked_up, draws=5).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert steps == 2 and len(asked) == 3  # only the background is scored by the trees
    assert len(got) == len(want)
    assert all(r[2] == pytest.approx(want[r[0], r[1]], abs=1e-12) for r in got)


def test_wide_forests_have_no_table(spark):
    df = table(spark).withColumn("features", F.array(*["a", "c"] * 6))
    _, scorer = Mo.fit_forest(df, trees=10, depth=5)
    assert scorer.table(spark, 10**12) is None


def test_null_features_are_refused_like_by_the_trees(spark):
    df = table(spark)
    gaps = df.withColumn("a", F.when(F.col("b") < 2, F.col("a")))
    _, scorer = forest(df)
    for s in (scorer, lambda rows: scorer(rows)):
        with pytest.raises(Exception, match="null|Null|NULL"):
            Ex.model_shapley(gaps, df, NAMES, s, draws=5).collect()
