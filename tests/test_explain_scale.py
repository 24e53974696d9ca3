"""Draws are made next to their row, in many tasks, and are never stored."""

import pytest

from tallyward.operators import explain as Ex


def small(spark, n=40):
    return spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(n)], "transaction_id long, a double, b double").coalesce(1)


def score(v):
    return v["a"] * 2.0 - v["b"]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().split("\n")


def test_draws_are_not_joined(spark):
    df = Ex.local_surrogate(small(spark), ["a", "b"], score, draws=50, preset="half_std")
    lines = plan(df)
    join = next(i for i, x in enumerate(lines) if "Join" in x)
    assert any("Generate explode" in x for x in lines[:join])  # unfolded after the join with the widths
    assert df.count() == 80


@pytest.mark.parametrize("preset", ["surrogate", "half_std"])
def test_one_file_is_dealt_over_tasks(spark, preset):
    df = Ex.local_surrogate(small(spark), ["a", "b"], score, draws=50, preset=preset)
    assert any("RepartitionByExpression" in x for x in plan(df))


def test_copies_of_a_row_share_one_model(spark):
    one = small(spark, 5)
    f = lambda df: {(r[0], r[1]): r[2] for r in Ex.local_surrogate(df, ["a", "b"], score, draws=400, preset="half_std", ridge=0.0).collect()}
    a, b = f(one), f(one.union(one))
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-6 for k in a)
