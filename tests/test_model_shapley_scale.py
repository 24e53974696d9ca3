"""A draw's ends are not scored again for every draw, and contributions stay whole."""

import pytest
from pyspark.sql import functions as F

from tallyward.operators import explain as Ex

NAMES = ["a", "b", "c"]


def table(spark):
    return spark.createDataFrame([(i, float(i % 7), float(i % 5), float(i % 3)) for i in range(30)], "transaction_id long, a double, b double, c double")


def product(rows):
    return rows.withColumn("score", F.aggregate("features", F.lit(1.0), lambda s, x: s * (x + 1.0)))


@pytest.mark.parametrize("width", [1, 2, 3])
def test_points_scored_and_sums(spark, width):
    asked, names = [], NAMES[:width]
    df, one = table(spark), table(spark).limit(1)

    def scorer(rows):
        asked.append(rows)
        return product(rows)

    out = Ex.model_shapley(df, one, names, scorer, draws=4)
    per_row = 4 * (width - 1) + 1 if width > 1 else 4
    assert sum(x.count() for x in asked) == 30 * per_row + 1
    base = product(one.select(F.array(*names).alias("features"))).first()["score"]
    want = {r["transaction_id"]: r["score"] - base for r in product(df.select("transaction_id", F.array(*names).alias("features"))).collect()}
    got = {r[0]: r[1] for r in out.groupBy("transaction_id").agg(F.sum("contribution")).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert out.count() == 30 * width
