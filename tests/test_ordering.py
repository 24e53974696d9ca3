import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.operators.ordering import exact_quantiles, ordinals, running_totals


def rows(spark, n=500):
    rng = np.random.default_rng(3)
    # a third of all rows share one value
    v = np.where(rng.random(n) < 0.34, 7, rng.integers(0, 50, n))
    data = [(i, int(x), float(rng.random()), int(i % 3 == 0)) for i, x in enumerate(v)]
    return data, spark.createDataFrame(data, "id long, v long, x double, g int")


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_by_group(spark, descending):
    data, df = rows(spark)
    counts = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = running_totals(counts, "v", {"upto": F.col("n")}, by=["g"], descending=descending).collect()
    for r in got:
        want = sum(1 for d in data if d[3] == r["g"] and (d[1] >= r["v"] if descending else d[1] <= r["v"]))
        assert r["upto"] == want


def test_ordinals_split_a_hot_value(spark):
    data, df = rows(spark)
    got = [r["id"] for r in ordinals(df, "v", "id").orderBy("ordinal").collect()]
    assert got == [d[0] for d in sorted(data, key=lambda d: (d[1], d[0]))]
    assert sorted(r["ordinal"] for r in ordinals(df, "v", "id").collect()) == list(range(len(data)))


@pytest.mark.parametrize("by", [[], ["g"]])
def test_exact_quantiles(spark, by):
    data, df = rows(spark)
    shares = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    for r in exact_quantiles(df, ["v", "x"], shares, by=by).collect():
        i = {"v": 1, "x": 2}[r["column"]]
        values = [d[i] for d in data if not by or d[3] == r["g"]]
        assert r["value"] == pytest.approx(np.quantile(values, r["share"]), rel=1e-12)


def test_one_value_and_empty(spark):
    one = spark.createDataFrame([(1.5,)], "x double")
    assert [r["value"] for r in exact_quantiles(one, ["x"], [0.5]).collect()] == [1.5]
    assert exact_quantiles(one.where("x > 2"), ["x"], [0.5]).collect() == []
