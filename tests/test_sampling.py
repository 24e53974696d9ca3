import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.operators import neighbours as N
from tallyward.operators import resample as Rs
from tallyward.operators import splits as Sp


def vectors(spark, n=240, d=6, seed=2, copies=80):
    """Random vectors of which ``copies`` rows (a third) are equal."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[:copies] = x[0]
    data = [(i, [float(v) for v in row], int(i % 8 == 0)) for i, row in enumerate(x)]
    return x, spark.createDataFrame(data, "row_id long, features array<double>, label int")


def brute(x, k, exclude_self, ref=None):
    ref = range(len(x)) if ref is None else ref
    out = {}
    for i in range(len(x)):
        d = [(float(np.sqrt(((x[i] - x[j]) ** 2).sum())), j) for j in ref if not (exclude_self and i == j)]
        out[i] = [j for _, j in sorted(d)[:k]]
    return out


@pytest.mark.parametrize("pivots, block", [(1, 1024), (12, 16)])
@pytest.mark.parametrize("exclude_self", [True, False])
def test_neighbours_equal_brute_force(spark, pivots, block, exclude_self):
    x, df = vectors(spark)
    got = {}
    for r in N.nearest_neighbours(df, df, 5, exclude_self=exclude_self, pivots=pivots, block_rows=block).orderBy("row_id", "rank").collect():
        got.setdefault(r["row_id"], []).append(r["neighbour"])
    assert got == brute(x, 5, exclude_self)


def test_neighbours_of_a_small_reference(spark):
    _, df = vectors(spark)
    few = df.where("row_id >= 238")
    rows = N.nearest_neighbours(df, few, 5).collect()
    assert len(rows) == 240 * 2
    with pytest.raises(ValueError):
        N.nearest_neighbours(df, df.where("false"), 5)


def test_outliers_score_higher(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(120, 4)), rng.normal(5, 1, size=(12, 4))])
    df = spark.createDataFrame([(i, v.tolist(), int(i >= 120)) for i, v in enumerate(x)], "row_id long, features array<double>, label int")
    s = N.local_outlier_factor(df, k=10).join(df, "row_id").groupBy("label").agg(F.avg("score").alias("s")).orderBy("label").collect()
    assert s[1]["s"] > 2 * s[0]["s"]


def test_smote_lies_between_its_parents(spark):
    x, df = vectors(spark, copies=1)
    new = Rs.smote(df, ratio=0.5).collect()
    rare = int((np.arange(240) % 8 == 0).sum())
    assert len(new) == (240 - rare) // 2 - rare
    for r in new:
        a, b, f = x[r["base"]], x[r["neighbour"]], np.array(r["features"])
        assert r["base"] % 8 == 0 and r["neighbour"] % 8 == 0
        assert np.all(f >= np.minimum(a, b) - 1e-12) and np.all(f <= np.maximum(a, b) + 1e-12)
    assert sorted(map(str, new)) == sorted(map(str, Rs.smote(df, ratio=0.5).collect()))
    with pytest.raises(ValueError):
        Rs.smote(df, ratio=0.01)


def test_adasyn_favours_mixed_neighbourhoods(spark):
    # a lone minority row among the majority, and a separate minority cluster
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(0, 1, (60, 2)), [[0.0, 0.0]], rng.normal(50, 0.1, (8, 2))])
    df = spark.createDataFrame([(i, v.tolist(), int(i >= 60)) for i, v in enumerate(x)], "row_id long, features array<double>, label int")
    bases = [r["base"] for r in Rs.adasyn(df, ratio=0.5).collect()]
    assert bases and set(bases) == {60}


def labelled(spark, n=2000):
    return spark.range(n).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))


def test_exact_split_sizes(spark):
    df = Sp.exact_class_split(labelled(spark), "id", "y")
    got = {(r["y"], r["split"]): r["count"] for r in df.groupBy("y", "split").count().collect()}
    assert got == {(0, "test"): 360, (0, "validation"): 180, (0, "train"): 1260, (1, "test"): 40, (1, "validation"): 20, (1, "train"): 140}


def test_class_split_trains_on_one_class(spark):
    df = Sp.class_split(labelled(spark), "id", "y")
    assert df.where("split = 'train' and y = 1").count() == 0
    assert df.where("split = 'test' and y = 1").count() > 0


def test_folds_are_stratified_and_repeatable(spark):
    a = Sp.stratified_folds(labelled(spark), "id", "y", 5)
    sizes = {r["count"] for r in a.where("y = 1").groupBy("fold").count().collect()}
    assert sizes == {40}
    b = Sp.stratified_folds(labelled(spark).repartition(11), "id", "y", 5)
    assert a.exceptAll(b).count() == 0


def test_undersampling(spark):
    exact = Sp.undersample(labelled(spark), "id", "y", 0.5, exact=True)
    assert exact.where("y = 0").count() == 400 and exact.where("y = 1").count() == 200
    about = Sp.undersample(labelled(spark), "id", "y", 0.5).where("y = 0").count()
    assert 300 < about < 500


def test_ordered_split_boundaries(spark):
    df = spark.range(101).select(F.col("id"), F.timestamp_seconds(F.col("id") * 0).alias("t"), F.lit(1).alias("user_id"))
    got = {r["split"]: r["count"] for r in Sp.ordered_split(df, "t", "id").groupBy("split").count().collect()}
    assert got == {"train": 70, "validation": 15, "test": 16}
