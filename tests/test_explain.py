import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.functions import scoring as S
from tallyward.operators import explain as Ex
from tallyward.operators import reports as Rp

FEATS = ["a", "b", "c"]


def frame(spark, n=60, seed=0):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rng.normal(size=(n, 3)))], "transaction_id long, a double, b double, c double")


def mixed(v):
    return 2.0 * v["a"] + v["a"] * v["b"] - v["c"]


def test_shapley_sums_to_the_difference(spark):
    df = frame(spark)
    one = df.limit(1)  # a background of one row makes the sum exact per row
    base = one.select(mixed(Ex.current(FEATS)).alias("y")).first()["y"]
    c = Ex.sampled_shapley(df, one, FEATS, mixed, draws=6).groupBy("transaction_id").agg(F.sum("contribution").alias("s"))
    for r in c.join(df, "transaction_id").select("s", mixed(Ex.current(FEATS)).alias("y")).collect():
        assert r["s"] == pytest.approx(r["y"] - base)


def test_model_shapley_agrees_on_a_linear_model(spark):
    df = frame(spark)
    one = df.limit(1).first()

    def scorer(rows):
        return rows.withColumn("score", F.col("features")[0] * 3.0 - F.col("features")[1])

    got = Ex.model_shapley(df, df.limit(1), FEATS, scorer, draws=4).groupBy("transaction_id").pivot("feature", FEATS).sum("contribution")
    for r in got.withColumnsRenamed({f: f"s_{f}" for f in FEATS}).join(df, "transaction_id").collect():
        assert r["s_a"] == pytest.approx(3 * (r["a"] - one["a"])) and r["s_b"] == pytest.approx(one["b"] - r["b"])
        assert r["s_c"] == pytest.approx(0.0, abs=1e-12)


def test_linear_contributions_average_to_zero(spark):
    c = Ex.linear_contributions(frame(spark), {"a": 2.0, "b": -1.0})
    for r in c.groupBy("feature").agg(F.avg("contribution").alias("m")).collect():
        assert r["m"] == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("preset", ["surrogate", "half_std"])
def test_surrogate_recovers_a_linear_score(spark, preset):
    df = frame(spark)
    std = df.agg(*[F.stddev_pop(f).alias(f) for f in FEATS]).first()
    out = Ex.local_surrogate(df.limit(5), FEATS, lambda v: 2.0 * v["a"] - v["c"], draws=2000, top_n=None, preset=preset, ridge=1e-9)
    std = df.limit(5).agg(*[F.stddev_pop(f).alias(f) for f in FEATS]).first()
    want = {"a": 2.0 * std["a"], "b": 0.0, "c": -std["c"]}
    for r in out.collect():
        assert r["contribution"] == pytest.approx(want[r["feature"]], abs=1e-6)


def test_surrogate_is_repeatable(spark):
    df = frame(spark)
    a, b = (Ex.local_surrogate(x, FEATS, mixed, draws=50) for x in (df, df.repartition(5)))
    key = lambda d: [(r[0], r[1], round(r[2], 9)) for r in d.orderBy("transaction_id", "feature").collect()]
    assert key(a) == key(b)


def test_dependence_of_a_linear_score(spark):
    df = frame(spark)
    grids = {f: Ex.feature_grid(df, f, 20) for f in FEATS}
    assert all(len(g) == 20 for g in grids.values())
    pd = Ex.partial_dependence(df, grids, FEATS, lambda v: 2.0 * v["a"] + v["b"] ** 2)
    lin = {r["feature"]: r for r in Ex.linearity(pd).collect()}
    assert lin["a"]["is_linear"] and not lin["b"]["is_linear"]
    top = Ex.range_importance(pd, 1).first()
    assert top["feature"] in ("a", "b")


def test_small_grid_uses_distinct_values(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (1.0,)], "a double")
    assert Ex.feature_grid(df, "a") == [1.0, 3.0]


def test_permutation_effect_of_an_unused_feature_is_zero(spark):
    e = {r["feature"]: r["effect"] for r in Ex.permutation_effect(frame(spark), FEATS, lambda v: v["a"] * v["b"]).collect()}
    assert e["c"] == pytest.approx(0.0, abs=1e-12) and abs(e["a"]) > 1e-6


def test_rule_request_example(spark):
    df = spark.createDataFrame([("tx-1", 1200.0, 0.8, 9.0, 110.0)], "transaction_id string, amount double, merchant_risk double, velocity_1h double, distance_from_home double")
    p = S.clamp_probability(S.rule_score())
    r = df.select(p.alias("p"), S.risk_tier(p).alias("t"), S.decision(p).alias("d"), S.reasons().alias("r")).first()
    assert (r["p"], r["t"], r["d"]) == (0.676, "high", "fraud")
    assert r["r"] == ["high_amount", "merchant_risk", "high_velocity", "distance_from_home"]
    none = df.withColumn("amount", F.lit(1.0)).withColumn("merchant_risk", F.lit(0.0)).withColumn("velocity_1h", F.lit(0.0)).withColumn("distance_from_home", F.lit(0.0))
    assert none.select(S.reasons()).first()[0] == ["baseline_pattern"]


def test_blend_edges(spark):
    row = spark.range(1)
    empty = F.create_map().cast("map<string,double>")
    assert row.select(S.blend_map(empty)["score"]).first()[0] == 0.0
    zero = S.blend_map(F.create_map(F.lit("a"), F.lit(0.8)), F.create_map(F.lit("a"), F.lit(-1.0)))
    assert row.select(zero["score"]).first()[0] == 0.0
    two = S.blend_map(F.create_map(F.lit("a"), F.lit(0.9), F.lit("b"), F.lit(0.3)), F.create_map(F.lit("a"), F.lit(3.0), F.lit("b"), F.lit(1.0)))
    r = row.select(two.alias("t")).first()["t"]
    assert r["score"] == 0.75 and r["label"] == 1 and r["contributions"] == {"a": 0.675, "b": 0.075}


def test_top_factors_are_at_most_n_and_quality(spark):
    c = Ex.linear_contributions(frame(spark), {"a": 2.0, "b": -1.0, "c": 0.1})
    top = Rp.risk_factors(c, 2)
    assert top.groupBy("transaction_id").count().agg(F.max("count")).first()[0] == 2
    q = Ex.explanation_quality(c).first()
    assert q["passed"] and q["unique_features"] == 3 and q["features_per_explanation"] == 3.0
    bad = c.withColumn("contribution", F.when(F.col("feature") == "a", F.lit(float("nan"))).otherwise(F.lit(float("inf"))))
    q = Ex.explanation_quality(bad).first()
    assert not q["passed"] and q["null_values"] == 60 and q["infinite_values"] == 120


def test_repeated_runs_are_consistent(spark):
    c = Ex.linear_contributions(frame(spark, 1), {"a": 2.0})
    runs = c.unionByName(c).withColumnRenamed("transaction_id", "run")
    r = Ex.consistency(runs).first()
    assert r["variance"] == 0.0 and r["is_consistent"]
