import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tallyward import ml
from tallyward.operators import detectors as De
from tallyward.operators import ensemble as En
from tallyward.operators import models as Mo
from tallyward.operators import scaling as Sc
from tallyward.plans import benchmarks as Be
from tallyward.plans import views as V

D = 10


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(42)
    x = np.vstack([rng.normal(size=(500, D)), rng.normal(5, 1, size=(50, D))])
    rows = [(i, v.tolist(), int(i >= 500)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "row_id long, features array<double>, label int").cache()


@pytest.mark.parametrize("kind, options", [
    ("isolation_forest", {"trees": 30}), ("outlier_factor", {}), ("one_class", {"rounds": 15}), ("reconstruction", {"latent": 3}),
])
def test_anomalies_score_higher(blobs, kind, options):
    d = De.Detector(kind, D, **options).fit(blobs.where("label = 0"))
    mean = {r["label"]: r["s"] for r in d.score(blobs).groupBy("label").agg(F.avg("score").alias("s")).collect()}
    assert mean[1] > mean[0]


def test_detector_contract(blobs):
    d = De.Detector("isolation_forest", D, trees=20)
    with pytest.raises(ValueError):
        d.score(blobs)
    normal = blobs.where("label = 0")
    d.fit(normal)
    with pytest.raises(ValueError):
        d.predict(blobs)
    d.set_threshold(d.score(normal), 0.05)
    hit = {r["label"]: r["h"] for r in d.predict(blobs).groupBy("label").agg(F.avg("predicted").alias("h")).collect()}
    assert hit[1] > 0.9 and hit[0] < 0.1
    with pytest.raises(ValueError):
        De.Detector("unknown", D)


def test_forest_is_repeatable_and_bounded(blobs):
    normal = blobs.where("label = 0")
    one = De.fit_isolation_forest(normal, "row_id", trees=10).score(blobs)
    two = De.fit_isolation_forest(normal.repartition(5), "row_id", trees=10).score(blobs)
    a, b = ([r["score"] for r in x.orderBy("row_id").collect()] for x in (one, two))
    assert a == b and all(0 < s <= 1 for s in a)


def test_batch_score_equals_single_score(blobs):
    model = De.fit_isolation_forest(blobs.where("label = 0"), "row_id", trees=10)
    whole = {r["row_id"]: r["score"] for r in model.score(blobs).collect()}
    one = model.score(blobs.where("row_id = 7")).first()
    assert whole[7] == one["score"]


def test_average_path():
    assert De.average_path(1) == 0 and De.average_path(2) == 1
    assert De.average_path(256) == pytest.approx(10.244770920)


def separates(scored, column="score"):
    m = {r["label"]: r["s"] for r in scored.groupBy("label").agg(F.avg(column).alias("s")).collect()}
    return m[1] > m[0] + 0.3


def test_classifiers_separate(blobs):
    for fit in (
        lambda d: Mo.fit_logistic(d, balanced=True), lambda d: Mo.fit_forest(d, trees=10, depth=4),
        lambda d: Mo.fit_boosting(d, rounds=3, depth=3), lambda d: Mo.fit_focal(d, D, rounds=40),
        lambda d: Mo.fit_perceptron(d, D, hidden=(8,), max_iter=20),
    ):
        _, scorer = fit(blobs)
        assert separates(scorer(blobs))


def test_focal_gradient_matches_differences():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(20, 3)), (rng.random(20) < 0.5).astype(float)
    theta = rng.normal(size=4)

    def loss(t):
        z = x @ t[:-1] + t[-1]
        p = 1 / (1 + np.exp(-z))
        pt, a = np.where(y == 1, p, 1 - p), np.where(y == 1, 0.25, 0.75)
        return (-a * (1 - pt) ** 2 * np.log(pt)).sum()

    got = Mo._focal_gradient(theta, 0.25, 2.0)(x, y)
    for i in range(4):
        e = np.zeros(4)
        e[i] = 1e-6
        assert got[i] == pytest.approx((loss(theta + e) - loss(theta - e)) / 2e-6, rel=1e-4)


def test_stacking_beats_a_bad_base(blobs):
    fits = {"lr": lambda d: Mo.fit_logistic(d, out="lr")[1], "rf": lambda d: Mo.fit_forest(d, trees=5, depth=3, out="rf")[1]}
    out = Mo.stack_out_of_fold(blobs, blobs, fits, "row_id", folds=2)
    assert separates(out, "stacked")


def test_votes(spark):
    df = spark.createDataFrame([(0, 0.0, 1.0), (1, 1.0, 0.0), (2, 1.0, 1.0)], "id long, a double, b double")
    v = {r["id"]: r["ensemble"] for r in En.vote_majority(df, ["a", "b"]).collect()}
    assert v == {0: 0.5, 1: 0.5, 2: 1.0}
    binary = df.select("id", F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"))
    assert [r[0] for r in binary.orderBy("id").select(En.vote_binary(["a", "b"])).collect()] == [1, 1, 1]


def test_scaling_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [list(r) for r in Sc.standardise(df, ["a", "b"]).collect()] == [[-1.0, 0.0], [1.0, 0.0]]
    assert [list(r) for r in Sc.min_max(df, ["a", "b"]).collect()] == [[0.0, 0.0], [1.0, 0.0]]


def test_components_explain_variance(blobs):
    wide = blobs.select("row_id", "label", *[F.col("features")[i].alias(f"f{i}") for i in range(D)])
    out, explained = Sc.principal_components(wide, [f"f{i}" for i in range(D)], "row_id", 2, ["label"])
    assert explained[0] > explained[1] > 0 and sum(explained) <= 100 + 1e-9
    assert out.columns == ["row_id", "label", "pc1", "pc2"] and out.count() == 550


def test_resampling_touches_only_training_folds(blobs):
    seen = []

    def resample(train):
        seen.append(train.count())
        return train.where("label = 1 or row_id % 2 = 0")

    m = Be.cross_validate(blobs, Mo.fit_logistic, "t", folds=2, resample=resample)
    assert len(seen) == 2 and sum(seen) == 550  # each fold's training rows are the other half
    assert m.where("metric = 'auroc'").agg(F.min("value")).first()[0] > 0.95


def test_stages_save_and_load(spark, sf, tmp_path):
    t = V.tx(spark, sf)
    stages = [
        ml.VelocityFeatures(windows=["1h"], features=["count"]), ml.DeviationFeatures(features=["amount"], windowSize=5),
        ml.MerchantRiskFeatures(alpha=2.0), ml.Standardise(inputCols=["amount"]),
    ]
    model = Pipeline(stages=stages).fit(t)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = model.transform(t), again.transform(t)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0
    with pytest.raises(ValueError):
        ml.MerchantRiskFeatures().fit(t.drop("is_fraud"))


def test_selector_keeps_named_columns(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), int(a > 0)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "transaction_id long, signal double, noise double, is_fraud int")
    kept = ml.ContributionSelector(inputCols=["noise", "signal"], nFeatures=1, trees=10).fit(df)
    assert kept.get_feature_names_out() == ["transaction_id", "signal"]
