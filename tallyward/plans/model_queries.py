"""Models, detectors, ensembles and batch scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyward import ml
from tallyward.functions import scoring as S
from tallyward.operators import detectors as De
from tallyward.operators import ensemble as En
from tallyward.operators import models as Mo
from tallyward.operators import sequences as Sq
from tallyward.operators import stages as St
from tallyward.operators.explain import top_factors
from tallyward.operators.metrics import fold_summary, result_table
from tallyward.operators.splits import class_split, hold_out, undersample
from tallyward.operators.velocity import velocity_names
from tallyward.plans import benchmarks as Be
from tallyward.plans import views as V
from tallyward.plans.registry import query
from tallyward.plans.views import with_views
from tallyward.session import fresh_path, settle

FEATS = S.RULE_FEATURES
WIDTH = 64


def supervised(spark, sf):
    """Rule inputs as one feature vector per transaction."""
    s = V.scored(spark, sf).select(F.col("transaction_id").alias("row_id"), F.col("is_fraud").alias("label"), *FEATS)
    return Mo.as_features(s, FEATS).select("row_id", "features", "label")


def _halves(df):
    rows = hold_out(df, "row_id", 0.3)
    return rows.where(F.col("split") == "train").drop("split"), rows.where(F.col("split") == "test").drop("split")


@query("I4_logistic_regression")
def i4(spark, sf):
    train, test = _halves(supervised(spark, sf))
    _, scorer = Mo.fit_logistic(train, balanced=True)
    return scorer(test).select("row_id", "label", "score")


@query("I5_random_forest")
def i5(spark, sf):
    train, test = _halves(V.vec(spark, sf))
    _, scorer = Mo.fit_forest(train, balanced=True)
    return scorer(test).select("row_id", "label", "score")


@query("I6_gradient_boosting")
def i6(spark, sf):
    train, test = _halves(supervised(spark, sf))
    _, scorer = Mo.fit_boosting(train)
    return scorer(test).select("row_id", "label", "score")


@query("I7_focal_loss_model")
def i7(spark, sf):
    train, test = _halves(V.vec(spark, sf))
    _, scorer = Mo.fit_focal(train, WIDTH)
    return scorer(test).select("row_id", "label", "score")


@query("I8_perceptron_on_last_step")
def i8(spark, sf):
    seqs = Sq.last_step(Sq.user_sequences(V.tx(spark, sf), 10, ["amount", "hour_of_day"]))
    rows = seqs.select(F.col("transaction_id").alias("row_id"), "features", "label")
    train, test = _halves(rows)
    _, scorer = Mo.fit_perceptron(undersample(train, "row_id", "label", 1.0), 2)
    return scorer(test).select("row_id", "label", "score")


def _normal(spark, sf):
    v = V.vec(spark, sf)
    return v, v.where(F.col("label") == 0)


@query("I9_isolation_forest")
def i9(spark, sf):
    v, normal = _normal(spark, sf)
    return De.fit_isolation_forest(normal, "row_id").score(v).select("row_id", "label", "score")


@query("I11_one_class_boundary")
def i11(spark, sf):
    v, normal = _normal(spark, sf)
    return De.fit_one_class(normal, WIDTH).score(v).select("row_id", "label", "score")


@query("I12_reconstruction_error")
def i12(spark, sf):
    v, normal = _normal(spark, sf)
    return De.reconstruction_scorer(normal, WIDTH)(v).select("row_id", "label", "score")


MODELS = ["p", "q", "merchant_risk"]


@query("I13_vote_average", with_views("scored") + "SELECT transaction_id, round((p+q+merchant_risk)/3.0::DOUBLE,6) AS ensemble FROM scored")
def i13(spark, sf):
    return V.scored(spark, sf).select("transaction_id", F.round(En.vote_average(MODELS), 6).alias("ensemble"))


@query(
    "I13_vote_average_weighted",
    with_views("scored") + "SELECT transaction_id, round(p*(2.0::DOUBLE/4.0::DOUBLE)+q*(1.0::DOUBLE/4.0::DOUBLE)+merchant_risk*(1.0::DOUBLE/4.0::DOUBLE),6) AS ensemble FROM scored",
)
def i13_weighted(spark, sf):
    w = {"p": 2.0, "q": 1.0, "merchant_risk": 1.0}
    return V.scored(spark, sf).select("transaction_id", F.round(En.vote_average(MODELS, w), 6).alias("ensemble"))


_RANGE = "SELECT " + ", ".join(f"min({m}) AS {m}_lo, max({m}) AS {m}_hi" for m in MODELS) + " FROM scored"


@query(
    "I14_vote_majority",
    with_views("scored", r=_RANGE) + "SELECT transaction_id, round((" + "+".join(
        f"CASE WHEN ({m}-{m}_lo)/({m}_hi-{m}_lo+1e-10::DOUBLE)>=0.5::DOUBLE THEN 1.0::DOUBLE ELSE 0 END" for m in MODELS
    ) + ")/3.0::DOUBLE,6) AS ensemble FROM scored, r",
)
def i14(spark, sf):
    v = En.vote_majority(V.scored(spark, sf), MODELS)
    return v.select("transaction_id", F.round("ensemble", 6).alias("ensemble"))


_BIN = "SELECT transaction_id, CAST(p>=0.15::DOUBLE AS INTEGER) AS a, CAST(q>=0.5::DOUBLE AS INTEGER) AS b, CAST(merchant_risk>=0.25::DOUBLE AS INTEGER) AS c, CAST(velocity_1h>=2 AS INTEGER) AS d FROM scored"


def _binary(spark, sf):
    return V.scored(spark, sf).select(
        "transaction_id", (F.col("p") >= 0.15).cast("int").alias("a"), (F.col("q") >= 0.5).cast("int").alias("b"),
        (F.col("merchant_risk") >= 0.25).cast("int").alias("c"), (F.col("velocity_1h") >= 2).cast("int").alias("d"),
    )


@query("I15_vote_binary", with_views("scored", x=_BIN) + "SELECT transaction_id, CAST(a+b+c+d>=2 AS INTEGER) AS predicted FROM x")
def i15(spark, sf):
    return _binary(spark, sf).select("transaction_id", En.vote_binary(["a", "b", "c", "d"]).alias("predicted"))


@query(
    "I15_vote_binary_weighted",
    with_views("scored", x=_BIN) + "SELECT transaction_id, CAST(a*0.5::DOUBLE+b*0.25::DOUBLE+c*0.25::DOUBLE+d*0.0::DOUBLE>=0.5::DOUBLE AS INTEGER) AS predicted FROM x",
)
def i15_weighted(spark, sf):
    w = {"a": 2.0, "b": 1.0, "c": 1.0, "d": 0.0}
    return _binary(spark, sf).select("transaction_id", En.vote_binary(["a", "b", "c", "d"], w).alias("predicted"))


@query(
    "I16_scaled_average",
    with_views("scored", r=_RANGE) + "SELECT transaction_id, round((" + "+".join(f"({m}-{m}_lo)/({m}_hi-{m}_lo)" for m in MODELS)
    + ")/3.0::DOUBLE,6) AS ensemble FROM scored, r",
)
def i16(spark, sf):
    v = En.scaled_average(V.scored(spark, sf), MODELS)
    return v.select("transaction_id", F.round("ensemble", 6).alias("ensemble"))


@query("I17_stacking")
def i17(spark, sf):
    s = V.scored(spark, sf).select(F.col("transaction_id").alias("row_id"), F.col("is_fraud").alias("label"), *MODELS)
    train, test = _halves(s)
    return Mo.stack_models(train, test, MODELS).select("row_id", "label", "stacked")


@query("I18_stacking_out_of_fold")
def i18(spark, sf):
    train, test = _halves(V.vec(spark, sf))
    fits = {
        "lr": lambda d: Mo.fit_logistic(d, out="lr")[1],
        "rf": lambda d: Mo.fit_forest(d, out="rf")[1],
    }
    return Mo.stack_out_of_fold(train, test, fits, "row_id").select("row_id", "label", "stacked")


@query("I19_detector_benchmark")
def i19(spark, sf):
    return Be.detector_benchmark(V.vec(spark, sf), WIDTH)


@query("H9_resampled_cross_validation")
def h9(spark, sf):
    return Be.cross_validate(
        V.vec(spark, sf), Mo.fit_logistic, "random_undersampling",
        resample=lambda d: undersample(d, "row_id", "label", 0.5),
    )


@query("I20_imbalance_benchmark")
def i20(spark, sf):
    return result_table(fold_summary(Be.imbalance_benchmark(V.vec(spark, sf), WIDTH)), Be.METRICS)


_REASONS = """concat_ws('|', CASE WHEN amount>=500 THEN 'high_amount' END, CASE WHEN merchant_risk>=0.6::DOUBLE THEN 'merchant_risk' END,
 CASE WHEN velocity_1h>=6 THEN 'high_velocity' END, CASE WHEN distance_from_home>=80 THEN 'distance_from_home' END)"""
_TERMS = """SELECT transaction_id, 'amount' AS f, least(amount/1500.0::DOUBLE,1.0::DOUBLE)*0.35::DOUBLE AS c FROM scored
 UNION ALL SELECT transaction_id, 'merchant_risk', merchant_risk*0.3::DOUBLE FROM scored
 UNION ALL SELECT transaction_id, 'velocity_1h', least(velocity_1h/20.0::DOUBLE,1.0::DOUBLE)*0.2::DOUBLE FROM scored
 UNION ALL SELECT transaction_id, 'distance_from_home', least(distance_from_home/250.0::DOUBLE,1.0::DOUBLE)*0.15::DOUBLE FROM scored"""


@query(
    "I21_batch_score",
    with_views(
        "scored", t=_TERMS, k="SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY abs(c) DESC, f) AS rk FROM t",
        top="SELECT transaction_id, string_agg(f,'|' ORDER BY rk) AS top_factors FROM k WHERE rk<=3 GROUP BY transaction_id",
        r=f"SELECT transaction_id, {_REASONS} AS r FROM scored",
    ) + """SELECT s.transaction_id, user_id, merchant_id, p AS fraud_probability, CASE WHEN p>=0.5::DOUBLE THEN 'fraud' ELSE 'legitimate' END AS prediction,
    CASE WHEN p>=0.85::DOUBLE THEN 'critical' WHEN p>=0.65::DOUBLE THEN 'high' WHEN p>=0.4::DOUBLE THEN 'medium' ELSE 'low' END AS risk_tier,
    CASE WHEN r='' THEN 'baseline_pattern' ELSE r END AS reasons, top_factors
    FROM scored s JOIN top USING (transaction_id) JOIN r USING (transaction_id)""",
)
def i21(spark, sf):
    p = F.col("p")
    return V.scored_from(V.tx(spark, sf)).select(
        "transaction_id", "user_id", "merchant_id", p.alias("fraud_probability"), S.decision(p).alias("prediction"),
        S.risk_tier(p).alias("risk_tier"), F.concat_ws("|", S.reasons()).alias("reasons"),
        F.concat_ws("|", top_factors(3)).alias("top_factors"),
    )


FACTORS = ["amount", "hour_of_day", *velocity_names([(1, "h"), (24, "h")], ["count", "sum"]), "deviation_amount_zscore", "merchant_fraud_rate"]


def scoring_pipeline() -> Pipeline:
    """Features, scaling and a classifier as one savable pipeline."""
    filled = ", ".join(f"coalesce(double({c}), 0.0) AS x_{c}" for c in FACTORS)
    return Pipeline(
        stages=[
            ml.MerchantRiskFeatures(),
            ml.DeviationFeatures(features=["amount"]),
            ml.VelocityFeatures(windows=["1h", "24h"], features=["count", "sum"]),
            SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
            VectorAssembler(inputCols=[f"x_{c}" for c in FACTORS], outputCol="x"),
            StandardScaler(inputCol="x", outputCol="z", withMean=True),
            LogisticRegression(featuresCol="z", labelCol="is_fraud", regParam=0.01),
        ]
    )


FEATURE_STAGES = 3


def fit_scoring(train) -> PipelineModel:
    """:func:`scoring_pipeline` fitted in two steps, so that learned tables and features are computed once.

    ``Pipeline.fit`` would compute the windows again for every estimator behind them.
    """
    stages = scoring_pipeline().getStages()
    learned = fresh_path(train.sparkSession, "scoring-features")
    Pipeline(stages=stages[:FEATURE_STAGES]).fit(train).write().save(learned)
    features = PipelineModel.load(learned)
    rows = settle(features.transform(train).select(*FACTORS, "is_fraud"))
    classifier = Pipeline(stages=stages[FEATURE_STAGES:]).fit(rows)
    return PipelineModel([*features.stages, *classifier.stages])


def score_with(model: PipelineModel, df):
    """Probability, decision, tier and the three factors of largest absolute contribution to the log odds."""
    weights = [float(w) for w in model.stages[-1].coefficients]
    p = F.round(vector_to_array("probability")[1], 4)
    parts = F.zip_with(
        vector_to_array("z"),
        F.array(*[F.struct(F.lit(n).alias("n"), F.lit(w).alias("w")) for n, w in zip(FACTORS, weights, strict=True)]),
        lambda z, f: F.struct((-F.abs(z * f["w"])).alias("size"), f["n"].alias("name")),
    )
    top = F.array_join(F.transform(F.slice(F.array_sort(parts), 1, 3), lambda x: x["name"]), "|")
    return model.transform(df).select(
        "transaction_id", p.alias("fraud_probability"), S.decision(p).alias("prediction"), S.risk_tier(p).alias("risk_tier"),
        top.alias("top_factors"),
    )


@query("I21_batch_score_fitted")
def i21_fitted(spark, sf):
    """Fitted on a hold-out's training part, saved, loaded again, and applied to the whole table."""
    t = V.tx(spark, sf)
    train = hold_out(t, "transaction_id", 0.3).where(F.col("split") == "train").drop("split")
    path = fresh_path(spark, "scoring-pipeline")
    fit_scoring(train).write().save(path)
    return score_with(PipelineModel.load(path), t)


@query("I22_importances")
def i22(spark, sf):
    rows = supervised(spark, sf)
    lr, _ = Mo.fit_logistic(rows)
    rf, _ = Mo.fit_forest(rows)
    a = Mo.importances(FEATS, lr.coefficients.toArray(), rows).withColumn("model", F.lit("logistic"))
    b = Mo.importances(FEATS, rf.featureImportances.toArray(), rows).withColumn("model", F.lit("forest"))
    return a.unionByName(b)


@query("L3_detector_contract")
def l3(spark, sf):
    v = V.vec(spark, sf)
    rows = class_split(v, "row_id", "label")
    normal = rows.where(F.col("split") == "train").drop("split")
    d = De.Detector("reconstruction", WIDTH).fit(normal)
    d.set_threshold(d.score(normal), 0.05)
    return d.predict(v).select("row_id", "label", "score", "predicted")


@query("L3_detector_stages")
def l3_stages(spark, sf):
    """An isolation forest and its threshold as a Pipeline: fit on normal training rows, saved, loaded, scored."""
    from tallyward.session import fresh_path

    v = V.vec(spark, sf)
    rows = class_split(v, "row_id", "label")
    normal = rows.where(F.col("split") == "train").drop("split")
    fitted = Pipeline(stages=[St.IsolationForestDetector(), St.ShareThreshold(contamination=0.05)]).fit(normal)
    path = fresh_path(spark, "detector-pipeline")
    fitted.save(path)
    return PipelineModel.load(path).transform(v).select("row_id", "label", "score", "predicted")
