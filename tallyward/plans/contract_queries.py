"""The extension surface: stages, composition, callbacks and one-call helpers."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tallyward import ml
from tallyward.operators import explain as Ex
from tallyward.operators import models as Mo
from tallyward.operators.splits import undersample
from tallyward.plans import benchmarks as Be
from tallyward.plans import views as V
from tallyward.plans.registry import ORACLE, query
from tallyward.plans.views import with_views
from tallyward.plans.window_queries import US, _vel_sql
from tallyward.session import fresh_path


@query("L1_velocity_stage", _vel_sql("tx", US, ["count", "sum", "mean"], True))
def l1(spark, sf):
    out = ml.VelocityFeatures().transform(V.tx(spark, sf))
    names = ml.VelocityFeatures().get_feature_names_out()
    return out.withColumns({c: F.round(c, 6) for c in names if "mean" in c}).select("transaction_id", *names)


@query("L2_saved_stages", ORACLE["C5_feature_union"])
def l2(spark, sf):
    """Three stages fitted together, saved, loaded and applied."""
    t = V.tx(spark, sf)
    stages = [ml.VelocityFeatures(features=["count", "sum", "mean"]), ml.DeviationFeatures(), ml.MerchantRiskFeatures()]
    path = fresh_path(spark, "stages")
    Pipeline(stages=stages).fit(t).write().overwrite().save(path)
    model = PipelineModel.load(path)
    names = [n for s in model.stages for n in s.get_feature_names_out()]
    done = model.transform(t)
    six = [c for c in names if "mean" in c or "deviation" in c or c == "merchant_fraud_rate"]
    return done.withColumns({c: F.round(c, 6) for c in six}).select("transaction_id", *names)


@query("L2_selection_and_scaling")
def l2_selection(spark, sf):
    s = V.scored(spark, sf)
    names = ["amount", "merchant_risk", "velocity_1h", "distance_from_home"]
    selector = ml.ContributionSelector(inputCols=names, nFeatures=3, keepCols=["transaction_id", "is_fraud"])
    kept = selector.fit(s).transform(s)
    cols = [c for c in kept.columns if c in names]
    return ml.Standardise(inputCols=cols).fit(kept).transform(kept)


@query("L5_resampler_callback")
def l5(spark, sf):
    def resample(rows):
        return undersample(rows, "row_id", "label", 1.0)

    return Be.cross_validate(V.vec(spark, sf), Mo.fit_logistic, "callback", resample=resample)


@query(
    "L6_one_call_helpers",
    with_views("merch") + "SELECT transaction_id, round(rate,6) AS merchant_fraud_rate, fraud_count AS merchant_fraud_count, total_count AS merchant_total_count FROM tx JOIN merch USING (merchant_id)",
)
def l6(spark, sf):
    out = ml.merchant_risk_features(V.tx(spark, sf))
    return out.select(
        "transaction_id", F.round("merchant_fraud_rate", 6).alias("merchant_fraud_rate"), "merchant_fraud_count",
        "merchant_total_count",
    )


@query("J1_forest_shapley")
def forest_shapley(spark, sf):
    """Sampled Shapley values of a fitted forest for every transaction."""
    s = V.scored(spark, sf)
    names = ["amount", "merchant_risk", "velocity_1h", "distance_from_home"]
    _, scorer = Mo.fit_forest(Mo.as_features(s.withColumn("label", F.col("is_fraud")), names))
    return Ex.model_shapley(s, s, names, scorer)
