"""Estimators behind the features are fitted on written rows, not on the windows again."""

from pyspark.ml.feature import StandardScaler

from tallyward.plans import model_queries as Mq


def test_features_are_written_before_the_classifier(spark, sf, monkeypatch):
    plans, fit = [], StandardScaler._fit

    def seen(self, dataset):
        plans.append(dataset._jdf.queryExecution().optimizedPlan().toString())
        return fit(self, dataset)

    monkeypatch.setattr(StandardScaler, "_fit", seen)
    out = Mq.i21_fitted(spark, sf)
    assert len(plans) == 1 and "Window" not in plans[0] and "Join" not in plans[0]
    rows = out.collect()
    assert len(rows) == 1000 and all(0 <= r["fraud_probability"] <= 1 for r in rows)
