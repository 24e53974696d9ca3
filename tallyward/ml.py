"""The feature families as ``pyspark.ml`` stages, and one-call helpers.

Stages compose in a ``pyspark.ml.Pipeline`` and are saved with it: parameters as
metadata, learned statistics as Parquet tables next to it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators import scaling
from tallyward.operators.explain import global_importance, model_shapley, select_features
from tallyward.operators.features import FraudFeatures, FraudFeaturesModel
from tallyward.operators.models import as_features, fit_forest
from tallyward.operators.velocity import require, velocity, velocity_names

Resampler = Callable[[DataFrame], DataFrame]


def parse_window(text: str) -> tuple[int, str]:
    """``24h`` -> (24, 'h')."""
    m = re.fullmatch(r"(\d+)(s|min|h|d)", text)
    if not m:
        raise ValueError(f"Not a window: {text}")
    return int(m[1]), m[2]


def _param(name: str, doc: str, convert=TypeConverters.toString) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=convert)


class _Columns(Params):
    idCol = _param("idCol", "row id column")
    userCol = _param("userCol", "user column")
    merchantCol = _param("merchantCol", "merchant column")
    datetimeCol = _param("datetimeCol", "timestamp column")
    amountCol = _param("amountCol", "amount column")
    labelCol = _param("labelCol", "label column")

    def _column_defaults(self) -> None:
        self._setDefault(
            idCol="transaction_id", userCol="user_id", merchantCol="merchant_id", datetimeCol="timestamp",
            amountCol="amount", labelCol="is_fraud",
        )

    def _of(self, name: str):
        return self.getOrDefault(getattr(self, name))


class VelocityFeatures(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds rolling count, sum, mean, std per window and the gap to the previous row."""

    windows = _param("windows", "windows such as 1h, 24h, 7d", TypeConverters.toListString)
    features = _param("features", "count, sum, mean, std, time_since_last", TypeConverters.toListString)
    ties = _param("ties", "peers or row")

    @keyword_only
    def __init__(self, *, windows=None, features=None, ties=None, idCol=None, userCol=None, datetimeCol=None, amountCol=None):
        super().__init__()
        self._column_defaults()
        self._setDefault(windows=["1h", "24h", "7d"], features=["count", "sum", "mean", "time_since_last"], ties="peers")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def get_feature_names_out(self) -> list[str]:
        return velocity_names([parse_window(w) for w in self._of("windows")], self._of("features"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return velocity(
            dataset, self._of("userCol"), self._of("datetimeCol"), self._of("amountCol"), self._of("idCol"),
            [parse_window(w) for w in self._of("windows")], self._of("features"), self._of("ties"), keep=dataset.columns,
        ).select(*dataset.columns, *self.get_feature_names_out())


class _TableWriter(MLWriter):
    def __init__(self, instance: _FamilyModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        extra = {"family": self.instance.inner.params}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sc, extraMetadata=extra)
        for name, table in self.instance.inner.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/tables/{name}")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sc)
        params = meta["family"]
        names = {"deviation": ["users", "moments"], "merchant": ["merchants", "rate"]}
        tables = {
            n: self.sparkSession.read.parquet(f"{path}/tables/{n}") for f in params["include"] for n in names.get(f, [])
        }
        out = self.cls(FraudFeaturesModel(json.loads(json.dumps(params)), tables))
        out._resetUid(meta["uid"])
        return out


class _FamilyModel(Model, MLWritable, MLReadable):
    """Learned statistics of one family, joined back on transform."""

    def __init__(self, inner: FraudFeaturesModel):
        super().__init__()
        self.inner = inner

    def get_feature_names_out(self) -> list[str]:
        return self.inner.feature_names()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.inner.transform(dataset)

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class DeviationFeaturesModel(_FamilyModel):
    pass


class MerchantRiskFeaturesModel(_FamilyModel):
    pass


class DeviationFeatures(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns per-user statistics over the last rows; adds z-score and ratio."""

    features = _param("features", "columns to compare with history", TypeConverters.toListString)
    windowSize = _param("windowSize", "rows of history", TypeConverters.toInt)
    minTransactions = _param("minTransactions", "shorter histories use global statistics", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, features=None, windowSize=None, minTransactions=None, idCol=None, userCol=None, datetimeCol=None):
        super().__init__()
        self._column_defaults()
        self._setDefault(features=["amount"], windowSize=30, minTransactions=3)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> DeviationFeaturesModel:
        inner = FraudFeatures(
            user_col=self._of("userCol"), datetime_col=self._of("datetimeCol"), id_col=self._of("idCol"),
            deviation_features=self._of("features"), window_size=self._of("windowSize"),
            min_transactions=self._of("minTransactions"), include=["deviation"],
        ).fit(dataset)
        return DeviationFeaturesModel(inner)


class MerchantRiskFeatures(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns smoothed merchant fraud rates; needs labels."""

    alpha = _param("alpha", "prior frauds", TypeConverters.toFloat)
    beta = _param("beta", "prior non-frauds", TypeConverters.toFloat)
    globalRateWeight = _param("globalRateWeight", "weight of the global rate", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, alpha=None, beta=None, globalRateWeight=None, idCol=None, merchantCol=None, labelCol=None):
        super().__init__()
        self._column_defaults()
        self._setDefault(alpha=1.0, beta=1.0, globalRateWeight=0.5)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> MerchantRiskFeaturesModel:
        inner = FraudFeatures(
            merchant_col=self._of("merchantCol"), label_col=self._of("labelCol"), id_col=self._of("idCol"),
            alpha=self._of("alpha"), beta=self._of("beta"), global_rate_weight=self._of("globalRateWeight"),
            include=["merchant"],
        ).fit(dataset)
        return MerchantRiskFeaturesModel(inner)


class SelectColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps named columns."""

    columns = _param("columns", "columns to keep", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def get_feature_names_out(self) -> list[str]:
        return self.getOrDefault(self.columns)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*self.getOrDefault(self.columns))


class ContributionSelector(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the features with the largest mean absolute contribution in a forest.

    ``threshold`` wins over ``nFeatures``.  Contributions are taken on all rows.
    """

    inputCols = _param("inputCols", "candidate features", TypeConverters.toListString)
    keepCols = _param("keepCols", "columns kept besides the features", TypeConverters.toListString)
    nFeatures = _param("nFeatures", "how many to keep", TypeConverters.toInt)
    threshold = _param("threshold", "least importance", TypeConverters.toFloat)
    trees = _param("trees", "trees in the forest", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, keepCols=None, nFeatures=None, threshold=None, trees=None, idCol=None, labelCol=None):
        super().__init__()
        self._column_defaults()
        self._setDefault(nFeatures=20, trees=20, keepCols=["transaction_id"])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SelectColumns:
        names, key = self._of("inputCols"), self._of("idCol")
        require(dataset, [*names, self._of("labelCol"), key])
        clean = dataset.fillna(0.0, subset=names)
        rows = as_features(clean.withColumn("label", F.col(self._of("labelCol"))), names)
        _, scorer = fit_forest(rows.select(key, "features", "label"), trees=self._of("trees"), depth=5)
        importance = global_importance(model_shapley(clean, clean, names, scorer, row=key))
        limit = self.getOrDefault("threshold") if self.isDefined("threshold") else None
        chosen = {r["feature"] for r in select_features(importance, self._of("nFeatures"), limit).collect()}
        return SelectColumns(columns=[*self._of("keepCols"), *[n for n in names if n in chosen]])


class _ScalerWriter(MLWriter):
    def __init__(self, instance: StandardiseModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sc, extraMetadata={"fitted": self.instance.fitted})


class _ScalerReader(MLReader):
    def load(self, path: str) -> StandardiseModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sc)
        out = StandardiseModel(meta["fitted"])
        out._resetUid(meta["uid"])
        return out


class StandardiseModel(Model, MLWritable, MLReadable):
    """Fitted (mean, population std) per column."""

    def __init__(self, fitted: dict[str, list[float]]):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.fitted.items()})

    def write(self) -> MLWriter:
        return _ScalerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ScalerReader()


class Standardise(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Population-std scaling of columns; a zero std divides by 1."""

    inputCols = _param("inputCols", "columns to scale", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> StandardiseModel:
        cols = self.getOrDefault(self.inputCols)
        row = dataset.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        return StandardiseModel({c: [row[f"m{i}"], row[f"s{i}"] or 1.0] for i, c in enumerate(cols)})


# one-call helpers

def velocity_features(df: DataFrame, **options) -> DataFrame:
    return VelocityFeatures(**options).transform(df)


def deviation_features(df: DataFrame, **options) -> DataFrame:
    return DeviationFeatures(**options).fit(df).transform(df)


def merchant_risk_features(df: DataFrame, **options) -> DataFrame:
    return MerchantRiskFeatures(**options).fit(df).transform(df)


def scale_features(df: DataFrame, columns: list[str], method: str = "standard", fitted_on: DataFrame | None = None) -> DataFrame:
    if method not in ("standard", "minmax"):
        raise ValueError(f"Unknown scaling: {method}")
    return (scaling.standardise if method == "standard" else scaling.min_max)(df, columns, fitted_on)
