"""Detectors as Spark ML stages: fit, save, load and use inside a ``Pipeline``.

``IsolationForestDetector`` is an ``Estimator`` whose model keeps its trees as a
table of nodes (at most trees x 2 x sample rows, whatever the data size) and saves
them as Parquet beside the stage's parameters.  ``ShareThreshold`` learns the
score above which the expected share of rows lies and gives a ``ThresholdModel``
stage that marks them.  All stages write and read with Spark ML's own formats, so a
fitted pipeline can be saved by one job and scored by another.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsReadable, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.detectors import IsolationForest, average_path, fit_isolation_forest
from tallyward.operators.curves import share_threshold


class _Columns(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "array column of features", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "row key, used to draw tree samples", TypeConverters.toString)
    scoreCol = Param(Params._dummy(), "scoreCol", "output score column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", idCol="row_id", scoreCol="score")


class _ForestParams(_Columns):
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    sample = Param(Params._dummy(), "sample", "rows drawn per tree", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(trees=100, sample=256, seed=42)


class IsolationForestDetector(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits an isolation forest on the rows given (normal rows, as the reference trains)."""

    @keyword_only
    def __init__(self, *, featuresCol="features", idCol="row_id", scoreCol="score", trees=100, sample=256, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> IsolationForestModel:
        g = self.getOrDefault
        forest = fit_isolation_forest(dataset, g(self.idCol), g(self.featuresCol), g(self.trees), g(self.sample), g(self.seed))
        model = IsolationForestModel(_nodes(forest), forest.sample)
        return self._copyValues(model)


def _nodes(forest: IsolationForest) -> pd.DataFrame:
    parts = [pd.DataFrame({"tree": t, "node": np.arange(len(a["feature"])), **a}) for t, a in enumerate(forest.trees)]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=["tree", "node", "feature", "cut", "low", "high", "rest"])


class IsolationForestModel(Model, _ForestParams, MLReadable, MLWritable):
    """Scores rows by mean path length; 1 is most anomalous."""

    def __init__(self, nodes: pd.DataFrame | None = None, sample: int = 256):
        super().__init__()
        self.nodes = nodes if nodes is not None else pd.DataFrame()
        self.sample_size = sample

    def forest(self) -> IsolationForest:
        trees = []
        for _, part in self.nodes.sort_values(["tree", "node"]).groupby("tree"):
            trees.append({c: part[c].to_numpy() for c in ("feature", "cut", "low", "high", "rest")})
        return IsolationForest(trees, self.sample_size)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.forest().score(dataset, self.getOrDefault(self.featuresCol), self.getOrDefault(self.scoreCol))

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader(cls)


class _ForestWriter(MLWriter):
    def __init__(self, instance: IsolationForestModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"sample": self.instance.sample_size})
        nodes = self.instance.nodes.astype({"tree": "int64", "node": "int64", "feature": "int64", "low": "int64", "high": "int64"})
        self.sparkSession.createDataFrame(nodes).coalesce(1).write.parquet(f"{path}/nodes")


class _ForestReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> IsolationForestModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        nodes = self.sparkSession.read.parquet(f"{path}/nodes").toPandas()  # bounded: trees x 2 x sample rows
        model = self.cls(nodes, int(meta["sample"]))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class _ThresholdParams(Params):
    scoreCol = Param(Params._dummy(), "scoreCol", "score column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "0/1 output column", TypeConverters.toString)
    contamination = Param(Params._dummy(), "contamination", "expected share of anomalies", TypeConverters.toFloat)
    threshold = Param(Params._dummy(), "threshold", "scores at or above are anomalies", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(scoreCol="score", predictionCol="predicted", contamination=0.01)


class ShareThreshold(Estimator, _ThresholdParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the threshold above which ``contamination`` of the fitted rows' scores lie."""

    @keyword_only
    def __init__(self, *, scoreCol="score", predictionCol="predicted", contamination=0.01):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ThresholdModel:
        g = self.getOrDefault
        cut = share_threshold(dataset, g(self.scoreCol), g(self.contamination)).first()["threshold"]
        model = ThresholdModel()
        model._set(threshold=float(cut) if cut is not None else float("inf"))
        return self._copyValues(model)


class ThresholdModel(Model, _ThresholdParams, DefaultParamsReadable, DefaultParamsWritable):
    """Marks rows whose score is at or above the threshold (null score: null)."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        g = self.getOrDefault
        return dataset.withColumn(g(self.predictionCol), (F.col(g(self.scoreCol)) >= F.lit(g(self.threshold))).cast("int"))


__all__ = ["IsolationForestDetector", "IsolationForestModel", "ShareThreshold", "ThresholdModel", "average_path"]
