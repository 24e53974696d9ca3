"""Anomaly detectors: fit on normal rows, score every row, higher is more anomalous."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.curves import share_threshold
from tallyward.operators.gradient import partition_sums
from tallyward.operators.neighbours import local_outlier_factor
from tallyward.session import settle

EULER_GAMMA = 0.5772156649
NODES = "tree int, node int, feature int, cut double, low int, high int, size int"


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER_GAMMA) - 2.0 * (n - 1) / n


def _grow(seed: int, limit: int):
    """Grow one isolation tree from its (bounded) sample."""

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf.sort_values("id")["f"].to_numpy())
        rng = np.random.default_rng([seed, tree])
        nodes: list[list] = []
        todo = [(np.arange(len(x)), 0, None)]
        while todo:
            idx, depth, parent = todo.pop()
            me = len(nodes)
            nodes.append([tree, me, -1, 0.0, -1, -1, len(idx)])
            if parent is not None:
                nodes[parent[0]][parent[1]] = me
            part = x[idx]
            spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0))
            if depth >= limit or len(idx) <= 1 or not len(spread):
                continue
            f = int(rng.choice(spread))
            cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
            below = part[:, f] < cut
            nodes[me][2], nodes[me][3] = f, cut
            todo += [(idx[~below], depth + 1, (me, 5)), (idx[below], depth + 1, (me, 4))]
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "low", "high", "size"])

    return grow


@dataclass
class IsolationForest:
    """Trees as flat arrays: at most trees * 2 * sample nodes, whatever the size of the data."""

    trees: list[dict[str, np.ndarray]]
    sample: int

    def score(self, df: DataFrame, features: str = "features", out: str = "score") -> DataFrame:
        trees, norm = self.trees, average_path(self.sample) or 1.0

        @F.pandas_udf("double")
        def path_score(col: pd.Series) -> pd.Series:
            x = np.stack(col.to_numpy()) if len(col) else np.zeros((0, 1))
            total = np.zeros(len(x))
            for t in trees:
                at = np.zeros(len(x), dtype=int)
                depth = np.zeros(len(x))
                while True:
                    inner = t["feature"][at] >= 0
                    if not inner.any():
                        break
                    here = at[inner]
                    go_low = x[inner, t["feature"][here]] < t["cut"][here]
                    at[inner] = np.where(go_low, t["low"][here], t["high"][here])
                    depth[inner] += 1
                total += depth + t["rest"][at]
            return pd.Series(2.0 ** (-(total / max(len(trees), 1)) / norm))

        return df.withColumn(out, path_score(F.col(features)))


def fit_isolation_forest(
    df: DataFrame, key: str, features: str = "features", trees: int = 100, sample: int = 256, seed: int = 42
) -> IsolationForest:
    """Each tree gets ``sample`` rows by hash order and is grown in its own task."""
    n = df.count()
    size = min(sample, n)
    share = min(1.0, 2.0 * size / max(n, 1))

    def draw(tree: Column) -> Column:
        return F.pmod(F.xxhash64(F.col(key), tree, F.lit(seed)), F.lit(1 << 31)) / F.lit(float(1 << 31))

    # a row is only copied to the trees that may use it: twice the sample on average
    offered = df.select(
        F.col(key).alias("id"), F.col(features).alias("f"), key,
        F.explode(F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < share)).alias("tree"),
    ).withColumn("h", draw(F.col("tree")))
    w = Window.partitionBy("tree").orderBy("h", "id")
    chosen = offered.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= size).select("tree", "id", "f")
    limit = math.ceil(math.log2(max(size, 2)))
    grown = chosen.groupBy("tree").applyInPandas(_grow(seed, limit), NODES).toPandas()
    flat = []
    for _, part in grown.sort_values(["tree", "node"]).groupby("tree"):
        rest = np.where(part["feature"] < 0, [average_path(s) for s in part["size"]], 0.0)
        flat.append({c: part[c].to_numpy() for c in ("feature", "cut", "low", "high")} | {"rest": rest})
    return IsolationForest(flat, size)


@dataclass
class OneClassBoundary:
    """Random Fourier features of an RBF kernel with a linear one-class boundary."""

    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    rho: float

    def score(self, df: DataFrame, features: str = "features", out: str = "score") -> DataFrame:
        d, p, w, rho = self.directions, self.phases, self.weights, self.rho

        @F.pandas_udf("double")
        def distance(col: pd.Series) -> pd.Series:
            x = np.stack(col.to_numpy()) if len(col) else np.zeros((0, len(d)))
            return pd.Series(rho - _fourier(x, d, p) @ w)

        return df.withColumn(out, distance(F.col(features)))


def _fourier(x: np.ndarray, directions: np.ndarray, phases: np.ndarray) -> np.ndarray:
    return np.sqrt(2.0 / len(phases)) * np.cos(x @ directions + phases)


def fit_one_class(
    df: DataFrame, width: int, features: str = "features", nu: float = 0.1, gamma: float | None = None,
    components: int = 128, rounds: int = 60, step: float = 0.5, seed: int = 42,
) -> OneClassBoundary:
    """Distributed sub-gradient descent on the one-class objective.

    ``gamma=None`` takes 1 / (width * variance).  A round brings ``components + 1``
    numbers to the driver.
    """
    rows = settle(df.select(F.col(features).alias("x"), F.lit(0.0).alias("y")))
    n = max(rows.count(), 1)
    if gamma is None:
        both = partition_sums(rows, lambda x, y: np.array([x.sum(), (x**2).sum()]), 2) / (n * width)
        gamma = 1.0 / (width * max(both[1] - both[0] ** 2, 1e-12))
    rng = np.random.default_rng(seed)
    directions = rng.normal(0.0, math.sqrt(2.0 * gamma), (width, components))
    phases = rng.uniform(0.0, 2.0 * math.pi, components)
    mean = partition_sums(rows, lambda x, y: _fourier(x, directions, phases).sum(axis=0), components) / n
    w, rho = mean.copy(), 0.0
    for i in range(rounds):
        sums = partition_sums(rows, _one_class_sums(w.copy(), float(rho), directions, phases), components + 1) / n
        rate = step / (1.0 + i)
        w, rho = w - rate * (w - sums[:-1] / nu), rho - rate * (sums[-1] / nu - 1.0)
    return OneClassBoundary(directions, phases, w, float(rho))


def _one_class_sums(w: np.ndarray, rho: float, directions: np.ndarray, phases: np.ndarray):
    def sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = _fourier(x, directions, phases)
        outside = (z @ w < rho).astype(float)
        return np.append(outside @ z, outside.sum())

    return sums


def reconstruction_scorer(df: DataFrame, width: int, features: str = "features", latent: int = 16, out: str = "score"):
    """Mean squared reconstruction error of a linear autoencoder (standardise, PCA, rebuild).

    The components are orthonormal, so the error is what the projection misses;
    no rebuilt vector is materialised.
    """
    stats = df.select(F.posexplode(features).alias("dim", "v")).groupBy("dim").agg(
        F.avg("v").alias("m"), F.coalesce(F.nullif(F.stddev_pop("v"), F.lit(0.0)), F.lit(1.0)).alias("s")
    ).orderBy("dim").collect()  # one row per dimension
    means = F.array(*[F.lit(r["m"]) for r in stats])
    stds = F.array(*[F.lit(r["s"]) for r in stats])

    def scale(data: DataFrame) -> DataFrame:
        centred = F.zip_with(features, means, lambda a, m: a - m)
        return data.withColumn("__a", F.zip_with(centred, stds, lambda a, s: a / s)).withColumn(
            "__x", array_to_vector("__a")
        )

    model = PCA(k=min(latent, width), inputCol="__x", outputCol="__z").fit(scale(df))

    def norm2(c: Column) -> Column:
        return F.aggregate(c, F.lit(0.0), lambda s, v: s + v * v)

    def score(data: DataFrame) -> DataFrame:
        done = model.transform(scale(data))
        error = (norm2(F.col("__a")) - norm2(vector_to_array("__z"))) / F.lit(float(width))
        return done.withColumn(out, F.greatest(error, F.lit(0.0))).select(*data.columns, out)

    return score


class Detector:
    """``fit`` on normal rows, ``score`` any rows, ``set_threshold``, ``predict``.

    Kinds: ``isolation_forest``, ``outlier_factor``, ``one_class``, ``reconstruction``.
    """

    KINDS = ("isolation_forest", "outlier_factor", "one_class", "reconstruction")

    def __init__(self, kind: str, width: int, key: str = "row_id", features: str = "features", **options):
        if kind not in self.KINDS:
            raise ValueError(f"Unknown detector: {kind}")
        self.kind, self.width, self.key, self.features, self.options = kind, width, key, features, options
        self._score = None
        self.threshold: Column | float | None = None

    def fit(self, normal: DataFrame) -> Detector:
        k, f = self.key, self.features
        if self.kind == "isolation_forest":
            model = fit_isolation_forest(normal, k, f, **self.options)
            self._score = lambda df: model.score(df, f)
        elif self.kind == "one_class":
            boundary = fit_one_class(normal, self.width, f, **self.options)
            self._score = lambda df: boundary.score(df, f)
        elif self.kind == "reconstruction":
            self._score = reconstruction_scorer(normal, self.width, f, **self.options)
        else:
            reference = normal.select(k, f)

            def factor(df: DataFrame) -> DataFrame:
                return df.join(_factor_against(df, reference, k, f, **self.options), k)

            self._score = factor
        return self

    def score(self, df: DataFrame) -> DataFrame:
        if self._score is None:
            raise ValueError("fit the detector first")
        return self._score(df)

    def set_threshold(self, scored: DataFrame, contamination: float = 0.01) -> Detector:
        """Threshold from the expected share of anomalies among scored rows."""
        self.threshold = share_threshold(scored, "score", contamination).first()["threshold"]
        return self

    def predict(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        cut = threshold if threshold is not None else self.threshold
        if cut is None:
            raise ValueError("no threshold set")
        return self.score(df).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def _factor_against(df: DataFrame, reference: DataFrame, key: str, features: str, neighbours: int = 20) -> DataFrame:
    """Outlier factor of ``df`` rows against a fitted reference."""
    both = df.select(key, features).join(reference.select(key, F.lit(0).alias("__l")), key, "left")
    both = both.withColumn("__l", F.coalesce("__l", F.lit(1)))
    extra = reference.join(df.select(key), key, "left_anti").select(key, features, F.lit(0).alias("__l"))
    scored = local_outlier_factor(both.unionByName(extra), "__l", neighbours, key, features)
    return scored.withColumnRenamed("row_id", key)
