"""Feature families behind one fit / transform contract, saved as tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.operators.heavy import Heavy
from tallyward.operators.history import deviation, user_stats
from tallyward.operators.merchants import merchant_features, merchant_stats
from tallyward.operators.velocity import DEFAULT_WINDOWS, require, velocity, velocity_names

FAMILIES = ("velocity", "deviation", "merchant")


class FraudFeatures:
    """Velocity, deviation and merchant features of each transaction.

    ``fit`` learns small tables (user and merchant statistics, global moments);
    ``transform`` joins them back.  Keys not seen in ``fit`` fall back to the
    global statistics.
    """

    def __init__(
        self,
        user_col: str = "user_id",
        merchant_col: str = "merchant_id",
        datetime_col: str = "timestamp",
        amount_col: str = "amount",
        id_col: str = "transaction_id",
        label_col: str = "is_fraud",
        windows: Sequence[tuple[int, str]] = tuple(DEFAULT_WINDOWS),
        velocity_features: Sequence[str] = ("count", "sum", "mean"),
        deviation_features: Sequence[str] | None = None,
        window_size: int = 30,
        min_transactions: int = 3,
        alpha: float = 1.0,
        beta: float = 1.0,
        global_rate_weight: float = 0.5,
        include: Sequence[str] = FAMILIES,
        ties: str = "peers",
    ):
        unknown = set(include) - set(FAMILIES)
        if unknown:
            raise ValueError(f"Unknown feature families: {sorted(unknown)}")
        self.params = {
            "user_col": user_col, "merchant_col": merchant_col, "datetime_col": datetime_col,
            "amount_col": amount_col, "id_col": id_col, "label_col": label_col,
            "windows": [list(w) for w in windows], "velocity_features": list(velocity_features),
            "deviation_features": list(deviation_features or [amount_col]), "window_size": window_size,
            "min_transactions": min_transactions, "alpha": alpha, "beta": beta,
            "global_rate_weight": global_rate_weight, "include": list(include), "ties": ties,
        }

    def fit(self, df: DataFrame) -> FraudFeaturesModel:
        p = self.params
        require(df, [p["id_col"]])
        tables: dict[str, DataFrame] = {}
        if "velocity" in p["include"]:
            require(df, [p["user_col"], p["datetime_col"], p["amount_col"]])
        if "deviation" in p["include"]:
            feats = p["deviation_features"]
            require(df, [p["user_col"], *feats])
            tables["users"] = user_stats(
                df, feats, p["user_col"], (p["datetime_col"], p["id_col"]), p["window_size"]
            )
            fields = []
            for f in feats:
                fields += [F.avg(f).alias(f"{f}_mean"), F.stddev_samp(f).alias(f"{f}_std")]
            tables["moments"] = df.agg(*fields)
        if "merchant" in p["include"]:
            if p["label_col"] not in df.columns:
                raise ValueError("labels are required for merchant features")
            require(df, [p["merchant_col"]])
            tables["merchants"] = merchant_stats(
                df, p["merchant_col"], p["label_col"], p["alpha"], p["beta"], p["global_rate_weight"]
            )
            tables["rate"] = df.agg(F.avg(p["label_col"]).alias("r"))
        return FraudFeaturesModel(p, tables)


class FraudFeaturesModel:
    def __init__(self, params: dict, tables: dict[str, DataFrame]):
        self.params = params
        self.tables = tables

    def feature_names(self) -> list[str]:
        p = self.params
        names: list[str] = []
        if "velocity" in p["include"]:
            names += velocity_names([tuple(w) for w in p["windows"]], p["velocity_features"])
        if "deviation" in p["include"]:
            names += [f"deviation_{f}_{k}" for f in p["deviation_features"] for k in ("zscore", "ratio")]
        if "merchant" in p["include"]:
            names += ["merchant_fraud_rate", "merchant_fraud_count", "merchant_total_count"]
        return names

    def transform(self, df: DataFrame, rule: Heavy = Heavy()) -> DataFrame:
        """``df`` plus the features, row by row identity, not by position."""
        p = self.params
        out = df
        if "merchant" in p["include"]:
            out = merchant_features(
                out, self.tables["merchants"], self.tables["rate"].scalar(), p["merchant_col"]
            )
        if "deviation" in p["include"]:
            feats = p["deviation_features"]
            names = [f"{f}_{s}" for f in feats for s in ("mean", "std")]
            moments = self.tables["moments"].select(F.struct(*names).alias("s")).scalar()
            out = deviation(out, self.tables["users"], moments, feats, p["user_col"], p["min_transactions"])
        if "velocity" in p["include"]:
            out = velocity(
                out, p["user_col"], p["datetime_col"], p["amount_col"], p["id_col"],
                [tuple(w) for w in p["windows"]], p["velocity_features"], p["ties"], rule=rule, keep=out.columns,
            )
        return out.select(*df.columns, *self.feature_names())

    def save(self, path: str) -> None:
        """Learned tables as Parquet; parameters as one JSON row."""
        spark = next(iter(self.tables.values())).sparkSession if self.tables else SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(self.params, sort_keys=True),)], "params string").coalesce(1).write.mode(
            "overwrite"
        ).json(f"{path}/params")
        for name, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")


def load_features(spark: SparkSession, path: str) -> FraudFeaturesModel:
    params = json.loads(spark.read.schema("params string").json(f"{path}/params").first()[0])
    names = []
    if "deviation" in params["include"]:
        names += ["users", "moments"]
    if "merchant" in params["include"]:
        names += ["merchants", "rate"]
    return FraudFeaturesModel(params, {n: spark.read.parquet(f"{path}/{n}") for n in names})
