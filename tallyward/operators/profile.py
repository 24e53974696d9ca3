"""Exploration tables: summaries, histograms, correlations, rates by group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.columns import AMOUNT_EDGES, right_closed_bin
from tallyward.functions.hashing import hash_unit
from tallyward.operators.ordering import exact_quantiles


def money_sum(amount: Column) -> Column:
    """Exact money total to six places, independent of the order of addition."""
    return F.coalesce(F.sum(amount.cast("decimal(28,6)")).cast("double"), F.lit(0.0))


def summary(df: DataFrame, label: str, amount: str, n_features: int) -> DataFrame:
    """Headline figures in one pass; averages of an empty class are 0."""
    lab, amt = F.col(label), F.col(amount)
    n, fraud, legit = F.count(F.lit(1)), F.count_if(lab == 1), F.count_if(lab == 0)

    def mean(condition: Column) -> Column:
        total = F.sum(F.when(condition, amt.cast("decimal(28,6)"))).cast("double")
        return F.coalesce(F.try_divide(total, F.count_if(condition & amt.isNotNull())), F.lit(0.0))

    return df.agg(
        n.alias("total"), fraud.alias("fraud"), legit.alias("legitimate"),
        F.coalesce(F.round(F.try_divide(fraud * 100.0, n), 2), F.lit(0.0)).alias("fraud_percent"),
        money_sum(amt).alias("total_amount"), mean(F.lit(True)).alias("avg_amount"),
        mean(lab == 1).alias("avg_fraud_amount"), mean(lab == 0).alias("avg_legitimate_amount"),
        F.lit(n_features).alias("features"),
    )


def range_summary(df: DataFrame, label: str, amount: str, n_features: int, low: float, high: float) -> DataFrame:
    return summary(df.where(F.col(amount).between(low, high)), label, amount, n_features)


def histogram(df: DataFrame, value: str, by: Sequence[str], bins: int = 50, log: bool = False) -> DataFrame:
    """(by..., bin, low, high, count) over equal-width bins between the global min and max."""
    v = F.log1p(F.col(value)) if log else F.col(value).cast("double")
    rows = df.select(*by, v.alias("__v")).where(F.col("__v").isNotNull())
    edges = rows.agg(F.struct(F.min("__v").alias("lo"), F.max("__v").alias("hi")).alias("e")).scalar()
    width = (F.col("__e.hi") - F.col("__e.lo")) / F.lit(float(bins))
    slot = F.least(
        F.coalesce(F.floor(F.try_divide(F.col("__v") - F.col("__e.lo"), width)), F.lit(0)), F.lit(bins - 1)
    ).cast("int")
    return (
        rows.withColumn("__e", edges)
        .groupBy(*by, slot.alias("bin"), F.col("__e.lo").alias("__lo"), width.alias("__w"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            *by, "bin", (F.col("__lo") + F.col("bin") * F.col("__w")).alias("low"),
            (F.col("__lo") + (F.col("bin") + 1) * F.col("__w")).alias("high"), "count",
        )
    )


def pair_corr(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are present; null if either is constant.

    ``F.corr`` divides by zero for a constant column under ANSI rules.
    """
    x = F.when(F.col(b).isNotNull(), F.col(a).cast("double"))
    y = F.when(F.col(a).isNotNull(), F.col(b).cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every ordered pair; nulls are dropped pair by pair.

    Each task multiplies its batches as matrices and hands on four sums per pair;
    columns are centred first so that the sums keep their precision.
    """
    means = df.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).alias("m")).scalar()
    centred = df.withColumn("__m", means).select(
        *[(F.col(c).cast("double") - F.col(f"__m.m{i}")).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    sums = centred.mapInArrow(_pair_sums(len(columns)), "i int, j int, n double, sx double, sxx double, sxy double")
    pair = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sxx", "sxy")])
    other = pair.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("sx").alias("sy"), F.col("sxx").alias("syy"))
    n = F.col("n")
    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    vx = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), n)
    vy = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n)
    # rounding can leave a trace of variance in a constant column
    solid = (vx > 1e-12 * F.col("sxx")) & (vy > 1e-12 * F.col("syy"))
    corr = F.when(F.col("i") == F.col("j"), F.lit(1.0)).when(solid, cov / F.sqrt(vx * vy))
    names = F.array(*[F.lit(c) for c in columns])
    # columns x columns rows
    return pair.join(other, ["i", "j"]).select(
        F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), corr.alias("corr")
    )


def _pair_sums(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, k, k))
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns])
            seen = ~np.isnan(x)
            x, seen = np.where(seen, x, 0.0), seen.astype(float)
            total += np.stack([seen.T @ seen, x.T @ seen, (x * x).T @ seen, x.T @ x])
        i, j = np.indices((k, k)).reshape(2, -1).astype("int32")
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(j), *[pa.array(t.ravel()) for t in total]], names=["i", "j", "n", "sx", "sxx", "sxy"]
        )

    return run


def label_correlations(df: DataFrame, columns: Sequence[str], label: str, top_n: int = 10) -> DataFrame:
    once = df.agg(*[pair_corr(c, label).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in columns])
    return once.select(F.inline(rows)).orderBy(F.col("corr").desc_nulls_last(), "feature").limit(top_n)


def rates_by(df: DataFrame, group: Column, name: str, label: str) -> DataFrame:
    """(name, total, fraud, fraud_rate percent) per group."""
    fraud = F.count_if(F.col(label) == 1)
    return df.groupBy(group.alias(name)).agg(
        F.count(F.lit(1)).alias("total"), fraud.alias("fraud"),
        (F.try_divide(fraud * 100.0, F.count(F.lit(1)))).alias("fraud_rate"),
    )


def rates_by_amount(df: DataFrame, amount: str, label: str) -> DataFrame:
    return rates_by(df, right_closed_bin(F.col(amount), AMOUNT_EDGES), "bin", label)


def amount_by_class(df: DataFrame, amount: str, label: str) -> DataFrame:
    """(label, median, max, mean): the median is exact and not computed in one buffer."""
    basic = df.groupBy(label).agg(F.max(amount).alias("max"), F.avg(amount).alias("mean"))
    median = exact_quantiles(df, [amount], [0.5], by=[label]).select(label, F.col("value").alias("median"))
    return basic.join(median, label, "left").select(label, "median", "max", "mean")


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by hash order of the key: repeatable, top-k per partition."""
    return df.withColumn("__h", hash_unit(F.col(key), f"sample:{seed}")).orderBy("__h", key).limit(n).drop("__h")


def sample_share(df: DataFrame, share: float, key: str, seed: int = 42) -> DataFrame:
    """About ``share`` of the rows by a hash filter: no shuffle."""
    return df.where(hash_unit(F.col(key), f"sample_share:{seed}") < share)
