"""Scaling fitted on one table and applied to another, and PCA."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def standardise(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Subtract the mean, divide by the population std; a zero std divides by 1."""
    fields = []
    for c in columns:
        fields += [F.avg(c).alias(f"{c}_m"), F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias(f"{c}_s")]
    fit = (fitted_on if fitted_on is not None else df).agg(F.struct(*fields).alias("f")).scalar()
    return df.withColumn("__f", fit).withColumns(
        {c: (F.col(c) - F.col(f"__f.{c}_m")) / F.col(f"__f.{c}_s") for c in columns}
    ).drop("__f")


def min_max(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Scale to [0, 1] by the fitted range; a zero range gives 0."""
    from tallyward.operators.ensemble import scaled

    return scaled(df, columns, fitted_on=fitted_on)


def principal_components(df: DataFrame, columns: Sequence[str], row: str, n: int = 2, keep: Sequence[str] = ()) -> tuple[DataFrame, list[float]]:
    """Project standardised rows on ``n`` components; also the explained variance in percent.

    Rows with nulls are removed.  The sign of a component is fixed so that its
    largest loading is positive.
    """
    n = max(2, n)
    clean = df.na.drop(subset=list(columns))
    ready = VectorAssembler(inputCols=list(columns), outputCol="__x").transform(standardise(clean, columns))
    model = PCA(k=n, inputCol="__x", outputCol="__p").fit(ready)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, i]).argmax(), i] > 0 else -1.0 for i in range(n)]
    out = model.transform(ready).withColumn("__a", vector_to_array("__p")).select(
        row, *keep, *[(F.col("__a")[i] * signs[i]).alias(f"pc{i + 1}") for i in range(n)]
    )
    return out, [float(v) * 100.0 for v in model.explainedVariance.toArray()]
