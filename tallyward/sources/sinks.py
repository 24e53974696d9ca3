"""Writing splits, failure cases and metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One folder per split, so that reading a split prunes the others."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def load_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split_col) == split)


def export_failures(df: DataFrame, path: str, fmt: str = "csv") -> None:
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"Unsupported format: {fmt}")
    df.write.mode("overwrite").option("header", True).format(fmt).save(path)


def save_metrics(df: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """Append a metric table under its run id."""
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError(f"Unsupported format: {fmt}")
    writer = df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id")
    writer.option("header", True).format(fmt).save(path)
