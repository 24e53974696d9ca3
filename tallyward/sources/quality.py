"""Data-quality rules: each check is one aggregate pass or one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators.ordering import exact_quantiles
from tallyward.sources.readers import CARD_COLUMNS

# Required fields of a scoring request.
REQUIRED_FIELDS = ["transaction_id", "user_id", "merchant_id", "amount", "timestamp"]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def value_rules(df: DataFrame, label: str, amount: str) -> DataFrame:
    """One row of violation counts for the label and amount rules."""
    lab, amt = F.col(label), F.col(amount)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(lab.isNull()).alias("label_null"),
        F.count_if(amt.isNull()).alias("amount_null"),
        F.count_if(~lab.isin(0, 1)).alias("label_not_binary"),
    )


def validate_card(df: DataFrame, required: Sequence[str] = tuple(CARD_COLUMNS)) -> list[str]:
    """Messages for every broken rule; an empty list means valid."""
    missing = missing_columns(df, required)
    if missing:
        return [f"missing columns: {missing}"]
    problems = [
        f"{c} is not numeric" for c in ("Class", "Amount") if not isinstance(df.schema[c].dataType, T.NumericType)
    ]
    if problems:
        return problems
    found = value_rules(df, "Class", "Amount").first()
    names = {"label_null": "Class has nulls", "amount_null": "Amount has nulls", "label_not_binary": "Class not in {0,1}"}
    return [text for key, text in names.items() if found[key]]


def request_rules(df: DataFrame, strict_amount: bool = False) -> list[tuple[str, Column]]:
    """(reason, violated) pairs for the columns that exist."""
    rules: list[tuple[str, Column]] = []
    for name in ("transaction_id", "user_id", "merchant_id"):
        if name in df.columns:
            rules.append((f"{name}_missing", F.col(name).isNull()))
    if "amount" in df.columns:
        bad = F.col("amount") <= 0 if strict_amount else F.col("amount") < 0
        rules.append(("amount_out_of_range", F.col("amount").isNull() | bad))
    if "merchant_risk" in df.columns:
        rules.append(("merchant_risk_out_of_range", ~F.col("merchant_risk").between(0.0, 1.0)))
    for name in ("velocity_1h", "distance_from_home"):
        if name in df.columns:
            rules.append((f"{name}_negative", F.col(name) < 0))
    return rules


def quarantine(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add ``reasons`` (array of broken rules) and ``valid``; nothing is dropped."""
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))
    return df.withColumn("reasons", broken).withColumn("valid", F.size("reasons") == 0)


def required_fields(df: DataFrame, fields: Sequence[str] = tuple(REQUIRED_FIELDS)) -> DataFrame:
    """Quarantine rows without a required field; a missing column is an error."""
    missing = missing_columns(df, fields)
    if missing:
        raise ValueError(f"Missing required fields: {missing}")
    return quarantine(df, [(f"{f}_missing", F.col(f).isNull()) for f in fields])


def profile(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """(column, type, rows, nulls, any_missing), from one pass over the table."""
    kinds = dict(df.dtypes) | dict(types or {})
    once = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(f"__n_{c}") for c in df.columns]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col("__rows").alias("rows"),
                F.col(f"__n_{c}").alias("nulls"), (F.col(f"__n_{c}") > 0).alias("any_missing"),
            )
            for c in df.columns
        ]
    )
    return once.select(F.inline(rows))


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max); quartiles are exact."""
    stats = []
    for c in columns:
        v = F.col(c).cast("double")
        stats += [
            F.struct(
                F.lit(c).alias("column"), F.count(v).alias("count"), F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
            ).alias(c)
        ]
    basic = df.agg(*stats).select(F.inline(F.array(*[F.col(c) for c in columns])))
    quart = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    wide = quart.groupBy("column").agg(
        *[F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for s, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    )
    return basic.join(wide, "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def drop_nulls_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """(kept, dropped) in one pass."""
    any_null = None
    for c in subset or df.columns:
        any_null = F.col(c).isNull() if any_null is None else any_null | F.col(c).isNull()
    return df.agg(F.count_if(~any_null).alias("kept"), F.count_if(any_null).alias("dropped"))


def width_check(df: DataFrame, features: str, names: Sequence[str]) -> DataFrame:
    """Counts of vectors whose length differs from the number of feature names."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size(features) != F.lit(len(names))).alias("wrong_width"),
    )
