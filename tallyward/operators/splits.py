"""Splits and folds from hash draws: repeatable, no shuffle unless exact sizes are asked for.

Each random step draws from a stream of its own name, so chained steps are independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.hashing import hash_unit
from tallyward.operators.ordering import ordinals, running_totals


def three_way(key: Column, test: float = 0.2, validation: float = 0.1, seed: int | str = 42) -> Column:
    """``test``, ``validation`` or ``train``; both sizes are fractions of the whole."""
    h = hash_unit(key, f"split:{seed}")
    return F.when(h < test, "test").when(h < test + validation, "validation").otherwise("train")


def class_split(
    df: DataFrame, key: str, label: str, test: float = 0.2, validation: float = 0.1, seed: int | str = 42,
    train_class: int | None = 0,
) -> DataFrame:
    """Add ``split``; the train part keeps only ``train_class`` (None keeps both).

    One draw per row is stratified in expectation: each class gets the same shares.
    """
    out = df.withColumn("split", three_way(F.col(key), test, validation, seed))
    if train_class is None:
        return out
    return out.where((F.col("split") != "train") | (F.col(label) == train_class))


def exact_class_split(
    df: DataFrame, key: str, label: str, test: float = 0.2, validation: float = 0.1, seed: int | str = 42
) -> DataFrame:
    """Add ``split`` with exact sizes per class: rows are ranked by their draw within the class.

    ``key`` must be numeric.  The ranking is split by draw, so a class may hold
    nearly all rows.
    """
    drawn = df.withColumn("__h", hash_unit(F.col(key), f"exact_split:{seed}"))
    ranked = ordinals(drawn, "__h", key, by=[label], out="__o")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    n, o = F.col("__n"), F.col("__o")
    split = (
        F.when(o < F.round(n * test), "test")
        .when(o < F.round(n * test) + F.round(n * validation), "validation")
        .otherwise("train")
    )
    return ranked.join(sizes, label).withColumn("split", split).select(*df.columns, "split")


def hold_out(df: DataFrame, key: str, test: float = 0.2, seed: int | str = 42) -> DataFrame:
    return df.withColumn("split", F.when(hash_unit(F.col(key), f"hold_out:{seed}") < test, "test").otherwise("train"))


def fold_of(key: Column, k: int = 5, stream: int | str = "folds:42") -> Column:
    """Fold number from a hash draw; with a per-class stream this is stratified."""
    return F.floor(hash_unit(key, stream) * F.lit(float(k))).cast("int")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int | str = 42) -> DataFrame:
    """Add ``fold``: rows of each class are dealt to folds in draw order, so class counts differ by at most 1."""
    drawn = df.withColumn("__h", hash_unit(F.col(key), f"stratified_folds:{seed}"))
    ranked = ordinals(drawn, "__h", key, by=[label], out="__o")
    return ranked.withColumn("fold", (F.col("__o") % k).cast("int")).select(*df.columns, "fold")


def ordered_split(
    df: DataFrame, datetime_col: str, key: str, train: float = 0.7, validation: float = 0.15,
    order: str = "time", user_col: str = "user_id",
) -> DataFrame:
    """Add ``split`` by position, boundaries rounded down.

    ``time`` cuts the whole table by time; ``user_time`` orders by user first, so
    it separates users.
    """
    rows = df.withColumn("__us", F.unix_micros(F.col(datetime_col)))
    if order == "time":
        ranked = ordinals(rows, "__us", key, out="__o")
    elif order == "user_time":
        inside = ordinals(rows, "__us", key, by=[user_col], out="__i")
        sizes = df.groupBy(user_col).agg(F.count(F.lit(1)).alias("__n"))
        before = running_totals(sizes, user_col, {"__upto": F.col("__n")})
        ranked = inside.join(before, user_col).withColumn("__o", F.col("__i") + F.col("__upto") - F.col("__n"))
    else:
        raise ValueError(f"Unknown order: {order}")
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    first, second = F.floor(total * F.lit(train)), F.floor(total * F.lit(train + validation))
    split = F.when(F.col("__o") < first, "train").when(F.col("__o") < second, "validation").otherwise("test")
    return ranked.withColumn("split", split).select(*df.columns, "split")


def undersample(
    df: DataFrame, key: str, label: str, ratio: float = 0.1, seed: int | str = 42, exact: bool = False
) -> DataFrame:
    """Keep the minority and about (or exactly) minority / ratio majority rows."""
    counts = df.agg(
        F.struct(F.count_if(F.col(label) == 1).alias("n1"), F.count_if(F.col(label) == 0).alias("n0")).alias("c")
    ).scalar()
    rare, common = df.where(F.col(label) == 1), df.where(F.col(label) == 0)
    drawn = common.withColumn("__h", hash_unit(F.col(key), f"undersample:{seed}")).withColumn("__c", counts)
    if exact:
        wanted = F.floor(F.col("__c.n1") / F.lit(ratio))
        ranked = ordinals(drawn.drop("__c"), "__h", key, out="__o").withColumn("__c", counts)
        kept = ranked.where(F.col("__o") < wanted)
    else:
        kept = drawn.where(F.col("__h") < F.try_divide(F.col("__c.n1") / F.lit(ratio), F.col("__c.n0")))
    return rare.unionByName(kept.select(*df.columns))
