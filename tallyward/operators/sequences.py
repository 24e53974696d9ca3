"""Per-user transaction sequences for sequence scoring.

A heavy user's rows are cut into time chunks.  Each chunk borrows the rows just
before it, so every window is complete and no task holds all rows of a user.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.heavy import Heavy, chunk_of, split_heavy
from tallyward.operators.history import last_n
from tallyward.operators.velocity import UNIT_US


def _step(cols: Sequence[str]):
    return F.array(*[F.col(c).cast("double") for c in cols])


def user_sequences(
    df: DataFrame, max_length: int, features: Sequence[str], min_length: int = 3,
    user_col: str = "user_id", datetime_col: str = "timestamp", id_col: str = "transaction_id",
    label_col: str = "is_fraud", rule: Heavy = Heavy(), chunk_us: int = UNIT_US["h"],
) -> DataFrame:
    """(id, user, label, length, sequence) for every row with enough predecessors.

    ``sequence`` has ``max_length`` steps, padded with zeros on the left;
    ``length`` counts the real steps.  Users with fewer than ``min_length`` rows
    give no sequence.
    """
    rows = df.where(F.col(user_col).isNotNull() & F.col(datetime_col).isNotNull()).select(
        F.col(id_col).alias("__id"), F.col(user_col).alias("__u"), F.unix_micros(datetime_col).alias("__us"),
        F.col(label_col).alias("__label"), _step(features).alias("__step"),
    )
    light, heavy = split_heavy(rows, ["__u"], rule)
    order = ["__us", "__id"]

    def windowed(part: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(max_length - 1), 0)
        return part.withColumn("__seq", F.collect_list("__step").over(w)).where(F.size("__seq") >= min_length)

    # heavy users: the last rows of every chunk, and for each chunk the ones before it
    chunked = heavy.withColumn("__chunk", chunk_of(F.col("__us"), chunk_us))
    recent = Window.partitionBy("__u", "__chunk").orderBy(*[F.col(c).desc() for c in order])
    tails = chunked.withColumn("__rn", F.row_number().over(recent)).where(F.col("__rn") <= max_length)
    along = Window.partitionBy("__u").orderBy(*order)
    item = F.struct("__id", "__us", "__label", "__step")
    lent = (
        tails.withColumn("__prev", F.lag("__chunk").over(along))
        .withColumn("__before", F.collect_list(item).over(along.rowsBetween(-(max_length - 1), -1)))
        .where(F.col("__prev").isNotNull() & (F.col("__prev") != F.col("__chunk")))
        .select("__u", "__chunk", F.inline("__before"))
        .withColumn("__lent", F.lit(True))
    )
    split = windowed(chunked.withColumn("__lent", F.lit(False)).unionByName(lent), ["__u", "__chunk"]).where(~F.col("__lent"))
    cols = ["__id", "__u", "__label", "__seq"]
    seqs = windowed(light, ["__u"]).select(*cols).unionByName(split.select(*cols))
    zero = F.array_repeat(F.array(*[F.lit(0.0)] * len(features)), max_length - F.size("__seq"))
    return seqs.select(
        F.col("__id").alias(id_col), F.col("__u").alias(user_col), F.col("__label").alias("label"),
        F.size("__seq").alias("length"), F.concat(zero, F.col("__seq")).alias("sequence"),
    )


def latest_sequences(
    df: DataFrame, max_length: int, features: Sequence[str], min_length: int = 3,
    user_col: str = "user_id", datetime_col: str = "timestamp", id_col: str = "transaction_id",
) -> DataFrame:
    """(user, id, length, sequence): the sequence that ends in each user's last row.

    Only the last rows per user are shuffled.
    """
    recent = last_n(df, user_col, [datetime_col, id_col], max_length)
    item = F.struct(F.unix_micros(datetime_col).alias("us"), F.col(id_col).alias("id"), _step(features).alias("step"))
    lists = recent.groupBy(user_col).agg(F.array_sort(F.collect_list(item)).alias("__l"))
    length = F.size("__l")
    zero = F.array_repeat(F.array(*[F.lit(0.0)] * len(features)), max_length - length)
    return lists.where(length >= min_length).select(
        user_col, F.element_at("__l", -1)["id"].alias(id_col), length.alias("length"),
        F.concat(zero, F.transform("__l", lambda x: x["step"])).alias("sequence"),
    )


def last_step(seqs: DataFrame, sequence: str = "sequence") -> DataFrame:
    """Replace each sequence by its last step (single-row baseline input)."""
    return seqs.withColumn("features", F.element_at(sequence, -1)).drop(sequence)


def step_moments(seqs: DataFrame, sequence: str = "sequence") -> DataFrame:
    """(dim, mean, std) over all steps, padding included; population std, 0 becomes 1."""
    steps = seqs.select(F.explode(sequence).alias("step")).select(F.posexplode("step").alias("dim", "v"))
    return steps.groupBy("dim").agg(
        F.avg("v").alias("mean"), F.coalesce(F.nullif(F.stddev_pop("v"), F.lit(0.0)), F.lit(1.0)).alias("std")
    )


def standardise_sequences(seqs: DataFrame, moments: DataFrame, sequence: str = "sequence") -> DataFrame:
    """Scale every step with moments fitted elsewhere (one row per feature, so a scalar subquery)."""
    packed = moments.agg(F.array_sort(F.collect_list(F.struct("dim", "mean", "std"))).alias("m")).scalar()
    return (
        seqs.withColumn("__m", packed)
        .withColumn(
            sequence,
            F.transform(
                sequence, lambda s: F.zip_with(s, F.col("__m"), lambda v, m: (v - m["mean"]) / m["std"])
            ),
        )
        .drop("__m")
    )
