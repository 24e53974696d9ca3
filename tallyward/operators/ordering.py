"""Running totals, ranks and exact quantiles that no single task has to hold.

A plain ``Window.orderBy`` without partitions sends the whole table to one task,
and ``percentile`` keeps every distinct value of a group in one buffer.  Here the
order axis is cut at approximate quantiles (a few numbers, read on the driver).
The cuts are constants of the plan, so retries give the same buckets.  Each
bucket is summed on its own, and the bucket totals (at most one row per bucket
and group) supply what comes before.
"""

from __future__ import annotations

import math
import os
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyward.session import settle


def bucket_count(df: DataFrame) -> int:
    """One bucket per shuffle partition, bounded so the cut list stays small."""
    return max(2, min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4096))


def number_line(df: DataFrame, column: str) -> Column:
    """A double that rises with the column, for cutting its axis; not one to one.

    Numbers, dates and times stand for themselves.  Text counts by its first six
    bytes behind the beginning that all its values share (that of least and largest).
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, StringType):
        value = F.col(column)
        return (F.unix_micros(value) if kind.typeName() == "timestamp" else value).cast("double")
    low, high = df.agg(F.min(column), F.max(column)).first()
    common = len(os.path.commonprefix([(low or "").encode(), (high or "").encode()]))
    six = F.substring(F.col(column).cast("binary"), common + 1, 6)
    return F.conv(F.rpad(F.hex(six), 12, "0"), 16, 10).cast("double")


def cut_points(df: DataFrame, column: str, buckets: int) -> tuple[list[float], list[float]]:
    """Approximate quantile cuts of a numeric column, and the values heavy enough to repeat."""
    shares = [i / buckets for i in range(1, buckets)]
    accuracy = max(1000, 20 * buckets)
    found = df.agg(F.percentile_approx(F.col(column).cast("double"), shares, accuracy)).first()[0] or []
    heavy = sorted({a for a, b in zip(found, found[1:]) if a == b})
    cuts = sorted(set(found) | {math.nextafter(v, math.inf) for v in heavy})
    return cuts, heavy


def with_bucket(df: DataFrame, column: str, cuts: Sequence[float], out: str) -> DataFrame:
    """Bucket number by binary search over the cuts; bucket i is [cut i-1, cut i)."""
    if not cuts:
        return df.withColumn(out, F.lit(0.0))
    splits = [-math.inf, *cuts, math.inf]
    probe = "__probe"
    tagged = df.withColumn(probe, F.col(column).cast("double"))
    return Bucketizer(splits=splits, inputCol=probe, outputCol=out, handleInvalid="keep").transform(tagged).drop(probe)


def running_totals(
    df: DataFrame,
    order: str,
    measures: Mapping[str, Column | str],
    by: Sequence[str] = (),
    tie: str | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add inclusive running sums of ``measures`` along ``order`` within each ``by`` group.

    ``order`` (and ``tie``, which orders equal values) are numbers, times or text, and
    together unique within a group.  A value of ``order`` so frequent that it spans
    several quantile cuts gets its own bucket, which is cut again along ``tie``.
    """
    buckets = bucket_count(df)
    line = number_line(df, order)
    df = df.withColumn("__axis", F.col(order)).withColumn("__line", -line if descending else line)
    cuts, heavy = cut_points(df, "__line", buckets)
    df = with_bucket(df, "__line", cuts, "__b1")
    if tie and heavy:
        busy = F.col("__line").isin(heavy)
        df = df.withColumn("__tie", number_line(df, tie))
        tie_cuts, _ = cut_points(df.where(busy), "__tie", buckets)
        df = with_bucket(df, "__tie", tie_cuts, "__b2").drop("__tie")
        df = df.withColumn("__b2", F.when(busy, F.col("__b2")).otherwise(F.lit(0.0)))
    else:
        df = df.withColumn("__b2", F.lit(0.0))
    slot = [*by, "__b1", "__b2"]
    within = (
        Window.partitionBy(*slot)
        .orderBy(F.col("__axis").desc() if descending else F.col("__axis").asc(), *([tie] if tie else []))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    exprs = {name: (F.col(e) if isinstance(e, str) else e) for name, e in measures.items()}
    local = df.withColumns({name: F.sum(e).over(within) for name, e in exprs.items()})
    before = Window.partitionBy(*by).orderBy("__b1", "__b2").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*slot).agg(*[F.sum(e).alias(f"__t_{n}") for n, e in exprs.items()])
    prior = totals.select(*slot, *[F.sum(f"__t_{n}").over(before).alias(f"__p_{n}") for n in exprs])
    if not by:
        # at most buckets * buckets rows, whatever the size of the data
        prior = F.broadcast(prior)
    joined = local.alias("l").join(
        prior.alias("r"), [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in slot], "left"
    )
    kept = [c for c in local.columns if c not in exprs and c not in ("__axis", "__line", "__b1", "__b2")]
    return joined.select(
        *[F.col(f"l.{c}") for c in kept],
        *[(F.col(f"l.{n}") + F.coalesce(F.col(f"r.__p_{n}"), F.lit(0))).alias(n) for n in exprs],
    )


def ordinals(df: DataFrame, order: str, tie: str, by: Sequence[str] = (), out: str = "ordinal") -> DataFrame:
    """Zero-based position of every row in (order, tie) order, without a global sort task."""
    ranked = running_totals(df, order, {out: F.lit(1)}, by=by, tie=tie)
    return ranked.withColumn(out, (F.col(out) - 1).cast("bigint"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact, linearly interpolated quantiles: rows (by..., column, share, value).

    Values are counted first, so repeats cost nothing, then ranked with
    ``running_totals``; a quantile is read off the values whose rank range covers
    the wanted position.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(*by, F.inline(pairs)).where(F.col("value").isNotNull())
    keys = [*by, "column"]
    counts = settle(long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n")))
    ranked = running_totals(counts, "value", {"upto": F.col("n")}, by=keys)
    sizes = counts.groupBy(*keys).agg(F.sum("n").alias("size"))
    ranked = ranked.join(sizes, keys) if by else ranked.join(F.broadcast(sizes), keys)
    size, upto, n = F.col("size"), F.col("upto"), F.col("n")
    aggs = []
    for i, share in enumerate(shares):
        position = F.lit(float(share)) * (size - 1)
        low, high = F.floor(position), F.ceil(position)
        holds = lambda rank: (upto > rank) & (upto - n <= rank)
        aggs += [
            F.max(F.when(holds(low), F.col("value"))).alias(f"__lo{i}"),
            F.max(F.when(holds(high), F.col("value"))).alias(f"__hi{i}"),
            F.max(position - low).alias(f"__fr{i}"),
        ]
    wide = ranked.groupBy(*keys).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(float(s)).alias("share"),
                (F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__fr{i}")).alias("value"),
            )
            for i, s in enumerate(shares)
        ]
    )
    return wide.select(*keys, F.inline(rows))
