"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.session import settle

MAX_ROUNDS = 60


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where(F.col("u") != F.col("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    out = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = out.unionByName(low.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of the component of each linked node that is not itself a root.

    ``links`` has bigint columns u, v.  Large-star and small-star rounds alternate; each
    round is written to the shared folder, so plans stay short.  Vertex neighbourhoods
    are never collected: minima are combined before the shuffle.
    """
    edges = settle(
        links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    mark = None
    for _ in range(MAX_ROUNDS):
        edges = settle(_small_star(_large_star(edges)))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError("components did not settle")
