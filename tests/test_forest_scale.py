"""A forest keeps each row's node between levels; its trees are those of a forest that does not."""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from tallyward.operators import models as Mo


def test_nodes_are_kept_and_trees_equal(spark):
    rows = spark.range(400).select(
        F.array((F.col("id") % 17) * 1.0, (F.col("id") % 5) * 1.0, (F.col("id") % 29) * 1.0).alias("features"),
        ((F.col("id") * 7) % 11 < 4).cast("int").alias("label"),
    ).coalesce(1)
    model, _ = Mo.fit_forest(rows, trees=5, depth=6)
    assert model.getCacheNodeIds()
    ready = Mo._prepared(rows.withColumn("__w", F.lit(1.0)), "features", "label")
    plain = RandomForestClassifier(
        featuresCol="__x", labelCol="__y", weightCol="__w", numTrees=5, maxDepth=6, seed=42, cacheNodeIds=False
    ).fit(ready)
    cut = lambda m: m.toDebugString.split("\n", 1)[1]
    assert cut(model) == cut(plain)
