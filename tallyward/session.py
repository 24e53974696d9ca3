"""Session settings and the shared scratch folder every operator relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tallyward", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; a cluster job brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset and
    the master is local (tests, a laptop) do we pick a temporary folder ourselves;
    on a cluster executors would not see it, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if spark.sparkContext.getCheckpointDir() is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyward-"))
    return spark.sparkContext.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Several readers then do not recompute it, the lineage is cut, and the table
    survives lost executors.
    """
    path = fresh_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    import uuid

    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
