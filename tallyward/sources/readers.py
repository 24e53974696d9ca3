"""Table scans with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The wide card table.
CARD_FEATURES = [f"V{i}" for i in range(1, 29)]
CARD_COLUMNS = ["Time", *CARD_FEATURES, "Amount", "Class"]
CARD_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c == "Class" else T.DoubleType()) for c in CARD_COLUMNS]
)
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("merchant_id", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("is_fraud", T.IntegerType()),
    ]
)
# Label columns in order of preference, and the scoring record fields.
LABEL_CANDIDATES = ["is_fraud", "Class"]
RECORD_FIELDS = ["amount", "merchant_risk", "velocity_1h", "distance_from_home"]
FORMATS = ("csv", "parquet")


def read_card_csv(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    """The 31-column card table; a malformed file raises when it is read."""
    reader = spark.read.schema(CARD_SCHEMA).option("header", True).option("mode", "FAILFAST")
    df = reader.option("enforceSchema", False).csv(path)
    if validate:
        from tallyward.sources.quality import validate_card

        problems = validate_card(df)
        if problems:
            raise ValueError("; ".join(problems))
    return df


def read_table(spark: SparkSession, path: str, file_type: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Scan by declared format."""
    if file_type not in FORMATS:
        raise ValueError(f"Unsupported file type: {file_type}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if file_type == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
        if schema is None:
            reader = reader.option("inferSchema", True)
    return reader.format(file_type).load(path)


def detect_label(df: DataFrame) -> str:
    """``is_fraud``, else ``Class``, else the last column."""
    for name in LABEL_CANDIDATES:
        if name in df.columns:
            return name
    return df.columns[-1]


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed(detect_label(df), "label")


def normalise_records(df: DataFrame) -> DataFrame:
    """The five scoring fields; missing or unreadable numbers become 0."""
    out = [F.col("transaction_id") if "transaction_id" in df.columns else F.lit(None).alias("transaction_id")]
    for name in RECORD_FIELDS:
        value = F.col(name).try_cast("double") if name in df.columns else F.lit(None).cast("double")
        out.append(F.coalesce(value, F.lit(0.0)).alias(name))
    return df.select(*out)
