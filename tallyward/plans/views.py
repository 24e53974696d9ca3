"""Canonical views over the given tables, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions import scoring as S
from tallyward.operators.merchants import global_rate, merchant_features, merchant_stats
from tallyward.operators.velocity import velocity
from tallyward.session import fresh_path


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tx(spark: SparkSession, sf: str) -> DataFrame:
    """Card transactions from the event table."""
    e = table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id").alias("transaction_id"),
        "user_id",
        F.get_json_object("props", "$.k").cast("int").alias("merchant_id"),
        ts.alias("timestamp"),
        F.col("value").alias("amount"),
        F.hour(ts).alias("hour_of_day"),
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),
    )


def orders_tx(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as transactions: large amounts and many equal times."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("c_nationkey").alias("merchant_id"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.col("o_totalprice").alias("amount"),
        (F.col("o_orderstatus") == "P").cast("int").alias("is_fraud"),
    )


LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def line(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as unlabelled wide rows: five numeric features and a label."""
    return table(spark, sf, "lineitem").select(
        *[F.col(c).cast("double").alias(c) for c in LINE_FEATURES],
        "l_suppkey",
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


def vec(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as feature vectors; label 9 is the rare class."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        F.transform("embedding", lambda x: x.cast("double")).alias("features"),
        (F.col("label") == 9).cast("int").alias("label"),
    )


def card(spark: SparkSession, sf: str) -> DataFrame:
    """The 31-column card table: 28 embedding dimensions, elapsed time, amount, class."""
    v = vec(spark, sf)
    return v.select(
        (F.col("row_id") * 97.0).alias("Time"),
        *[F.col("features")[i].alias(f"V{i + 1}") for i in range(28)],
        F.round(F.abs(F.col("features")[28]) * 1000.0, 2).alias("Amount"),
        F.col("label").alias("Class"),
    )


def scored_from(t: DataFrame) -> DataFrame:
    """Rule-score inputs and score for every transaction of ``t``."""
    stats = merchant_stats(t)
    risk = merchant_features(t, stats, global_rate(t))
    joined = velocity(risk, windows=[(1, "h")], features=["count"], keep=risk.columns)
    out = joined.select(
        "transaction_id", "user_id", "merchant_id", "timestamp", "is_fraud", "amount",
        F.col("merchant_fraud_rate").alias("merchant_risk"),
        F.col("velocity_count_1h").cast("double").alias("velocity_1h"),
        (F.col("amount") % 250.0).alias("distance_from_home"),
    )
    raw = S.rule_score()
    return out.withColumn("raw", raw).withColumn("p", S.clamp_probability(raw)).withColumn(
        "q", F.col("amount") / 500.0
    )


_WRITTEN: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """``build(spark, sf)``, written once per application to the shared folder and then read."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _WRITTEN:
        path = fresh_path(spark, name)
        build(spark, sf).write.parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return written(spark, sf, "scored", lambda s, d: scored_from(tx(s, d)))


def half_up(expr: str, places: int) -> str:
    """SQL for Spark's ``round``: half up on the shortest decimal text of the double."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(30,20)),{places}) AS DOUBLE)"


SQL_VIEWS: dict[str, tuple[list[str], str]] = {
    "tx": ([], """SELECT event_id AS transaction_id, user_id, CAST(json_extract_string(props,'$.k') AS INTEGER) AS merchant_id,
        ts AS timestamp, value AS amount, CAST(hour(ts) AS INTEGER) AS hour_of_day,
        CAST(event_type='error' AS INTEGER) AS is_fraud FROM events"""),
    "ord": ([], """SELECT o_orderkey AS transaction_id, o_custkey AS user_id, c_nationkey AS merchant_id,
        o_orderdate AS timestamp, o_totalprice AS amount, CAST(o_orderstatus='P' AS INTEGER) AS is_fraud
        FROM orders JOIN customer ON o_custkey=c_custkey"""),
    "line": ([], """SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
        l_suppkey, CAST(l_returnflag='R' AS INTEGER) AS label FROM lineitem"""),
    "vec": ([], """SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS features,
        CAST(label=9 AS INTEGER) AS label FROM embeddings"""),
    "card": (["vec"], "SELECT row_id*97.0::DOUBLE AS Time, "
             + ", ".join(f"features[{i + 1}] AS V{i + 1}" for i in range(28))
             + ", round(abs(features[29])*1000.0::DOUBLE,2) AS Amount, label AS Class FROM vec"),
    "grate": (["tx"], "SELECT avg(is_fraud) AS g FROM tx"),
    "merch": (["tx", "grate"], """SELECT merchant_id, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, count(*) AS total_count,
        0.5::DOUBLE*max(g) + 0.5::DOUBLE*((sum(is_fraud)+1.0::DOUBLE)/(count(*)+2.0::DOUBLE)) AS rate
        FROM tx, grate GROUP BY merchant_id"""),
    "vel1": (["tx"], """SELECT transaction_id, count(amount) OVER (PARTITION BY user_id ORDER BY epoch_us(timestamp)
        RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS c FROM tx"""),
    "scored0": (["tx", "merch", "vel1"], """SELECT tx.transaction_id, user_id, tx.merchant_id, timestamp, is_fraud, amount,
        rate AS merchant_risk, CAST(c AS DOUBLE) AS velocity_1h, amount % 250.0::DOUBLE AS distance_from_home
        FROM tx JOIN merch USING (merchant_id) JOIN vel1 USING (transaction_id)"""),
    "scored1": (["scored0"], """SELECT *, least(amount/1500.0::DOUBLE,1.0::DOUBLE)*0.35::DOUBLE + merchant_risk*0.3::DOUBLE
        + least(velocity_1h/20.0::DOUBLE,1.0::DOUBLE)*0.2::DOUBLE
        + least(distance_from_home/250.0::DOUBLE,1.0::DOUBLE)*0.15::DOUBLE AS raw, amount/500.0::DOUBLE AS q FROM scored0"""),
    "scored": (["scored1"], f"""SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, {half_up('raw', 4)})) AS p FROM scored1"""),
}


def with_views(*names: str, **extra: str) -> str:
    """``WITH`` clause for the named views, dependencies first, then extra CTEs in order."""
    done: list[str] = []

    def add(name: str) -> None:
        for need in SQL_VIEWS[name][0]:
            add(need)
        if name not in done:
            done.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({SQL_VIEWS[n][1]})" for n in done] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n"
