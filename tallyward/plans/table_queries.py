"""Scans, sinks and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.functions.hashing import hash_unit
from tallyward.operators.features import FraudFeatures, load_features
from tallyward.plans import views as V
from tallyward.plans.registry import query
from tallyward.plans.views import with_views
from tallyward.session import fresh_path
from tallyward.sources import quality as Q
from tallyward.sources import readers as R
from tallyward.sources import sinks

HASH_SQL = "('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{stream}'),1,13))::UBIGINT / 4503599627370496.0::DOUBLE"


@query("A1_card_csv_scan", with_views("card") + "SELECT Time, V1, V14, V28, Amount, Class FROM card")
def card_csv(spark, sf):
    path = fresh_path(spark, "card-csv")
    V.card(spark, sf).write.option("header", True).csv(path)
    return R.read_card_csv(spark, path).select("Time", "V1", "V14", "V28", "Amount", "Class")


@query(
    "A2_scan_by_format",
    with_views("tx") + """SELECT f AS file_type, transaction_id, amount, is_fraud
    FROM tx, (VALUES ('csv'),('parquet')) v(f)""",
)
def scan_by_format(spark, sf):
    out = None
    for fmt in R.FORMATS:
        path = fresh_path(spark, f"tx-{fmt}")
        V.tx(spark, sf).write.option("header", True).format(fmt).save(path)
        part = R.read_table(spark, path, fmt, R.TRANSACTION_SCHEMA).select(
            F.lit(fmt).alias("file_type"), "transaction_id", "amount", "is_fraud"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "A3_label_detection",
    with_views("tx", "card") + """SELECT 'is_fraud' AS source, CAST(sum(is_fraud) AS BIGINT) AS positives, count(*) AS n FROM tx
    UNION ALL SELECT 'Class', CAST(sum(Class) AS BIGINT), count(*) FROM card
    UNION ALL SELECT 'label', CAST(sum(label) AS BIGINT), count(*) FROM vec""",
)
def label_detection(spark, sf):
    out = None
    for df in (V.tx(spark, sf), V.card(spark, sf), V.vec(spark, sf)):
        part = R.with_label(df).agg(
            F.lit(R.detect_label(df)).alias("source"), F.sum("label").alias("positives"), F.count(F.lit(1)).alias("n")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "A4_value_rules",
    """SELECT count(*) AS rows, count(*) FILTER (quality IS NULL) AS label_null, count(*) FILTER (n_chars IS NULL) AS amount_null,
    count(*) FILTER (NOT quality IN (0,1)) AS label_not_binary FROM documents LEFT JOIN labels USING (doc_id)""",
)
def value_rules(spark, sf):
    d = V.table(spark, sf, "documents").join(V.table(spark, sf, "labels"), "doc_id", "left")
    return Q.value_rules(d, "quality", "n_chars")


@query(
    "A5_normalise_records",
    """SELECT event_id AS transaction_id, coalesce(TRY_CAST(value AS DOUBLE),0.0::DOUBLE) AS amount,
    coalesce(TRY_CAST(props AS DOUBLE),0.0::DOUBLE) AS merchant_risk,
    coalesce(TRY_CAST(json_extract_string(props,'$.k') AS DOUBLE),0.0::DOUBLE) AS velocity_1h,
    0.0::DOUBLE AS distance_from_home FROM events""",
)
def normalise_records(spark, sf):
    raw = V.table(spark, sf, "events").select(
        F.col("event_id").alias("transaction_id"), F.col("value").cast("string").alias("amount"),
        F.col("props").alias("merchant_risk"), F.get_json_object("props", "$.k").alias("velocity_1h"),
    )
    return R.normalise_records(raw)


@query(
    "A6_range_quarantine",
    """WITH r AS (SELECT o_orderkey AS transaction_id, o_custkey AS user_id,
      CASE WHEN o_orderpriority='1-URGENT' THEN NULL ELSE c_nationkey END AS merchant_id,
      c_acctbal AS amount, c_acctbal/8000.0::DOUBLE AS merchant_risk, c_acctbal-100.0::DOUBLE AS velocity_1h
      FROM orders JOIN customer ON o_custkey=c_custkey),
    w AS (SELECT transaction_id, concat_ws('|', CASE WHEN transaction_id IS NULL THEN 'transaction_id_missing' END,
      CASE WHEN user_id IS NULL THEN 'user_id_missing' END, CASE WHEN merchant_id IS NULL THEN 'merchant_id_missing' END,
      CASE WHEN amount<0 THEN 'amount_out_of_range' END,
      CASE WHEN NOT merchant_risk BETWEEN 0 AND 1 THEN 'merchant_risk_out_of_range' END,
      CASE WHEN velocity_1h<0 THEN 'velocity_1h_negative' END) AS reasons FROM r)
    SELECT transaction_id, reasons, reasons='' AS valid FROM w""",
)
def range_quarantine(spark, sf):
    o, c = V.table(spark, sf, "orders"), V.table(spark, sf, "customer")
    r = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("user_id"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("c_nationkey")).alias("merchant_id"),
        F.col("c_acctbal").alias("amount"), (F.col("c_acctbal") / 8000.0).alias("merchant_risk"),
        (F.col("c_acctbal") - 100.0).alias("velocity_1h"),
    )
    return Q.quarantine(r, Q.request_rules(r)).select(
        "transaction_id", F.concat_ws("|", "reasons").alias("reasons"), "valid"
    )


@query(
    "A7_required_fields",
    with_views("tx") + """SELECT transaction_id, CASE WHEN merchant_id=0 THEN 'merchant_id_missing' ELSE '' END AS reasons,
    merchant_id<>0 AS valid FROM tx""",
)
def required_fields(spark, sf):
    t = V.tx(spark, sf).withColumn("merchant_id", F.nullif(F.col("merchant_id"), F.lit(0)))
    return Q.required_fields(t).select("transaction_id", F.concat_ws("|", "reasons").alias("reasons"), "valid")


@query(
    "A8_dataset_profile",
    """WITH d AS (SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
    n AS (SELECT count(*) AS rows, count(*)-count(doc_id) AS a, count(*)-count(lang) AS b, count(*)-count(n_chars) AS c,
      count(*)-count(quality) AS d, count(*)-count(toxic) AS e FROM d)
    SELECT t.column, t.type, rows, t.nulls, t.nulls>0 AS any_missing FROM n,
    LATERAL (VALUES ('doc_id','bigint',a),('lang','string',b),('n_chars','bigint',c),('quality','int',d),('toxic','int',e)) t("column",type,nulls)""",
)
def dataset_profile(spark, sf):
    d = V.table(spark, sf, "documents").join(V.table(spark, sf, "labels"), "doc_id", "left")
    return Q.profile(d.select("doc_id", "lang", "n_chars", "quality", "toxic"))


NUM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "A9_numeric_profile",
    with_views("line") + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}),9) AS mean, round(stddev_samp({c}),9) AS std, min({c}) AS min,
        round(quantile_cont({c},0.25),6) AS q25, round(quantile_cont({c},0.5),6) AS q50, round(quantile_cont({c},0.75),6) AS q75,
        max({c}) AS max FROM line""" for c in NUM_COLS
    ),
)
def numeric_profile(spark, sf):
    p = Q.numeric_profile(V.line(spark, sf), NUM_COLS)
    return p.withColumns({c: F.round(c, 9 if c in ("mean", "std") else 6) for c in ("mean", "std", "q25", "q50", "q75")})


SPLIT_SQL = f"""SELECT transaction_id, amount, is_fraud, CASE WHEN h<0.2 THEN 'test' WHEN h<0.3 THEN 'validation' ELSE 'train' END AS split
 FROM (SELECT *, {HASH_SQL.format(key='transaction_id', stream=42)} AS h FROM tx)"""


@query("A10_split_store", with_views("tx", s=SPLIT_SQL) + "SELECT transaction_id, amount, is_fraud, split FROM s WHERE split='validation'")
def split_store(spark, sf):
    h = hash_unit(F.col("transaction_id"), 42)
    split = F.when(h < 0.2, "test").when(h < 0.3, "validation").otherwise("train")
    path = fresh_path(spark, "splits")
    sinks.save_splits(V.tx(spark, sf).select("transaction_id", "amount", "is_fraud", split.alias("split")), path)
    return sinks.load_split(spark, path, "validation")


@query(
    "A11_export_failures",
    with_views("tx") + """SELECT transaction_id, is_fraud AS label, amount AS score,
    CASE WHEN is_fraud=1 THEN 'FN' ELSE 'FP' END AS outcome FROM tx WHERE (amount>=100) <> (is_fraud=1)""",
)
def export_failures(spark, sf):
    from tallyward.operators.outcomes import failures

    bad = failures(V.tx(spark, sf).withColumnsRenamed({"is_fraud": "label", "amount": "score"}), 100.0)
    path = fresh_path(spark, "failures")
    sinks.export_failures(bad.select("transaction_id", "label", "score", "outcome"), path, "csv")
    return spark.read.schema("transaction_id bigint, label int, score double, outcome string").option("header", True).csv(path)


@query(
    "A12_metric_store",
    with_views("tx") + """SELECT 'run-1' AS run_id, hour_of_day, count(*) AS n, round(avg(is_fraud),6) AS rate FROM tx GROUP BY hour_of_day
    UNION ALL SELECT 'run-2', hour_of_day, count(*), round(avg(is_fraud),6) FROM tx GROUP BY hour_of_day""",
)
def metric_store(spark, sf):
    m = V.tx(spark, sf).groupBy("hour_of_day").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("is_fraud"), 6).alias("rate")
    )
    path = fresh_path(spark, "metrics")
    sinks.save_metrics(m, path, "run-1", "json")
    sinks.save_metrics(m, path, "run-2", "json")
    return spark.read.schema("hour_of_day int, n bigint, rate double, run_id string").json(path)


@query(
    "A13_saved_features",
    with_views("tx", "merch", "vel1") + """SELECT transaction_id, c AS velocity_count_1h, round(rate,6) AS merchant_fraud_rate
    FROM tx JOIN merch USING (merchant_id) JOIN vel1 USING (transaction_id)""",
)
def saved_features(spark, sf):
    t = V.tx(spark, sf)
    path = fresh_path(spark, "features")
    FraudFeatures(windows=[(1, "h")], velocity_features=["count"], include=["velocity", "merchant"]).fit(t).save(path)
    done = load_features(spark, path).transform(t)
    return done.select("transaction_id", "velocity_count_1h", F.round("merchant_fraud_rate", 6).alias("merchant_fraud_rate"))


@query(
    "A14_drop_nulls",
    "SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL",
)
def drop_nulls(spark, sf):
    d = V.table(spark, sf, "documents").join(V.table(spark, sf, "labels"), "doc_id", "left")
    return Q.drop_nulls(d.select("doc_id", "quality", "toxic"), ["quality", "toxic"])


@query(
    "A14_drop_nulls_report",
    """SELECT count(*) FILTER (quality IS NOT NULL) AS kept, count(*) FILTER (quality IS NULL) AS dropped
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def drop_nulls_report(spark, sf):
    d = V.table(spark, sf, "documents").join(V.table(spark, sf, "labels"), "doc_id", "left")
    return Q.drop_nulls_report(d, ["quality", "toxic"])


@query("A15_feature_width", with_views("vec") + "SELECT count(*) AS rows, count(*) FILTER (len(features)<>64) AS wrong_width FROM vec")
def feature_width(spark, sf):
    return Q.width_check(V.vec(spark, sf), "features", [f"f{i}" for i in range(64)])
