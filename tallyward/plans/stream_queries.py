"""Online behaviours, each as a real stream over the event file and as a batch query."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators.heavy import Heavy
from tallyward.operators.merchants import global_rate, merchant_stats
from tallyward.plans import views as V
from tallyward.plans.registry import query
from tallyward.plans.views import half_up, with_views
from tallyward.plans.window_queries import _FLAT, US, _vel_sql, flat
from tallyward.streaming import online as On


def tx_stream(spark, sf):
    """The event file as a stream of transactions."""
    schema = V.table(spark, sf, "events").schema
    e = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id").alias("transaction_id"), "user_id",
        F.get_json_object("props", "$.k").cast("int").alias("merchant_id"), ts.alias("timestamp"),
        F.col("value").alias("amount"), F.hour(ts).alias("hour_of_day"),
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),
    )


_LIMIT = """SELECT transaction_id AS id, CAST(user_id AS VARCHAR) AS key, epoch_us(timestamp)//86400000000*86400 AS window_start,
 row_number() OVER (PARTITION BY user_id, epoch_us(timestamp)//86400000000 ORDER BY timestamp, transaction_id) AS r FROM tx"""
_LIMIT_SQL = with_views("tx", l=_LIMIT) + "SELECT id, key, window_start, r<=2 AS allowed, greatest(0,2-r) AS remaining, window_start+86400 AS reset_at FROM l"
LIMIT = dict(limit=2, seconds=86400)  # the table has few events per minute, so the limit is per day


@query("K1_rate_limit_batch", _LIMIT_SQL)
def k1_batch(spark, sf):
    return On.rate_limit_batch(V.tx(spark, sf), "user_id", "timestamp", "transaction_id", **LIMIT)


@query("K1_rate_limit_stream", _LIMIT_SQL)
def k1_stream(spark, sf):
    out = On.rate_limit_stream(tx_stream(spark, sf), "user_id", "timestamp", "transaction_id", **LIMIT)
    return On.drain(out, "rate-limit")


@query(
    "K1_window_counts_batch",
    with_views("tx") + "SELECT user_id AS key, epoch_us(timestamp)//86400000000*86400 AS window_start, count(*) AS requests FROM tx GROUP BY ALL",
)
def k1_counts_batch(spark, sf):
    """All windows, also those that a stream still holds open when its source ends."""
    return On.window_counts(V.tx(spark, sf), "user_id", "timestamp", 86400)


@query(
    "K1_window_counts_stream",
    with_views("tx") + """SELECT user_id AS key, epoch_us(timestamp)//86400000000*86400 AS window_start, count(*) AS requests FROM tx
    GROUP BY ALL HAVING (epoch_us(any_value(timestamp))//86400000000+1)*86400000000 <= (SELECT epoch_us(max(timestamp))-3600000000 FROM tx)""",
)
def k1_counts(spark, sf):
    return On.drain(On.window_counts_stream(tx_stream(spark, sf), "user_id", "timestamp", 86400), "window-counts")


# key: user and merchant; the time to live is long because the test table is thin
_TTL = 5 * 86400
_REPEAT_SQL = "WITH RECURSIVE " + with_views(
    "tx", e="SELECT transaction_id AS id, user_id || '-' || merchant_id % 10 AS key, epoch_us(timestamp) AS us FROM tx"
)[5:] + f""", c AS (SELECT key, min(us) AS us FROM e GROUP BY key
  UNION ALL SELECT c.key, (SELECT min(us) FROM e WHERE e.key=c.key AND e.us>=c.us+{_TTL * 1000000}) FROM c WHERE c.us IS NOT NULL)
 SELECT id, key, us, (key, us) IN (SELECT (key, us) FROM c WHERE us IS NOT NULL) AS computed FROM e"""


def _keyed(df):
    return df.withColumn("key", F.concat_ws("-", "user_id", F.col("merchant_id") % 10))


@query("K2_suppress_repeats_batch", _REPEAT_SQL)
def k2_batch(spark, sf):
    return On.suppress_repeats_batch(_keyed(V.tx(spark, sf)), "key", "timestamp", "transaction_id", _TTL)


@query("K2_suppress_repeats_split_keys", _REPEAT_SQL)
def k2_split(spark, sf):
    """Every key treated as heavy: same result by pointer doubling."""
    return On.suppress_repeats_batch(
        _keyed(V.tx(spark, sf)), "key", "timestamp", "transaction_id", _TTL, Heavy(share=0.0, min_rows=0)
    )


@query("K2_suppress_repeats_stream", _REPEAT_SQL)
def k2_stream(spark, sf):
    out = On.suppress_repeats_stream(_keyed(tx_stream(spark, sf)), "key", "timestamp", "transaction_id", _TTL)
    return On.drain(out, "repeats")


@query("K3_velocity_stream", _vel_sql("tx", US, ["count", "sum", "mean"], True))
def k3(spark, sf):
    out = On.drain(On.velocity_stream(tx_stream(spark, sf)), "velocity")
    return out.withColumns({c: F.round(c, 6) for c in out.columns if "mean" in c})


_SEQ = """SELECT transaction_id, user_id, list([amount, CAST(hour_of_day AS DOUBLE)]) OVER w AS s
 FROM tx WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, transaction_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"""


@query(
    "K4_sequence_stream",
    with_views(
        "tx", q=_SEQ,
        z="""SELECT transaction_id, user_id, CAST(len(s) AS INTEGER) AS length,
        list_concat(list_transform(range(10-len(s)), lambda i: [0.0::DOUBLE,0.0::DOUBLE]), s) AS sequence FROM q WHERE len(s)>=3""",
    ) + _FLAT.format(t="z"),
)
def k4(spark, sf):
    return flat(On.drain(On.sequence_stream(tx_stream(spark, sf), 10, ["amount", "hour_of_day"]), "sequences"))


_REQ = """SELECT transaction_id, amount, rate AS merchant_risk, CAST(hour_of_day AS DOUBLE) AS velocity_1h, amount % 250.0::DOUBLE AS distance_from_home FROM tx JOIN merch USING (merchant_id)"""
_T = {
    "amount": "least(amount/1500.0::DOUBLE,1.0::DOUBLE)*0.35::DOUBLE", "merchant_risk": "merchant_risk*0.3::DOUBLE",
    "velocity_1h": "least(velocity_1h/20.0::DOUBLE,1.0::DOUBLE)*0.2::DOUBLE",
    "distance_from_home": "least(distance_from_home/250.0::DOUBLE,1.0::DOUBLE)*0.15::DOUBLE",
}
_K5_SQL = with_views(
    "tx", "merch", q=_REQ,
    s=f"SELECT *, greatest(0.0::DOUBLE,least(1.0::DOUBLE,{half_up('+'.join(_T.values()), 4)})) AS p FROM q",
    t=" UNION ALL ".join(f"SELECT transaction_id, '{f}' AS f, {e} AS c FROM q" for f, e in _T.items()),
    k="SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY abs(c) DESC, f) AS rk FROM t",
    top="SELECT transaction_id, string_agg(f,'|' ORDER BY rk) AS top_factors FROM k WHERE rk<=3 GROUP BY transaction_id",
) + """SELECT transaction_id, p AS fraud_probability, CASE WHEN p>=0.5::DOUBLE THEN 'fraud' ELSE 'legitimate' END AS prediction,
 CASE WHEN p>=0.85::DOUBLE THEN 'critical' WHEN p>=0.65::DOUBLE THEN 'high' WHEN p>=0.4::DOUBLE THEN 'medium' ELSE 'low' END AS risk_tier,
 coalesce(nullif(concat_ws('|', CASE WHEN amount>=500 THEN 'high_amount' END, CASE WHEN merchant_risk>=0.6::DOUBLE THEN 'merchant_risk' END,
 CASE WHEN velocity_1h>=6 THEN 'high_velocity' END, CASE WHEN distance_from_home>=80 THEN 'distance_from_home' END),''),'baseline_pattern') AS reasons, top_factors
 FROM s JOIN top USING (transaction_id)"""


def _requests(df, stats, overall):
    """Request fields; merchant risk comes from a stream-static lookup, the global rate for a new merchant."""
    side = stats.select("merchant_id", F.col("rate").alias("merchant_risk"))
    return df.join(side, "merchant_id", "left").select(
        "transaction_id", "amount", F.coalesce("merchant_risk", overall).alias("merchant_risk"), F.col("hour_of_day").cast("double").alias("velocity_1h"),
        (F.col("amount") % 250.0).alias("distance_from_home"),
    )


@query("K5_score_stream", _K5_SQL)
def k5_stream(spark, sf):
    t = V.tx(spark, sf)
    # one number, read before the stream starts
    overall = F.lit(t.agg(F.avg("is_fraud")).first()[0])
    return On.drain(On.score_rows(_requests(tx_stream(spark, sf), merchant_stats(t), overall)), "alerts")


@query("K5_score_batch", _K5_SQL)
def k5_batch(spark, sf):
    t = V.tx(spark, sf)
    return On.score_rows(_requests(t, merchant_stats(t), global_rate(t)))
