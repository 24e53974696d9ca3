"""Windows, history, lookups and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.functions.columns import MERCHANT_RISK_EDGES
from tallyward.functions.hashing import hash_unit
from tallyward.operators import history as Hi
from tallyward.operators import merchants as M
from tallyward.operators import sequences as Sq
from tallyward.operators.features import FraudFeatures
from tallyward.operators.heavy import Heavy
from tallyward.operators.velocity import gaps, global_gaps, rolling_stats, velocity
from tallyward.plans import views as V
from tallyward.plans.registry import query
from tallyward.plans.views import with_views

US = {"1h": 3600000000, "24h": 86400000000, "7d": 604800000000}
SPLIT_ALL = Heavy(share=0.0, min_rows=0)


def _vel_body(view: str, spans, funcs, gap: bool) -> str:
    out = ["transaction_id"]
    for w in spans:
        f = f"OVER (PARTITION BY user_id ORDER BY epoch_us(timestamp) RANGE BETWEEN {US[w] - 1} PRECEDING AND CURRENT ROW)"
        if "count" in funcs:
            out.append(f"count(amount) {f} AS velocity_count_{w}")
        if "sum" in funcs:
            out.append(f"CAST(sum(CAST(amount AS DECIMAL(18,2))) {f} AS DOUBLE) AS velocity_sum_{w}")
        if "mean" in funcs:
            out.append(f"round(CAST(sum(CAST(amount AS DECIMAL(18,2))) {f} AS DOUBLE)/count(amount) {f},6) AS velocity_mean_{w}")
        if "std" in funcs:
            out.append(f"round(stddev_samp(amount) {f},6) AS velocity_std_{w}")
    if gap:
        out.append(
            "coalesce((epoch_us(timestamp)-lag(epoch_us(timestamp)) OVER (PARTITION BY user_id ORDER BY timestamp,transaction_id))/1e6::DOUBLE,"
            "999999.0::DOUBLE) AS velocity_time_since_last_s"
        )
    return f"SELECT {', '.join(out)} FROM {view}"


def _vel_sql(view: str, spans, funcs, gap: bool) -> str:
    return with_views(view) + _vel_body(view, spans, funcs, gap)


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in df.columns if "mean" in c or "std" in c})


ALL_FUNCS = ["count", "sum", "mean", "std"]
_F1 = _vel_sql("tx", US, ALL_FUNCS, False)


@query("F1_velocity", _F1)
def f1(spark, sf):
    return _rounded(velocity(V.tx(spark, sf), features=ALL_FUNCS))


@query("F1_velocity_split_users", _F1)
def f1_split(spark, sf):
    """Every user treated as heavy: same result by the chunked path."""
    return _rounded(velocity(V.tx(spark, sf), features=ALL_FUNCS, rule=SPLIT_ALL))


@query("F1_velocity_ties_as_peers", _vel_sql("ord", ["7d"], ["count", "sum", "mean"], False))
def f1_peers(spark, sf):
    return _rounded(velocity(V.orders_tx(spark, sf), windows=[(7, "d")], features=["count", "sum", "mean"]))


@query(
    "F1_velocity_ties_by_row",
    with_views("ord") + """SELECT transaction_id,
    (SELECT count(*) FROM ord b WHERE b.user_id=a.user_id AND epoch_us(b.timestamp)>epoch_us(a.timestamp)-604800000000
      AND (b.timestamp<a.timestamp OR (b.timestamp=a.timestamp AND b.transaction_id<=a.transaction_id))) AS velocity_count_7d,
    (SELECT CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) FROM ord b WHERE b.user_id=a.user_id AND epoch_us(b.timestamp)>epoch_us(a.timestamp)-604800000000
      AND (b.timestamp<a.timestamp OR (b.timestamp=a.timestamp AND b.transaction_id<=a.transaction_id))) AS velocity_sum_7d FROM ord a""",
)
def f1_rows(spark, sf):
    return velocity(V.orders_tx(spark, sf), windows=[(7, "d")], features=["count", "sum"], ties="row")


@query("F2_time_since_last", _vel_sql("tx", [], [], True))
def f2(spark, sf):
    return velocity(V.tx(spark, sf), windows=[], features=["time_since_last"])


@query("F2_time_since_last_split_users", _vel_sql("ord", [], [], True))
def f2_split(spark, sf):
    return velocity(V.orders_tx(spark, sf), windows=[], features=["time_since_last"], rule=SPLIT_ALL)


def _roll_sql() -> str:
    out = ["transaction_id"]
    for w in ("1h", "24h"):
        f = f"OVER (PARTITION BY merchant_id ORDER BY epoch_us(timestamp) RANGE BETWEEN {US[w] - 1} PRECEDING AND CURRENT ROW)"
        p = "merchant_id_amount"
        out += [
            f"count(amount) {f} AS {p}_count_{w}", f"CAST(sum(CAST(amount AS DECIMAL(18,2))) {f} AS DOUBLE) AS {p}_sum_{w}",
            f"round(CAST(sum(CAST(amount AS DECIMAL(18,2))) {f} AS DOUBLE)/count(amount) {f},6) AS {p}_mean_{w}",
            f"round(stddev_samp(amount) {f},6) AS {p}_std_{w}", f"max(amount) {f} AS {p}_max_{w}", f"min(amount) {f} AS {p}_min_{w}",
        ]
    return with_views("tx") + f"SELECT {', '.join(out)} FROM tx"


@query("F3_rolling_stats", _roll_sql())
def f3(spark, sf):
    return _rounded(
        rolling_stats(
            V.tx(spark, sf), "merchant_id", "amount", "timestamp", "transaction_id", [(1, "h"), (24, "h")],
            [*ALL_FUNCS, "max", "min"],
        )
    )


_RECENT = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, transaction_id DESC) AS rn FROM tx"


@query("F4_last_n_per_user", with_views("tx", r=_RECENT) + "SELECT transaction_id, user_id, amount FROM r WHERE rn<=30")
def f4(spark, sf):
    return Hi.last_n(V.tx(spark, sf), "user_id", ["timestamp", "transaction_id"], 30).select("transaction_id", "user_id", "amount")


@query(
    "F5_gap_per_key",
    with_views("tx") + """SELECT transaction_id, (epoch_us(timestamp)-lag(epoch_us(timestamp)) OVER (PARTITION BY merchant_id ORDER BY timestamp,transaction_id))/1e6::DOUBLE AS gap_s FROM tx""",
)
def f5(spark, sf):
    return gaps(V.tx(spark, sf), "merchant_id", "timestamp", "transaction_id")


@query(
    "F5_gap_whole_table",
    with_views("ord") + "SELECT transaction_id, (epoch_us(timestamp)-lag(epoch_us(timestamp)) OVER (ORDER BY timestamp,transaction_id))/1e6::DOUBLE AS gap_s FROM ord",
)
def f5_global(spark, sf):
    return global_gaps(V.orders_tx(spark, sf), "timestamp", "transaction_id")


_GLOB = "SELECT avg(amount) AS gm, stddev_samp(amount) AS gs, avg(hour_of_day) AS hm, stddev_samp(hour_of_day) AS hs FROM tx"
_USTATS = """SELECT user_id, count(*) AS n, avg(amount) AS am, stddev_samp(amount) AS astd, avg(hour_of_day) AS hm, stddev_samp(hour_of_day) AS hstd,
  quantile_cont(amount,0.25) AS q25, quantile_cont(amount,0.5) AS q50, quantile_cont(amount,0.75) AS q75 FROM r WHERE rn<=30 GROUP BY user_id"""
_DEV = """SELECT transaction_id,
  round((amount-am)/coalesce(nullif(astd,0),nullif(gs,0),1.0::DOUBLE),6) AS deviation_amount_zscore, round(amount/am,6) AS deviation_amount_ratio,
  round((hour_of_day-u.hm)/coalesce(nullif(hstd,0),nullif(hs,0),1.0::DOUBLE),6) AS deviation_hour_of_day_zscore,
  round(CASE WHEN u.hm<>0 THEN hour_of_day/u.hm WHEN hour_of_day=0 THEN 1.0::DOUBLE ELSE 'inf'::DOUBLE END,6) AS deviation_hour_of_day_ratio
  FROM tx JOIN u USING (user_id), g"""


def _dev(spark, sf):
    t = V.tx(spark, sf)
    feats = ["amount", "hour_of_day"]
    d = Hi.deviation(t, Hi.user_stats(t, feats), Hi.global_moments(t, feats), feats)
    cols = [c for c in d.columns if c.startswith("deviation_")]
    return d.select("transaction_id", *[F.round(c, 6).alias(c) for c in cols])


_DEV_SQL = with_views("tx", r=_RECENT, u=_USTATS, g=_GLOB) + _DEV


@query("F6_deviation", _DEV_SQL)
def f6(spark, sf):
    return _dev(spark, sf)


@query(
    "F7_deviation_full_history",
    with_views("tx", u="SELECT user_id, avg(amount) AS m, stddev_samp(amount) AS s FROM tx GROUP BY user_id")
    + """SELECT transaction_id, round((amount-m)/coalesce(nullif(s,0),1.0::DOUBLE),6) AS deviation_amount_zscore,
    round(amount/coalesce(nullif(m,0),1.0::DOUBLE),6) AS deviation_amount_ratio FROM tx JOIN u USING (user_id)""",
)
def f7(spark, sf):
    t = V.tx(spark, sf)
    stats = Hi.user_stats(t, ["amount"], window_size=None)
    d = Hi.deviation(t, stats, Hi.global_moments(t, ["amount"]), ["amount"], preset="full_history")
    return d.select(
        "transaction_id", F.round("deviation_amount_zscore", 6).alias("deviation_amount_zscore"),
        F.round("deviation_amount_ratio", 6).alias("deviation_amount_ratio"),
    )


_SEQ = """SELECT transaction_id, user_id, is_fraud AS label, list([amount, CAST(hour_of_day AS DOUBLE)]) OVER w AS s
 FROM {view} WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, transaction_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"""
_SEQ_OUT = """SELECT transaction_id, user_id, label, CAST(len(s) AS INTEGER) AS length,
 list_concat(list_transform(range(10-len(s)), lambda i: [0.0::DOUBLE,0.0::DOUBLE]), s) AS sequence FROM q WHERE len(s)>=3"""
SEQ = ["amount", "hour_of_day"]
# one row per step, so that only plain values are compared
_FLAT = "SELECT * EXCLUDE (sequence, i), CAST(i-1 AS INTEGER) AS step, sequence[i][1] AS amount, sequence[i][2] AS hour_of_day FROM (SELECT *, unnest(range(1,11)) AS i FROM {t})"
_SEQ_SQL = with_views("tx", q=_SEQ.format(view="tx"), z=_SEQ_OUT) + _FLAT.format(t="z")


def flat(seqs):
    others = [c for c in seqs.columns if c != "sequence"]
    steps = seqs.select(*others, F.posexplode("sequence").alias("step", "s"))
    return steps.select(*others, "step", F.col("s")[0].alias("amount"), F.col("s")[1].alias("hour_of_day"))


@query("F8_user_sequences", _SEQ_SQL)
def f8(spark, sf):
    return flat(Sq.user_sequences(V.tx(spark, sf), 10, SEQ))


@query("F8_user_sequences_split_users", _SEQ_SQL)
def f8_split(spark, sf):
    return flat(Sq.user_sequences(V.tx(spark, sf), 10, SEQ, rule=SPLIT_ALL, chunk_us=86_400_000_000))


@query(
    "F9_latest_sequence",
    with_views(
        "tx", q=_SEQ.format(view="tx"), z=_SEQ_OUT, r=_RECENT,
        y="SELECT z.user_id, transaction_id, length, sequence FROM z JOIN (SELECT transaction_id FROM r WHERE rn=1) USING (transaction_id)",
    ) + _FLAT.format(t="y"),
)
def f9(spark, sf):
    return flat(Sq.latest_sequences(V.tx(spark, sf), 10, SEQ))


@query(
    "F10_last_step",
    with_views("tx", q=_SEQ.format(view="tx"), z=_SEQ_OUT)
    + "SELECT transaction_id, user_id, label, length, sequence[10][1] AS amount, sequence[10][2] AS hour_of_day FROM z",
)
def f10(spark, sf):
    last = Sq.last_step(Sq.user_sequences(V.tx(spark, sf), 10, SEQ))
    return last.select(
        "transaction_id", "user_id", "label", "length", F.col("features")[0].alias("amount"), F.col("features")[1].alias("hour_of_day")
    )


_IN_TRAIN = "('0x' || substr(md5(CAST(transaction_id AS VARCHAR) || ':train'),1,13))::UBIGINT / 4503599627370496.0::DOUBLE < 0.5::DOUBLE"


@query(
    "F11_scaled_sequences",
    with_views(
        "tx", q=_SEQ.format(view="tx"), z=_SEQ_OUT,
        m="""SELECT avg(s[1]) AS m1, stddev_pop(s[1]) AS s1, avg(s[2]) AS m2, stddev_pop(s[2]) AS s2
        FROM (SELECT unnest(sequence) AS s FROM z WHERE """ + _IN_TRAIN + ")",
        y="""SELECT transaction_id, list_transform(sequence, lambda s: [round((s[1]-m1)/s1,6), round((s[2]-m2)/s2,6)]) AS sequence FROM z, m""",
    ) + _FLAT.format(t="y"),
)
def f11(spark, sf):
    seqs = Sq.user_sequences(V.tx(spark, sf), 10, SEQ)
    train = seqs.where(hash_unit(F.col("transaction_id"), "train") < 0.5)
    done = Sq.standardise_sequences(seqs, Sq.step_moments(train))
    steps = flat(done.select("transaction_id", "sequence"))
    return steps.withColumns({c: F.round(c, 6) for c in SEQ})


@query(
    "F12_importance_share",
    with_views(
        "scored",
        c="""SELECT transaction_id, 'amount' AS feature, least(amount/1500.0::DOUBLE,1.0::DOUBLE)*0.35::DOUBLE AS contribution FROM scored
        UNION ALL SELECT transaction_id, 'merchant_risk', merchant_risk*0.3::DOUBLE FROM scored
        UNION ALL SELECT transaction_id, 'velocity_1h', least(velocity_1h/20.0::DOUBLE,1.0::DOUBLE)*0.2::DOUBLE FROM scored
        UNION ALL SELECT transaction_id, 'distance_from_home', least(distance_from_home/250.0::DOUBLE,1.0::DOUBLE)*0.15::DOUBLE FROM scored""",
    )
    + "SELECT transaction_id, feature, round(abs(contribution)/sum(abs(contribution)) OVER (PARTITION BY transaction_id),6) AS share FROM c",
)
def f12(spark, sf):
    from tallyward.operators.explain import rule_terms
    from tallyward.operators.reports import importance_shares

    return importance_shares(rule_terms(V.scored(spark, sf))).select("transaction_id", "feature", F.round("share", 6).alias("share"))


# lookups and the statistics behind them

# a hash share of the keys is known when the statistics are learned, at every size
_IS_SEEN = "('0x' || substr(md5(CAST(merchant_id AS VARCHAR) || ':known'),1,13))::UBIGINT / 4503599627370496.0::DOUBLE < 0.6::DOUBLE"
_IS_KNOWN = "('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':known'),1,13))::UBIGINT / 4503599627370496.0::DOUBLE < 0.7::DOUBLE"
_SEEN = f"SELECT * FROM tx WHERE {_IS_SEEN}"
_HALF = """SELECT merchant_id, CAST(sum(is_fraud) AS BIGINT) AS f, count(*) AS n FROM seen GROUP BY merchant_id"""


@query(
    "C1_merchant_lookup",
    with_views("tx", seen=_SEEN, h=_HALF, g0="SELECT avg(is_fraud) AS g FROM seen")
    + """SELECT transaction_id, round(CASE WHEN n IS NULL THEN g ELSE 0.5::DOUBLE*g+0.5::DOUBLE*((f+1.0::DOUBLE)/(n+2.0::DOUBLE)) END,6) AS merchant_fraud_rate,
    coalesce(f,0) AS merchant_fraud_count, coalesce(n,0) AS merchant_total_count FROM tx LEFT JOIN h USING (merchant_id), g0""",
)
def c1(spark, sf):
    t = V.tx(spark, sf)
    seen = t.where(hash_unit(F.col("merchant_id"), "known") < 0.6)
    out = M.merchant_features(t, M.merchant_stats(seen), M.global_rate(seen))
    return out.select(
        "transaction_id", F.round("merchant_fraud_rate", 6).alias("merchant_fraud_rate"), "merchant_fraud_count",
        "merchant_total_count",
    )


_KNOWN = f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, transaction_id DESC) AS rn FROM tx WHERE {_IS_KNOWN}"


@query(
    "C2_user_lookup_fallback",
    with_views(
        "tx", r=_KNOWN, g=f"SELECT avg(amount) AS gm, stddev_samp(amount) AS gs FROM tx WHERE {_IS_KNOWN}",
        u="SELECT user_id, avg(amount) AS m, stddev_samp(amount) AS s FROM r WHERE rn<=30 GROUP BY user_id HAVING count(*)>=3",
    )
    + """SELECT transaction_id, round((amount-coalesce(m,gm))/coalesce(nullif(s,0),nullif(gs,0),1.0::DOUBLE),6) AS deviation_amount_zscore,
    round(amount/coalesce(m,gm),6) AS deviation_amount_ratio FROM tx LEFT JOIN u USING (user_id), g""",
)
def c2(spark, sf):
    t = V.tx(spark, sf)
    known = t.where(hash_unit(F.col("user_id"), "known") < 0.7)
    d = Hi.deviation(t, Hi.user_stats(known, ["amount"]), Hi.global_moments(known, ["amount"]), ["amount"])
    return d.select(
        "transaction_id", F.round("deviation_amount_zscore", 6).alias("deviation_amount_zscore"),
        F.round("deviation_amount_ratio", 6).alias("deviation_amount_ratio"),
    )


@query("C3_unseen_keys", with_views("tx") + f"SELECT merchant_id, count(*) AS rows FROM tx WHERE NOT {_IS_SEEN} GROUP BY merchant_id")
def c3(spark, sf):
    t = V.tx(spark, sf)
    return M.unseen_keys(t, M.merchant_stats(t.where(hash_unit(F.col("merchant_id"), "known") < 0.6)), "merchant_id")


@query(
    "C4_statistics_merge",
    with_views("tx", m="SELECT merchant_id, avg(amount) AS mean_amount, max(amount) AS max_amount, count(*) AS n FROM tx GROUP BY merchant_id")
    + "SELECT transaction_id, round(mean_amount,6) AS mean_amount, max_amount, n FROM tx JOIN m USING (merchant_id)",
)
def c4(spark, sf):
    t = V.tx(spark, sf)
    m = t.groupBy("merchant_id").agg(
        F.round(F.avg("amount"), 6).alias("mean_amount"), F.max("amount").alias("max_amount"), F.count(F.lit(1)).alias("n")
    )
    return t.join(m, "merchant_id").select("transaction_id", "mean_amount", "max_amount", "n")


@query(
    "C5_feature_union",
    with_views(
        "tx", "merch", r=_RECENT, u=_USTATS, g=_GLOB,
        v=_vel_body("tx", US, ["count", "sum", "mean"], False),
    )
    + """SELECT v.*, round((amount-am)/coalesce(nullif(astd,0),nullif(gs,0),1.0::DOUBLE),6) AS deviation_amount_zscore, round(amount/am,6) AS deviation_amount_ratio,
    round(rate,6) AS merchant_fraud_rate, fraud_count AS merchant_fraud_count, total_count AS merchant_total_count
    FROM v JOIN tx USING (transaction_id) JOIN merch USING (merchant_id) JOIN u USING (user_id), g""",
)
def c5(spark, sf):
    t = V.tx(spark, sf)
    model = FraudFeatures().fit(t)
    done = model.transform(t)
    round6 = [c for c in model.feature_names() if "mean" in c or "deviation" in c or c == "merchant_fraud_rate"]
    return done.withColumns({c: F.round(c, 6) for c in round6}).select("transaction_id", *model.feature_names())


@query(
    "C6_align_model_scores",
    with_views("scored") + """SELECT transaction_id, p AS rule, q AS amount, merchant_risk AS merchant FROM scored""",
)
def c6(spark, sf):
    from tallyward.operators.ensemble import align_scores, long_scores

    s = V.scored(spark, sf)
    long = long_scores(s, "transaction_id", {"rule": "p", "amount": "q", "merchant": "merchant_risk"})
    return align_scores(long, "transaction_id", ["rule", "amount", "merchant"])


@query(
    "D12_global_statistics",
    with_views("tx") + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(avg({c}),6) AS mean, round(stddev_samp({c}),6) AS std, round(quantile_cont({c},0.25),6) AS q25,
        round(quantile_cont({c},0.5),6) AS q50, round(quantile_cont({c},0.75),6) AS q75 FROM tx""" for c in SEQ
    ),
)
def d12(spark, sf):
    g = Hi.global_stats(V.tx(spark, sf), SEQ)
    return g.select("feature", *[F.round(c, 6).alias(c) for c in ("mean", "std", "q25", "q50", "q75")])


@query(
    "D13_user_statistics",
    with_views("tx", r=_RECENT, u=_USTATS)
    + "SELECT user_id, n, round(am,6) AS amount_mean, round(astd,6) AS amount_std, round(q25,6) AS amount_q25, round(q50,6) AS amount_q50, round(q75,6) AS amount_q75 FROM u",
)
def d13(spark, sf):
    u = Hi.user_stats(V.tx(spark, sf), ["amount"], quantiles=True)
    return u.select("user_id", "n", *[F.round(c, 6).alias(c) for c in u.columns if c.startswith("amount_")])


@query("D14_merchant_counts", with_views("tx") + "SELECT merchant_id, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, count(*) AS total_count FROM tx GROUP BY merchant_id")
def d14(spark, sf):
    return M.merchant_stats(V.tx(spark, sf)).select("merchant_id", "fraud_count", "total_count")


@query(
    "D15_smoothed_merchant_rate",
    with_views("merch") + """SELECT merchant_id, round(fraud_count/total_count,6) AS raw_rate,
    round((fraud_count+1.0::DOUBLE)/(total_count+2.0::DOUBLE),6) AS smoothed_rate, round(rate,6) AS rate FROM merch""",
)
def d15(spark, sf):
    m = M.merchant_stats(V.tx(spark, sf))
    return m.select("merchant_id", *[F.round(c, 6).alias(c) for c in ("raw_rate", "smoothed_rate", "rate")])


@query(
    "D16_m_estimate_encoding",
    with_views("merch") + "SELECT merchant_id, round((fraud_count+g*10)/(total_count+10),6) AS rate FROM merch, grate",
)
def d16(spark, sf):
    m = M.merchant_stats(V.tx(spark, sf), preset="m_estimate")
    return m.select("merchant_id", F.round("rate", 6).alias("rate"))


@query(
    "D10_rate_by_merchant_risk",
    with_views("merch") + """SELECT CASE WHEN rate>0 AND rate<=0.01::DOUBLE THEN 'Low' WHEN rate>0.01::DOUBLE AND rate<=0.05::DOUBLE THEN 'Medium'
    WHEN rate>0.05::DOUBLE AND rate<=1 THEN 'High' END AS bin, count(*) AS merchants FROM merch GROUP BY 1""",
)
def merchants_by_risk(spark, sf):
    from tallyward.functions.columns import MERCHANT_RISK_LABELS, right_closed_bin

    m = M.merchant_stats(V.tx(spark, sf))
    b = right_closed_bin(F.col("rate"), MERCHANT_RISK_EDGES, MERCHANT_RISK_LABELS)
    return m.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("merchants"))
