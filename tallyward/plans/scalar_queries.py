"""Projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.functions import columns as C
from tallyward.functions import hashing as H
from tallyward.functions import scoring as S
from tallyward.operators.ordering import exact_quantiles
from tallyward.operators.outcomes import failures, with_outcome
from tallyward.plans import views as V
from tallyward.plans.registry import query
from tallyward.plans.views import half_up, with_views

D = "::DOUBLE"


@query(
    "B1_hour_from_elapsed",
    """SELECT event_id AS transaction_id, CAST(floor(epoch_us(ts)/1000000.0::DOUBLE/3600.0::DOUBLE)::BIGINT % 24 AS INTEGER) AS hour FROM events""",
)
def hour_from_elapsed(spark, sf):
    seconds = F.unix_micros(F.col("timestamp")) / F.lit(1e6)
    return V.tx(spark, sf).select("transaction_id", C.hour_from_elapsed(seconds).alias("hour"))


@query("B2_log_amount", with_views("tx") + "SELECT transaction_id, round(ln(1+amount),6) AS log_amount FROM tx")
def log_amount(spark, sf):
    return V.tx(spark, sf).select("transaction_id", F.round(C.log_amount(F.col("amount")), 6).alias("log_amount"))


@query("B3_label_as_int", "SELECT doc_id, CAST(quality AS INTEGER) AS label FROM labels")
def label_as_int(spark, sf):
    return V.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").cast("int").alias("label"))


@query("B4_hour_of_timestamp", "SELECT event_id AS transaction_id, CAST(hour(ts) AS INTEGER) AS hour_of_day FROM events")
def hour_of_timestamp(spark, sf):
    return V.tx(spark, sf).select("transaction_id", "hour_of_day")


@query(
    "B5_lenient_timestamp",
    """SELECT o_orderkey AS transaction_id, CASE WHEN o_orderstatus='P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS parsed FROM orders""",
)
def lenient_timestamp(spark, sf):
    day = F.date_format(F.col("o_orderdate").cast("timestamp"), "dd/MM/yyyy")
    text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("bad "), day)).otherwise(day)
    return V.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.date_format(C.parse_timestamp(text, "dd/MM/yyyy"), "yyyy-MM-dd HH:mm:ss").alias("parsed")
    )


@query(
    "B6_default_for_unseen",
    "SELECT doc_id, coalesce(quality,0) AS quality FROM documents LEFT JOIN labels USING (doc_id)",
)
def default_for_unseen(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id").join(V.table(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", C.default_for_missing(F.col("quality"), 0).alias("quality"))


@query(
    "B7_clamp_probability",
    with_views("tx") + "SELECT transaction_id, greatest(0.0::DOUBLE,least(1.0::DOUBLE," + half_up("amount/300.0::DOUBLE-0.2::DOUBLE", 4) + ")) AS p FROM tx",
)
def clamp_probability(spark, sf):
    return V.tx(spark, sf).select("transaction_id", S.clamp_probability(F.col("amount") / 300.0 - 0.2).alias("p"))


@query("B8_format_probability", with_views("tx") + "SELECT transaction_id, " + half_up("amount/500.0::DOUBLE", 2) + " AS p FROM tx")
def format_probability(spark, sf):
    return V.tx(spark, sf).select("transaction_id", S.format_probability(F.col("amount") / 500.0, 2).alias("p"))


def _tier_sql(value: str, preset: str) -> str:
    steps, rest = S.TIERS[preset]
    return "CASE " + " ".join(f"WHEN {value}>={b}::DOUBLE THEN '{n}'" for b, n in steps) + f" ELSE '{rest}' END"


def _tier_query(key: str, preset: str, value_sql: str):
    @query(key, with_views("tx") + f"SELECT transaction_id, {value_sql.format(_tier_sql('amount/500.0::DOUBLE', preset))} AS tier FROM tx")
    def tier(spark, sf):
        return V.tx(spark, sf).select("transaction_id", S.risk_tier(F.col("amount") / 500.0, preset).alias("tier"))


_tier_query("B9_tier_core", "core", "{}")
_tier_query("B10_tier_scoring", "scoring", "CASE WHEN amount/500.0::DOUBLE BETWEEN 0 AND 1 THEN {} END")
_tier_query("B11_level_report", "report", "{}")
_tier_query("B12_tier_config", "config", "{}")


@query(
    "B13_impact_level",
    with_views("tx") + """SELECT transaction_id, CASE WHEN amount/500.0::DOUBLE>0.5::DOUBLE THEN 'Very High' WHEN amount/500.0::DOUBLE>0.3::DOUBLE THEN 'High'
    WHEN amount/500.0::DOUBLE>0.1::DOUBLE THEN 'Medium' WHEN amount/500.0::DOUBLE>0.05::DOUBLE THEN 'Low' ELSE 'Very Low' END AS impact FROM tx""",
)
def impact(spark, sf):
    return V.tx(spark, sf).select("transaction_id", S.impact_level(F.col("amount") / 500.0).alias("impact"))


@query("B14_rule_score", with_views("scored") + "SELECT transaction_id, p FROM scored")
def rule_score(spark, sf):
    return V.scored_from(V.tx(spark, sf)).select("transaction_id", "p")


# o_totalprice is far above every amount bound; customers' balances give a spread of values
_WIDE_SQL = """SELECT o_orderkey AS transaction_id, c_acctbal/10.0::DOUBLE AS amount, c_acctbal/8000.0::DOUBLE AS merchant_risk,
  CAST(c_nationkey AS DOUBLE) AS velocity_1h, c_acctbal % 250.0::DOUBLE AS distance_from_home
  FROM orders JOIN customer ON o_custkey=c_custkey"""
_WIDE_RAW = """least(amount/1500.0::DOUBLE,1.0::DOUBLE)*0.35::DOUBLE+merchant_risk*0.3::DOUBLE
  +least(velocity_1h/20.0::DOUBLE,1.0::DOUBLE)*0.2::DOUBLE+least(distance_from_home/250.0::DOUBLE,1.0::DOUBLE)*0.15::DOUBLE"""


def _wide(spark, sf):
    o, c = V.table(spark, sf, "orders"), V.table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("transaction_id"), (F.col("c_acctbal") / 10.0).alias("amount"),
        (F.col("c_acctbal") / 8000.0).alias("merchant_risk"), F.col("c_nationkey").cast("double").alias("velocity_1h"),
        (F.col("c_acctbal") % 250.0).alias("distance_from_home"),
    )


@query(
    "B15_reasons",
    f"""WITH w AS ({_WIDE_SQL}), r AS (SELECT transaction_id, concat_ws('|', CASE WHEN amount>=500 THEN 'high_amount' END,
    CASE WHEN merchant_risk>=0.6::DOUBLE THEN 'merchant_risk' END, CASE WHEN velocity_1h>=6 THEN 'high_velocity' END,
    CASE WHEN distance_from_home>=80 THEN 'distance_from_home' END) AS r FROM w)
    SELECT transaction_id, CASE WHEN r='' THEN 'baseline_pattern' ELSE r END AS reasons FROM r""",
)
def reasons(spark, sf):
    return _wide(spark, sf).select("transaction_id", F.concat_ws("|", S.reasons()).alias("reasons"))


@query(
    "B16_decision",
    f"""WITH w AS ({_WIDE_SQL}), r AS (SELECT transaction_id, greatest(0.0::DOUBLE,least(1.0::DOUBLE,{half_up(_WIDE_RAW, 4)})) AS p FROM w)
    SELECT transaction_id, p, CASE WHEN p>=0.5::DOUBLE THEN 'fraud' ELSE 'legitimate' END AS prediction FROM r""",
)
def decision(spark, sf):
    p = S.clamp_probability(S.rule_score())
    return _wide(spark, sf).select("transaction_id", p.alias("p"), S.decision(p).alias("prediction"))


@query(
    "B17_predict_by_threshold",
    with_views("scored", t="SELECT quantile_cont(p,0.9) AS t FROM scored")
    + "SELECT transaction_id, CAST(p>=t AS INTEGER) AS predicted FROM scored, t",
)
def predict_by_threshold(spark, sf):
    s = V.scored(spark, sf)
    cut = exact_quantiles(s, ["p"], [0.9]).select("value").scalar()
    return s.select("transaction_id", S.over_threshold(F.col("p"), cut).alias("predicted"))


@query(
    "B18_blend_columns",
    with_views("scored", b="SELECT transaction_id, round(p*0.6::DOUBLE,6) AS a, round(q*0.4::DOUBLE,6) AS b FROM scored")
    + "SELECT transaction_id, round(a+b,6) AS score, a AS part_rule, b AS part_amount FROM b",
)
def blend_columns(spark, sf):
    s = V.scored(spark, sf)
    score, parts = S.blend(
        {"rule": F.col("p"), "amount": F.col("q"), "merchant": F.col("merchant_risk"), "unweighted": F.col("p")},
        {"rule": 3.0, "amount": 2.0, "merchant": -1.0},
    )
    return s.select(
        "transaction_id", score.alias("score"), parts["rule"].alias("part_rule"), parts["amount"].alias("part_amount")
    )


@query(
    "B18_blend_map",
    with_views("scored", b="SELECT transaction_id, round(p*(1.0::DOUBLE/2.0::DOUBLE),6) AS a, round(q*(1.0::DOUBLE/2.0::DOUBLE),6) AS b FROM scored")
    + """SELECT transaction_id, round(b+a,6) AS score, a AS part_rule, b AS part_amount,
    CAST(b+a>=0.5::DOUBLE AS INTEGER) AS label FROM b""",
)
def blend_map(spark, sf):
    scores = F.create_map(F.lit("amount"), F.col("q"), F.lit("rule"), F.col("p"))
    b = V.scored(spark, sf).select("transaction_id", S.blend_map(scores).alias("b"))
    return b.select(
        "transaction_id", F.col("b.score").alias("score"), F.col("b.contributions")["rule"].alias("part_rule"),
        F.col("b.contributions")["amount"].alias("part_amount"), F.col("b.label").alias("label"),
    )


_JSON_SQL = """'{"amount": ' || CAST(amount AS VARCHAR) || ', "merchant_id": ' || CAST(merchant_id AS VARCHAR) || ', "user_id": ' || CAST(user_id AS VARCHAR) || '}'"""


def _fields():
    return {
        "user_id": F.col("user_id").cast("string"), "merchant_id": F.col("merchant_id").cast("string"),
        "amount": H.json_number(F.col("amount")),
    }


@query("B19_fingerprint", with_views("tx") + f"SELECT transaction_id, substr(sha256({_JSON_SQL}),1,16) AS fingerprint FROM tx")
def fingerprint(spark, sf):
    return V.tx(spark, sf).select("transaction_id", H.fingerprint(_fields()).alias("fingerprint"))


@query(
    "B20_prediction_key",
    with_views("tx") + f"SELECT transaction_id, 'prediction:' || transaction_id || ':' || substr(sha256({_JSON_SQL}),1,16) AS key FROM tx",
)
def prediction_key(spark, sf):
    key = H.prediction_key(F.col("transaction_id"), H.fingerprint(_fields()))
    return V.tx(spark, sf).select("transaction_id", key.alias("key"))


@query(
    "B21_amount_bins",
    with_views("tx") + """SELECT transaction_id, CASE WHEN amount>0 AND amount<=10 THEN '(0, 10]' WHEN amount>10 AND amount<=50 THEN '(10, 50]'
    WHEN amount>50 AND amount<=100 THEN '(50, 100]' WHEN amount>100 AND amount<=500 THEN '(100, 500]' WHEN amount>500 THEN '(500, inf]' END AS bin,
    CAST(CASE WHEN amount>0 AND amount<=10 THEN 1 WHEN amount>10 AND amount<=50 THEN 2 WHEN amount>50 AND amount<=100 THEN 3
    WHEN amount>100 AND amount<=500 THEN 4 WHEN amount>500 THEN 5 END AS INTEGER) AS bin_order FROM tx""",
)
def amount_bins(spark, sf):
    b = C.right_closed_bin(F.col("amount"), C.AMOUNT_EDGES)
    return V.tx(spark, sf).select(
        "transaction_id", b.alias("bin"), C.bin_order(b, C.AMOUNT_EDGES).alias("bin_order")
    )


@query(
    "B22_merchant_risk_bins",
    with_views("tx") + """SELECT transaction_id, CASE WHEN amount/2000.0::DOUBLE>0 AND amount/2000.0::DOUBLE<=0.01::DOUBLE THEN 'Low'
    WHEN amount/2000.0::DOUBLE>0.01::DOUBLE AND amount/2000.0::DOUBLE<=0.05::DOUBLE THEN 'Medium' WHEN amount/2000.0::DOUBLE>0.05::DOUBLE AND amount/2000.0::DOUBLE<=1 THEN 'High' END AS bin FROM tx""",
)
def merchant_risk_bins(spark, sf):
    b = C.right_closed_bin(F.col("amount") / 2000.0, C.MERCHANT_RISK_EDGES, C.MERCHANT_RISK_LABELS)
    return V.tx(spark, sf).select("transaction_id", b.alias("bin"))


def _readable_sql(col: str) -> str:
    words = (
        f"array_to_string(list_transform(list_filter(string_split({col},'_'), lambda x: x<>''), "
        "lambda x: upper(x[1]) || lower(x[2:])), ' ')"
    )
    for a, b in C.ABBREVIATIONS.items():
        words = f"replace({words},'{a}','{b}')"
    return words


_NAME_SQL = """SELECT DISTINCT 'avg_txn_amt_30d_' || lower(n_name) || '_num' AS feature FROM nation
 UNION SELECT DISTINCT 'max_' || lower(p_type) || '_std_24h' FROM part"""


def _feature_names(spark, sf):
    n = V.table(spark, sf, "nation").select(F.concat(F.lit("avg_txn_amt_30d_"), F.lower("n_name"), F.lit("_num")).alias("feature"))
    p = V.table(spark, sf, "part").select(F.concat(F.lit("max_"), F.lower("p_type"), F.lit("_std_24h")).alias("feature"))
    return n.union(p).distinct()


@query("B23_readable_names", f"WITH f AS ({_NAME_SQL}) SELECT feature, {_readable_sql('feature')} AS readable FROM f")
def readable_names(spark, sf):
    return _feature_names(spark, sf).select("feature", C.readable_name(F.col("feature")).alias("readable"))


@query(
    "B24_description_mapping",
    f"""WITH f AS ({_NAME_SQL}), o AS (SELECT DISTINCT 'max_' || lower(p_type) || '_std_24h' AS feature, 'Spread of ' || p_type AS d FROM part)
    SELECT feature, coalesce(d, {_readable_sql('feature')}) AS description FROM f LEFT JOIN o USING (feature)""",
)
def description_mapping(spark, sf):
    from tallyward.operators.reports import describe_features

    custom = V.table(spark, sf, "part").select(
        F.concat(F.lit("max_"), F.lower("p_type"), F.lit("_std_24h")).alias("feature"),
        F.concat(F.lit("Spread of "), "p_type").alias("description"),
    ).distinct()
    return describe_features(_feature_names(spark, sf), custom)


@query(
    "B25_display_text",
    """SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) AS currency, format('{:,}', o_custkey*1000) AS number,
    printf('%.1f%%', round(o_totalprice/600000.0::DOUBLE*100.0::DOUBLE,1)) AS percent FROM orders""",
)
def display_text(spark, sf):
    return V.table(spark, sf, "orders").select(
        "o_orderkey", C.currency_text(F.col("o_totalprice")).alias("currency"),
        C.number_text(F.col("o_custkey") * 1000, integer=True).alias("number"),
        C.percent_text(F.col("o_totalprice") / 600000.0).alias("percent"),
    )


@query("B26_amount_range", with_views("tx") + "SELECT transaction_id, amount FROM tx WHERE amount BETWEEN 50 AND 150")
def amount_range(spark, sf):
    return V.tx(spark, sf).where(F.col("amount").between(50, 150)).select("transaction_id", "amount")


@query("B27_one_class", with_views("tx") + "SELECT transaction_id, amount FROM tx WHERE is_fraud=0")
def one_class(spark, sf):
    return V.tx(spark, sf).where(F.col("is_fraud") == 0).select("transaction_id", "amount")


_OUTCOME_SQL = with_views(
    "tx",
    o="""SELECT transaction_id, is_fraud AS label, amount AS score, CAST(amount>=100 AS INTEGER) AS predicted,
    CASE WHEN amount>=100 THEN CASE WHEN is_fraud=1 THEN 'TP' ELSE 'FP' END ELSE CASE WHEN is_fraud=1 THEN 'FN' ELSE 'TN' END END AS outcome FROM tx""",
)


def _as_scored(spark, sf):
    return V.tx(spark, sf).select("transaction_id", F.col("is_fraud").alias("label"), F.col("amount").alias("score"))


@query("B28_outcome_type", _OUTCOME_SQL + "SELECT * FROM o")
def outcome_types(spark, sf):
    return with_outcome(_as_scored(spark, sf), 100.0)


@query("B29_failures_only", _OUTCOME_SQL + "SELECT * FROM o WHERE outcome IN ('FP','FN')")
def failures_only(spark, sf):
    return failures(_as_scored(spark, sf), 100.0)


@query(
    "B30_rule_points",
    with_views("ord") + """SELECT transaction_id, CASE WHEN amount>250000 THEN 2.0::DOUBLE ELSE 0 END + CASE WHEN merchant_id<5 THEN 1.5::DOUBLE ELSE 0 END
    + CASE WHEN is_fraud=1 THEN 1.0::DOUBLE ELSE 0 END AS points FROM ord""",
)
def rule_points(spark, sf):
    rules = [(F.col("amount") > 250000, 2.0), (F.col("merchant_id") < 5, 1.5), (F.col("is_fraud") == 1, 1.0)]
    return V.orders_tx(spark, sf).select("transaction_id", S.rule_points(rules).alias("points"))


_Z = "(-3.0::DOUBLE+amount/100.0::DOUBLE*0.8::DOUBLE+hour_of_day*0.05::DOUBLE)"


def _z():
    return S.logit(
        {"a": F.col("amount") / 100.0, "h": F.col("hour_of_day").cast("double")}, {"a": 0.8, "h": 0.05}, -3.0
    )


@query("B31_logistic_score", with_views("tx") + f"SELECT transaction_id, round(1.0::DOUBLE/(1.0::DOUBLE+exp(-{_Z})),6) AS score FROM tx")
def logistic_score(spark, sf):
    return V.tx(spark, sf).select("transaction_id", F.round(S.logistic(_z()), 6).alias("score"))


@query(
    "B32_top_fraction_label",
    with_views("tx", c="SELECT quantile_cont(amount,0.98) AS c FROM tx")
    + "SELECT transaction_id, CAST(amount>c AS INTEGER) AS label_strict, CAST(amount>=c AS INTEGER) AS label FROM tx, c",
)
def top_fraction_label(spark, sf):
    t = V.tx(spark, sf)
    cut = exact_quantiles(t, ["amount"], [0.98]).select("value").scalar()
    return t.select(
        "transaction_id", (F.col("amount") > cut).cast("int").alias("label_strict"),
        (F.col("amount") >= cut).cast("int").alias("label"),
    )


_BCE = f"(greatest({_Z},0.0::DOUBLE)-{_Z}*is_fraud+ln(1+exp(-abs({_Z}))))"
_PT = f"CASE WHEN is_fraud=1 THEN 1.0::DOUBLE/(1.0::DOUBLE+exp(-{_Z})) ELSE 1.0::DOUBLE-1.0::DOUBLE/(1.0::DOUBLE+exp(-{_Z})) END"
_FL = f"(CASE WHEN is_fraud=1 THEN 0.25::DOUBLE ELSE 0.75::DOUBLE END*pow(1.0::DOUBLE-({_PT}),2)*{_BCE})"


@query("B33_focal_loss_rows", with_views("tx") + f"SELECT transaction_id, round({_FL},6) AS loss FROM tx")
def focal_rows(spark, sf):
    return V.tx(spark, sf).select("transaction_id", F.round(S.focal_loss(_z(), F.col("is_fraud")), 6).alias("loss"))


@query("B33_focal_loss_reduced", with_views("tx") + f"SELECT round(avg({_FL}),6) AS mean_loss, round(sum({_FL}),4) AS sum_loss FROM tx")
def focal_reduced(spark, sf):
    loss = S.focal_loss(_z(), F.col("is_fraud"))
    return V.tx(spark, sf).agg(F.round(F.avg(loss), 6).alias("mean_loss"), F.round(F.sum(loss), 4).alias("sum_loss"))


@query(
    "B34_weighted_bce",
    with_views("tx", w="SELECT count(*)/(2.0::DOUBLE*sum(1-is_fraud)) AS w0, count(*)/(2.0::DOUBLE*sum(is_fraud)) AS w1 FROM tx")
    + f"SELECT transaction_id, round(CASE WHEN is_fraud=1 THEN w1 ELSE w0 END*{_BCE},6) AS loss FROM tx, w",
)
def weighted_bce(spark, sf):
    from tallyward.operators.balance import class_weights

    t = V.tx(spark, sf)
    w = class_weights(t, "is_fraud").select(F.struct("weight_0", "weight_1").alias("w")).scalar()
    loss = S.weighted_bce(_z(), F.col("is_fraud"), F.col("w.weight_0"), F.col("w.weight_1"))
    return t.withColumn("w", w).select("transaction_id", F.round(loss, 6).alias("loss"))
