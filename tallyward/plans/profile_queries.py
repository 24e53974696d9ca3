"""Exploration, balance, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators import balance as B
from tallyward.operators import profile as P
from tallyward.operators import scaling as Sc
from tallyward.operators.explain import rule_terms
from tallyward.operators.reports import top_per_row
from tallyward.plans import views as V
from tallyward.plans.registry import query
from tallyward.plans.views import LINE_FEATURES, with_views

HASH = "(('0x' || substr(md5(CAST({k} AS VARCHAR) || ':{s}'),1,13))::UBIGINT / 4503599627370496.0::DOUBLE)"


@query(
    "D1_class_distribution",
    with_views("tx") + """SELECT CAST(c AS INTEGER) AS class, count(*) FILTER (is_fraud=c) AS count, round(count(*) FILTER (is_fraud=c)*100.0::DOUBLE/count(*),2) AS percent
    FROM tx, (VALUES (0),(1)) v(c) GROUP BY c""",
)
def d1(spark, sf):
    return B.class_distribution(V.tx(spark, sf), "is_fraud")


@query(
    "D2_imbalance_ratio",
    with_views("tx") + """SELECT count(*) FILTER (is_fraud=0) AS legitimate, count(*) FILTER (is_fraud=1) AS fraud,
    round(count(*) FILTER (is_fraud=0)/count(*) FILTER (is_fraud=1),6) AS ratio FROM tx""",
)
def d2(spark, sf):
    return B.imbalance_ratio(V.tx(spark, sf), "is_fraud").withColumn("ratio", F.round("ratio", 6))


def _summary_sql(where: str) -> str:
    money = "CAST(sum(CAST(amount AS DECIMAL(18,2))) {} AS DOUBLE)"
    f1, f0 = "FILTER (is_fraud=1)", "FILTER (is_fraud=0)"
    return with_views("ord") + f"""SELECT count(*) AS total, count(*) {f1} AS fraud, count(*) {f0} AS legitimate,
    round(count(*) {f1}*100.0::DOUBLE/count(*),2) AS fraud_percent, {money.format('')} AS total_amount, round({money.format('')}/count(*),6) AS avg_amount,
    round({money.format(f1)}/count(*) {f1},6) AS avg_fraud_amount, round({money.format(f0)}/count(*) {f0},6) AS avg_legitimate_amount, CAST(4 AS INTEGER) AS features FROM ord {where}"""


def _round_avg(df):
    return df.withColumns({c: F.round(c, 6) for c in ("avg_amount", "avg_fraud_amount", "avg_legitimate_amount")})


@query("D3_summary", _summary_sql(""))
def d3(spark, sf):
    return _round_avg(P.summary(V.orders_tx(spark, sf), "is_fraud", "amount", 4))


@query("D4_range_summary", _summary_sql("WHERE amount BETWEEN 100000 AND 200000"))
def d4(spark, sf):
    return _round_avg(P.range_summary(V.orders_tx(spark, sf), "is_fraud", "amount", 4, 100000, 200000))


def _hist_sql(view: str, value: str, by: str, bins: int) -> str:
    return with_views(
        view, e=f"SELECT min({value}) AS lo, max({value}) AS hi FROM {view}",
        b=f"""SELECT {by}, CAST(least(floor(({value}-lo)/((hi-lo)/{bins}.0::DOUBLE)),{bins - 1}) AS INTEGER) AS bin, lo, (hi-lo)/{bins}.0::DOUBLE AS w FROM {view}, e""",
    ) + f"SELECT {by}, bin, round(lo+bin*w,6) AS low, round(lo+(bin+1)*w,6) AS high, count(*) AS count FROM b GROUP BY {by}, bin, lo, w"


def _round_edges(df):
    return df.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query("D5_amount_histogram", _hist_sql("tx", "amount", "is_fraud", 50))
def d5(spark, sf):
    return _round_edges(P.histogram(V.tx(spark, sf), "amount", ["is_fraud"], 50))


@query("D5_amount_histogram_log", _hist_sql("tx", "ln(1+amount)", "is_fraud", 50))
def d5_log(spark, sf):
    return _round_edges(P.histogram(V.tx(spark, sf), "amount", ["is_fraud"], 50, log=True))


@query(
    "D6_score_histogram_by_outcome",
    with_views(
        "scored",
        o="SELECT p, CASE WHEN p>=0.15::DOUBLE THEN CASE WHEN is_fraud=1 THEN 'TP' ELSE 'FP' END ELSE CASE WHEN is_fraud=1 THEN 'FN' ELSE 'TN' END END AS outcome FROM scored",
        e="SELECT min(p) AS lo, max(p) AS hi FROM o",
        b="SELECT outcome, CAST(least(floor((p-lo)/((hi-lo)/30.0::DOUBLE)),29) AS INTEGER) AS bin, lo, (hi-lo)/30.0::DOUBLE AS w FROM o, e",
    ) + "SELECT outcome, bin, round(lo+bin*w,6) AS low, round(lo+(bin+1)*w,6) AS high, count(*) AS count FROM b GROUP BY outcome, bin, lo, w",
)
def d6(spark, sf):
    from tallyward.operators.outcomes import with_outcome

    o = with_outcome(V.scored(spark, sf), 0.15, "is_fraud", "p")
    return _round_edges(P.histogram(o, "p", ["outcome"], 30))


_CORR_COLS = [*LINE_FEATURES, "label"]


@query(
    "D7_correlation_matrix",
    with_views("line") + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, " + ("1.0::DOUBLE" if a == b else f"round(corr({a},{b}),6)") + " AS corr FROM "
        + ("(SELECT 1)" if a == b else "line") for a in _CORR_COLS for b in _CORR_COLS
    ),
)
def d7(spark, sf):
    return P.correlations(V.line(spark, sf), _CORR_COLS).withColumn("corr", F.round("corr", 6))


@query(
    "D8_label_correlation",
    with_views("vec", c=" UNION ALL ".join(f"SELECT 'V{i}' AS feature, corr(features[{i}],label) AS corr FROM vec" for i in range(1, 65)))
    + "SELECT feature, round(corr,6) AS corr FROM c ORDER BY c.corr DESC, feature LIMIT 10",
)
def d8(spark, sf):
    """Top ten of all 64 embedding dimensions by correlation with the label."""
    wide = V.vec(spark, sf).select(*[F.col("features")[i].alias(f"V{i + 1}") for i in range(64)], "label")
    top = P.label_correlations(wide, [f"V{i}" for i in range(1, 65)], "label", 10)
    return top.withColumn("corr", F.round("corr", 6))


@query(
    "D9_rate_by_hour",
    with_views("tx") + """SELECT hour_of_day AS hour, count(*) AS total, count(*) FILTER (is_fraud=1) AS fraud,
    round(count(*) FILTER (is_fraud=1)*100.0::DOUBLE/count(*),6) AS fraud_rate FROM tx GROUP BY 1""",
)
def d9(spark, sf):
    r = P.rates_by(V.tx(spark, sf), F.col("hour_of_day"), "hour", "is_fraud")
    return r.withColumn("fraud_rate", F.round("fraud_rate", 6))


@query(
    "D10_rate_by_amount",
    with_views("tx") + """SELECT CASE WHEN amount>0 AND amount<=10 THEN '(0, 10]' WHEN amount>10 AND amount<=50 THEN '(10, 50]'
    WHEN amount>50 AND amount<=100 THEN '(50, 100]' WHEN amount>100 AND amount<=500 THEN '(100, 500]' WHEN amount>500 THEN '(500, inf]' END AS bin,
    count(*) AS total, count(*) FILTER (is_fraud=1) AS fraud, round(count(*) FILTER (is_fraud=1)*100.0::DOUBLE/count(*),6) AS fraud_rate FROM tx GROUP BY 1""",
)
def d10(spark, sf):
    return P.rates_by_amount(V.tx(spark, sf), "amount", "is_fraud").withColumn("fraud_rate", F.round("fraud_rate", 6))


@query(
    "D11_amount_by_class",
    with_views("tx") + "SELECT is_fraud, round(quantile_cont(amount,0.5),6) AS median, max(amount) AS max, round(avg(amount),6) AS mean FROM tx GROUP BY is_fraud",
)
def d11(spark, sf):
    a = P.amount_by_class(V.tx(spark, sf), "amount", "is_fraud")
    return a.select("is_fraud", F.round("median", 6).alias("median"), "max", F.round("mean", 6).alias("mean"))


@query(
    "D17_class_weights",
    with_views("tx") + "SELECT round(count(*)/(2.0::DOUBLE*count(*) FILTER (is_fraud=0)),6) AS weight_0, round(count(*)/(2.0::DOUBLE*count(*) FILTER (is_fraud=1)),6) AS weight_1 FROM tx",
)
def d17(spark, sf):
    w = B.class_weights(V.tx(spark, sf), "is_fraud")
    return w.select(F.round("weight_0", 6).alias("weight_0"), F.round("weight_1", 6).alias("weight_1"))


@query(
    "D17_weight_column",
    with_views("tx", w="SELECT count(*)/(2.0::DOUBLE*count(*) FILTER (is_fraud=0)) AS w0, count(*)/(2.0::DOUBLE*count(*) FILTER (is_fraud=1)) AS w1 FROM tx")
    + "SELECT transaction_id, round(CASE WHEN is_fraud=1 THEN w1 ELSE w0 END,6) AS weight FROM tx, w",
)
def d17_column(spark, sf):
    return B.with_class_weight(V.tx(spark, sf), "is_fraud").select("transaction_id", F.round("weight", 6).alias("weight"))


@query("D18_positive_weight", with_views("tx") + "SELECT round(count(*) FILTER (is_fraud=0)/count(*) FILTER (is_fraud=1),6) AS positive_weight FROM tx")
def d18(spark, sf):
    return B.positive_weight(V.tx(spark, sf), "is_fraud").select(F.round("positive_weight", 6).alias("positive_weight"))


@query(
    "D27_any_fraud_in_group",
    "SELECT o_custkey, max(CAST(o_orderstatus='P' AS INTEGER)) AS label FROM orders GROUP BY o_custkey",
)
def d27(spark, sf):
    o = V.table(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(F.max((F.col("o_orderstatus") == "P").cast("int")).alias("label"))


# ordering, top-k, sets

_TERMS = """SELECT transaction_id, 'amount' AS feature, least(amount/1500.0::DOUBLE,1.0::DOUBLE)*0.35::DOUBLE AS contribution FROM scored
 UNION ALL SELECT transaction_id, 'merchant_risk', merchant_risk*0.3::DOUBLE FROM scored
 UNION ALL SELECT transaction_id, 'velocity_1h', least(velocity_1h/20.0::DOUBLE,1.0::DOUBLE)*0.2::DOUBLE FROM scored
 UNION ALL SELECT transaction_id, 'distance_from_home', least(distance_from_home/250.0::DOUBLE,1.0::DOUBLE)*0.15::DOUBLE FROM scored"""


@query(
    "G1_top_factors_per_row",
    with_views("scored", c=_TERMS, r="SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY abs(contribution) DESC, feature) AS rank FROM c")
    + "SELECT transaction_id, string_agg(feature,'|' ORDER BY rank) AS factors FROM r WHERE rank<=3 GROUP BY transaction_id",
)
def g1(spark, sf):
    from tallyward.operators.explain import top_factors

    return V.scored(spark, sf).select("transaction_id", F.concat_ws("|", top_factors(3)).alias("factors"))


@query(
    "G2_top_contributions",
    with_views("scored", c=_TERMS, r="SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY abs(contribution) DESC, feature) AS rank FROM c")
    + "SELECT transaction_id, feature, round(contribution,6) AS contribution, CAST(rank AS INTEGER) AS rank FROM r WHERE rank<=5",
)
def g2(spark, sf):
    top = top_per_row(rule_terms(V.scored(spark, sf)), 5)
    return top.select("transaction_id", "feature", F.round("contribution", 6).alias("contribution"), "rank")


_IMPORTANCE = "SELECT feature, avg(abs(contribution)) AS importance FROM c GROUP BY feature"


@query(
    "G3_select_top_features",
    with_views("scored", c=_TERMS, i=_IMPORTANCE) + "SELECT feature, round(importance,6) AS importance FROM i ORDER BY i.importance DESC, feature LIMIT 2",
)
def g3(spark, sf):
    from tallyward.operators.explain import global_importance, select_features

    chosen = select_features(global_importance(rule_terms(V.scored(spark, sf))), n=2)
    return chosen.withColumn("importance", F.round("importance", 6))


@query(
    "G3_select_by_threshold",
    with_views("scored", c=_TERMS, i=_IMPORTANCE) + "SELECT feature, round(importance,6) AS importance FROM i WHERE importance>=0.03::DOUBLE",
)
def g3_threshold(spark, sf):
    from tallyward.operators.explain import global_importance, select_features

    chosen = select_features(global_importance(rule_terms(V.scored(spark, sf))), n=2, threshold=0.03)
    return chosen.withColumn("importance", F.round("importance", 6))


@query("G5_fixed_sample", with_views("tx") + f"SELECT transaction_id, amount FROM tx ORDER BY {HASH.format(k='transaction_id', s='sample:42')}, transaction_id LIMIT 5000")
def g5(spark, sf):
    return P.sample_rows(V.tx(spark, sf).select("transaction_id", "amount"), 5000, "transaction_id")


@query("G5_share_sample", with_views("tx") + f"SELECT transaction_id, amount FROM tx WHERE {HASH.format(k='transaction_id', s='sample_share:42')}<0.1::DOUBLE")
def g5_share(spark, sf):
    return P.sample_share(V.tx(spark, sf).select("transaction_id", "amount"), 0.1, "transaction_id")


@query(
    "G8_common_keys",
    "SELECT o_custkey AS k, 'both' AS side FROM orders WHERE o_custkey IN (SELECT user_id FROM events) GROUP BY o_custkey",
)
def g8_common(spark, sf):
    a = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    b = V.table(spark, sf, "events").select(F.col("user_id").alias("k"))
    return a.intersect(b).withColumn("side", F.lit("both"))


@query(
    "G8_symmetric_difference",
    """SELECT k, 'orders' AS side FROM (SELECT o_custkey AS k FROM orders EXCEPT SELECT user_id FROM events)
    UNION ALL SELECT k, 'events' FROM (SELECT user_id AS k FROM events EXCEPT SELECT o_custkey FROM orders)""",
)
def g8_difference(spark, sf):
    a = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    b = V.table(spark, sf, "events").select(F.col("user_id").alias("k"))
    return a.subtract(b).withColumn("side", F.lit("orders")).unionByName(b.subtract(a).withColumn("side", F.lit("events")))


@query(
    "G8_feature_sets",
    """WITH a AS (SELECT c_nationkey AS g, list(DISTINCT c_mktsegment) AS s FROM customer GROUP BY 1),
    b AS (SELECT c_nationkey AS g, list(DISTINCT c_mktsegment) AS s FROM customer JOIN orders ON c_custkey=o_custkey WHERE o_orderstatus='P' AND o_totalprice>400000 GROUP BY 1)
    SELECT g, CAST(len(list_intersect(a.s,b.s)) AS INTEGER) AS common,
    array_to_string(list_sort(list_filter(a.s, lambda x: NOT list_contains(b.s,x))),'|') AS only_first FROM a JOIN b USING (g)""",
)
def g8_sets(spark, sf):
    c, o = V.table(spark, sf, "customer"), V.table(spark, sf, "orders")
    a = c.groupBy(F.col("c_nationkey").alias("g")).agg(F.collect_set("c_mktsegment").alias("a"))
    big = o.where((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000))
    b = c.join(big, c.c_custkey == big.o_custkey, "left_semi").groupBy(F.col("c_nationkey").alias("g")).agg(
        F.collect_set("c_mktsegment").alias("b")
    )
    return a.join(b, "g").select(
        "g", F.size(F.array_intersect("a", "b")).alias("common"),
        F.concat_ws("|", F.array_sort(F.array_except("a", "b"))).alias("only_first"),
    )


# scaling

def _scale_sql(expr: str, stats: str) -> str:
    cols = ", ".join(f"round({expr.format(c=c)},6) AS {c}" for c in ("amount", "hour_of_day"))
    return with_views("tx", f=stats) + f"SELECT transaction_id, {cols} FROM tx, f"


@query(
    "I1_standardise",
    _scale_sql(
        "({c}-{c}_m)/coalesce(nullif({c}_s,0),1.0::DOUBLE)",
        "SELECT avg(amount) AS amount_m, stddev_pop(amount) AS amount_s, avg(hour_of_day) AS hour_of_day_m, stddev_pop(hour_of_day) AS hour_of_day_s FROM tx WHERE is_fraud=0",
    ),
)
def i1(spark, sf):
    t = V.tx(spark, sf)
    s = Sc.standardise(t, ["amount", "hour_of_day"], fitted_on=t.where(F.col("is_fraud") == 0))
    return s.select("transaction_id", F.round("amount", 6).alias("amount"), F.round("hour_of_day", 6).alias("hour_of_day"))


@query(
    "I2_min_max",
    _scale_sql(
        "coalesce(({c}-{c}_lo)/nullif({c}_hi-{c}_lo,0),0.0::DOUBLE)",
        "SELECT min(amount) AS amount_lo, max(amount) AS amount_hi, min(hour_of_day) AS hour_of_day_lo, max(hour_of_day) AS hour_of_day_hi FROM tx WHERE is_fraud=0",
    ),
)
def i2(spark, sf):
    t = V.tx(spark, sf)
    s = Sc.min_max(t, ["amount", "hour_of_day"], fitted_on=t.where(F.col("is_fraud") == 0))
    return s.select("transaction_id", F.round("amount", 6).alias("amount"), F.round("hour_of_day", 6).alias("hour_of_day"))


@query("I3_principal_components")
def i3(spark, sf):
    c = V.card(spark, sf)
    out, explained = Sc.principal_components(c, [f"V{i}" for i in range(1, 29)], "Time", 2, ["Class"])
    return out.withColumn("explained_1", F.lit(explained[0])).withColumn("explained_2", F.lit(explained[1]))
