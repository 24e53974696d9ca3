"""Explanations of the rule score and of fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.functions import scoring as S
from tallyward.operators import explain as Ex
from tallyward.operators import models as Mo
from tallyward.operators import profile as P
from tallyward.operators import reports as Rp
from tallyward.plans import views as V
from tallyward.plans.registry import query
from tallyward.plans.split_queries import unit
from tallyward.plans.views import with_views

FEATS = S.RULE_FEATURES
TERM = {
    "amount": "least(amount/1500.0::DOUBLE,1.0::DOUBLE)*0.35::DOUBLE",
    "merchant_risk": "merchant_risk*0.3::DOUBLE",
    "velocity_1h": "least(velocity_1h/20.0::DOUBLE,1.0::DOUBLE)*0.2::DOUBLE",
    "distance_from_home": "least(distance_from_home/250.0::DOUBLE,1.0::DOUBLE)*0.15::DOUBLE",
}
_MEANS = "SELECT " + ", ".join(f"avg({e}) AS m_{f}" for f, e in TERM.items()) + " FROM scored"
_C = " UNION ALL ".join(f"SELECT transaction_id, '{f}' AS feature, {e}-m_{f} AS contribution FROM scored, means" for f, e in TERM.items())
CONTRIB = dict(means=_MEANS, c=_C)


def contrib(spark, sf):
    return Ex.rule_contributions(V.scored(spark, sf))


def _r(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("J1_additive_contributions", with_views("scored", **CONTRIB) + "SELECT transaction_id, feature, round(contribution,6) AS contribution FROM c")
def j1(spark, sf):
    return _r(contrib(spark, sf), "contribution")


@query(
    "J1_linear_contributions",
    with_views("scored", m="SELECT avg(amount) AS a, avg(velocity_1h) AS v FROM scored")
    + """SELECT transaction_id, 'amount' AS feature, round(amount*0.01::DOUBLE-a*0.01::DOUBLE,6) AS contribution FROM scored, m
    UNION ALL SELECT transaction_id, 'velocity_1h', round(velocity_1h*-0.5::DOUBLE-v*-0.5::DOUBLE,6) FROM scored, m""",
)
def j1_linear(spark, sf):
    return _r(Ex.linear_contributions(V.scored(spark, sf), {"amount": 0.01, "velocity_1h": -0.5}), "contribution")


def steep(values):
    """A score in which features interact: logistic of the rule score."""
    return S.logistic(S.rule_score(values) * 20.0 - 4.0)


@query("J1_sampled_shapley")
def j1_sampled(spark, sf):
    s = V.scored(spark, sf)
    return Ex.sampled_shapley(s, s, FEATS, steep, draws=20)


@query(
    "J2_global_contributions",
    with_views(
        "scored", pick="SELECT * FROM scored",
        means=_MEANS.replace("FROM scored", "FROM pick"), c=_C.replace("FROM scored", "FROM pick"),
    ) + "SELECT feature, round(avg(abs(contribution)),6) AS importance FROM c GROUP BY feature",
)
def j2(spark, sf):
    sample = V.scored(spark, sf)
    return _r(Ex.global_importance(Ex.rule_contributions(sample)), "importance")


@query(
    "J3_permutation_effect",
    with_views("scored") + " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, round((SELECT avg(1.0::DOUBLE/(1.0::DOUBLE+exp(-(raw*20.0::DOUBLE-4.0::DOUBLE)))) FROM scored) -
        avg(1.0::DOUBLE/(1.0::DOUBLE+exp(-(({'+'.join(e.replace(f, 'b.' + f) if g == f else e.replace(g, 'a.' + g) for g, e in TERM.items())})*20.0::DOUBLE-4.0::DOUBLE)))),6) AS effect
        FROM (SELECT *, row_number() OVER (ORDER BY {unit('transaction_id', 42)}, transaction_id) AS i FROM scored) a
        JOIN (SELECT {f}, row_number() OVER (ORDER BY {unit('transaction_id', '42:' + f)}, transaction_id) AS i FROM scored) b USING (i)"""
        for f in FEATS
    ),
)
def j3(spark, sf):
    return _r(Ex.permutation_effect(V.scored(spark, sf), FEATS, steep), "effect")


@query("J4_local_surrogate")
def j4(spark, sf):
    return Ex.local_surrogate(V.scored(spark, sf), FEATS, steep, draws=5000, top_n=5, arrays=True)


@query("J5_local_surrogate_half_std")
def j5(spark, sf):
    return Ex.local_surrogate(V.scored(spark, sf), FEATS, steep, draws=1000, top_n=5, preset="half_std", arrays=True)


@query("J6_surrogate_importance")
def j6(spark, sf):
    return Ex.surrogate_importance(Ex.local_surrogate(V.scored(spark, sf), FEATS, steep, draws=1000, top_n=None, arrays=True))


_GRIDS = dict(
    g=" UNION ALL ".join(
        f"""SELECT '{f}' AS feature, i AS point, lo+(hi-lo)*i/99.0::DOUBLE AS value FROM (SELECT quantile_cont({f},0.05) AS lo, quantile_cont({f},0.95) AS hi FROM scored), range(100) r(i)
        WHERE (SELECT count(DISTINCT {f}) FROM scored)>=100
        UNION ALL SELECT '{f}', row_number() OVER (ORDER BY v)-1, v FROM (SELECT DISTINCT {f} AS v FROM scored) WHERE (SELECT count(DISTINCT {f}) FROM scored)<100"""
        for f in FEATS
    ),
    pd=" UNION ALL ".join(
        f"SELECT g.feature, g.point, g.value, avg({'+'.join(e.replace(f, 'g.value') if h == f else e for h, e in TERM.items())}) AS average FROM scored, g WHERE g.feature='{f}' GROUP BY ALL"
        for f in FEATS
    ),
)


def grids(spark, sf):
    return Ex.feature_grids(V.scored(spark, sf), FEATS)


def dependence(spark, sf):
    return Ex.partial_dependence(V.scored(spark, sf), grids(spark, sf), FEATS, Ex.rule_fn)


@query("J7_partial_dependence", with_views("scored", **_GRIDS) + "SELECT feature, CAST(point AS INTEGER) AS point, round(value,6) AS value, round(average,6) AS average FROM pd")
def j7(spark, sf):
    return _r(dependence(spark, sf), "value", "average")


@query(
    "J7_dependence_summary",
    with_views("scored", **_GRIDS) + """SELECT feature, round(min(value),6) AS min_value, round(max(value),6) AS max_value, round(min(average),6) AS min_prediction,
    round(max(average),6) AS max_prediction, round(max(average)-min(average),6) AS range FROM pd GROUP BY feature""",
)
def j7_summary(spark, sf):
    return _r(Ex.dependence_summary(dependence(spark, sf)), "min_value", "max_value", "min_prediction", "max_prediction", "range")


_ICE = [0.0, 100.0, 200.0, 300.0, 400.0]


@query(
    "J8_individual_curves",
    with_views("scored", g="SELECT CAST(row_number() OVER ()-1 AS INTEGER) AS point, v AS value FROM (SELECT unnest([0.0,100.0,200.0,300.0,400.0]::DOUBLE[]) AS v)")
    + f"SELECT transaction_id, 'amount' AS feature, point, value, round({'+'.join(e.replace('amount', 'g.value') for e in TERM.values())},9) AS score FROM scored, g",
)
def j8(spark, sf):
    curves = Ex.individual_curves(V.scored(spark, sf), {"amount": _ICE}, FEATS, Ex.rule_fn)
    return curves.withColumn("score", F.round("score", 9))


@query(
    "J9_two_way_dependence",
    with_views("scored", a="SELECT i*50.0::DOUBLE AS value_a FROM range(10) r(i)", b="SELECT i*0.1::DOUBLE AS value_b FROM range(10) r(i)")
    + f"""SELECT value_a, round(value_b,6) AS value_b, round(avg({'+'.join(e.replace('amount', 'value_a').replace('merchant_risk', 'value_b') for e in TERM.values())}),6) AS average
    FROM scored, a, b GROUP BY value_a, value_b""",
)
def j9(spark, sf):
    out = Ex.two_way_dependence(
        V.scored(spark, sf), "amount", "merchant_risk", [i * 50.0 for i in range(10)], [i * 0.1 for i in range(10)],
        FEATS, Ex.rule_fn,
    )
    return _r(out, "value_b", "average")


@query(
    "J10_importance_by_range",
    with_views("scored", **_GRIDS, r="SELECT feature, max(average)-min(average) AS range FROM pd GROUP BY feature")
    + "SELECT feature, round(r.range,6) AS range FROM r ORDER BY r.range DESC, feature LIMIT 3",
)
def j10(spark, sf):
    return _r(Ex.range_importance(dependence(spark, sf), 3), "range")


@query(
    "J11_linearity",
    with_views("scored", **_GRIDS, r="SELECT feature, corr(value,average) AS c, max(average)-min(average) AS r FROM pd GROUP BY feature")
    + """SELECT feature, round(c,6) AS correlation, round(r,6) AS pdp_range, abs(c)>=0.95::DOUBLE AS is_linear,
    CASE WHEN abs(c)>=0.95::DOUBLE THEN 'Linear relationship' ELSE 'Non-linear relationship - may require careful interpretation' END AS recommendation FROM r""",
)
def j11(spark, sf):
    return _r(Ex.linearity(dependence(spark, sf)), "correlation", "pdp_range")


_RANKED = "SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY abs(contribution) DESC, feature) AS rank FROM c"
_IMPACT = """CASE WHEN abs(contribution)>0.5::DOUBLE THEN 'Very High' WHEN abs(contribution)>0.3::DOUBLE THEN 'High' WHEN abs(contribution)>0.1::DOUBLE THEN 'Medium'
 WHEN abs(contribution)>0.05::DOUBLE THEN 'Low' ELSE 'Very Low' END"""
_NAME = """CASE feature WHEN 'amount' THEN 'Amount' WHEN 'merchant_risk' THEN 'Merchant Risk' WHEN 'velocity_1h' THEN 'Velocity 1h' ELSE 'Distance From Home' END"""


@query(
    "J12_risk_factors",
    with_views("scored", **CONTRIB, k=_RANKED) + f"""SELECT transaction_id, CAST(rank AS INTEGER) AS rank, feature, {_NAME} AS description, round(contribution,6) AS importance,
    round(abs(contribution),6) AS abs_importance, CASE WHEN contribution>0 THEN 'increases' ELSE 'decreases' END AS direction, {_IMPACT} AS impact_level FROM k WHERE rank<=5""",
)
def j12(spark, sf):
    return _r(Rp.risk_factors(contrib(spark, sf), 5), "importance", "abs_importance")


@query(
    "J13_report_rows",
    with_views(
        "scored", **CONTRIB, k=_RANKED,
        f="""SELECT transaction_id, string_agg(rank || ':' || feature || ':' || CASE WHEN contribution>0 THEN 'increases' ELSE 'decreases' END, '|' ORDER BY rank) AS risk_factors
        FROM k WHERE rank<=5 GROUP BY transaction_id""",
        l="SELECT transaction_id, q AS p, CASE WHEN q>=0.8::DOUBLE THEN 'Critical' WHEN q>=0.6::DOUBLE THEN 'High' WHEN q>=0.4::DOUBLE THEN 'Medium' WHEN q>=0.2::DOUBLE THEN 'Low' ELSE 'Very Low' END AS risk_level FROM scored",
    ) + """SELECT transaction_id, p AS probability, printf('%.2f%%', CAST(round(CAST(CAST(p*100.0::DOUBLE AS VARCHAR) AS DECIMAL(30,20)),2) AS DOUBLE)) AS probability_text,
    CASE WHEN p>=0.5::DOUBLE THEN 'fraud' ELSE 'legitimate' END AS predicted_class, risk_level,
    CASE risk_level WHEN 'Critical' THEN '#e74c3c' WHEN 'High' THEN '#e67e22' WHEN 'Medium' THEN '#f39c12' WHEN 'Low' THEN '#27ae60' ELSE '#2980b9' END AS risk_colour, risk_factors
    FROM l JOIN f USING (transaction_id)""",
)
def j13(spark, sf):
    s = V.scored(spark, sf)
    scores = s.select("transaction_id", F.col("q").alias("probability"), S.decision(F.col("q")).alias("predicted_class"))
    out = Rp.report_rows(scores, Rp.risk_factors(contrib(spark, sf), 5))
    text = F.transform("risk_factors", lambda x: F.concat_ws(":", x["rank"].cast("string"), x["feature"], x["direction"]))
    return out.withColumn("risk_factors", F.concat_ws("|", text))


# statistics over explanation tables

@query(
    "D28_mean_contribution",
    with_views("scored", **CONTRIB) + "SELECT feature, round(avg(abs(contribution)),6) AS importance FROM c GROUP BY feature",
)
def d28(spark, sf):
    return _r(Ex.global_importance(contrib(spark, sf)), "importance")


_BINNED = """SELECT transaction_id, feature || CASE WHEN contribution>0 THEN ' > 0' ELSE ' <= 0' END AS feature, contribution FROM c
 UNION ALL SELECT transaction_id, feature || ' <= 9', contribution*0.5::DOUBLE FROM c"""


@query(
    "D29_merge_feature_bins",
    with_views("scored", **CONTRIB, b=_BINNED)
    + "SELECT transaction_id, split_part(feature,' ',1) AS feature, round(sum(abs(contribution)),6) AS contribution FROM b GROUP BY 1, 2",
)
def d29(spark, sf):
    c = contrib(spark, sf)
    sign = F.when(F.col("contribution") > 0, " > 0").otherwise(" <= 0")
    binned = c.withColumn("feature", F.concat("feature", sign)).unionByName(
        c.select("transaction_id", F.concat("feature", F.lit(" <= 9")).alias("feature"), (F.col("contribution") * 0.5).alias("contribution"))
    )
    return _r(Ex.merge_bins(binned), "contribution")


@query(
    "D30_run_consistency",
    with_views("scored", **CONTRIB, v="SELECT feature, var_pop(contribution) AS v FROM c GROUP BY feature")
    + "SELECT feature, round(v,9) AS variance, round(max(v) OVER (),9) AS max_variance, max(v) OVER ()<=1e-5::DOUBLE AS is_consistent FROM v",
)
def d30(spark, sf):
    runs = contrib(spark, sf).withColumnRenamed("transaction_id", "run")  # each explanation as one run
    out = Ex.consistency(runs)
    return out.withColumns({"variance": F.round("variance", 9), "max_variance": F.round("max_variance", 9)})


_HOLES = "SELECT transaction_id, feature, CASE WHEN feature='velocity_1h' AND transaction_id%100=0 THEN NULL ELSE contribution END AS contribution FROM c WHERE abs(contribution)>0.01::DOUBLE"


def _holes(spark, sf):
    c = contrib(spark, sf).where(F.abs("contribution") > 0.01)
    empty = (F.col("feature") == "velocity_1h") & (F.col("transaction_id") % 100 == 0)
    return c.withColumn("contribution", F.when(~empty, F.col("contribution")))


@query(
    "D31_explanation_quality",
    with_views("scored", **CONTRIB, h=_HOLES) + """SELECT count(DISTINCT transaction_id) AS total_explanations, count(*)-count(contribution) AS null_values, CAST(0 AS BIGINT) AS infinite_values,
    count(DISTINCT feature) AS unique_features, round(count(DISTINCT feature)/count(DISTINCT transaction_id),9) AS avg_features_per_explanation,
    round(count(*)/count(DISTINCT transaction_id),6) AS features_per_explanation, count(*)=count(contribution) AS passed FROM h""",
)
def d31(spark, sf):
    q = Ex.explanation_quality(_holes(spark, sf))
    return q.withColumns(
        {"avg_features_per_explanation": F.round("avg_features_per_explanation", 9), "features_per_explanation": F.round("features_per_explanation", 6)}
    )


@query(
    "D31_feature_coverage",
    with_views("scored", **CONTRIB, h=_HOLES) + "SELECT feature, round(count(DISTINCT transaction_id)/(SELECT count(DISTINCT transaction_id) FROM h),6) AS coverage FROM h GROUP BY feature",
)
def d31_coverage(spark, sf):
    return _r(Ex.feature_coverage(_holes(spark, sf)), "coverage")


_TOP = "SELECT transaction_id, list(feature ORDER BY abs(contribution) DESC, feature)[1:2] AS top FROM {c} GROUP BY transaction_id"


@query(
    "D32_rank_stability",
    with_views(
        "scored", **CONTRIB, b=_TOP.format(c="c"),
        n=f"SELECT transaction_id, run, feature, contribution+({unit("transaction_id || '-' || feature || '-' || run", 'noise')}-0.5::DOUBLE)*0.04::DOUBLE AS contribution FROM c, range(3) r(run)",
        p="SELECT transaction_id, run, list(feature ORDER BY abs(contribution) DESC, feature)[1:2] AS top FROM n GROUP BY transaction_id, run",
        o="SELECT len(list_intersect(p.top,b.top))/2.0::DOUBLE AS o FROM p JOIN b USING (transaction_id)",
    ) + "SELECT round(avg(o),6) AS mean_overlap, round(stddev_pop(o),6) AS std_overlap, min(o) AS min_overlap, count(*) AS runs, avg(o)>0.7::DOUBLE AS is_stable FROM o",
)
def d32(spark, sf):
    from tallyward.functions.hashing import hash_unit

    c = contrib(spark, sf)

    def top(df, *keys):
        # four features per explanation, so the collected list is small
        item = F.struct((-F.abs("contribution")).alias("k"), "feature")
        lists = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("l"))
        return lists.select(*keys, F.transform(F.slice("l", 1, 2), lambda x: x["feature"]).alias("top"))

    runs = c.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(2))))
    key = F.concat_ws("-", "transaction_id", "feature", "run")
    noisy = runs.withColumn("contribution", F.col("contribution") + (hash_unit(key, "noise") - 0.5) * 0.04)
    return _r(Ex.rank_stability(top(c, "transaction_id"), top(noisy, "transaction_id", "run")), "mean_overlap", "std_overlap")


@query(
    "D33_confidence_intervals",
    with_views(
        "tx", t="SELECT unnest(range(1,29)) AS df, unnest([" + ",".join(repr(x) for x in Ex.T_975) + "]::DOUBLE[]) AS t",
        s="SELECT merchant_id*1000+hour_of_day AS grp, count(*) AS n, avg(amount) AS mean, stddev_pop(amount) AS sd FROM tx GROUP BY 1",
        m=f"SELECT s.*, CASE WHEN n<30 THEN t ELSE {Ex.Z_975!r}::DOUBLE END*sd/sqrt(n) AS m FROM s LEFT JOIN t ON t.df=s.n-1",
    ) + "SELECT grp, n, round(mean,6) AS mean, round(mean-m,6) AS lower, round(mean+m,6) AS upper, round(m,6) AS margin FROM m",
)
def d33(spark, sf):
    t = V.tx(spark, sf).select((F.col("merchant_id") * 1000 + F.col("hour_of_day")).alias("grp"), F.col("amount").alias("contribution"))
    return _r(Ex.confidence_intervals(t, "grp"), "mean", "lower", "upper", "margin")


@query(
    "D34_timing_summary",
    with_views("tx", g="SELECT amount/100.0::DOUBLE AS s FROM tx") + """SELECT round(avg(s),6) AS mean, round(quantile_cont(s,0.5),6) AS median, round(quantile_cont(s,0.95),6) AS p95,
    round(quantile_cont(s,0.99),6) AS p99, round(stddev_pop(s),6) AS std, min(s) AS min, max(s) AS max, avg(s)<=2 AS meets_target, 2.0::DOUBLE AS target FROM g""",
)
def d34(spark, sf):
    t = V.tx(spark, sf).select((F.col("amount") / 100.0).alias("s"))
    return _r(Ex.timing_summary(t, "s"), "mean", "median", "p95", "p99", "std")


@query(
    "C8_grid_product",
    with_views("scored", g="SELECT unnest([50.0,150.0,250.0]::DOUBLE[]) AS value")
    + f"SELECT value, count(*) AS rows, round(avg({'+'.join(e.replace('amount', 'value') for e in TERM.values())}),6) AS average FROM scored, g GROUP BY value",
)
def c8(spark, sf):
    rows = Ex.individual_curves(V.scored(spark, sf), {"amount": [50.0, 150.0, 250.0]}, FEATS, Ex.rule_fn)
    return rows.groupBy("value").agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("score"), 6).alias("average"))


@query("L4_explainer_on_fitted_model")
def l4(spark, sf):
    """Contributions of a fitted logistic model on its own features."""
    s = V.scored(spark, sf)
    rows = Mo.as_features(s.withColumn("label", F.col("is_fraud")), FEATS)
    model, _ = Mo.fit_logistic(rows)
    weights = dict(zip(FEATS, (float(w) for w in model.coefficients.toArray())))
    return Ex.linear_contributions(s, weights)
