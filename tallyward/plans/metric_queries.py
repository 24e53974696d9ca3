"""Thresholds, curves and metric tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators import curves as Cu
from tallyward.operators import metrics as Me
from tallyward.operators import outcomes as O
from tallyward.operators.ensemble import long_scores
from tallyward.plans import views as V
from tallyward.plans.registry import query
from tallyward.plans.views import with_views

MODELS = {"rule": "p", "amount": "q", "merchant": "merchant_risk"}
_LONG = " UNION ALL ".join(f"SELECT transaction_id, is_fraud, '{m}' AS model, {c} AS score FROM scored" for m, c in MODELS.items())


def _long(spark, sf):
    return long_scores(V.scored(spark, sf), "transaction_id", MODELS, keep=["is_fraud"])


def _r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


_CONF = """count(*) FILTER (y=1 AND h=1) AS tp, count(*) FILTER (y=0 AND h=1) AS fp, count(*) FILTER (y=1 AND h=0) AS fn, count(*) FILTER (y=0 AND h=0) AS tn"""
_RATES = dict(
    prec="coalesce(tp/nullif(tp+fp,0),0.0::DOUBLE)", rec="coalesce(tp/nullif(tp+fn,0),0.0::DOUBLE)",
    fpr="coalesce(fp/nullif(fp+tn,0),0.0::DOUBLE)",
)
_F1 = "coalesce(2*{p}*{r}/nullif({p}+{r},0),0.0::DOUBLE)".format(p=_RATES["prec"], r=_RATES["rec"])


@query(
    "D19_detection_metrics",
    with_views("scored", h="SELECT is_fraud AS y, CAST(p>=0.15::DOUBLE AS INTEGER) AS h FROM scored", c=f"SELECT {_CONF} FROM h")
    + f"SELECT tp,fp,fn,tn, round({_RATES['rec']},6) AS detection_rate, round({_RATES['fpr']},6) AS false_positive_rate, round({_RATES['prec']},6) AS precision, round({_RATES['rec']},6) AS recall, round({_F1},6) AS f1 FROM c",
)
def d19(spark, sf):
    m = Me.detection_metrics(V.scored(spark, sf), 0.15, "is_fraud", "p")
    return _r6(m, "detection_rate", "false_positive_rate", "precision", "recall", "f1")


@query(
    "D20_classification_metrics",
    with_views("scored", l=_LONG, h="SELECT model, is_fraud AS y, CAST(score>=0.2::DOUBLE AS INTEGER) AS h FROM l", c=f"SELECT model, {_CONF} FROM h GROUP BY model")
    + f"SELECT model, round((tp+tn)/(tp+fp+fn+tn),6) AS accuracy, round({_RATES['prec']},6) AS precision, round({_RATES['rec']},6) AS recall, round({_F1},6) AS f1 FROM c",
)
def d20(spark, sf):
    rows = _long(spark, sf).withColumn("predicted", (F.col("score") >= 0.2).cast("int"))
    return _r6(Me.classification_metrics(rows, "is_fraud", "predicted", ["model"]), "accuracy", "precision", "recall", "f1")


@query(
    "D21_class_report",
    with_views(
        "scored", h="SELECT is_fraud AS y, CAST(p>=0.15::DOUBLE AS INTEGER) AS h FROM scored", c=f"SELECT {_CONF} FROM h",
        z="""SELECT '0' AS class, coalesce(tn/nullif(tn+fn,0),0.0::DOUBLE) AS p, coalesce(tn/nullif(tn+fp,0),0.0::DOUBLE) AS r, tn+fp AS n FROM c
        UNION ALL SELECT '1', coalesce(tp/nullif(tp+fp,0),0.0::DOUBLE), coalesce(tp/nullif(tp+fn,0),0.0::DOUBLE), tp+fn FROM c""",
        y="SELECT *, coalesce(2*p*r/nullif(p+r,0),0.0::DOUBLE) AS f FROM z",
        a="""SELECT class,p,r,f,n FROM y UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(n) AS BIGINT) FROM y
        UNION ALL SELECT 'weighted avg', sum(p*n)/sum(n), sum(r*n)/sum(n), sum(f*n)/sum(n), CAST(sum(n) AS BIGINT) FROM y""",
    ) + "SELECT class, round(p,6) AS precision, round(r,6) AS recall, round(f,6) AS f1, n AS support FROM a",
)
def d21(spark, sf):
    rows = V.scored(spark, sf).withColumn("predicted", (F.col("p") >= 0.15).cast("int"))
    return _r6(Me.class_report(rows, "is_fraud", "predicted"), "precision", "recall", "f1")


_OUT = """SELECT *, CASE WHEN score>={t}::DOUBLE THEN CASE WHEN is_fraud=1 THEN 'TP' ELSE 'FP' END ELSE CASE WHEN is_fraud=1 THEN 'FN' ELSE 'TN' END END AS outcome FROM l"""
_FAIL = """count(*) AS rows, count(*) FILTER (outcome IN ('FP','FN')) AS failures, count(*) FILTER (outcome='FP') AS false_positives,
 count(*) FILTER (outcome='FN') AS false_negatives, round(avg(score) FILTER (outcome='FP'),6) AS mean_score_fp, round(avg(score) FILTER (outcome='FN'),6) AS mean_score_fn"""


@query(
    "D22_failure_summary",
    with_views("scored", l="SELECT is_fraud, p AS score FROM scored", o=_OUT.format(t=0.15)) + f"SELECT {_FAIL} FROM o",
)
def d22(spark, sf):
    o = O.with_outcome(V.scored(spark, sf), 0.15, "is_fraud", "p")
    return _r6(O.failure_summary(o, score="p"), "mean_score_fp", "mean_score_fn")


@query(
    "D23_failures_by_model",
    with_views("scored", l=_LONG, o=_OUT.format(t=0.2)) + f"SELECT model, {_FAIL} FROM o GROUP BY model",
)
def d23(spark, sf):
    o = O.with_outcome(_long(spark, sf), 0.2, "is_fraud", "score")
    return _r6(O.failure_summary(o, ["model"]), "mean_score_fp", "mean_score_fn")


_FEATS = ["amount", "merchant_risk", "velocity_1h", "distance_from_home"]


@query(
    "D24_failure_profile",
    with_views(
        "scored", l="SELECT *, p AS score FROM scored", o=_OUT.format(t=0.15),
        f=" UNION ALL ".join(f"SELECT '{c}' AS feature, outcome, {c} AS v FROM o WHERE outcome IN ('FP','FN')" for c in _FEATS),
        m="SELECT feature, outcome, avg(v) AS mean, avg(abs(v)) AS mean_abs FROM f GROUP BY feature, outcome",
        t="SELECT feature, sum(mean_abs) AS total FROM m GROUP BY feature ORDER BY total DESC, feature LIMIT 3",
    ) + "SELECT feature, outcome, round(mean,6) AS mean, round(mean_abs,6) AS mean_abs, round(total,6) AS total FROM m JOIN t USING (feature)",
)
def d24(spark, sf):
    o = O.with_outcome(V.scored(spark, sf), 0.15, "is_fraud", "p")
    return _r6(O.failure_profile(o, _FEATS, 3), "mean", "mean_abs", "total")


_FOLD = "CAST(floor(('0x' || substr(md5(CAST(transaction_id AS VARCHAR) || ':fold'),1,13))::UBIGINT / 4503599627370496.0::DOUBLE*5) AS INTEGER)"
_FOLD_CTES = dict(
    l=_LONG, h=f"SELECT model AS technique, {_FOLD} AS fold, is_fraud AS y, CAST(score>=0.2::DOUBLE AS INTEGER) AS h FROM l",
    c=f"SELECT technique, fold, {_CONF} FROM h GROUP BY technique, fold",
    v=f"""SELECT technique, fold, 'accuracy' AS metric, (tp+tn)/(tp+fp+fn+tn) AS value FROM c
    UNION ALL SELECT technique, fold, 'precision', {_RATES['prec']} FROM c UNION ALL SELECT technique, fold, 'recall', {_RATES['rec']} FROM c
    UNION ALL SELECT technique, fold, 'f1', {_F1} FROM c""",
    s="SELECT technique, metric, avg(value) AS mean, stddev_pop(value) AS std FROM v GROUP BY technique, metric",
)
BASIC = ["accuracy", "precision", "recall", "f1"]


def _fold_summary(spark, sf):
    from tallyward.operators.splits import fold_of

    rows = _long(spark, sf).withColumnRenamed("model", "technique").withColumns(
        {"fold": fold_of(F.col("transaction_id"), 5, "fold"), "predicted": (F.col("score") >= 0.2).cast("int")}
    )
    wide = Me.classification_metrics(rows, "is_fraud", "predicted", ["technique", "fold"])
    return Me.fold_summary(wide.unpivot(["technique", "fold"], BASIC, "metric", "value"))


@query("D25_fold_summary", with_views("scored", **_FOLD_CTES) + "SELECT technique, metric, round(mean,6) AS mean, round(std,6) AS std FROM s")
def d25(spark, sf):
    return _r6(_fold_summary(spark, sf), "mean", "std")


@query(
    "D26_result_table",
    with_views("scored", **_FOLD_CTES, t="SELECT technique, metric, printf('%.4f ± %.4f', mean, std) AS t FROM s")
    + "SELECT technique, " + ", ".join(f"max(t) FILTER (metric='{m}') AS {m}" for m in BASIC) + " FROM t GROUP BY technique",
)
def d26(spark, sf):
    return Me.result_table(_fold_summary(spark, sf), BASIC)


@query(
    "G4_rank_techniques",
    with_views("scored", **_FOLD_CTES, w="SELECT technique, max(mean) FILTER (metric='f1') AS f1 FROM s GROUP BY technique")
    + "SELECT technique, round(f1,6) AS f1, CAST(NULL AS DOUBLE) AS auprc, CAST(rank() OVER (ORDER BY w.f1 DESC) AS INTEGER) AS rank FROM w",
)
def g4(spark, sf):
    return _r6(Me.rank_techniques(_fold_summary(spark, sf)), "f1")


@query(
    "G7_stack_model_results",
    with_views("scored") + " UNION ALL ".join(f"SELECT '{m}' AS model, count(*) AS n, round(avg({c}),6) AS mean_score FROM scored" for m, c in MODELS.items()),
)
def g7(spark, sf):
    s = V.scored(spark, sf)
    out = None
    for m, c in MODELS.items():
        part = s.agg(F.lit(m).alias("model"), F.count(F.lit(1)).alias("n"), F.round(F.avg(c), 6).alias("mean_score"))
        out = part if out is None else out.unionByName(part)
    return out


# thresholds

@query("E1_threshold_at_fpr", with_views("scored") + "SELECT round(quantile_cont(p,0.99),6) AS threshold FROM scored WHERE is_fraud=0")
def e1(spark, sf):
    return _r6(Cu.fpr_threshold(V.scored(spark, sf), "is_fraud", "p", 0.01), "threshold")


@query("E2_threshold_from_scores", with_views("scored") + "SELECT round(quantile_cont(p,0.95),6) AS threshold FROM scored")
def e2(spark, sf):
    return _r6(Cu.quantile_threshold(V.scored(spark, sf), "p", 0.95), "threshold")


@query("E3_threshold_from_share", with_views("scored") + "SELECT round(quantile_cont(q,0.9),6) AS threshold FROM scored")
def e3(spark, sf):
    return _r6(Cu.share_threshold(V.scored(spark, sf), "q", 0.1), "threshold")


_COUNTS = """SELECT score, n, pos, CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp, CAST(sum(n-pos) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
 CAST(sum(pos) OVER () AS BIGINT) AS p, CAST(sum(n-pos) OVER () AS BIGINT) AS q FROM (SELECT p AS score, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS pos FROM scored GROUP BY p)"""
_PTS = """SELECT *, tp/p AS tpr, fp/q AS fpr, tp/(tp+fp) AS prec, (tp-pos)/p AS tpr0, (fp-(n-pos))/q AS fpr0,
 coalesce((tp-pos)/nullif(tp-pos+fp-(n-pos),0),1.0::DOUBLE) AS prec0 FROM c"""
_CURVE = with_views("scored", c=_COUNTS, k=_PTS)


def _counts(spark, sf):
    return Cu.cumulative_counts(V.scored(spark, sf), "is_fraud", "p")


@query("E4_f1_threshold", _CURVE + """, f AS (SELECT score, 2*prec*tpr/(prec+tpr+1e-10::DOUBLE) AS f FROM k) SELECT score AS threshold, round(f,6) AS f1 FROM f ORDER BY f DESC, score LIMIT 1""")
def e4(spark, sf):
    return _r6(Cu.best_f1_threshold(_counts(spark, sf)), "f1")


def _grid_sql(points: str) -> str:
    return with_views(
        "scored", g=points, h="SELECT t, is_fraud AS y, CAST(q>=t AS INTEGER) AS h FROM scored, g", c=f"SELECT t, {_CONF} FROM h GROUP BY t",
        v=f"SELECT t, {_F1} AS f FROM c",
    ) + "SELECT t AS threshold, round(f,6) AS value, t=(SELECT t FROM v ORDER BY f DESC, t LIMIT 1) AS chosen FROM v"


@query("E5_grid_threshold", _grid_sql("SELECT i/99.0::DOUBLE AS t FROM range(100) r(i)"))
def e5(spark, sf):
    return _r6(Cu.grid_threshold(V.scored(spark, sf), "is_fraud", "q"), "value")


@query("E6_custom_grid", _grid_sql("SELECT round(0.1::DOUBLE+0.05::DOUBLE*i,2) AS t FROM range(16) r(i)"))
def e6(spark, sf):
    return _r6(Cu.grid_threshold(V.scored(spark, sf), "is_fraud", "q", [round(0.1 + 0.05 * i, 2) for i in range(16)]), "value")


@query(
    "E6_percentile_grid",
    _grid_sql("SELECT unnest(quantile_cont(q,[0.95,0.97,0.98,0.99,0.995])) AS t FROM scored").replace("t AS threshold", "round(t,6) AS threshold"),
)
def e6_percentiles(spark, sf):
    from tallyward.operators.ordering import exact_quantiles

    s = V.scored(spark, sf)
    shares = [x / 100.0 for x in (95.0, 97.0, 98.0, 99.0, 99.5)]
    cuts = [r["value"] for r in exact_quantiles(s, ["q"], shares).select("value").collect()]  # five numbers
    return _r6(Cu.grid_threshold(s, "is_fraud", "q", cuts), "value", "threshold")


@query("E7_cumulative_counts", _CURVE + "SELECT score, n, pos, tp, fp, p, q FROM c")
def e7(spark, sf):
    return _counts(spark, sf)


@query("E8_roc_points", _CURVE + "SELECT score AS threshold, round(fpr,6) AS fpr, round(tpr,6) AS tpr FROM k UNION ALL SELECT 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE")
def e8(spark, sf):
    return _r6(Cu.roc_points(_counts(spark, sf)), "fpr", "tpr")


@query("E10_pr_points", _CURVE + "SELECT score AS threshold, round(prec,6) AS precision, round(tpr,6) AS recall FROM k UNION ALL SELECT 'inf'::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE")
def e10(spark, sf):
    return _r6(Cu.pr_points(_counts(spark, sf)), "precision", "recall")


_AREA = {
    "E9_auroc": ("auroc", "sum((fpr-fpr0)*(tpr+tpr0)/2.0::DOUBLE)"),
    "E11_pr_auc_trapezoid": ("pr_auc", "sum((tpr-tpr0)*(prec+prec0)/2.0::DOUBLE)"),
    "E12_average_precision": ("average_precision", "sum((tpr-tpr0)*prec)"),
    "E13_recall_at_fpr": ("recall_at_fpr", "coalesce(max(tpr) FILTER (fpr<=0.01::DOUBLE),0.0::DOUBLE)"),
}


def _area_query(key: str, column: str, expr: str) -> None:
    @query(key, _CURVE + f"SELECT round({expr},6) AS {column} FROM k")
    def area(spark, sf):
        return Cu.curve_areas(_counts(spark, sf)).select(F.round(column, 6).alias(column))


for _key, (_col, _expr) in _AREA.items():
    _area_query(_key, _col, _expr)


_BY_MODEL = dict(
    l=_LONG,
    c0="SELECT model, score, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS pos FROM l GROUP BY model, score",
    c="""SELECT model, score, n, pos, sum(pos) OVER w AS tp, sum(n-pos) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS p, sum(n-pos) OVER (PARTITION BY model) AS q
    FROM c0 WINDOW w AS (PARTITION BY model ORDER BY score DESC)""",
    k=_PTS,
    a="SELECT model, " + ", ".join(f"round({e},6) AS {c}" for c, e in _AREA.values()) + " FROM k GROUP BY model",
    h="SELECT model, is_fraud AS y, CAST(score>=0.2::DOUBLE AS INTEGER) AS h FROM l",
    m=f"SELECT model, {_CONF} FROM h GROUP BY model",
)


@query(
    "E14_all_metrics",
    with_views("scored", **_BY_MODEL) + f"""SELECT model, round((tp+tn)/(tp+fp+fn+tn),6) AS accuracy, round({_RATES['prec']},6) AS precision, round({_RATES['rec']},6) AS recall,
    round({_F1},6) AS f1, round({_RATES['fpr']},6) AS false_positive_rate, auroc, pr_auc, average_precision, recall_at_fpr FROM m JOIN a USING (model)""",
)
def e14(spark, sf):
    m = Cu.all_metrics(_long(spark, sf), "is_fraud", "score", 0.2, ["model"])
    return _r6(m, *[c for c in m.columns if c != "model"])


@query(
    "E15_tune_share",
    with_views(
        "scored", t="SELECT q AS s FROM scored WHERE is_fraud=0", v="SELECT q AS s FROM scored",
        c=" UNION ALL ".join(f"SELECT {x}::DOUBLE AS contamination, quantile_cont(s,{1 - x}) AS threshold FROM t" for x in (0.01, 0.02, 0.05, 0.1)),
        r="SELECT contamination, threshold, count(*) FILTER (s>threshold)/count(*) AS achieved FROM c, v GROUP BY ALL",
    ) + """SELECT contamination, round(threshold,6) AS threshold, round(achieved,6) AS achieved,
    contamination=(SELECT contamination FROM r ORDER BY abs(achieved-0.05::DOUBLE), contamination LIMIT 1) AS chosen FROM r""",
)
def e15(spark, sf):
    s = V.scored(spark, sf)
    out = Cu.tune_share(s.where(F.col("is_fraud") == 0), s, "q", [0.01, 0.02, 0.05, 0.1], 0.05)
    return _r6(out, "threshold", "achieved")
