"""Cases that went wrong before: chained draws, blends, lost rows, missing amounts, new merchants, text ids."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyward.functions import scoring as S
from tallyward.operators import explain as Ex
from tallyward.operators import neighbours as N
from tallyward.operators import resample as Rs
from tallyward.operators import splits as Sp
from tallyward.operators import velocity as Ve
from tallyward.operators.ensemble import vote_average
from tallyward.operators.merchants import global_rate, merchant_stats
from tallyward.plans.stream_queries import _requests
from tallyward.streaming import online as On

T0 = dt.datetime(2024, 1, 1)
TX = "transaction_id string, user_id string, timestamp timestamp, amount double"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_a_hold_out_leaves_both_classes_to_an_undersample(spark):
    df = spark.range(20000).select(F.col("id").alias("row_id"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    train = Sp.hold_out(df, "row_id", 0.3).where("split = 'train'").drop("split")
    got = {r["label"]: r["count"] for r in Sp.undersample(train, "row_id", "label", 1.0).groupBy("label").count().collect()}
    assert 0.9 < got[0] / got[1] < 1.1


@pytest.mark.parametrize(
    "scores, weights, score, label",
    [
        ({"a": 0.9, "b": 0.6}, {"a": 2.0}, 0.9, 1),  # a model without a weight counts nothing
        ({"a": 0.9, "b": 0.6}, {"a": 1.0, "b": -3.0}, 0.9, 1),
        ({"a": 0.4, "b": 0.6}, {"a": 0.0, "b": 0.0}, 0.0, 0),
        ({}, None, 0.0, 0),
        ({"a": 1.7}, None, 1.7, 1),  # not clamped
        ({"a": 0.1234567, "b": 0.1234567}, None, 0.123456, 0),  # parts are rounded before they are added
    ],
)
def test_blends(spark, scores, weights, score, label):
    df = spark.createDataFrame([(scores, weights)], "s map<string,double>, w map<string,double>")
    b = df.select(S.blend_map(F.col("s"), None if weights is None else F.col("w")).alias("b")).first()["b"]
    assert b["score"] == pytest.approx(score, abs=1e-9) and b["label"] == label
    if scores:
        total, parts = S.blend({m: F.lit(v) for m, v in scores.items()}, weights)
        row = df.select(total.alias("t"), *[p.alias(m) for m, p in parts.items()]).first()
        assert row["t"] == pytest.approx(score, abs=1e-9) and {m: row[m] for m in scores} == pytest.approx(b["contributions"])


def test_average_divides_by_the_plain_sum(spark):
    df = spark.createDataFrame([(1.0, 0.5)], "a double, b double")
    assert df.select(vote_average(["a", "b"], {"a": 3.0, "b": -1.0})).first()[0] == pytest.approx(1.25)


ROWS = [
    ("t1", "u", at(0), 1.005), ("t2", "u", at(30), 0.003), ("t3", "u", at(40), None), ("t4", "u", at(50), float("nan")),
    ("t5", None, at(10), 3.0), ("t6", "u", None, 4.0), ("t7", "v", at(5), float("inf")),
]


@pytest.mark.parametrize("funcs", [("count", "sum"), ("max",), ("count", "sum", "max")])
def test_rolling_keeps_all_rows_and_exact_values(spark, funcs):
    df = spark.createDataFrame(ROWS, TX)
    got = {r["transaction_id"]: r for r in Ve.rolling_stats(df, "user_id", "amount", "timestamp", "transaction_id", [(1, "h")], funcs).collect()}
    assert set(got) == {r[0] for r in ROWS}
    if "sum" in funcs:
        assert got["t4"]["user_id_amount_sum_1h"] == 1.008 and got["t4"]["user_id_amount_count_1h"] == 2
        assert got["t5"]["user_id_amount_sum_1h"] is None and got["t7"]["user_id_amount_count_1h"] == 0
    if "max" in funcs:
        assert got["t4"]["user_id_amount_max_1h"] == 1.005 and got["t6"]["user_id_amount_max_1h"] is None
    gaps = {r["transaction_id"]: r["gap_s"] for r in Ve.gaps(df, "user_id", "timestamp", "transaction_id").collect()}
    assert gaps == {"t1": None, "t2": 1800.0, "t3": 600.0, "t4": 600.0, "t5": None, "t6": None, "t7": None}


def _stream(spark, rows, schema, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def test_stream_velocity_of_missing_amounts_equals_batch(spark, tmp_path):
    rows = [r for r in ROWS if r[1] and r[2]]
    out = On.drain(On.velocity_stream(_stream(spark, rows, TX, tmp_path), windows=[(1, "h")]), "velocity-test")
    batch = Ve.velocity(spark.createDataFrame(rows, TX), windows=[(1, "h")])
    cols = ["transaction_id", "velocity_count_1h", "velocity_sum_1h", "velocity_mean_1h", "velocity_time_since_last_s"]
    assert sorted(map(tuple, out.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_limits_and_repeats_of_null_keys(spark, tmp_path):
    rows = [("a", None, at(0), 1.0), ("b", None, at(1), 1.0), ("c", "k", at(0), 1.0)]
    df = spark.createDataFrame(rows, TX)
    key = lambda d: sorted(map(tuple, d.collect()), key=repr)
    limit = dict(limit=1, seconds=3600)
    stream = On.rate_limit_stream(_stream(spark, rows, TX, tmp_path), "user_id", "timestamp", "transaction_id", **limit)
    batch = On.rate_limit_batch(df, "user_id", "timestamp", "transaction_id", **limit)
    assert key(On.drain(stream, "limit-test").select(batch.columns)) == key(batch)
    assert {r["key"] for r in batch.collect()} == {None, "k"}
    untimed = spark.createDataFrame([*rows, ("d", "k", None, 1.0)], TX)
    marks = {r["id"]: r["computed"] for r in On.suppress_repeats_batch(untimed, "user_id", "timestamp", "transaction_id").collect()}
    assert marks == {"a": True, "b": False, "c": True, "d": True}


def test_requests_of_a_new_merchant_stay(spark):
    cols = "transaction_id long, merchant_id int, amount double, hour_of_day int, is_fraud int"
    df = spark.createDataFrame([(1, 1, 5.0, 3, 1), (2, 1, 5.0, 3, 0), (3, 9, 5.0, 3, 0), (4, None, 5.0, 3, 0)], cols)
    known = df.where("merchant_id = 1")
    got = {r["transaction_id"]: r["merchant_risk"] for r in _requests(df, merchant_stats(known), global_rate(known)).collect()}
    assert len(got) == 4 and got[3] == got[4] == 0.5


def test_text_ids_give_what_numbers_give(spark):
    n = 300
    name = F.format_string("tx-%06d", F.col("id"))
    base = spark.range(n).select(
        name.alias("name"), F.col("id").alias("number"), (F.col("id") % 7 == 0).cast("int").alias("label"),
        F.array(*[(F.sin(F.col("id") * (i + 1)) * 3).alias(f"x{i}") for i in range(3)]).alias("features"),
        F.timestamp_seconds(F.col("id").cast("long") * 60 % 977).alias("ts"), (F.col("id") % 11).cast("string").alias("user"),
    )
    back = {r["name"]: r["number"] for r in base.collect()}
    near = lambda key: N.nearest_neighbours(base, base, 3, row=key, exclude_self=True)
    want = sorted((r["row_id"], r["rank"], r["neighbour"]) for r in near("number").collect())
    assert sorted((back[r["row_id"]], r["rank"], back[r["neighbour"]]) for r in near("name").collect()) == want
    gap = lambda key: {r[key]: r["gap_s"] for r in Ve.global_gaps(base, "ts", key).collect()}
    assert {back[k]: v for k, v in gap("name").items()} == gap("number")
    folds = Sp.stratified_folds(base, "name", "label").groupBy("label", "fold").count().collect()
    assert max(r["count"] for r in folds if r["label"] == 0) - min(r["count"] for r in folds if r["label"] == 0) <= 1
    ordered = Sp.ordered_split(base, "ts", "name", order="user_time", user_col="user")
    rows = sorted(ordered.collect(), key=lambda r: (r["user"], r["ts"], r["name"]))
    assert [r["split"] for r in rows] == ["train"] * 210 + ["validation"] * 45 + ["test"] * 45
    assert Sp.exact_class_split(base, "name", "label").where("split = 'test'").count() == round(43 * 0.2) + round(257 * 0.2)
    assert Sp.undersample(base, "name", "label", 0.5, exact=True).count() == 43 + 86
    assert Rs.smote(base, ratio=0.3, row="name").count() == Rs.smote(base, ratio=0.3, row="number").count() > 0
    effect = Ex.permutation_effect(base.withColumn("a", F.col("number") % 5), ["a"], lambda c: c["a"] * 2.0, row="name")
    assert effect.count() == 1


def test_a_saved_pipeline_scores_like_the_fitted_one(spark, sf):
    from pyspark.ml import PipelineModel

    from tallyward.plans import model_queries as Mq
    from tallyward.plans import views as V
    from tallyward.session import fresh_path

    t = V.tx(spark, sf)
    fitted = Mq.scoring_pipeline().fit(t)
    path = fresh_path(spark, "saved-pipeline")
    fitted.write().save(path)
    rows = lambda m: sorted(map(tuple, Mq.score_with(m, t).collect()))
    got = rows(fitted)
    assert got == rows(PipelineModel.load(path)) and len(got) == t.count()
    assert all(0 <= r[1] <= 1 and len(r[4].split("|")) == 3 for r in got)


def test_kept_columns_travel_through_the_windows(spark):
    df = spark.createDataFrame(ROWS, TX).withColumn("extra", F.concat(F.lit("x"), "transaction_id"))
    for rule in (Ve.Heavy(), Ve.Heavy(share=0.0, min_rows=0)):
        got = Ve.velocity(df, windows=[(1, "h")], keep=df.columns, rule=rule)
        plain = Ve.velocity(df, windows=[(1, "h")], rule=rule)
        assert got.count() == len(ROWS) and {r["extra"] for r in got.collect()} == {"x" + r[0] for r in ROWS}
        cols = plain.columns
        assert sorted(map(tuple, got.select(cols).collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
