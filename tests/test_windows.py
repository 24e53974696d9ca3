import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyward.operators import history as Hi
from tallyward.operators import merchants as M
from tallyward.operators import sequences as Sq
from tallyward.operators.heavy import Heavy, heavy_keys
from tallyward.operators.velocity import gaps, global_gaps, rolling_stats, velocity, velocity_names

ALL_HEAVY = Heavy(share=0.0, min_rows=0)
RULES = [Heavy(), ALL_HEAVY]


def frame(spark, rows):
    return spark.createDataFrame(rows, "transaction_id long, user_id long, t string, amount double").withColumn(
        "timestamp", F.try_to_timestamp("t")
    )


def five(spark, second=2.0):
    times = ["00:00:00", "00:30:00", "00:30:00", "01:00:00", "01:30:00"]
    amounts = [1.0, second, 4.0, 8.0, 16.0]
    return frame(spark, [(i, 1, f"2024-01-01 {t}", a) for i, (t, a) in enumerate(zip(times, amounts))])


def col(df, name, key="transaction_id"):
    return [r[name] for r in df.orderBy(key).collect()]


@pytest.mark.parametrize("rule", RULES)
@pytest.mark.parametrize(
    "ties, counts, sums", [("row", [1, 2, 3, 3, 2], [1, 3, 7, 14, 24]), ("peers", [1, 3, 3, 3, 2], [1, 7, 7, 14, 24])]
)
def test_window_boundary_and_ties(spark, rule, ties, counts, sums):
    v = velocity(five(spark), windows=[(1, "h")], features=["count", "sum"], ties=ties, rule=rule)
    assert col(v, "velocity_count_1h") == counts
    assert col(v, "velocity_sum_1h") == sums


def test_null_amount_is_not_counted(spark):
    v = velocity(five(spark, None), windows=[(1, "h")], features=["count"], ties="row")
    assert col(v, "velocity_count_1h") == [1, 1, 2, 2, 2]


def test_bad_timestamp_keeps_the_row(spark):
    df = frame(spark, [(0, 1, "2024-01-01 00:00:00", 1.0), (1, 1, "not a time", 2.0)])
    v = velocity(df, windows=[(1, "h")], features=["count", "time_since_last"])
    assert col(v, "velocity_count_1h") == [1, None]
    assert col(v, "velocity_time_since_last_s") == [999999.0, None]


def test_names_and_missing_columns(spark):
    assert velocity_names([(1, "h"), (7, "d")], ["mean", "count"]) == [
        "velocity_count_1h", "velocity_mean_1h", "velocity_count_7d", "velocity_mean_7d",
    ]
    with pytest.raises(ValueError, match="Missing required columns"):
        velocity(five(spark).drop("amount"))
    with pytest.raises(ValueError, match="unit"):
        velocity(five(spark), windows=[(1, "w")])


def random_rows(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    base = dt.datetime(2024, 1, 1)
    # one user holds more than a third of the rows, many times repeat
    users = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 8, n))
    pdf = pd.DataFrame(
        {
            "transaction_id": np.arange(n), "user_id": users,
            "timestamp": [base + dt.timedelta(minutes=int(m)) for m in rng.integers(0, 2000, n)],
            "amount": np.round(rng.uniform(0, 500, n), 2), "is_fraud": (rng.random(n) < 0.2).astype(int),
        }
    )
    return pdf, spark.createDataFrame(pdf)


def brute(pdf, minutes, fn):
    out = []
    for r in pdf.sort_values("transaction_id").itertuples():
        w = pdf[
            (pdf.user_id == r.user_id) & (pdf.timestamp <= r.timestamp)
            & (pdf.timestamp > r.timestamp - pd.Timedelta(minutes=minutes))
        ]
        out.append(fn(w.amount))
    return out


@pytest.mark.parametrize("rule", RULES)
def test_rolling_equals_brute_force(spark, rule):
    pdf, df = random_rows(spark)
    s = rolling_stats(
        df, "user_id", "amount", "timestamp", "transaction_id", [(2, "h")], ["count", "sum", "std", "max", "min"], rule=rule
    )
    got = s.orderBy("transaction_id").toPandas()
    for f in ("count", "sum", "std", "max", "min"):
        want = np.array(brute(pdf, 120, getattr(pd.Series, f)), dtype=float)
        np.testing.assert_allclose(got[f"user_id_amount_{f}_2h"].astype(float), want, rtol=1e-9)


@pytest.mark.parametrize("rule", RULES)
def test_gap_equals_shift(spark, rule):
    pdf, df = random_rows(spark)
    pdf = pdf.sort_values(["timestamp", "transaction_id"])
    want = pdf.assign(g=pdf.groupby("user_id").timestamp.diff().dt.total_seconds()).sort_values("transaction_id").g
    got = gaps(df, "user_id", "timestamp", "transaction_id", rule).orderBy("transaction_id").toPandas().gap_s
    np.testing.assert_allclose(got.astype(float), want)
    whole = pdf.assign(g=pdf.timestamp.diff().dt.total_seconds()).sort_values("transaction_id").g
    got = global_gaps(df, "timestamp", "transaction_id").orderBy("transaction_id").toPandas().gap_s
    np.testing.assert_allclose(got.astype(float), whole)


def test_heavy_keys_are_few(spark):
    _, df = random_rows(spark)
    found = [r[0] for r in heavy_keys(df, ["user_id"], Heavy(share=1 / 3, min_rows=10)).collect()]
    assert found == [0]


@pytest.mark.parametrize("rule", RULES)
def test_sequences_equal_brute_force(spark, rule):
    pdf, df = random_rows(spark, 300)
    got = {r["transaction_id"]: r for r in Sq.user_sequences(df, 4, ["amount"], 3, rule=rule).collect()}
    want = {}
    for _, g in pdf.sort_values(["timestamp", "transaction_id"]).groupby("user_id"):
        amounts = g.amount.tolist()
        for i, t in enumerate(g.transaction_id):
            if i + 1 >= 3:
                seq = amounts[max(0, i - 3) : i + 1]
                want[t] = [[0.0]] * (4 - len(seq)) + [[a] for a in seq]
    assert {k: r["sequence"] for k, r in got.items()} == want
    latest = Sq.latest_sequences(df, 4, ["amount"], 3).collect()
    assert all(r["sequence"] == want[r["transaction_id"]] for r in latest) and len(latest) == pdf.user_id.nunique()


def deviate(spark, train, rows, **kw):
    schema = "transaction_id long, user_id long, timestamp timestamp, amount double"
    now = dt.datetime(2024, 1, 1)
    make = lambda data: spark.createDataFrame([(i, u, now + dt.timedelta(hours=i), a) for i, (u, a) in enumerate(data)], schema)
    t = make(train)
    out = Hi.deviation(make(rows), Hi.user_stats(t, ["amount"]), Hi.global_moments(t, ["amount"]), ["amount"], **kw)
    return [(r["deviation_amount_zscore"], r["deviation_amount_ratio"]) for r in out.orderBy("transaction_id").collect()]


def test_single_transaction_has_no_null(spark):
    assert deviate(spark, [(1, 100.0)], [(1, 100.0)]) == [(0.0, 1.0)]


def test_zero_variance_and_zero_mean(spark):
    assert deviate(spark, [(1, 50.0)] * 4, [(1, 50.0)]) == [(0.0, 1.0)]
    assert deviate(spark, [(1, 0.0)] * 4, [(1, 0.0), (1, 5.0)])[0] == (0.0, 1.0)
    assert deviate(spark, [(1, 0.0)] * 4, [(1, 5.0)])[0][1] == float("inf")


def test_unseen_user_and_short_history_use_global(spark):
    train = [(1, 10.0), (1, 20.0), (1, 30.0), (2, 1000.0)]
    unseen, short = deviate(spark, train, [(9, 265.0), (2, 265.0)])
    assert unseen == short == (0.0, 1.0)
    assert deviate(spark, train, [(2, 2000.0)], min_transactions=0)[0][1] == 2.0


def merchants(spark):
    rows = [(m, int(i < f)) for m, n, f in ((1, 10, 8), (2, 10, 0), (3, 1, 1)) for i in range(n)]
    return spark.createDataFrame(rows, "merchant_id long, is_fraud int")


def test_merchant_rates(spark):
    df = merchants(spark)
    rate = {r["merchant_id"]: r["rate"] for r in M.merchant_stats(df).collect()}
    assert rate[1] > rate[3] > rate[2] and all(0 <= v <= 1 for v in rate.values())
    strong = lambda a, b: M.merchant_stats(df, alpha=a, beta=b).where("merchant_id = 3").first()["rate"]
    assert strong(10.0, 1.0) > strong(1.0, 10.0)


def test_unseen_merchant(spark):
    df = merchants(spark)
    new = spark.createDataFrame([(99, 0)], "merchant_id long, is_fraud int")
    r = M.merchant_features(new, M.merchant_stats(df), M.global_rate(df)).first()
    assert (r["merchant_fraud_count"], r["merchant_total_count"]) == (0, 0)
    assert r["merchant_fraud_rate"] == pytest.approx(9 / 21)
