"""Surrogates over arrays: the same draws as in columns, each made once and next to its row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.functions import hashing as H
from tallyward.functions import scoring as S
from tallyward.operators import explain as Ex
from tallyward.plans.explain_queries import steep

FEATS = S.RULE_FEATURES


def rows(spark, key="long"):
    rng = np.random.default_rng(3)
    data = [[i if i % 7 else i // 14, *map(float, rng.random(4) * [900, 1, 15, 200])] for i in range(60)]  # keys repeat
    data[3][0] = data[20][0] = None
    data[5][1] = data[6][2] = data[8][2] = None  # a missing amount counts in full, a missing risk leaves no score
    data[9][3], data[10][2], data[11][1] = float("nan"), float("nan"), float("inf")
    data.append([data[8][0], 5.0, 0.5, 2.0, 100.0])  # shares its key with a record that has no score
    schema = "transaction_id long, " + ", ".join(f"{f} double" for f in FEATS)
    return spark.createDataFrame(data, schema).withColumn("transaction_id", F.col("transaction_id").cast(key)).repartition(3)


def table(df):
    found = df.collect()
    out = {(r[0], r[1]): r[2] for r in found}
    assert len(out) == len(found)
    return out


def test_hashes_are_those_of_spark(spark):
    texts = ["42:0:r", "42:0:a", "7", "seven..", "12345678", "123456789abcdef!", "123456789abcdef!" + "x" * 15]
    df = spark.range(1, 40).withColumn("d", (F.col("id") * 7919 - 90_000).cast("int"))
    cols = [F.xxhash64("id").alias("h"), F.xxhash64("id", "d").alias("hd"), *[F.xxhash64("id", "d", F.lit(t)) for t in texts]]
    got = np.array(df.select("d", *cols).collect(), dtype=np.int64)
    root = H.carried_int(got[:, 0], got[:, 1].copy().view(np.uint64))
    assert (root.view(np.int64) == got[:, 2]).all()
    for i, t in enumerate(texts):
        h = next(H.carried_texts([t], root, np.empty_like(root)))
        assert (h.view(np.int64) == got[:, 3 + i]).all()
    two = list(H.carried_texts(texts[:2], root, np.empty_like(root)))
    assert (np.array(two).view(np.int64) == got[:, 3:5].T).all()


@pytest.mark.parametrize("preset, key, top_n", [("surrogate", "long", None), ("half_std", "string", None), ("surrogate", "string", 2)])
def test_arrays_give_what_columns_give(spark, preset, key, top_n):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # a key's records come in several batches
    # a table without nulls and NaN has finite deviations, one with them has not
    try:
        for df in (rows(spark, key), rows(spark, key).where("not isnan(merchant_risk) and not isnan(velocity_1h) and amount < 1e6")):
            a, b = (table(Ex.local_surrogate(df, FEATS, steep, draws=60, top_n=top_n, preset=preset, arrays=x)) for x in (False, True))
            if top_n is None:
                assert a.keys() == b.keys()
            assert len(a) == len(b)
            same = [k for k in a if k in b]
            assert len(same) >= 0.95 * len(a)  # equal sizes may be ordered by rounding
            assert all((a[k] is None) == (b[k] is None) for k in same)
            assert all(b[k] == pytest.approx(a[k], abs=1e-9, nan_ok=True) for k in same if a[k] is not None)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


@pytest.mark.parametrize("half", [False, True])
def test_blocks_do_not_change_the_sums(monkeypatch, half):
    rng = np.random.default_rng(5)
    h, x, s = rng.integers(0, 1 << 63, 23).astype(np.uint64), rng.random((23, 4)) * 50, rng.random((23, 4))
    sums = []
    for block in (60, 150, 10_000):
        monkeypatch.setattr(Ex, "_BLOCK_DRAWS", block)
        sums.append(Ex._draw_sums(h, x, s, FEATS, steep, 60, 42, 1.0, half))
    assert np.allclose(sums[0], sums[2], rtol=1e-12) and np.allclose(sums[1], sums[2], rtol=1e-12)
    alone = Ex._draw_sums(h[:1], x[:1], s[:1], FEATS, steep, 30_000, 42, 1.0, half)  # products in several parts
    assert alone[0, 0, 1:5] == pytest.approx(alone[0, 1:, 0], rel=1e-12)
    assert abs(alone[0, 0, 1]) < 0.02 * alone[0, 0, 0]


def test_draws_never_become_rows(spark):
    df = Ex.local_surrogate(rows(spark), FEATS, steep, draws=50, top_n=3, preset="half_std", arrays=True)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" not in plan and "Join" not in plan and "Window" not in plan
    assert "RepartitionByExpression" in plan


def test_cosine_of_a_share():
    a = np.random.default_rng(4).integers(0, 1 << 31, 100_000).astype(np.uint32)
    a[:4] = 0, (1 << 31) - 1, (1 << 20) - 1, 1 << 20
    assert np.abs(Ex._cosine(a) - np.cos((a + 0.5) * 2.0**-31 * 2 * np.pi)).max() < 2e-15


def test_importance_fits_the_surrogates_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    local = Ex.linear_contributions(rows(spark), {"amount": 2.0, "velocity_1h": -1.0})
    want = table_of(local)
    once = local.mapInArrow(counted, local.schema)
    got = {r[0]: r[1] for r in Ex.surrogate_importance(once).collect()}
    assert calls.value == 2 * rows(spark).count()
    assert got.keys() == want.keys()
    assert all(got[f] == pytest.approx(want[f], nan_ok=True) for f in want)


def table_of(local):
    n = local.select("transaction_id").where("transaction_id is not null").distinct().count()
    return {r[0]: r[1] / n for r in local.groupBy("feature").agg(F.sum(F.abs("contribution"))).collect()}
