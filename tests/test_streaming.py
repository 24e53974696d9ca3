"""Streams in several micro-batches equal the batch operators."""

import pytest
from pyspark.sql import functions as F

from tallyward.operators.heavy import Heavy
from tallyward.operators.sequences import user_sequences
from tallyward.operators.velocity import velocity
from tallyward.plans import views as V
from tallyward.streaming import online as On


@pytest.fixture(scope="module")
def source(spark, sf, tmp_path_factory):
    """Transactions in four files, in time order, one file per micro-batch."""
    folder = tmp_path_factory.mktemp("stream")
    t = V.tx(spark, sf).where("user_id < 6").cache()
    n = t.agg(F.max("transaction_id")).first()[0] + 1
    for i in range(4):
        part = t.where((F.col("transaction_id") >= n * i // 4) & (F.col("transaction_id") < n * (i + 1) // 4))
        part.coalesce(1).write.mode("append").parquet(str(folder))
    return t, str(folder)


def stream(spark, source):
    t, folder = source
    return spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def same(a, b):
    assert a.count() == b.count() > 0
    assert a.select(*sorted(a.columns)).exceptAll(b.select(*sorted(a.columns))).count() == 0


def test_velocity(spark, source):
    got = On.drain(On.velocity_stream(stream(spark, source), windows=[(1, "h"), (7, "d")]), "v")
    want = velocity(source[0], windows=[(1, "h"), (7, "d")])
    r = lambda d: d.withColumns({c: F.round(c, 6) for c in d.columns if "mean" in c})
    same(r(got), r(want))


def test_rate_limit(spark, source):
    got = On.drain(On.rate_limit_stream(stream(spark, source), "user_id", "timestamp", "transaction_id", 1, 86400), "k")
    same(got, On.rate_limit_batch(source[0], "user_id", "timestamp", "transaction_id", 1, 86400))


@pytest.mark.parametrize("rule", [Heavy(), Heavy(0.0, 0)])
def test_repeats(spark, source, rule):
    got = On.drain(On.suppress_repeats_stream(stream(spark, source), "user_id", "timestamp", "transaction_id", 86400), "r")
    same(got, On.suppress_repeats_batch(source[0], "user_id", "timestamp", "transaction_id", 86400, rule))


def test_sequences(spark, source):
    got = On.drain(On.sequence_stream(stream(spark, source), 5, ["amount"]), "s")
    same(got, user_sequences(source[0], 5, ["amount"]).select("transaction_id", "user_id", "length", "sequence"))


def test_deduplication_within_the_watermark(spark, source):
    out = On.drain(On.drop_repeated_keys(stream(spark, source), "user_id", "timestamp", 30 * 86400), "d")
    assert out.count() == source[0].select("user_id").distinct().count()


def test_default_limit_and_counts(spark, source):
    b = On.rate_limit_batch(source[0], "user_id", "timestamp", "transaction_id")
    assert b.where("not allowed").count() == 0 and b.agg(F.max("remaining")).first()[0] == 99
