import pytest
from pyspark.sql import functions as F

from tallyward.functions import columns as C
from tallyward.functions import hashing as H
from tallyward.sources import quality as Q
from tallyward.sources import readers as R
from tallyward.sources import sinks


def card_line(k, label):
    return ",".join([str(float(k))] + ["0.5"] * 28 + ["10.0", str(label)])


def write(path, lines):
    path.write_text(",".join(R.CARD_COLUMNS) + "\n" + "\n".join(lines) + "\n")
    return str(path)


def test_card_csv(spark, tmp_path):
    good = write(tmp_path / "good.csv", [card_line(i, i % 2) for i in range(3)])
    df = R.read_card_csv(spark, good)
    assert df.count() == 3 and df.columns == R.CARD_COLUMNS
    with pytest.raises(Exception):
        R.read_card_csv(spark, str(tmp_path / "absent.csv"))
    bad = write(tmp_path / "bad.csv", [card_line(0, 0).replace("10.0", "ten")])
    with pytest.raises(Exception):
        R.read_card_csv(spark, bad, validate=False).collect()
    label = write(tmp_path / "label.csv", [card_line(0, 2)])
    with pytest.raises(ValueError, match="Class not in"):
        R.read_card_csv(spark, label)


def test_validation_messages(spark):
    assert "missing columns" in Q.validate_card(spark.range(1))[0]
    df = spark.createDataFrame([("x", 1)], "Amount string, Class int")
    assert Q.validate_card(df, ["Amount", "Class"]) == ["Amount is not numeric"]
    df = spark.createDataFrame([(None, 1), (2.0, 3)], "Amount double, Class int")
    assert Q.validate_card(df, ["Amount", "Class"]) == ["Amount has nulls", "Class not in {0,1}"]


def test_formats_and_labels(spark, tmp_path):
    with pytest.raises(ValueError):
        R.read_table(spark, "x", "pickle")
    df = spark.createDataFrame([(1, 0)], "v int, y int")
    assert R.detect_label(df) == "y"
    assert R.detect_label(df.withColumn("Class", F.lit(1)).withColumn("z", F.lit(1))) == "Class"
    with pytest.raises(ValueError):
        sinks.export_failures(df, str(tmp_path / "x"), "excel")


def test_records_and_quarantine(spark):
    df = spark.createDataFrame([(1, "12.5", None), (2, "bad", "0.4")], "transaction_id int, amount string, merchant_risk string")
    got = [list(r) for r in R.normalise_records(df).orderBy("transaction_id").collect()]
    assert got == [[1, 12.5, 0.0, 0.0, 0.0], [2, 0.0, 0.4, 0.0, 0.0]]
    rows = spark.createDataFrame([("a", 0.0, 0.5), ("b", -1.0, 1.5), (None, 1.0, 0.0)], "transaction_id string, amount double, merchant_risk double")
    q = Q.quarantine(rows, Q.request_rules(rows)).orderBy("amount").collect()
    assert [r["reasons"] for r in q] == [["amount_out_of_range", "merchant_risk_out_of_range"], [], ["transaction_id_missing"]]
    strict = Q.quarantine(rows, Q.request_rules(rows, strict_amount=True)).where("amount = 0").first()
    assert strict["reasons"] == ["amount_out_of_range"]
    with pytest.raises(ValueError):
        Q.required_fields(rows)


def test_bins_at_their_edges(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.5,), (600.0,)], "v double")
    b = C.right_closed_bin(F.col("v"), C.AMOUNT_EDGES)
    assert [r[0] for r in df.select(b).collect()] == [None, "(0, 10]", "(10, 50]", "(500, inf]"]


def test_text_helpers(spark):
    df = spark.createDataFrame([("avg_transaction_amt_30d", 1234.5, 0.125)], "f string, v double, p double")
    r = df.select(C.readable_name(F.col("f")), C.currency_text(F.col("v")), C.number_text(F.col("v")), C.percent_text(F.col("p"))).first()
    assert list(r) == ["Average Transaction Amount 30 Days", "$1,234.50", "1,234.50", "12.5%"]


def test_fingerprint_is_the_json_hash(spark):
    import hashlib
    import json

    values = {"b": 12345678.5, "a": 3, "c": 0.25}
    df = spark.createDataFrame([(3, 12345678.5, 0.25)], "a int, b double, c double")
    fields = {"a": F.col("a").cast("string"), "b": H.json_number(F.col("b")), "c": H.json_number(F.col("c"))}
    want = hashlib.sha256(json.dumps(values, sort_keys=True).encode()).hexdigest()[:16]
    assert df.select(H.fingerprint(fields)).first()[0] == want


def test_hash_unit_is_uniform(spark):
    s = spark.range(4000).select(H.hash_unit(F.col("id"), "s").alias("u")).agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(s[0] - 0.5) < 0.03 and s[1] >= 0 and s[2] < 1
