"""The pipeline and its stages against plain versions over the small tables; queries against their SQL."""

import importlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as Cp
from scripts.check_queries import norm
from tallyward.llm import sentencepiece_unigram as Su
from tests.llm.test_jaccard_search import plain_join
from tests.llm.test_lines_secrets import plain_lines

entry = importlib.import_module("__spark_entry__")
NAMES = sorted(n for n in entry.queries() if n.startswith("op"))


def test_all_eleven_are_registered():
    assert [sum(n.startswith(f"op{k}_") for n in NAMES) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in entry.queries()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in sorted(os.listdir(sf)):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", [n for n in NAMES if n in entry.oracle_sql()])
def test_query_equals_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    assert got == sorted((tuple(norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)


def test_pipeline_equals_its_plain_version(spark, sf):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    langs = Cp.language_stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    kept = sorted(r["doc_id"] for r in langs.collect())
    assert langs.columns == list(next(iter(docs.values())).asDict()) and len(kept) >= 0.99 * len(docs)
    texts = {i: t for i, t, *_ in plain_lines([(i, docs[i]["text"]) for i in kept])}
    one = [i for i, _, root, _ in plain_join(sorted(texts.items())) if i == root]
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    codec = Su.Codec(Su.default_model())
    want = {i: codec.encode(texts[i]) for i in one if not any(x in texts[i] for x in items)}
    got = {r["doc_id"]: r for r in Cp.run(spark, sf).collect()}
    assert {i: r["ids"] for i, r in got.items()} == want
    assert all(r["exact"] for r in got.values())


def test_stages_take_odd_rows(spark, sf):
    rows = [(None, "some words without an id here", "en", "s", 5), (1, None, None, None, None), (2, "", "en", "s", 0), (3, "x" * 200000, "en", "s", 1)]
    rows += [(4, "plain english words of the usual kind in a row", "en", "s", 1)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for part in (df, df.limit(0)):
        docs = part
        for _, stage in Cp.STAGES:
            docs = stage(spark, docs, sf)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() == 0


def test_row_counts_of_the_last_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20)
    assert Cp.encoding_stage(spark, docs, sf).where(F.col("exact")).count() == 20
