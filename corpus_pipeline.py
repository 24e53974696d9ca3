"""From raw documents to token ids: language, lines, near copies, benchmark passages, encoding.

Each stage reads what the one before it wrote, in the folder that all executors share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import table
from tallyward.llm.decontaminate import drop_contaminated
from tallyward.llm.jaccard_join import keep_one
from tallyward.llm.language import UNKNOWN, fit, train_rows
from tallyward.llm.line_dedup import drop_repeated_lines
from tallyward.llm.sentencepiece_unigram import default_model, round_trips, share
from tallyward.session import fresh_path

#: A document is rejected when its language is unknown or its calibrated score is lower.
MIN_SCORE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts that are null or without letters go."""
    model = fit(train_rows(docs), "text", "lang", F.col("doc_id"))
    judged = docs.withColumn("__p", model.column(spark, F.col("text")))
    return judged.where((F.col("__p.lang_pred") != UNKNOWN) & (F.col("__p.score") >= MIN_SCORE)).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share; ``n_chars`` follows the text."""
    out = drop_repeated_lines(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return out.withColumns(new).select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, checked by decoding them."""
    return round_trips(docs, share(spark, default_model()))


STAGES = [
    ("language id", language_stage),
    ("line dedup", line_stage),
    ("near copies", near_copy_stage),
    ("benchmark decontamination", benchmark_stage),
    ("piece encoding", encoding_stage),
]

#: Stages 1 and 5 are no SQL; tests/llm holds the whole run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
