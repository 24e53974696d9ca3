"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Method: letters of the whole text give hashed n-grams of one to three characters.
Document frequencies are counted over all labelled documents in Spark.  Weights are
trained by follow-the-regularised-leader with an elastic net (L1 makes them sparse),
on a bounded sample per language: each part of the sample runs its own pass from
the common state, the states are averaged, and the next pass starts from there.  A
temperature, fitted on sample documents that were not trained on, calibrates the
probabilities.  Prediction is one map over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import query, table
from tallyward.llm.perfect_hash import mix
from tallyward.session import settle

BITS = 15
SIZE = 1 << BITS
#: States travel in strips of so many slots.
STRIP = 1 << 12
STATE = pa.schema([("part", pa.int32()), ("at", pa.int32()), ("z", pa.binary()), ("n", pa.binary())])
UNKNOWN = "und"
_SPACE = 32
_letters = np.zeros(0, dtype=bool)


def _is_letter(points: np.ndarray) -> np.ndarray:
    global _letters
    if not len(_letters):
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters[points]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, counts) of the text's n-grams; none if it has no letters."""
    none = np.zeros(0, dtype=np.int64)
    if not text:
        return none, none
    total, letters = None, False
    # Long texts go through in slices that overlap by two characters; counts add up.
    low = text.lower()
    for at in range(0, len(low), 1 << 18):
        piece = " " * (at == 0) + low[max(0, at - 2 * (at > 0)) : at + (1 << 18)] + " "
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        good = _is_letter(points)
        letters |= bool(good.any())
        points[~good] = _SPACE
        # Runs of anything but letters are one space.
        keep = good.copy()
        keep[1:] |= good[:-1]
        keep[0] = True
        points = points[keep]
        if len(points) < 3:
            continue
        a, b, c = points[:-2], points[1:-1], points[2:]
        grams = np.concatenate((mix(b, 1), mix((a << np.uint64(21)) | b, 2), mix((a << np.uint64(42)) | (b << np.uint64(21)) | c, 3)))
        counts = np.bincount((grams >> np.uint64(64 - BITS)).astype(np.int64), minlength=SIZE)
        total = counts if total is None else total + counts
    if not letters or total is None:
        return none, none
    slots = np.flatnonzero(total)
    return slots, total[slots]


def _vector(slots: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[slots]
    return x / max(np.sqrt((x * x).sum()), 1e-12)


@dataclass(frozen=True)
class Settings:
    """``sample`` is the number of labelled documents, over all languages, that weights are trained on.

    It is trained in up to ``parts`` parts of at least ``part_rows`` documents.
    """

    sample: int = 8000
    parts: int = 8
    part_rows: int = 500
    passes: int = 5
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.2
    l2: float = 0.01


def _weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """The closed form of the regularised leader."""
    size = np.abs(z) - s.l1
    return np.where(size > 0, -np.sign(z) * size / ((s.beta + np.sqrt(n)) / s.alpha + s.l2), 0.0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _pass(rows: list[tuple], z: np.ndarray, n: np.ndarray, idf: np.ndarray, s: Settings) -> None:
    """One pass over (label number, slots, counts), changing z and n in place."""
    for label, slots, counts in rows:
        x = _vector(slots, counts, idf)
        w = _weights(z[slots], n[slots], s)
        error = _softmax(x @ w)
        error[label] -= 1.0
        g = x[:, None] * error[None, :]
        more = n[slots] + g * g
        z[slots] += g - (np.sqrt(more) - np.sqrt(n[slots])) / s.alpha * w
        n[slots] = more


def _averaged(trained: DataFrame) -> DataFrame:
    """(at, z, n): the mean over the parts of each strip of their states, added in the order of the parts."""

    def mean(table_):
        ordered = table_.sort_by("part")
        means = [np.mean([np.frombuffer(x) for x in ordered[c].to_pylist()], axis=0).tobytes() for c in ("z", "n")]
        return pa.table([ordered["at"].slice(0, 1), *[[m] for m in means]], schema=pa.schema(list(STATE)[1:]))

    return trained.groupBy("at").applyInArrow(mean, "at int, z binary, n binary")


def _document_counts(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per slot, and their number, over all given documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(SIZE, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                slots, _ = ngram_counts(text.as_py())
                seen[slots] += 1
                n += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(seen[used], n), pa.int64())], ["slot", "n"]
        )

    rows = texts.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slot, n = rows.column("slot").to_numpy(), rows.column("n").to_numpy()
    out = np.zeros(SIZE, dtype=np.int64)
    out[slot[slot >= 0]] = n[slot >= 0]
    return out, int(n[slot < 0].sum())


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def column(self, spark: SparkSession, text: Column) -> Column:
        """struct(lang_pred, score): ``und`` and 0 for a null text or one without letters."""
        shared = spark.sparkContext.broadcast(
            (self.languages, self.idf.astype(np.float32), self.weights.astype(np.float32), self.temperature)
        )

        def predict(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
            names, idf, weights, temperature = shared.value
            for texts in arrays:
                lang, score = [], []
                for text in texts:
                    slots, counts = ngram_counts(text.as_py())
                    if not len(slots) or not names:
                        lang.append(UNKNOWN)
                        score.append(0.0)
                        continue
                    p = _softmax(_vector(slots, counts, idf) @ weights[slots] / temperature)
                    best = int(p.argmax())
                    lang.append(names[best])
                    score.append(min(1.0, float(p[best])))
                yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

        return F.arrow_udf(predict, "lang_pred string, score double")(text)


def fit(docs: DataFrame, text_col: str, label_col: str, key: Column, settings: Settings = Settings()) -> LanguageModel:
    """Learn from the rows of ``docs`` whose label is not null.

    ``key`` orders the sample (a hash of it is compared with each language's share);
    rows without a key are not sampled.  With no labelled rows the model knows no
    language and answers ``und``.
    """
    s, spark = settings, docs.sparkSession
    rows = docs.where(F.col(label_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"), F.xxhash64(F.lit(31), key).alias("h"), key.isNotNull().alias("ok")
    )
    per = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(per)
    if not names:
        return LanguageModel([], np.ones(SIZE), np.zeros((SIZE, 0)), 1.0)
    seen, total = _document_counts(rows.select("text"))
    idf = np.log((1 + total) / (1 + seen)) + 1.0
    # Each language gets an equal share of the sample; the draw is a threshold on a hash.
    unit = (F.col("h").cast("double") / F.lit(2.0**64)) + 0.5
    share = F.element_at(F.create_map(*[x for k in names for x in (F.lit(k), F.lit(s.sample / len(names) / per[k]))]), F.col("label"))
    number = F.array_position(F.array(*[F.lit(k) for k in names]), F.col("label")) - 1

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_counts(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                    pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32())),
                ],
                ["label", "h", "slots", "counts"],
            )

    drawn = rows.where(F.col("ok") & (unit < share)).select("text", number.cast("int").alias("label"), "h")
    sample = settle(drawn.mapInArrow(features, "label int, h long, slots array<int>, counts array<int>").where(F.size("slots") > 0))
    parts = max(1, min(s.parts, sample.count() // s.part_rows))
    # A fifth of the sample is for calibration; its part is -1.
    held_out = F.pmod(F.shiftright("h", 40), F.lit(5)) == 0
    sample = sample.withColumn("part", F.when(held_out, F.lit(-1)).otherwise(F.pmod(F.shiftright("h", 8), F.lit(parts)).cast("int")))
    z, n = np.zeros((SIZE, len(names))), np.zeros((SIZE, len(names)))
    weigh = spark.sparkContext.broadcast(idf)
    for _ in range(s.passes):
        shared = spark.sparkContext.broadcast((z, n))

        def train(table_):
            z0, n0 = (a.copy() for a in shared.value)
            ordered = table_.sort_by([("h", "ascending"), ("label", "ascending")])
            _pass(
                [
                    (label, np.asarray(slots.values), np.asarray(counts.values))
                    for label, slots, counts in zip(ordered["label"].to_pylist(), ordered["slots"], ordered["counts"], strict=True)
                ],
                z0,
                n0,
                weigh.value,
                s,
            )
            at = range(0, SIZE, STRIP)
            part = ordered["part"][0].as_py()
            strips = [[a[i : i + STRIP].tobytes() for i in at] for a in (z0, n0)]
            return pa.table([[part] * len(at), list(at), *strips], schema=STATE)

        trained = sample.where(F.col("part") >= 0).groupBy("part").applyInArrow(train, "part int, at int, z binary, n binary")
        # The parts' states meet strip by strip; one state of fixed size comes back.
        for row in _averaged(trained).toArrow().to_pylist():
            for state, name in ((z, "z"), (n, "n")):
                state[row["at"] : row["at"] + STRIP] = np.frombuffer(row[name]).reshape(-1, len(names))
        shared.destroy()
    weights = _weights(z, n, s)
    learned = spark.sparkContext.broadcast(weights)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                _vector(np.asarray(a.values), np.asarray(b.values), weigh.value) @ learned.value[np.asarray(a.values)]
                for a, b in zip(batch.column(1), batch.column(2), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["label", "logits"])

    # A number per language of each held-out document comes back, not its features.
    held = sample.where(F.col("part") < 0).select("label", "slots", "counts")
    held = held.mapInArrow(logits, "label int, logits array<double>").toArrow()
    weigh.destroy()
    learned.destroy()
    labels = held["label"].to_pylist()
    return LanguageModel(names, idf, weights, best_temperature(np.array(held["logits"].to_pylist()).reshape(-1, len(names)), labels))


def best_temperature(logits: np.ndarray, labels: list[int]) -> float:
    """The temperature in [0.05, 20] of least negative log-likelihood; 1 without data."""
    if not len(labels):
        return 1.0
    rows = np.arange(len(labels))

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(_softmax(logits / t)[rows, labels], 1e-12)).mean())

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 241))
    return float(min(grid, key=lambda t: (loss(t), t)))


def train_rows(docs: DataFrame) -> DataFrame:
    """The documents of the contract that a model may learn from."""
    return docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def fit_documents(spark: SparkSession, sf_dir: str) -> LanguageModel:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return fit(train_rows(docs), "text", "lang", F.col("doc_id"))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_documents(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", model.column(spark, F.col("text")).alias("p"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "p.lang_pred", "p.score")
