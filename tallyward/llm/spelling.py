"""Spelling variant grouping over a variable-length gram (VGRAM) index.

Method: a frequency-pruned gram dictionary is built from the distinct words: all
grams of ``QMIN`` letters, and a gram one letter longer (up to ``QMAX``) wherever
its prefix lies in more than ``EXTEND_SHARE`` of all words.  The dictionary is
prefix-closed.  Each word is decomposed at every position into the longest
dictionary gram there, grams inside an earlier gram dropped.  One edit at position
p can only change grams that reach p (start at or before p, end at or after it)
and the ``QMAX - QMIN`` grams after p that a grown gram might swallow; the largest
such count over all p is the word's number of affected grams (NAG), and two words
one edit apart share at least ``|VG| - NAG`` grams of each.  All of these stand at
the same place, counted from the start before the edit and from the end after it.
So a word is listed, for every p, under all grams that an edit at p leaves (its
surviving grams, with their places and the two lengths), and words one edit apart
meet in such a list.  Lists are thus cut by as many grams as the bound allows, not
by one gram, which lies in a share of all words.  Candidates whose letters cannot
differ by one edit (a bit per letter, the parity of its count) are left out; the
others are verified by edit distance.

Words whose bound is not positive (mostly short ones) cannot be found by counting
grams; for them an exact deletion-neighbourhood join (the word, and each deletion
with its position) finds every word one edit away.

Shape of the plan: words are counted with map-side partial counts; gram
frequencies likewise; only grams above the share (at most ``(QMAX - QMIN + 1) x
mean length / EXTEND_SHARE`` of them) are sent to the tasks that decompose words.
The gram join is keyed by a 64-bit hash of the surviving grams.
Roots follow forms by pointer doubling, each round written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.llm.common import ascii_lower, checked, query, table
from tallyward.session import settle

QMIN = 2
QMAX = 4
EXTEND_SHARE = 0.01
# Fixed values of the contract.
MIN_CHARS = 5
# Maximal runs of at least so many letters: a deletion only makes a run shorter.
RUN = r"[A-Za-z\x{00C0}-\x{00FF}]{%d,}" % MIN_CHARS
MIN_COUNT = 3
DROP_MOD = 97


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, len): distinct words after the contract's deletion rule, with their occurrence counts.

    Null text has no runs.  A null id is written ``null`` in the hashed key.  Only
    words of at least 5 code points and 3 occurrences are kept.
    """
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("__id"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(RUN), 0)).alias("r"),
    )
    runs = runs.select("__id", ascii_lower(F.col("r")).alias("r"))
    h = F.crc32(F.encode(F.concat("__id", F.lit(":"), "r"), "UTF-8"))
    at = (h % F.char_length("r")).cast("int")
    cut = F.concat(F.substring("r", 1, at), F.substring(F.col("r"), at + 2, 1 << 30))
    words = runs.select(F.when(h % DROP_MOD == 0, cut).otherwise(F.col("r")).alias("word"))
    # The length is an aggregate, so that its filter does not compute the hash of every run again.
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.max(F.char_length("word")).alias("len"))
    return counted.where((F.col("len") >= MIN_CHARS) & (F.col("n") >= MIN_COUNT))


def _frequent_grams(words: DataFrame) -> frozenset[str]:
    """Grams of less than ``QMAX`` letters that stand in more than the share of all words."""
    pos = words.select("word", "len", F.explode(F.sequence(F.lit(0), F.col("len") - QMIN)).alias("i"))
    top = F.least(F.lit(QMAX - 1), F.col("len") - F.col("i"))
    grams = pos.select(F.explode(F.transform(F.sequence(F.lit(QMIN), top), lambda l: F.substring("word", F.col("i") + 1, l))).alias("g"))
    total = words.count()
    often = grams.groupBy("g").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") > F.lit(EXTEND_SHARE * total))
    return frozenset(r[0] for r in often.select("g").collect())


def _grams(word: str, often: frozenset[str]) -> list[tuple[int, int]]:
    """(position, length) of the longest gram at each position, without those inside an earlier one."""
    out, reach, n = [], 0, len(word)
    for i in range(n - QMIN + 1):
        l, top = QMIN, min(QMAX, n - i)
        while l < top and word[i : i + l] in often:
            l += 1
        if i + l > reach:
            reach = i + l
            out.append((i, l))
    return out


def decompose(words: DataFrame) -> DataFrame:
    """(word, i, g, l): the VGRAM decomposition of every word (positions from 0)."""
    shared = words.sparkSession.sparkContext.broadcast(_frequent_grams(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_grams(w, shared.value) for w in batch.column(0).to_pylist()]
            places = [pa.array([[g[j] for g in gs] for gs in found], pa.list_(pa.int32())) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *places], ["word", "at", "long"])

    each = words.select("word").mapInArrow(run, "word string, at array<int>, long array<int>")
    rows = each.select("word", F.explode(F.arrays_zip("at", "long")).alias("p")).select("word", F.col("p.at").alias("i"), F.col("p.long").alias("l"))
    return rows.select("word", "i", "l", F.substring("word", F.col("i") + 1, F.col("l")).alias("g"))


def affected(grams: DataFrame) -> DataFrame:
    """(word, nag, size): the most grams one edit can change, and the number of grams."""
    # Gram at i is hit by an edit at p in [i - (QMAX - QMIN), i + l]: a sweep over those intervals.
    ev = grams.select(
        "word",
        F.explode(
            F.array(
                F.struct((F.col("i") - (QMAX - QMIN)).alias("p"), F.lit(1).alias("d")),
                F.struct((F.col("i") + F.col("l") + 1).alias("p"), F.lit(-1).alias("d")),
            )
        ).alias("e"),
    ).select("word", "e.p", "e.d")
    at = ev.groupBy("word", "p").agg(F.sum("d").alias("d"))
    w = Window.partitionBy("word").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    depth = at.withColumn("c", F.sum("d").over(w))
    nag = depth.groupBy("word").agg(F.max("c").alias("nag"))
    size = grams.groupBy("word").agg(F.count(F.lit(1)).alias("size"))
    return nag.join(size, "word")


def _deletion_keys(words: DataFrame) -> DataFrame:
    """(word, len, key, at): the word itself (at -1) and each one-letter deletion with its position."""
    dels = words.select(
        "word", "len", F.explode(F.sequence(F.lit(0), F.col("len") - 1)).alias("at")
    ).withColumn("key", F.concat(F.substring("word", 1, F.col("at")), F.substring(F.col("word"), F.col("at") + 2, 1 << 30)))
    return dels.unionByName(words.select("word", "len", F.col("word").alias("key"), F.lit(-1).alias("at")))


def surviving(grams: list[tuple[int, int]], n: int, longest: int, slack: int) -> set[tuple[int, int]]:
    """(end, start) over edits at 0 to ``longest`` of a word of n letters.

    Grams before the edit cover the letters up to ``end``, those that start ``slack``
    or more after it the letters from ``start``.
    """
    out, before, after = set(), 0, 0
    for p in range(longest + 1):
        while before < len(grams) and sum(grams[before]) < p:
            before += 1
        while after < len(grams) and grams[after][0] < p + slack:
            after += 1
        out.add((sum(grams[before - 1]) if before else 0, grams[after][0] if after < len(grams) else n))
    return out


def _listed(words: DataFrame) -> DataFrame:
    """(word, len, bound, parity, changed, grown): VGRAM bound of each word, what edits leave of it.

    ``changed`` has the cuts of an edit that replaces or deletes a letter, ``grown``
    of one that inserts a letter.  A letter that goes is itself no longer there, so
    grams after it start one place further on than after a gap that is filled.
    """
    shared = words.sparkSession.sparkContext.broadcast(_frequent_grams(words))
    grow = QMAX - QMIN
    schema = "word string, len int, bound int, parity long, changed array<struct<e:int,s:int>>, grown array<struct<e:int,s:int>>"
    cuts = pa.list_(pa.struct([("e", pa.int32()), ("s", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            bound, parity, changed, grown = [], [], [], []
            for w in names:
                grams, n = _grams(w, shared.value), len(w)
                hit = [0] * (n + 2)
                for i, l in grams:
                    hit[max(0, i - grow)] += 1
                    hit[i + l + 1] -= 1
                most = now = 0
                for d in hit:
                    now += d
                    most = max(most, now)
                bits = 0
                for c in w:
                    bits ^= 1 << (ord(c) & 63)
                parity.append(bits - (1 << 64) if bits >> 63 else bits)
                bound.append(len(grams) - most)
                some = bound[-1] > 0
                changed.append([{"e": e, "s": t} for e, t in surviving(grams, n, n - 1, grow + 1)] if some else [])
                grown.append([{"e": e, "s": t} for e, t in surviving(grams, n, n, grow)] if some else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(w) for w in names], pa.int32()),
                    pa.array(bound, pa.int32()),
                    pa.array(parity, pa.int64()),
                    pa.array(changed, cuts),
                    pa.array(grown, cuts),
                ],
                ["word", "len", "bound", "parity", "changed", "grown"],
            )

    return words.select("word").mapInArrow(run, schema)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of distinct words one insertion, deletion or substitution apart."""
    nag = settle(_listed(words))

    def lists(name: str, cuts: str, shorter: int) -> DataFrame:
        """(name, its bits, key): the lists a word stands in; the shorter word of the pair has ``shorter`` letters less."""
        rows = nag.select("word", "parity", (F.col("len") - shorter).alias("m"), F.explode(cuts).alias("c"))
        left = F.substring(F.col("word"), F.lit(1), F.col("c.e"))
        right = F.substring(F.col("word"), F.col("c.s") + 1, F.lit(1 << 30))
        key = F.xxhash64("m", left, F.lit("\u0000"), right).alias("key")
        return rows.select(F.col("word").alias(name), F.col("parity").alias(f"bits_{name}"), key)

    def near(odd: int) -> Column:
        return (F.bit_count(F.col("bits_a").bitwiseXOR(F.col("bits_b"))) <= odd) & (F.levenshtein("a", "b", 1) == 1)

    equal = lists("a", "changed", 0).join(lists("b", "changed", 0), "key")
    equal = equal.where((F.col("a") < F.col("b")) & near(2)).select("a", "b")
    apart = lists("a", "grown", 0).join(lists("b", "changed", 1), "key").where(near(1))
    apart = apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    by_grams = equal.unionByName(apart)
    # Exact rest: every pair with a word whose bound is not positive.
    short = nag.where(F.col("bound") <= 0).select("word", "len")
    lens = settle(short.select(F.explode(F.array(F.col("len") - 1, F.col("len"), F.col("len") + 1)).alias("len")).distinct())
    keys = _deletion_keys(nag.select("word", "len").join(checked(lens), "len", "left_semi"))
    mine = _deletion_keys(short)
    met = mine.alias("x").join(
        keys.alias("y"),
        (F.col("x.key") == F.col("y.key"))
        & (((F.col("x.at") == F.col("y.at")) & (F.col("x.at") >= 0)) | ((F.col("x.at") < 0) != (F.col("y.at") < 0))),
    ).where(F.col("x.word") != F.col("y.word"))
    rest = met.select(F.least("x.word", "y.word").alias("a"), F.greatest("x.word", "y.word").alias("b"))
    return by_grams.unionByName(rest).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by pointer doubling over (word, form); forms only go to larger counts, so chains end."""
    cur = settle(forms.select("word", F.coalesce("form", "word").alias("up")))
    while True:
        nxt = cur.alias("c").join(cur.alias("u"), F.col("c.up") == F.col("u.word"), "left").select(
            F.col("c.word").alias("word"), F.coalesce(F.col("u.up"), F.col("c.up")).alias("up")
        )
        nxt = settle(nxt)
        moved = nxt.alias("n").join(cur.alias("c"), "word").where(F.col("n.up") != F.col("c.up")).limit(1).count()
        cur = nxt
        if moved == 0:
            return cur.withColumnRenamed("up", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per counted word: word, form, root, n, n_near, form_n (the contract of op11).

    A word's form is its near word of largest count (ties: smallest word), if that
    count is at least twice its own; else null.  root follows forms to the end (the
    word itself without a form).  n_near counts near words, 0 if none.  Empty input
    or text without runs gives no rows; repeated rows count each time; other input
    columns are ignored.
    """
    words = settle(word_counts(docs, id_col, text_col))
    pairs = settle(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"))
    )
    both = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("on")), "other")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("on")).alias("neg"), F.col("other").alias("w"))).alias("b")
    )
    table_ = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("b.neg") >= 2 * F.col("n"), F.col("b.w")).alias("form"),
        F.when(-F.col("b.neg") >= 2 * F.col("n"), -F.col("b.neg")).cast("long").alias("form_n"),
    )
    table_ = settle(table_)
    roots = _roots(table_.select("word", "form"))
    return table_.join(roots, "word").select("word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", "form_n")


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
