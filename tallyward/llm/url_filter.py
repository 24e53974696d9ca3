"""URL filters: rules first, then naive Bayes over segmented host and path words.

Method: a host label such as ``freebets`` is split by unigram Viterbi into the words
of highest total log probability.  Word counts come from the text of all pages (not
from urls, where a joined name would be its own word), counted in Spark; a label meets
only the counted words that are substrings of it, by a join.  Multinomial naive Bayes
then scores the words of host and path: both classes have the words of labelled examples, smoothed by how common a
word is among the distinct hosts of the corpus, so words that any host has say little.

Shape of the plan: word counts are partial sums; each distinct label is segmented
once; labels and their words are grouped per label, whose substrings are bounded by
the square of its length.  A host's words are joined back to its pages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import ascii_lower, query, table
from tallyward.session import settle

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``site`` holds for its host and all subdomains, ``path`` for paths that start with it."""

    site: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.site + self.path


#: Fixed values of the contract.
RULES = (
    Rule("org", "/", ALLOW),
    Rule("example.org", "/es/", BLOCK),
    Rule("example.org", "/en/1", BLOCK),
    Rule("com", "/fr/", ALLOW),
    Rule("com", "/de/", BLOCK),
)

#: Labelled examples (stated values, public knowledge of url spam): names of sites nobody wants in a corpus ...
BLOCK_EXAMPLES = """
casino win casino online casino bonus free bets best bets sports betting bet now poker win poker room slots jackpot lottery winner
adult videos adult x adult chat xxx movies xxx tube porn videos free porn sex chat sex cams nude pics hot girls escort girls
spam farm link farm seo spam buy backlinks cheap backlinks payday loans fast loans easy money make money get rich earn cash
cheap viagra buy pills cheap meds online pharmacy weight loss pills replica watches cheap replica fake designer warez crack
keygen crack serial ads track ad tracker ads tracking banner ads popup ads click tracker torrents free torrents malware
phishing scam free iphone free gift free prize free cash click here hot deals
""".split()
#: ... and names of ordinary ones.
ALLOW_EXAMPLES = """
daily news world news local news city library public library open university state university science journal history museum
weather report travel guide cooking recipes garden tips health clinic school board research institute free software open source
documentation reference manual user guide developer blog photo blog music review book review film festival sports club football
club community forum help center support online learning online course job center city council farm market family farm games
encyclopedia dictionary map service radio station television guide art gallery
""".split()

PRIOR_BLOCK = 0.2
#: Words that the background adds to each class.
SMOOTH = 50.0
LONGEST_WORD = 24
#: Least log odds of blocking.
MARGIN = 0.0


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): see the contract; both empty for null or without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, text.substr(at + 3, F.char_length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = rest.substr(F.char_length(host) + 1, F.char_length(rest))
    return ascii_lower(host), F.regexp_extract(tail, "^[^?#]*", 0)


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, nulls if none does; ties go to the first listed."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: -len(r.name))[::-1]:
        fits = ((host == r.site) | host.endswith("." + r.site)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def labels_of(host: Column) -> Column:
    """The labels of a host that name the site: without its last one (the top-level domain) and port."""
    parts = F.split(F.regexp_replace(host, ":[0-9]*$", ""), "\\.")
    return F.when(F.size(parts) > 1, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def word_counts(pages: DataFrame, html: str) -> DataFrame:
    """(word, n): lower-case words of the text between the tags of all pages."""
    bare = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), "<[^>]*>", " ")
    texts = pages.select(bare.alias("t"))
    words = texts.select(F.explode(F.regexp_extract_all(F.lower("t"), F.lit("[\\p{L}]+"), F.lit(0))).alias("word"))
    return words.where(F.char_length("word") <= LONGEST_WORD).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def viterbi(label: str, log_p: dict[str, float], unknown: float) -> list[str]:
    """The split of highest total log probability; an unknown stretch costs ``unknown`` per letter. Ties: fewer, longer words first."""
    n = len(label)
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)] + [(-math.inf, 0, 0)] * n  # score, -words, start
    for end in range(1, n + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            p = log_p.get(label[start:end])
            score = best[start][0] + (unknown * (end - start) - math.log(10.0) if p is None else p)
            if (score, best[start][1] - 1) > best[end][:2]:
                best[end] = (score, best[start][1] - 1, start)
    out, end = [], n
    while end:
        out.append(label[best[end][2] : end])
        end = best[end][2]
    return out[::-1]


def segment(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) of each distinct label; hyphens, digits and other marks part words beforehand."""
    spark = labels.sparkSession
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    runs = labels.select("label").distinct().select(
        "label", F.posexplode(F.regexp_extract_all("label", F.lit("[\\p{L}]+"), F.lit(0))).alias("i", "run")
    )
    distinct_runs = runs.select("run").distinct()
    starts = F.sequence(F.lit(1), F.char_length("run"))
    pieces = distinct_runs.select("run", F.explode(starts).alias("i")).select(
        "run", "i", F.explode(F.sequence(F.lit(1), F.least(F.char_length("run") - F.col("i") + 1, F.lit(LONGEST_WORD)))).alias("k")
    )
    pieces = pieces.select("run", F.col("run").substr(F.col("i"), F.col("k")).alias("word")).distinct()
    known = pieces.join(counts, "word").groupBy("run").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    asked = distinct_runs.join(known, "run", "left")
    seeds = sorted(set(BLOCK_EXAMPLES + ALLOW_EXAMPLES))
    shared = spark.sparkContext.broadcast((total, seeds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, named = shared.value
        # The words of the examples are words of the language, as common as one in 20 000.
        floor = max(1.0, n / 20_000)
        norm = math.log(max(1.0, n + floor * len(named)))
        base = {w: math.log(floor) - norm for w in named}
        for batch in batches:
            out = []
            for text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                log_p = dict(base)
                for x in found or ():
                    p = math.log(x["n"]) - norm
                    log_p[x["word"]] = max(p, log_p.get(x["word"], -math.inf))
                out.append(viterbi(text, log_p, -norm))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], ["run", "words"])

    split = asked.mapInArrow(run, "run string, words array<string>")
    parts = runs.join(split, "run").groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "words"))).alias("parts"))
    return parts.select("label", F.flatten(F.transform("parts", lambda p: p["words"])).alias("words"))


@dataclass
class NaiveBayes:
    """log P(word | block) - log P(word | allow) for the words of the examples; others weigh nothing."""

    odds: dict[str, float]
    prior: float

    @classmethod
    def fit(cls, corpus: dict[str, int], corpus_total: int) -> NaiveBayes:
        """``corpus``: counts of the example words among the words of all distinct hosts."""
        words = sorted(set(BLOCK_EXAMPLES + ALLOW_EXAMPLES))
        share = {w: (corpus.get(w, 0) + 1) / (corpus_total + len(words)) for w in words}

        def log_p(examples: list[str], w: str) -> float:
            return math.log((examples.count(w) + SMOOTH * share[w]) / (len(examples) + SMOOTH))

        odds = {w: log_p(BLOCK_EXAMPLES, w) - log_p(ALLOW_EXAMPLES, w) for w in words}
        return cls(odds, math.log(PRIOR_BLOCK) - math.log(1 - PRIOR_BLOCK))

    def score(self, words: Column) -> Column:
        """Log odds of blocking, summed word by word."""
        table_ = F.create_map(*[x for w, v in sorted(self.odds.items()) for x in (F.lit(w), F.lit(v))])
        return F.aggregate(words, F.lit(self.prior), lambda acc, w: acc + F.coalesce(F.try_element_at(table_, w), F.lit(0.0)))


def judge(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``pages`` with host, path, rule, words, score and verdict.

    The longest rule that fits decides; else naive Bayes does.  A null url, or one
    without ``://``, has an empty host and path, no words, and the verdict of the
    prior alone (allow).  Columns of these names are replaced, others stay.
    """
    host, path = split_url(F.col(url_col))
    work = pages.withColumns({"__host": host, "__path": path})
    counts = settle(word_counts(pages, html_col))
    hosts = work.select(F.col("__host").alias("host")).distinct()
    labels = hosts.select("host", F.posexplode(labels_of(F.col("host"))).alias("i", "label"))
    split = segment(labels, counts)
    host_words = labels.join(split, "label").groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("i", "words"))).alias("parts")
    )
    host_words = host_words.select(
        F.col("host").alias("__h"), F.flatten(F.transform("parts", lambda p: p["words"])).alias("__host_words")
    )
    seeds = sorted(set(BLOCK_EXAMPLES + ALLOW_EXAMPLES))
    host_words = settle(host_words)
    each = host_words.select(F.explode("__host_words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    total = each.agg(F.sum("n").alias("n")).first()["n"] or 0
    # At most as many rows as there are example words.
    seen = {r["word"]: r["n"] for r in each.where(F.col("word").isin(seeds)).collect()}
    model = NaiveBayes.fit(seen, total)
    joined = work.join(host_words, F.col("__host") == F.col("__h"), "left")
    path_words = F.regexp_extract_all(F.lower("__path"), F.lit("[\\p{L}]+"), F.lit(0))
    words = F.concat(F.coalesce("__host_words", F.array().cast("array<string>")), path_words)
    name, verdict = rule_for(F.col("__host"), F.col("__path"), rules)
    new = ("host", "path", "rule", "words", "score", "verdict")
    out = joined.withColumns({"__words": words}).withColumn("__score", model.score(F.col("__words")))
    return out.select(
        *[c for c in pages.columns if c.lower() not in new],
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        name.alias("rule"),
        F.col("__words").alias("words"),
        F.col("__score").alias("score"),
        F.coalesce(verdict, F.when(F.col("__score") > MARGIN, F.lit(BLOCK)).otherwise(F.lit(ALLOW))).alias("verdict"),
    )


@query("op4_url_filter")
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "words", "score")
