"""Benchmark decontamination by template canonicalisation.

Method: numbers, names and units become typed placeholders, so a question asked
again with other values has the same template.  Windows of template tokens are
hashed and hash-joined with the windows of the benchmark.  The values that stood in
the slots are then held against each other: a re-parameterised question replaces
equal values by equal values.  Where an alignment does not, it is read in two ways:
as the item with other values, without the windows that hold a conflicting slot, and
as a verbatim copy, by the windows of equal tokens alone.  The better one counts.
Only built-in functions are used.

Shape of the plan: window hashes of the documents stream past the benchmark's
windows, which are broadcast only after they have been counted; beyond
``BROADCAST_WINDOWS`` it is a shuffled join.  Only matches are grouped, by
(document, item, alignment).  Texts are read again for matched documents alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import checked, query, table
from tallyward.session import settle

#: Benchmark windows are broadcast up to this number (about 50 bytes each).
BROADCAST_WINDOWS = 1_000_000
WINDOW = 8
#: Items of fewer template tokens, or without a window that is at most half
#: placeholders, are searched word for word: by windows of their tokens.
MIN_TOKENS = 4
MIN_SHARE = 0.5
#: So many consistent windows in a row are a leak whatever share of the item they are:
#: 20 tokens with windows of 8.
RUN = 13

#: Number words and units that become placeholders.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
NUMBER_VALUES = [str(n) for n in [*range(21), *range(30, 100, 10), 100, 1000, 10**6, 10**9]]
UNITS = (
    "mm cm km kg mg ml metre metres meter meters kilometre kilometres kilometer kilometers mile miles gram grams kilogram "
    "kilograms pound pounds ounce ounces litre litres liter liters gallon gallons second seconds minute minutes hour hours "
    "day days week weeks month months year years dollar dollars euro euros cent cents percent degree degrees watt watts "
    "volt volts joule joules newton newtons"
).split()
#: Han and kana are written without spaces: each character is a token.
CJK = "\\u3005-\\u3007\\u3041-\\u3096\\u309d-\\u309f\\u30a1-\\u30fa\\u30fc-\\u30ff\\u31f0-\\u31ff\\u3400-\\u4dbf\\u4e00-\\u9fff\\uf900-\\ufaff\\uff66-\\uff9f\\x{20000}-\\x{323af}"
TOKEN = f"[.!?\\n]|[0-9]+(?:[.,][0-9]+)*|[\\p{{L}}\\p{{M}}&&[^{CJK}]]+|[{CJK}]"
MARKS = (".", "!", "?", "\n")
NAME = "^\\p{Lu}\\p{Ll}+$"
#: Words that open a sentence without being a name; another first word is no other value of theirs.
OPENERS = (
    "a an the this that these those there here it he she we you they i his her its my our your their what which who whom whose "
    "when where why how if in on at by for from with to of as after before during while since although because suppose let given "
    "consider assume find compute calculate determine solve evaluate explain describe write state name list choose select complete "
    "identify show prove is are was were do does did can could should would will may might must has have had and or but not no "
    "yes each every all some many most one both either neither another any under over between into through only just now then "
    "so also once first next last finally"
).split()


def _template(tokens: Column) -> Column:
    """Template token of each token; null for a sentence mark."""

    def one(t: Column, i: Column) -> Column:
        low = F.lower(t)
        head = F.substring(t, 1, 1)
        inner = (i > 0) & ~F.coalesce(F.get(tokens, i - 1).isin(*MARKS), F.lit(False))
        return (
            F.when(t.isin(*MARKS), F.lit(None))
            .when((head >= "0") & (head <= "9"), F.lit("<num>"))
            .when((low != t) & inner & F.rlike(t, F.lit(NAME)), F.lit("<name>"))
            .when(low.isin(*NUMBER_WORDS), F.lit("<num>"))
            .when(low.isin(*UNITS), F.lit("<unit>"))
            .otherwise(low)
        )

    return F.transform(tokens, one)


def _opens(tokens: Column) -> Column:
    """Whether each token that is no sentence mark begins a sentence and may be a name."""

    def one(t: Column, i: Column) -> Column:
        first = (i == 0) | F.coalesce(F.get(tokens, i - 1).isin(*MARKS), F.lit(False))
        name = first & F.rlike(t, F.lit(NAME)) & ~F.lower(t).isin(*NUMBER_WORDS, *UNITS, *OPENERS)
        return F.when(~t.isin(*MARKS), name)

    return F.array_compact(F.transform(tokens, one))


def templates(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``raw`` (tokens, lower-cased), ``tpl`` (template tokens) and ``opens``, position by position."""
    with_tokens = df.withColumn("__tok", F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), F.lit(0)))
    return (
        with_tokens.withColumn("tpl", F.array_compact(_template(F.col("__tok"))))
        .withColumn("opens", _opens(F.col("__tok")))
        .withColumn("raw", F.transform(F.filter("__tok", lambda t: ~t.isin(*MARKS)), F.lower))
        .drop("__tok")
    )


#: What a hash is made of: template tokens, raw tokens, or template tokens after a first word of any kind or name.
TEMPLATE, RAW, ANY_WORD = "template", "raw", "<first>"


def _starts(tokens: Column, length: int) -> Column:
    return F.when(F.size(tokens) >= length, F.sequence(F.lit(0), F.size(tokens) - length)).otherwise(F.array().cast("array<int>"))


def _hash(tokens: Column, at: Column, length: int, first: Column | None = None) -> Column:
    return F.xxhash64(F.lit(length), *([first] if first is not None else []), *[F.get(tokens, at + k) for k in range(first is not None, length)])


def _raw_hash(raw: Column, at: Column, length: int) -> Column:
    return F.xxhash64(F.lit(-length), *[F.get(raw, at + k) for k in range(length)])


def _plain_hashes(length: int) -> Column:
    tpl = F.col("tpl")
    return F.transform(_starts(tpl, length), lambda i: F.struct(i.alias("p"), _hash(tpl, i, length).alias("h")))


def window_hashes(kind: str, length: int) -> Column:
    """(p, h) of each window of ``length`` tokens of ``raw``, ``tpl`` and ``opens``.

    Template windows that begin with what may be a name at the start of a sentence
    have a second hash, which leaves the name open.
    """
    tpl, raw = F.col("tpl"), F.col("raw")
    entry = lambda i, h: F.struct(i.alias("p"), h.alias("h"))
    if kind == RAW:
        return F.transform(_starts(raw, length), lambda i: entry(i, _raw_hash(raw, i, length)))
    named = F.filter(_starts(tpl, length), lambda i: F.get("opens", i))
    return F.concat(_plain_hashes(length), F.transform(named, lambda i: entry(i, _hash(tpl, i, length, F.lit(ANY_WORD)))))


def first_word_hashes(length: int) -> Column:
    """(p, h) of an item's first window with its first word as a name, as running text has it, and left open."""
    tpl, zero = F.col("tpl"), F.lit(0)
    entry = lambda first: F.struct(zero.alias("p"), _hash(tpl, zero, length, F.lit(first)).alias("h"))
    word = ~F.get(tpl, 0).startswith("<")
    none = F.array().cast("array<struct<p:int,h:bigint>>")
    return F.concat(
        F.when(word, F.array(entry("<name>"))).otherwise(none), F.when(word & F.get("opens", 0), F.array(entry(ANY_WORD))).otherwise(none)
    )


def _value(token: Column) -> Column:
    """A number word as digits, other tokens as they are."""
    return F.coalesce(F.get(F.lit(NUMBER_VALUES), F.array_position(F.lit(list(NUMBER_WORDS)), token).cast("int") - 1), token)


def _informative(tpl: Column, at: Column, length: int) -> Column:
    slots = F.size(F.filter(F.slice(tpl, at + 1, length), lambda t: t.startswith("<")))
    return slots * 2 <= length


def benchmark_windows(
    benchmark: DataFrame, item_col: str, text_col: str, window: int
) -> tuple[DataFrame, DataFrame, list[tuple[str, int]]]:
    """(windows: item, at, len, h; items: item, raw, tpl, opens, n_windows; kinds and lengths in use).

    An item of fewer tokens than ``window`` is one window of its own length.
    Windows that are more than half placeholders are left out; an item without
    others, or under ``MIN_TOKENS`` tokens, has windows of its raw tokens.
    """
    items = templates(benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("__text")), "__text")
    items = items.where(F.size("tpl") > 0).select("item_id", "raw", "tpl", "opens")
    items = items.withColumn("len", F.least(F.size("tpl"), F.lit(window))).dropDuplicates(["item_id", "raw", "tpl"])
    slots = lambda i: F.size(F.filter(F.slice("tpl", i + 1, F.col("len")), lambda t: t.startswith("<")))
    telling = F.filter(F.sequence(F.lit(0), F.size("tpl") - F.col("len")), lambda i: slots(i) * 2 <= F.col("len"))
    items = items.withColumn("single", F.size(telling) == 1)
    items = items.withColumn("kind", F.when((F.size("tpl") >= MIN_TOKENS) & (F.size(telling) > 0), TEMPLATE).otherwise(RAW))
    items = settle(items.withColumn("text_key", F.xxhash64("raw", "tpl", "opens")))
    used = sorted((r[0], r[1]) for r in items.select("kind", "len").distinct().collect())  # at most twice ``window``
    parts = []
    for kind, n in used:
        mine = items.where((F.col("len") == n) & (F.col("kind") == kind))
        if kind == RAW:
            parts.append(mine.select("item_id", "text_key", F.inline(window_hashes(kind, n)).alias("at", "h"), F.lit(n).alias("len")))
            continue
        # With two windows or more, half of them remain without the first word's window.
        hashes = F.when(F.col("single"), F.concat(_plain_hashes(n), first_word_hashes(n))).otherwise(_plain_hashes(n))
        at = mine.select("item_id", "text_key", "tpl", F.inline(hashes).alias("at", "h"))
        parts.append(
            at.where(_informative(F.col("tpl"), F.col("at"), n)).select("item_id", "text_key", "at", "h", F.lit(n).alias("len"))
        )
    if not parts:
        empty = items.select("item_id", "text_key", F.lit(0).alias("at"), F.lit(0).cast("long").alias("h"), "len")
        return empty, items.withColumn("n_windows", F.lit(0).cast("long")), used
    windows = parts[0]
    for p in parts[1:]:
        windows = windows.unionByName(p)
    windows = settle(windows)
    counts = windows.groupBy("item_id", "text_key").agg(F.count_distinct("at").alias("n_windows"))
    return windows, items.join(counts.withColumnRenamed("item_id", "__i"), F.col("item_id").eqNullSafe(F.col("__i"))
                               & (items["text_key"] == counts["text_key"])).select(
        "item_id", items["text_key"], "raw", "tpl", "opens", "n_windows"), used


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """(id, item_id, n_matched, n_windows, n_changed) for each document that holds an item.

    ``n_matched`` counts the item's windows found with consistent slots, or found
    word for word, whichever are more; a pair is reported from ``min_share`` of its
    ``n_windows``, or from ``RUN`` of them in a row.  ``n_changed`` counts slots whose value differs (0: the same values).

    Null or empty texts hold nothing; an item without any word or number is nowhere.
    Items too short or too full of placeholders for a template are found verbatim.  Rows that repeat an id report each pair once, with the best row's
    figures.  A null id is reported as null.
    """
    windows, items, used = benchmark_windows(benchmark, item_col, item_text, window)
    work = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    work = work.withColumn("__row", F.xxhash64("__text"))
    side = checked(windows.select("h", "item_id", "text_key", "at"), BROADCAST_WINDOWS)
    tpl = templates(work, "__text")
    hits = None
    for kind, n in used:
        rows = tpl.select("__id", "__row", F.inline(window_hashes(kind, n)).alias("__p", "h"))
        found = rows.join(side, "h").select(
            "__id", "__row", "item_id", "text_key", (F.col("__p") - F.col("at")).alias("shift"), "at", F.lit(n).alias("len")
        )
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = work.join(side.where(F.lit(False)), F.lit(False)).select(
            "__id", "__row", "item_id", "text_key", F.lit(0).alias("shift"), "at", F.lit(0).alias("len")
        )
    runs = settle(
        hits.groupBy("__id", "__row", "item_id", "text_key", "shift").agg(
            F.array_sort(F.collect_set("at")).alias("ats"), F.max("len").alias("len")
        )
    )
    # The texts of matched documents alone, once more for their slot values.
    doc_keys = runs.select(F.col("__id").alias("__i"), F.col("__row").alias("__r")).distinct()
    raw = templates(
        work.join(doc_keys, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__row") == F.col("__r")), "left_semi")
        .dropDuplicates(["__id", "__row"]),
        "__text",
    ).select(F.col("__id").alias("__i"), F.col("__row").alias("__r"), F.col("raw").alias("doc_raw"))
    joined = runs.join(raw, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__row") == F.col("__r")))
    it = items.select(
        F.col("item_id").alias("__item"), F.col("text_key").alias("__key"), F.col("raw").alias("item_raw"), "tpl", "opens", "n_windows"
    )
    joined = joined.join(it, F.col("item_id").eqNullSafe(F.col("__item")) & (F.col("text_key") == F.col("__key")))
    # A first word that differs is a slot if it may be a name on both sides, else the first window does not match.
    here, there = F.get("item_raw", F.lit(0)), F.get("doc_raw", F.col("shift"))
    joined = joined.withColumn("renamed", F.array_contains("ats", 0) & (here != there) & ~F.get("tpl", F.lit(0)).startswith("<"))
    other = F.col("renamed") & (~F.get("opens", F.lit(0)) | there.isin(*NUMBER_WORDS, *UNITS, *OPENERS))
    joined = joined.withColumn("ats", F.when(other, F.filter("ats", lambda a: a > 0)).otherwise(F.col("ats")))
    joined = joined.withColumn("renamed", F.col("renamed") & ~other).where(F.size("ats") > 0)
    covered = F.array_distinct(
        F.flatten(F.transform("ats", lambda a: F.sequence(a, a + F.col("len") - 1)))
    )
    kind_of = lambda x: F.when(F.col("renamed") & (x == 0), F.lit("<name>")).otherwise(F.get(F.col("tpl"), x))
    slots = F.filter(covered, lambda x: kind_of(x).startswith("<"))
    pairs = F.array_distinct(
        F.transform(
            slots,
            lambda x: F.struct(
                kind_of(x).alias("kind"),
                F.get(F.col("item_raw"), x).alias("a"),
                F.get(F.col("doc_raw"), x + F.col("shift")).alias("b"),
            ),
        )
    )
    judged = joined.withColumn("slots", slots).withColumn("pairs", pairs)
    # Slots whose item value stands for several values of the document; 2 and two are one value.
    several = F.size(F.array_distinct(F.transform("pairs", lambda p: F.struct(p["kind"], p["a"])))) < F.size("pairs")
    torn = F.transform(
        F.filter(
            "pairs",
            lambda p: several & F.exists("pairs", lambda q: (q["kind"] == p["kind"]) & (q["a"] == p["a"]) & (_value(q["b"]) != _value(p["b"]))),
        ),
        lambda p: F.struct(p["kind"].alias("kind"), p["a"].alias("a")),
    )
    judged = judged.withColumn("torn", torn)
    slot = lambda x: F.struct(kind_of(x).alias("kind"), F.get(F.col("item_raw"), x).alias("a"))
    judged = judged.withColumn("bad", F.filter("slots", lambda x: F.array_contains("torn", slot(x))))
    whole = F.size("bad") == 0
    free = F.filter("ats", lambda a: ~F.exists("bad", lambda x: (x >= a) & (x < a + F.col("len"))))
    same = F.filter(
        "ats",
        lambda a: F.slice("item_raw", a + 1, F.col("len")) == F.slice("doc_raw", a + F.col("shift") + 1, F.col("len")),
    )
    judged = judged.withColumn("free", F.when(whole, F.col("ats")).otherwise(free))
    judged = judged.withColumn("same", F.when(whole, F.col("ats")).otherwise(same))
    judged = judged.where((F.size("free") > 0) | (F.size("same") > 0))
    run = lambda c: F.exists(
        F.transform(F.col(c), lambda a, i: F.get(F.col(c), i + RUN - 1) - a == RUN - 1), lambda x: F.coalesce(x, F.lit(False))
    )
    judged = judged.withColumn("run", run("free") | run("same"))
    per_row = judged.groupBy("__id", "__row", "item_id", "text_key", "n_windows").agg(
        *[F.size(F.array_distinct(F.flatten(F.collect_list(c)))).cast("long").alias(f"n_{c}") for c in ("free", "same")],
        F.min(F.size(F.filter("pairs", lambda p: p["a"] != p["b"]))).cast("long").alias("n_changed"),
        F.max("run").alias("run"),
    )
    per_row = per_row.withColumn("n_matched", F.greatest("n_free", "n_same")).where(
        F.col("run") | (F.col("n_matched") >= F.ceil(F.lit(min_share) * F.col("n_windows")))
    )
    best = per_row.groupBy("__id", "item_id").agg(
        F.max(F.struct("n_matched", "n_windows", (-F.col("n_changed")).alias("c"))).alias("b")
    )
    return best.select(
        F.col("__id").alias(id_col),
        "item_id",
        F.col("b.n_matched").alias("n_matched"),
        F.col("b.n_windows").alias("n_windows"),
        (-F.col("b.c")).alias("n_changed"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; documents with a null id are judged together."""
    hit = settle(contaminated(docs, benchmark, id_col, text_col).select(F.col(id_col).alias("__hit")).distinct())
    return docs.join(checked(hit), docs[id_col].eqNullSafe(F.col("__hit")), "left_anti")


def _sql_list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def template_sql(source: str, key: str) -> str:
    """SQL for (key, raw, tpl) of a table or CTE."""
    marks = "'.', '!', '?', chr(10)"
    return f"""
SELECT {key}, [lower(x) for x in tok if x NOT IN ({marks})] AS raw,
  [CASE WHEN tok[i] >= '0' AND tok[i] < ':' THEN '<num>'
        WHEN lower(tok[i]) <> tok[i] AND i > 1 AND coalesce(tok[i - 1] NOT IN ({marks}), true)
             AND regexp_matches(tok[i], '^\\p{{Lu}}\\p{{Ll}}+$') THEN '<name>'
        WHEN lower(tok[i]) IN ({_sql_list(NUMBER_WORDS)}) THEN '<num>'
        WHEN lower(tok[i]) IN ({_sql_list(UNITS)}) THEN '<unit>'
        ELSE lower(tok[i]) END
   for i in range(1, len(tok) + 1) if tok[i] NOT IN ({marks})] AS tpl
FROM (SELECT {key}, regexp_extract_all(coalesce(text, ''), '[.!?\\n]|[0-9]+(?:[.,][0-9]+)*|[\\p{{L}}\\p{{M}}]+') AS tok FROM {source})"""


def contaminated_sql(docs: str) -> str:
    """CTEs that end in ``hit`` (doc_id, item_id, n_matched, n_windows, n_changed) for table or CTE ``docs``."""
    return f"""
bt AS (SELECT *, least(len(tpl), {WINDOW}) AS n FROM ({template_sql("benchmark", "item_id")}) WHERE len(tpl) >= {MIN_TOKENS}),
bw AS (SELECT item_id, a0, n, w FROM (SELECT item_id, n, a0, tpl[a0:a0 + n - 1] AS w
       FROM (SELECT *, unnest(range(1, len(tpl) - n + 2)) AS a0 FROM bt)) WHERE 2 * len([x for x in w if x[1] = '<']) <= n),
bn AS (SELECT item_id, count(*) AS n_windows FROM bw GROUP BY item_id),
dt AS ({template_sql(docs, "doc_id")}),
dw AS (SELECT doc_id, n, a0, tpl[a0:a0 + n - 1] AS w
       FROM (SELECT doc_id, tpl, n, unnest(range(1, len(tpl) - n + 2)) AS a0 FROM dt, (SELECT DISTINCT n FROM bw))),
hits AS (SELECT DISTINCT doc_id, item_id, dw.a0 - bw.a0 AS shift, bw.a0, bw.n FROM dw JOIN bw USING (n, w)),
pos AS (SELECT DISTINCT doc_id, item_id, shift, unnest(range(a0, a0 + n)) AS x FROM hits),
pairs AS (SELECT DISTINCT pos.doc_id, pos.item_id, shift, bt.tpl[x] AS kind, bt.raw[x] AS a, dt.raw[x + shift] AS b
          FROM pos JOIN bt USING (item_id) JOIN dt USING (doc_id) WHERE bt.tpl[x][1] = '<'),
judged AS (SELECT doc_id, item_id, shift, count(*) = count(DISTINCT (kind, a)) AND count(*) = count(DISTINCT (kind, b)) AS ok,
           count(*) FILTER (WHERE a <> b) AS changed FROM pairs GROUP BY ALL),
kept AS (SELECT h.doc_id, h.item_id, h.a0, coalesce(j.changed, 0) AS changed FROM hits h
         LEFT JOIN judged j USING (doc_id, item_id, shift) WHERE coalesce(j.ok, true)),
hit AS (SELECT doc_id, item_id, count(DISTINCT a0) AS n_matched, any_value(n_windows) AS n_windows, min(changed) AS n_changed
        FROM kept JOIN bn USING (item_id) GROUP BY doc_id, item_id HAVING count(DISTINCT a0) >= ceil({MIN_SHARE} * any_value(n_windows)))"""


@query("op9_decontaminate", f"WITH {contaminated_sql('documents')} SELECT * FROM hit")
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
