"""Secret scans: rules found through a trigram inverted index, then verified on the text.

Method: each rule's regular expression states, as a Boolean query, which trigrams
every match must hold (an OR of ANDs, derived from its literal parts).  An inverted
index has a posting (trigram, document) for each trigram that some rule can ask
for.  Intersecting postings gives the candidates of a rule; only they are run
through its expression.  Rules without a mandatory trigram scan every document.
Only built-in functions are used.

Shape of the plan: postings carry 64-bit keys, no text, and are grouped by
(rule, clause, document), never by trigram, so a trigram that every document holds
makes no large group.  The text is shuffled once, to meet its candidate rules.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from re import _constants as rx_ops
from re import _parser as rx_parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import ascii_lower, query, table

#: A piece of an expression counts as literal while it stands for at most so many strings.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the least length of ``value_group``.

    Matches with a shorter value are dropped after matching, so they still take up
    their characters.
    """

    kind: str
    regex: str
    value_group: int = 0
    value_min: int = 0

    def clauses(self) -> list[list[str]]:
        return trigram_query(self.regex)


#: The three base kinds of the contract, then further public token formats.
RULES = (
    Rule(
        "assign",
        "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
        "|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        value_group=2,
        value_min=6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", value_min=20),
    Rule("hex", "[0-9a-f]{24,}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[baprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", "[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


def _strings(op, arg) -> set[str] | None:
    """The lower-cased strings that one node can match, or None if they are too many to list."""
    if op is rx_ops.LITERAL:
        return {chr(arg).lower()}
    if op is rx_ops.IN:
        out: set[str] = set()
        for kind, x in arg:
            if kind is rx_ops.LITERAL:
                out.add(chr(x).lower())
            elif kind is rx_ops.RANGE and x[1] - x[0] < MAX_STRINGS:
                out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is rx_ops.SUBPATTERN:
        return _sequence_strings(arg[-1])
    if op is rx_ops.BRANCH:
        each = [_sequence_strings(x) for x in arg[1]]
        return None if any(x is None for x in each) else set().union(*each)
    if op is rx_ops.MAX_REPEAT and arg[:2] == (0, 1):
        inner = _sequence_strings(arg[2])
        return None if inner is None else inner | {""}
    return None


def _sequence_strings(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        found = _strings(*node)
        if found is None or len(out) * len(found) > MAX_STRINGS:
            return None
        out = {a + b for a, b in itertools.product(out, found)}
    return out


def trigram_query(regex: str) -> list[list[str]]:
    """OR of ANDs of lower-cased trigrams that each match must hold; empty if nothing is mandatory."""
    runs: list[set[str]] = []
    run = {""}
    for node in rx_parser.parse(regex):
        found = _strings(*node)
        if found is None or len(run) * len(found) > MAX_STRINGS:
            runs.append(run)
            run = found if found is not None else {""}
        else:
            run = {a + b for a, b in itertools.product(run, found)}
    runs.append(run)
    useful = [{tuple(_trigrams(s)) for s in r} for r in runs if all(len(s) >= 3 for s in r)]
    if not useful:
        return []
    every = {frozenset(t for part in choice for t in part) for choice in itertools.product(*useful)}
    # A clause that asks for more than another one adds no candidates.
    return sorted(sorted(c) for c in every if not any(other < c for other in every))


def _trigrams(literal: str) -> list[str]:
    return [literal[i : i + 3] for i in range(len(literal) - 2)]


def build_index(docs: DataFrame, keys: list[str], text: Column, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, list[str]]:
    """Postings (trigram, ``keys``) of each trigram that some rule can ask for, once per document."""
    wanted = sorted({t for r in rules for clause in r.clauses() for t in clause})
    low = docs.select(*keys, ascii_lower(text).alias("__low"))
    held = F.filter(
        F.array(*[F.when(F.contains("__low", F.lit(t)), F.lit(i)) for i, t in enumerate(wanted)]), lambda x: x.isNotNull()
    )
    # A posting names its trigram by its place in ``wanted``.
    return low.select(*keys, F.explode(held).alias("trigram")), wanted


def candidates(postings: DataFrame, keys: list[str], wanted: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(``keys``, rules): the rules of which a clause has all its trigrams among the document's postings."""
    number = {t: i for i, t in enumerate(wanted)}
    # Intersection of posting lists: per document, the set of trigrams that it has.
    sets = postings.groupBy(*keys).agg(F.collect_set("trigram").alias("__has"))
    tests = []
    for i, rule in enumerate(rules):
        hit = F.lit(False)
        for clause in rule.clauses():
            ids = F.array(*[F.lit(number[t]) for t in clause])
            hit = hit | (F.size(F.array_intersect(F.col("__has"), ids)) == len(clause))
        tests.append(F.when(hit, F.lit(i)))
    return sets.select(*keys, F.filter(F.array(*tests), lambda x: x.isNotNull()).alias("__rules")).where(F.size("__rules") > 0)


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Leftmost non-overlapping matches of a rule as (start, rank, end), in code points, end exclusive."""
    rx = F.lit(rule.regex)
    matches = F.regexp_extract_all(text, rx, F.lit(0))
    between = F.transform(F.split(text, rule.regex, -1), lambda p: F.char_length(p))
    if rule.value_group:
        values = F.transform(F.regexp_extract_all(text, rx, F.lit(rule.value_group)), lambda v: F.char_length(v))
    else:
        values = F.transform(matches, lambda m: F.char_length(m))
    lengths = F.transform(matches, lambda m: F.char_length(m))
    steps = F.arrays_zip(between.alias("gap"), lengths.alias("n"), values.alias("v"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rank:int,stop:int>>").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        good = x["n"].isNotNull() & (x["v"] >= rule.value_min)
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), (begin + x["n"]).alias("stop"))
        return F.struct(
            (begin + F.coalesce(x["n"], F.lit(0))).alias("at"),
            F.when(good, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"),
        )

    return F.aggregate(steps, start, step)["found"]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``found``: array of (start, rank, stop), by start, then rule order.

    Null text counts as empty and has no spans.  Rows are told apart by id and text,
    so repeated or null ids each get their own text's spans.  Extra columns stay; a
    column named ``found`` is replaced.
    """
    keys = ["__id", "__row"]
    work = docs.withColumns({"__id": F.col(id_col), "__row": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})
    postings, wanted = build_index(work, keys, F.coalesce(F.col(text_col), F.lit("")), rules)
    found = candidates(postings, keys, wanted, rules).select(
        F.col("__id").alias("__id2"), F.col("__row").alias("__row2"), "__rules"
    )
    joined = work.join(found, F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__row") == F.col("__row2")), "left")
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<start:int,rank:int,stop:int>>")
    spans = []
    for i, rule in enumerate(rules):
        test = F.array_contains("__rules", i) if rule.clauses() else F.lit(True)
        test = F.coalesce(test, F.lit(False)) & F.rlike(text, F.lit(rule.regex))
        spans.append(F.when(test, rule_spans(text, rule, i)).otherwise(none))
    out = joined.withColumn("found", F.array_sort(F.concat(*spans)))
    return out.select(*[c for c in docs.columns if c.lower() != "found"], "found")


def spans_text(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def _sql_rule(rule: Rule, rank: int) -> str:
    rx = rule.regex.replace("'", "''")
    return f"""
SELECT doc_id, r, {rank} AS rank, '{rule.kind}' AS kind, gaps_before + lens_before AS s, gaps_before + lens_before + n AS e
FROM (SELECT doc_id, r, i, len(m[i]) AS n, len(v[i]) AS vn,
             list_sum([len(x) for x in p[1:i]]) AS gaps_before, coalesce(list_sum([len(x) for x in m[1:i - 1]]), 0) AS lens_before
      FROM (SELECT doc_id, r, m, v, p, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT doc_id, r, regexp_extract_all(t, '{rx}', 0) AS m, regexp_extract_all(t, '{rx}', {rule.value_group}) AS v,
                         regexp_split_to_array(t, '{rx}') AS p FROM d)))
WHERE vn >= {rule.value_min}"""


OP6_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_sql_rule(r, i) for i, r in enumerate(RULES))})
SELECT any_value(d.doc_id) AS doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
       count(*) FILTER (WHERE rank = 2) AS n_hex,
       sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (WHERE rank < 3), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (WHERE rank IS NOT NULL), '') AS spans
FROM d LEFT JOIN f ON d.r = f.r GROUP BY d.r
"""


@query("op6_secret_scan", OP6_SQL)
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("found", lambda s: s["rank"] < 3)
    count = lambda k: F.size(F.filter("found", lambda s: s["rank"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
    )
