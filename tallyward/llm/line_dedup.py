"""Line dedup: lines that many documents share stay in one of them only.

Method: explode normalised lines, hash them, count the distinct documents of each
hash, drop the lines whose count reaches the threshold, and put the rest together
again by position.  Only built-in functions are used.

Shape of the plan: hashes (not lines) are shuffled to be counted; counting is by
(hash, document) first, so a line that a third of all documents share is spread
over all tasks and only partial counts meet.  Finding the rows that a repeated
line loses is an equi-join; hashes that hold a large share of all rows are taken
out and broadcast (at most ``1 / HOT_SHARE`` hashes can be that frequent).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import BLANKS, ascii_lower, query, table
from tallyward.session import settle

#: A hash with more than this share of the exploded rows is broadcast; so at most 20 000 are.
HOT_SHARE = 5e-5


def line_key(line: Column) -> Column:
    """The line with blanks stripped at both ends and A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _rows(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """(id, text's hash, position, hash of the key) of each line long enough to count."""
    lines = docs.select(
        "__id", "__row", F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("__pos", "__line")
    )
    keys = lines.select("__id", "__row", "__pos", line_key(F.col("__line")).alias("__key"))
    keys = keys.where(F.char_length("__key") >= min_chars)
    return keys.select("__id", "__row", "__pos", F.xxhash64("__key").alias("h1"), F.xxhash64(F.lit(7), F.col("__key")).alias("h2"))


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` (before) and ``n_dropped``.

    A key of at least ``min_chars`` code points in at least ``min_docs`` distinct
    documents loses its lines in all but the largest id that holds it; within that
    document all copies stay.

    Null or empty text is one empty line.  A null id counts as one document, smaller
    than all others.  Rows that repeat an id count as one document and are judged
    alike, each row on its own text.  Extra columns are kept; an input column named
    like a new one is replaced.
    """
    work = docs.withColumns(
        {"__id": F.col(id_col), "__row": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))}
    )
    rows = _rows(work, text_col, min_chars)
    per_doc = rows.groupBy("h1", "h2", "__id").agg(F.count(F.lit(1)).alias("m"))
    counts = per_doc.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.max("__id").alias("keep"), F.sum("m").alias("m")
    )
    repeated = settle(counts.where(F.col("n") >= min_docs).select("h1", "h2", "keep", "m"))
    bar = repeated.agg(F.sum("m").alias("m")).scalar() * F.lit(HOT_SHARE)
    hot = repeated.where(F.col("m") > F.greatest(bar, F.lit(10_000.0))).select("h1", "h2", F.col("keep").alias("keep_hot"))
    usual = repeated.where(F.col("m") <= F.greatest(bar, F.lit(10_000.0))).select("h1", "h2", "keep")
    # Rows of a hot hash are settled by the broadcast and meet nothing in the join; the
    # others meet their count by a shuffle.  One pass over the lines serves both.
    marked = rows.join(F.broadcast(hot), ["h1", "h2"], "left")
    hot_here = F.col("keep_hot").isNotNull()
    marked = marked.where(~hot_here | ~F.col("__id").eqNullSafe(F.col("keep_hot")))
    marked = marked.select(
        "__id", "__row", "__pos", hot_here.alias("hot"), F.when(hot_here, F.xxhash64("__id")).otherwise(F.col("h1")).alias("h1"),
        F.when(~hot_here, F.col("h2")).alias("h2"),
    )
    met = marked.join(usual, ["h1", "h2"], "left")
    lost = (
        met.where(F.col("hot") | (F.col("keep").isNotNull() & ~F.col("__id").eqNullSafe(F.col("keep"))))
        .groupBy(F.col("__id").alias("__id2"), F.col("__row").alias("__row2"))
        .agg(F.collect_list("__pos").alias("__lost"))
    )
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    kept_at = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__lost"))
    kept = F.transform(kept_at, lambda p: F.get(F.col("__lines"), p))
    joined = work.join(lost, F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__row") == F.col("__row2")), "left")
    # Split once per document; documents that lose nothing keep their text as it is.
    out = joined.withColumn("__lines", lines).withColumns(
        {
            "kept_text": F.when(F.col("__lost").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(
                F.array_join(kept, "\n")
            ),
            "n_lines": F.size("__lines").cast("long"),
            "n_dropped": F.when(F.col("__lost").isNull(), F.lit(0)).otherwise(
                F.size("__lines") - F.size(kept_at)
            ).cast("long"),
        }
    )
    names = [c for c in docs.columns if c.lower() not in ("kept_text", "n_lines", "n_dropped")]
    return out.select(*names, "kept_text", "n_lines", "n_dropped")


#: The rule as SQL: (doc_id, position, line, goes) of every line of a table or CTE.
LINES_SQL = """
SELECT *, length(key) >= 20 AND n >= 3 AND doc_id <> last_doc AS goes FROM (
  SELECT *, max(doc_id) OVER (PARTITION BY key) AS last_doc,
         max(r) OVER (PARTITION BY key) AS n
  FROM (SELECT *, dense_rank() OVER (PARTITION BY key ORDER BY doc_id) AS r
        FROM (SELECT doc_id, pos, line,
                     translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
              FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
                    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {docs})))))
"""

OP8_SQL = f"""
WITH l AS ({LINES_SQL.format(docs="documents")})
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM l GROUP BY doc_id
"""


@query("op8_line_dedup", OP8_SQL)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_repeated_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
