"""Exact n-gram Jaccard self-join with multiple-global-order filtering.

Method: two sets of similarity t share a token among the first ``n - ceil(t n) + 1``
of each, whatever global order the tokens are put in.  A pair is a candidate only
if that holds under several orders: rare tokens first (by a counting sketch of the
whole corpus), ascending hash, and descending hash.  The first order makes the
candidates through a join on prefix tokens; the others are intersected with it
before a pair's sets are compared in full.  Most candidates only share a passage; the
low quarter of both sets, at half the width, tells nearly all of them apart, and whole
sets travel only for the rest.

Shape of the plan.

* Equal sets are one class, found by grouping 128-bit set hashes; copies never meet.
* Prefix tokens are counted with partial sums.  Tokens of up to ``SMALL`` classes
  give pairs.  More frequent ones first move to the end of the order, which leaves them
  in few prefixes; the classes that still hold one are put into blocks of about
  ``BLOCK``; blocks that share such a token meet in one task, which compares them by
  matrix products and returns a spanning forest and link counts, never the pairs.
* Blocks also hold a band of set sizes; bands further apart than the threshold
  allows do not meet.
* Components are large-star / small-star rounds over that forest.

Tokens are 64-bit hashes of shingles: a wrong link needs a collision within one
compared pair of documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import BROADCAST_ROWS, checked, query, table
from tallyward.llm.components import components
from tallyward.llm.perfect_hash import mix
from tallyward.llm.shingles import pieces, shingle_sets
from tallyward.session import settle

SLOT_BITS = 19
SMALL = 16
BLOCK = 256
#: Sketches hold the tokens below LOW, shifted to 32 bits.
LOW = np.uint64(1 << 62)
LOW_SHIFT = np.uint64(30)


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def _token_counts(texts: DataFrame, k: int) -> np.ndarray:
    """Document count per slot of the token space, over the whole corpus; 2**SLOT_BITS numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for batch in batches:
            for _, flat, offsets in pieces(batch.column(0)):
                sets = list(shingle_sets(flat, offsets, k))
                if sets:
                    at = (np.concatenate(sets) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                    slots += np.bincount(at, minlength=len(slots))
        used = np.flatnonzero(slots)
        for i in range(0, len(used), 50_000):
            part = used[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(slots[part])], ["slot", "n"])

    rows = texts.mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SLOT_BITS, dtype=np.int64)
    out[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return out


def _signatures(docs: DataFrame, counts: np.ndarray, k: int, percent: int, last: np.ndarray | None = None) -> DataFrame:
    """(id, n, h1, h2, prefix) of each document: set size, set hash, prefix in the first order.

    The order is by slot count, then hash; the tokens ``last`` (sorted) stand behind all others.
    """
    shared = docs.sparkSession.sparkContext.broadcast((counts, last))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, behind = shared.value
        for batch in batches:
            for at, flat, offsets in pieces(batch.column(1)):
                n, h1, h2, prefix = [], [], [], []
                for s in shingle_sets(flat, offsets, k):
                    n.append(len(s))
                    h1.append(int(mix(s, 21).sum(dtype=np.uint64)))
                    h2.append(int(mix(s, 22).sum(dtype=np.uint64)))
                    place = weight[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                    if behind is not None:
                        spot = np.searchsorted(behind, s)
                        spot[spot == len(behind)] = 0
                        place = np.where(behind[spot] == s, place + (1 << 60), place)
                    order = np.argsort(place, kind="stable")
                    prefix.append(s[order[: prefix_length(len(s), percent)]].view(np.int64))
                ids = batch.column(0).slice(at, len(n))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(n, pa.int64()),
                        pa.array(np.array(h1, dtype=np.uint64).view(np.int64)),
                        pa.array(np.array(h2, dtype=np.uint64).view(np.int64)),
                        pa.array(prefix, pa.list_(pa.int64())),
                    ],
                    ["id", "n", "h1", "h2", "prefix"],
                )

    return docs.mapInArrow(sign, "id long, n long, h1 long, h2 long, prefix array<long>")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(id, set): sorted tokens as bytes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, flat, offsets in pieces(batch.column(1)):
                sets = [s.tobytes() for s in shingle_sets(flat, offsets, k)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sets)), pa.array(sets, pa.binary())], ["id", "set"]
                )

    return docs.mapInArrow(make, "id long, set binary")


def _sketches(docs: DataFrame, k: int) -> DataFrame:
    """(id, set): set size, then the tokens of the low quarter of the token space in 32 bits each; nothing for an empty set."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, flat, offsets in pieces(batch.column(1)):
                low = [
                    np.append(np.uint64(len(s)), s[: np.searchsorted(s, LOW)] >> LOW_SHIFT).astype("<u4").tobytes() if len(s) else b""
                    for s in shingle_sets(flat, offsets, k)
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(low)), pa.array(low, pa.binary())], ["id", "set"])

    return docs.mapInArrow(make, "id long, set binary")


def _may_link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """False only if the sets of two sketches cannot link.

    Linked sets share ``need`` tokens, so at most ``len - need`` of one are not in the
    other, whatever part of the token space is looked at.  Shortened tokens only match more.
    """
    la, lb = int(a[0]), int(b[0])
    if 100 * min(la, lb) < percent * max(la, lb):
        return False
    need = -(-percent * (la + lb) // (100 + percent))
    return _missing(a[1:], b[1:]) <= la - need and _missing(b[1:], a[1:]) <= lb - need


def _missing(a: np.ndarray, b: np.ndarray) -> int:
    """How many of a are not in b; both are sorted."""
    if not len(b):
        return len(a)
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] != a).sum())


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Prefixes under the two hash orders first, then the whole sets."""
    la, lb = len(a), len(b)
    if 100 * min(la, lb) < percent * max(la, lb):
        return False
    pa_, pb = prefix_length(la, percent), prefix_length(lb, percent)
    for x, y in ((a[:pa_], b[:pb]), (a[la - pa_ :], b[lb - pb :])):
        if not _overlap(x, y):
            return False
    both = _overlap(a, b)
    return 100 * both >= percent * (la + lb - both)


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches, grouped by their first ``keys`` columns; a group may span batches."""
    from itertools import groupby

    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    return groupby(rows, key=lambda r: r[:keys])


def _verify_pairs(percent: int, test=_linked, width=np.uint64):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = [], []
        for (a,), rows in _runs(batches, 1):
            mine = [np.frombuffer(next(rows)[3], dtype=width)]
            for _, other, b, data in rows:
                s = np.frombuffer(data, dtype=width)
                if not other:  # a further text of the same document
                    mine.append(s)
                elif any(test(m, s, percent) for m in mine):
                    u.append(a)
                    v.append(b)
            if len(u) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
                u, v = [], []
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def _products(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over slices of the common tokens."""
    common = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    places = []
    for side in (left, right):
        rows = np.repeat(np.arange(len(side)), [len(s) for s in side])
        flat = np.concatenate(side)
        at = np.searchsorted(common, flat)
        at[at == len(common)] = max(0, len(common) - 1)
        hit = common[at] == flat if len(common) else np.zeros(len(flat), dtype=bool)
        order = np.argsort(at[hit], kind="stable")
        places.append((rows[hit][order], at[hit][order], len(side)))
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    for c in range(0, len(common), columns):
        dense = []
        for rows, at, n in places:
            a, b = np.searchsorted(at, (c, c + columns))
            m = np.zeros((n, min(columns, len(common) - c)), dtype=np.float32)
            m[rows[a:b], at[a:b] - c] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out.astype(np.int64)


def _verify_blocks(percent: int):
    def forest(ids: np.ndarray, links: np.ndarray) -> list[tuple[int, int]]:
        root = np.arange(len(ids))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for x, y in links:
            a, b = top(x), top(y)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((ids[x], ids[y]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = ["u", "v", "n"]
        for (b1, b2), rows in _runs(batches, 2):
            sides: tuple[list, list] = ([], [])
            for _, _, side, rid, copies, data in rows:
                sides[side].append((rid, copies, np.frombuffer(data, dtype=np.uint64)))
            left, right = sides[0], sides[1] if b1 != b2 else sides[0]
            if not left or not right:
                continue
            ids = [np.array([r[0] for r in s], dtype=np.int64) for s in (left, right)]
            copies = [np.array([r[1] for r in s], dtype=np.int64) for s in (left, right)]
            size = [np.array([len(r[2]) for r in s], dtype=np.int64) for s in (left, right)]
            both = _products([r[2] for r in left], [r[2] for r in right])
            linked = 100 * both >= percent * (size[0][:, None] + size[1][None, :] - both)
            linked &= ids[0][:, None] != ids[1][None, :]
            x, y = np.nonzero(np.triu(linked, 1) if b1 == b2 else linked)
            every = ids[0] if b1 == b2 else np.concatenate(ids)
            pairs = np.stack((x, y if b1 == b2 else y + len(left)), axis=1)
            edges = forest(every, pairs)
            totals = [(i, n) for i, n in zip(ids[0], linked @ copies[1], strict=True) if n]
            if b1 != b2:
                totals += [(i, n) for i, n in zip(ids[1], linked.T @ copies[0], strict=True) if n]
            u = [e[0] for e in edges] + [t[0] for t in totals]
            v = [e[1] for e in edges] + [None] * len(totals)
            n = [None] * len(edges) + [t[1] for t in totals]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (u, v, n)], schema)

    return run


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id, n_links, copies) per row of ``docs``.

    Documents link when ``100 * |intersection| >= percent * |union|`` of their distinct
    k-word shingles.  ``n_links`` counts the linked rows, exact copies included, and
    ``copies`` the rows with the same set.  A text without words (or null) has no
    shingles, links with nothing and is its own component.  Rows that repeat an id
    are one document; links of any of its texts count.  A row without an id takes no
    part: its component and link count are null.
    """
    work = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counts = _token_counts(work.select("text"), k)
    signed = settle(_signatures(work, counts, k, percent))
    with_id = signed.where(F.col("id").isNotNull() & (F.col("n") > 0))
    classes = settle(
        with_id.groupBy("h1", "h2", "n").agg(F.min("id").alias("rid"), F.count(F.lit(1)).alias("copies"))
    )
    copied = classes.where(F.col("copies") > 1).select("h1", "h2", "n", "rid")
    further = with_id.join(copied, ["h1", "h2", "n"]).where(F.col("id") != F.col("rid")).select("id", "h1", "h2")
    further = settle(further)
    reps = with_id.join(checked(further), ["id", "h1", "h2"], "left_anti")

    def count_prefixes(signs: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = signs.select(F.col("id").alias("rid"), "n", F.explode("prefix").alias("token"))
        each = found.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("rid").alias("u"), F.max("rid").alias("v"))
        return found, settle(each.where(F.col("c") > 1))

    rows, heads = count_prefixes(reps)
    # Tokens that turn out frequent go to the end of the order.  Only documents that had one
    # in their prefix get another prefix; for all others the old one is that of the new order.
    often = heads.where(F.col("c") > SMALL).select("token")
    if 0 < often.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        last = np.sort(often.toArrow().column("token").to_numpy().view(np.uint64))
        again = settle(rows.join(F.broadcast(often), "token", "left_semi").select(F.col("rid").alias("id")).distinct())
        anew = _signatures(work.join(checked(again), "id", "left_semi").select("id", "text"), counts, k, percent, last)
        anew = settle(anew.where(F.col("n") > 0)).join(checked(further), ["id", "h1", "h2"], "left_anti")
        rows, heads = count_prefixes(
            reps.join(checked(again), "id", "left_anti").select("id", "n", "prefix").unionByName(anew.select("id", "n", "prefix"))
        )
    near = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)
    two = heads.where((F.col("c") == 2) & (F.col("u") != F.col("v"))).select("u", "v").distinct()
    # Sizes of both, whatever text of a repeated id they come from.
    span = classes.groupBy("rid").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    for side in ("u", "v"):
        two = two.join(span.select(F.col("rid").alias(side), F.col("lo").alias(f"lo_{side}"), F.col("hi").alias(f"hi_{side}")), side)
    apart = (100 * F.col("hi_u") < percent * F.col("lo_v")) | (100 * F.col("hi_v") < percent * F.col("lo_u"))
    two = two.where(~apart).select("u", "v")
    more = heads.where(F.col("c") > 2).select("token", "c")
    members = settle(rows.join(checked(more), "token"))
    few = members.where(F.col("c") <= SMALL).groupBy("token").agg(F.array_sort(F.collect_list(F.struct("rid", "n"))).alias("m"))
    few = few.select(F.explode("m").alias("x"), "m").select("x", F.explode("m").alias("y"))
    few = few.where((F.col("x.rid") < F.col("y.rid")) & near(F.col("x.n"), F.col("y.n")))
    pairs = two.where(F.col("u") != F.col("v")).unionByName(
        few.select(F.col("x.rid").alias("u"), F.col("y.rid").alias("v"))
    ).distinct()

    # Blocks of the classes that hold frequent tokens.
    frequent = members.where(F.col("c") > SMALL)
    homes = frequent.groupBy("rid", "n").agg(
        F.max(F.struct("c", "token"))["token"].alias("home"), F.collect_set("token").alias("tokens")
    )
    # The small addend keeps sizes that are exact powers on one side of their bound.
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent)) + F.lit(1e-9))
    homes = homes.withColumn("band", band)
    parts = homes.groupBy("home", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("parts"))
    part = F.pmod(F.xxhash64("rid"), F.col("parts"))
    blocks = settle(
        homes.join(parts, ["home", "band"]).select(
            "rid", "band", F.xxhash64("home", "band", part).alias("block"), "tokens"
        )
    )
    block_tokens = blocks.select("block", "band", F.explode("tokens").alias("token")).distinct()
    other = block_tokens.select(F.col("block").alias("block2"), F.col("band").alias("band2"), "token")
    meets = (F.col("block") <= F.col("block2")) & (F.abs(F.col("band") - F.col("band2")) <= 1)
    units = settle(block_tokens.join(other, "token").where(meets).select("block", "block2").distinct())

    # Pairs that share a frequent token are met in blocks already.
    held = blocks.select(F.col("rid"), "tokens")
    pairs = (
        pairs.join(held.select(F.col("rid").alias("u"), F.col("tokens").alias("tu")), "u", "left")
        .join(held.select(F.col("rid").alias("v"), F.col("tokens").alias("tv")), "v", "left")
        .where(~F.coalesce(F.arrays_overlap("tu", "tv"), F.lit(False)))
        .select("u", "v")
    )
    pairs = settle(pairs)

    # Sets of the classes that some candidate needs, from their texts.  The small side
    # of each join is broadcast where it has been counted to be small, so that sets are
    # shuffled once, to the task that compares them.
    repeated = not with_id.groupBy("id", "h1", "h2").count().where("count > 1").isEmpty()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def sets_of(ids: DataFrame, make=_sets) -> DataFrame:
        wanted = work.join(checked(settle(ids.distinct())), "id", "left_semi").select("id", "text")
        found = make(wanted, k).where(F.octet_length("set") > 0)
        return found.distinct() if repeated else found

    def passing(pairs: DataFrame, make, verify) -> DataFrame:
        mine = pairs.select("u").distinct().select("u", F.lit(False).alias("other"), F.col("u").alias("id"))
        asked = settle(mine.unionByName(pairs.select("u", F.lit(True).alias("other"), F.col("v").alias("id"))))
        stream = sets_of(asked.select("id"), make).join(checked(asked), "id").select("u", "other", "id", "set")
        return settle(
            stream.repartition(n, "u").sortWithinPartitions("u", "other", "id").mapInArrow(verify, "u long, v long").distinct()
        )

    likely = passing(pairs, _sketches, _verify_pairs(percent, _may_link, np.dtype("<u4")))
    linked = passing(likely, _sets, _verify_pairs(percent))
    sized = classes.groupBy("rid").agg(F.sum("copies").alias("copies"))
    placed = settle(blocks.join(sized, "rid").select(F.col("rid").alias("id"), F.col("block").alias("b"), "copies"))
    sides = units.select("block", "block2", F.lit(0).alias("side"), F.col("block").alias("b")).unionByName(
        units.where("block <> block2").select("block", "block2", F.lit(1).alias("side"), F.col("block2").alias("b"))
    )
    loaded = sets_of(placed.select("id")).join(checked(placed), "id")
    met = loaded.join(checked(settle(sides)), "b").select("block", "block2", "side", F.col("id").alias("rid"), "copies", "set")
    compared = settle(
        met.repartition(n, "block", "block2")
        .sortWithinPartitions("block", "block2", "side")
        .mapInArrow(_verify_blocks(percent), "u long, v long, n long")
    )

    # One document with several texts is one node.
    again = with_id.groupBy("id").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x <> y").select("id")
    tied = (
        with_id.select("id", "h1", "h2", "n").join(again, "id").join(classes, ["h1", "h2", "n"])
        .select(F.col("id").alias("u"), F.col("rid").alias("v"))
    )
    edges = linked.unionByName(compared.where("v IS NOT NULL").select("u", "v")).unionByName(tied)
    roots = components(edges)
    each = linked.select("u", "v").unionByName(linked.select(F.col("v").alias("u"), F.col("u").alias("v")))
    each = each.join(sized.withColumnRenamed("rid", "v"), "v").select("u", F.col("copies").alias("n"))
    links = each.unionByName(compared.where("n IS NOT NULL").select("u", "n")).groupBy("u").agg(F.sum("n").alias("others"))
    named = (
        classes.join(roots, classes["rid"] == roots["node"], "left")
        .join(links, classes["rid"] == links["u"], "left")
        .select("h1", "h2", "n", F.coalesce("root", "rid").alias("component"), "copies", F.coalesce("others", F.lit(0)).alias("others"))
    )
    out = signed.select("id", "n", "h1", "h2").join(named, ["h1", "h2", "n"], "left")
    none = F.col("id").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(~none, F.coalesce("component", "id")).alias("component_id"),
        F.when(~none, F.coalesce(F.col("others") + F.col("copies") - 1, F.lit(0))).alias("n_links"),
        F.when(~none, F.coalesce("copies", F.lit(1))).alias("copies"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest id.

    Rows without an id stay.  Rows that repeat an id stay with it, once each.
    """
    found = settle(jaccard_components(docs, id_col, text_col))
    gone = settle(found.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("__gone")).distinct())
    kept = docs.join(checked(gone), docs[id_col] == F.col("__gone"), "left_anti")
    again = found.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__again")).count().where("count > 1").select("__again")
    if again.isEmpty():
        return kept
    again = checked(settle(again))
    once = kept.join(again, kept[id_col] == F.col("__again"), "left_anti")
    return once.unionByName(kept.join(again, kept[id_col] == F.col("__again"), "left_semi").dropDuplicates())


WORDS_SQL = """
SELECT doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[\\x20\\x09-\\x0D]+') if x <> ''] AS w FROM {docs}"""


def components_sql(docs: str) -> str:
    """CTEs that end in ``comp`` (doc_id, n_shingles, component_id, n_links, copies) for table or CTE ``docs``; ids must be unique."""
    return f"""
wd AS ({WORDS_SQL.format(docs=docs)}),
ss AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
       ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s FROM wd),
sg AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM ss),
cand AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS nb
         FROM sg a JOIN sg b USING (g) WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
ln AS (SELECT x, y FROM cand WHERE 100 * nb >= 80 * (nx + ny - nb)),
bi AS (SELECT x, y FROM ln UNION ALL SELECT y, x FROM ln),
reach(x, y) AS (SELECT doc_id, doc_id FROM wd UNION SELECT r.x, b.y FROM reach r JOIN bi b ON r.y = b.x),
comp AS (SELECT ss.doc_id, len(s) AS n_shingles, (SELECT min(y) FROM reach WHERE reach.x = ss.doc_id) AS component_id,
         (SELECT count(*) FROM bi WHERE bi.x = ss.doc_id) AS n_links,
         CASE WHEN len(s) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY list_sort(s)) END AS copies FROM ss)"""


@query("op1_jaccard_join", f"WITH RECURSIVE {components_sql('documents')} SELECT * FROM comp")
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
