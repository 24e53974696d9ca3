"""Exact top-k inner product search with cover trees over queries and data.

Method: queries and data share the top level of a cover tree (centres picked farthest
first from a bounded sample; every vector belongs to its nearest centre, with the
covering radius measured over all vectors).  Below, each block of a cell has a cover
tree of its own, built in the task, and so does each query group of more than twice
``GROUP``.  A pair of nodes is pruned when
``<cq, cd> + |cq| rd + |cd| rq + rq rd``, the largest product their members can have,
is below the worst k-th score of the query node's members.  At a leaf of the data
each query has a bound of its own, ``<q, cd> + |q| rd``, and only the queries that
pass it meet the leaf's vectors, in one matrix product.  Leaves are large, for a
product of matrices costs less than the bounds that would cut it up.

Shape of the plan: one pass assigns cells; cells are cut into blocks of about
``BLOCK`` vectors and query groups of about ``GROUP``, so one vector that holds a
third of all rows fills many blocks.  Groups first meet the block of the most
promising centre, which gives their k-th scores, then every block whose cell survives
the bound.  Groups (small) travel to blocks, blocks are read once per round.
Centres and cell figures (at most ``MAX_CELLS``) are all that passes through the
driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.llm.common import query, table
from tallyward.session import settle

BLOCK = 2048
GROUP = 256
MAX_CELLS = 1024
LEAF = 256
#: Sample that centres are picked from; only their quality depends on it, never the result.
SAMPLE = 8192
LOWEST = np.iinfo(np.int64).min


@dataclass
class Node:
    """Rows ``at`` of a point set lie within ``radius`` of ``centre``."""

    centre: np.ndarray
    radius: float
    at: np.ndarray
    children: list[Node] = field(default_factory=list)


def cover_tree(points: np.ndarray, at: np.ndarray | None = None, leaf: int = LEAF) -> Node:
    """Each node's children have centres among its points, apart by more than half its radius, and cover it."""
    at = np.arange(len(points)) if at is None else at
    mine = points[at]
    centre = mine.mean(axis=0) if len(mine) else np.zeros(points.shape[1])
    gaps = np.sqrt(np.maximum(((mine - centre) ** 2).sum(axis=1), 0)) if len(mine) else np.zeros(0)
    radius = float(gaps.max()) if len(gaps) else 0.0
    node = Node(centre, radius * (1 + 1e-9) + 1e-9, at)
    if len(at) <= leaf or radius == 0:
        return node
    first = int(gaps.argmax())
    near = np.sqrt(((mine - mine[first]) ** 2).sum(axis=1))
    home = np.zeros(len(at), dtype=np.int64)
    centres = 1
    while near.max() > radius / 2 and centres < 16:
        new = int(near.argmax())
        gap = np.sqrt(((mine - mine[new]) ** 2).sum(axis=1))
        closer = gap < near
        home[closer], near = centres, np.minimum(near, gap)
        centres += 1
    if centres > 1:
        node.children = [cover_tree(points, at[home == c], leaf) for c in range(centres) if (home == c).any()]
    return node


def _bound(q: Node, d: Node) -> float:
    """No member of q has a larger product with a member of d."""
    cq, cd = np.sqrt(q.centre @ q.centre), np.sqrt(d.centre @ d.centre)
    top = q.centre @ d.centre + cq * d.radius + cd * q.radius + q.radius * d.radius
    return float(top + 1 + 1e-9 * (cq + q.radius) * (cd + d.radius))


class Best:
    """The k best (score, id) of each query, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray) -> None:
        self.ids, self.k, self.floor = ids, k, floor
        self.score = np.full((len(ids), k), LOWEST, dtype=np.int64)
        self.who = np.full((len(ids), k), np.iinfo(np.int64).max, dtype=np.int64)

    def least(self, at: np.ndarray) -> np.ndarray:
        """What a score must reach to be among a query's k best."""
        return np.maximum(self.score[at, -1], self.floor[at])

    def offer(self, at: np.ndarray, scores: np.ndarray, who: np.ndarray) -> None:
        row, col = np.nonzero(scores >= self.least(at)[:, None])
        other = self.ids[at[row]] != who[col]
        row, col = row[other], col[other]
        if not len(row):
            return
        some = np.unique(row)
        mine = at[some]
        every = np.concatenate((np.repeat(some, self.k), row))
        names = np.concatenate((self.who[mine].ravel(), who[col]))
        values = np.concatenate((self.score[mine].ravel(), scores[row, col]))
        order = np.lexsort((names, ~values, every))  # ~x falls as x rises and cannot overflow
        every = every[order]
        best = order[np.arange(len(order)) - np.searchsorted(every, every) < self.k]
        self.score[mine] = values[best].reshape(len(mine), self.k)
        self.who[mine] = names[best].reshape(len(mine), self.k)


def products(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Exact integer products; floats are used where they are exact."""
    reach = float(np.abs(q).max(initial=0)) * float(np.abs(d).max(initial=0)) * max(1, q.shape[1])
    if reach < 2**53:
        return (q.astype(np.float64) @ d.astype(np.float64).T).astype(np.int64)
    if reach < 2**63:
        return q @ d.T
    exact = q.astype(object) @ d.T.astype(object)
    if exact.size and max(abs(int(x)) for x in exact.flat) >= 2**63:
        raise OverflowError("a score does not fit 64 bits")
    return exact.astype(np.int64)


def dual_search(q: np.ndarray, qtree: Node, d: np.ndarray, dtree: Node, who: np.ndarray, best: Best) -> None:
    """Offer every product that may be among a query's k best."""
    points = q.astype(np.float64)
    norm = np.sqrt((points * points).sum(axis=1))
    todo = [(_bound(qtree, dtree), qtree, dtree)]
    while todo:
        bound, a, b = todo.pop()
        least = best.least(a.at)
        if bound < least.min():
            continue
        if not a.children and not b.children:
            reach = np.sqrt(b.centre @ b.centre) + b.radius
            top = points[a.at] @ b.centre + norm[a.at] * b.radius + 1 + 1e-9 * norm[a.at] * reach
            at = a.at[top >= least]
            if len(at):
                best.offer(at, products(q[at], d[b.at]), who[b.at])
            continue
        split_data = bool(b.children) and (not a.children or b.radius >= a.radius)
        pairs = [(a, c) for c in b.children] if split_data else [(c, b) for c in a.children]
        todo.extend(sorted(((_bound(x, y), x, y) for x, y in pairs), key=lambda t: t[0]))  # the best is taken first


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, dim, v): floor(scale * x) as little-endian 64-bit integers; unusable vectors are left out."""
    x = F.col(vector_col).cast("array<double>")
    usable = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    rows = vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), x.alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, dims = [], []
            for v in batch.column(1):
                values = np.floor(scale * np.asarray(v.values.to_numpy(zero_copy_only=False), dtype=np.float64))
                if len(values) and np.abs(values).max() >= 2**62:
                    raise OverflowError("a component does not fit 64 bits")
                out.append(values.astype("<i8").tobytes())
                dims.append(len(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["id", "dim", "v"])

    return rows.mapInArrow(run, "id long, dim int, v binary")


def _points(blobs: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype="<i8").reshape(len(blobs), dim)


def pick_centres(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first centres of the sample."""
    points = sample.astype(np.float64)
    chosen = [0]
    near = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _assign(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        square = (c * c).sum(axis=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                p = _points(part.column("v").to_pylist(), c.shape[1]).astype(np.float64)
                cell = (square[None, :] - 2 * (p @ c.T)).argmin(axis=1)
                gap = np.sqrt(((p - c[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("v"), part.column("asks"), pa.array(cell.astype(np.int32)), pa.array(gap)],
                    ["id", "v", "asks", "cell", "gap"],
                )

    return rows.select("id", "v", "asks").mapInArrow(run, "id long, v binary, asks boolean, cell int, gap double")


def _pack(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, ids, payload) of each block; a block has a bounded number of vectors."""
    got = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("id", "v"))).alias("m"))
    return got.select(*key, F.col("m.id").alias("ids"), F.col("m.v").alias("vs"))


def _visit(pairs: DataFrame, groups: DataFrame, blocks: DataFrame, dim: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): per query group and block, what may be among the k best."""
    asked = pairs.join(groups, ["qcell", "qpart"]).select(
        "cell", "part", F.lit(1).alias("role"), "ids", "vs", "floors"
    )
    here = blocks.join(pairs.select("cell", "part").distinct(), ["cell", "part"], "left_semi").select(
        "cell", "part", F.lit(0).alias("role"), "ids", "vs", F.array().cast("array<long>").alias("floors")
    )
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist())
        for _, members in groupby(rows, key=lambda r: (r["cell"], r["part"])):
            first = next(members)
            d, who = _points(first["vs"], dim), np.array(first["ids"], dtype=np.int64)
            dtree = cover_tree(d.astype(np.float64))
            for r in members:
                q, ids = _points(r["vs"], dim), np.array(r["ids"], dtype=np.int64)
                best = Best(ids, k, np.array(r["floors"], dtype=np.int64))
                dual_search(q, cover_tree(q.astype(np.float64), leaf=2 * GROUP), d, dtree, who, best)
                good = (best.score > LOWEST) & (best.score >= best.floor[:, None])
                row, col = np.nonzero(good)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(best.who[row, col]), pa.array(best.score[row, col])], ["query_id", "vec_id", "score"]
                )

    together = asked.unionByName(here).repartition(n, "cell", "part").sortWithinPartitions("cell", "part", "role")
    return together.mapInArrow(run, "query_id long, vec_id long, score long")


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_dim(rows: DataFrame, dim: int, k: int) -> DataFrame:
    spark = rows.sparkSession
    n = rows.count()
    share = min(1.0, SAMPLE / max(1, n))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    sample = [bytes(r[0]) for r in drawn.select("v").limit(2 * SAMPLE).collect()]
    if not sample:
        sample = [bytes(r[0]) for r in rows.select("v").limit(SAMPLE).collect()]
    cells = int(min(MAX_CELLS, max(1, n // BLOCK)))
    centres = pick_centres(_points(sample, dim), cells)
    placed = settle(_assign(rows, centres))
    stats = {
        r["cell"]: r
        for r in placed.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"),
            F.max("gap").alias("radius"),
            F.sum(F.col("asks").cast("int")).alias("nq"),
            F.max(F.when(F.col("asks"), F.col("gap"))).alias("qradius"),
        ).collect()
    }
    parts = {c: -(-r["n"] // BLOCK) for c, r in stats.items()}
    qparts = {c: -(-r["nq"] // GROUP) for c, r in stats.items()}
    of = lambda counts: F.element_at(F.create_map(*[x for c, p in counts.items() for x in (F.lit(c), F.lit(max(1, p)))]), F.col("cell"))
    h = F.xxhash64(F.lit(9), "id", "v")
    blocks = settle(_pack(placed.withColumn("part", F.pmod(h, of(parts)).cast("int")), ["cell", "part"]))
    asks = placed.where("asks").withColumn("part", F.pmod(h, of(qparts)).cast("int"))
    groups = settle(_pack(asks, ["cell", "part"]).withColumnsRenamed({"cell": "qcell", "part": "qpart"}))
    shared = spark.sparkContext.broadcast((centres, stats, parts))

    def pair_up(survivors):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c, figures, cuts = shared.value
            norm = np.sqrt((c * c).sum(axis=1))
            for batch in batches:
                out = [
                    (r["qcell"], r["qpart"], cell, part)
                    for r in batch.to_pylist()
                    for cell, part in survivors(r, c, norm, figures, cuts)
                ]
                cols = list(zip(*out, strict=True)) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()) for x in cols], ["qcell", "qpart", "cell", "part"])

        return run

    def first(r, c, norm, figures, cuts):
        cell = max(sorted(figures), key=lambda x: (float(c[r["qcell"]] @ c[x]), figures[x]["n"]))
        return [(cell, 0)]

    def later(r, c, norm, figures, cuts):
        me, out = r["qcell"], []
        done = first(r, c, norm, figures, cuts)
        rq = figures[me]["qradius"]
        for cell in sorted(figures):
            rd = figures[cell]["radius"]
            top = float(c[me] @ c[cell]) + norm[me] * rd + norm[cell] * rq + rq * rd
            if top + 1 + 1e-9 * (norm[me] + rq) * (norm[cell] + rd) >= r["floor"]:
                out += [(cell, p) for p in range(cuts[cell]) if (cell, p) not in done]
        return out

    schema = "qcell int, qpart int, cell int, part int"
    none = groups.withColumn("floors", F.transform("ids", lambda _: F.lit(LOWEST)))
    one = settle(_visit(groups.select("qcell", "qpart").mapInArrow(pair_up(first), schema), none, blocks, dim, k))
    best = _top(one, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    # k-th score of each query so far, back in the order of its group.
    floors = (
        groups.select("qcell", "qpart", F.posexplode("ids").alias("i", "id"))
        .join(best, "id", "left")
        .groupBy("qcell", "qpart")
        .agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("floor", F.lit(LOWEST)).alias("f")))).alias("fs"))
        .select("qcell", "qpart", F.col("fs.f").alias("floors"))
    )
    known = settle(groups.join(floors, ["qcell", "qpart"]))
    pairs = known.select("qcell", "qpart", F.array_min("floors").alias("floor")).mapInArrow(pair_up(later), schema)
    two = _visit(pairs, known, blocks, dim, k)
    return _top(one.unionByName(two), k)


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best other rows of each query.

    Queries are the rows whose id is divisible by ``every``.  Rows with a null id, a
    null vector, or a null or non-finite component take no part.  Vectors of different
    lengths do not meet.  Rows that repeat an id and vector count once; rows with the
    query's own id are never its answers, and a query id with several vectors is
    answered over all of them.  A score or component beyond 64 bits is an error.
    """
    rows = quantised(vectors, id_col, vector_col, scale).dropDuplicates(["id", "v"])
    rows = settle(rows.withColumn("asks", F.col("id") % every == 0))
    dims = sorted(r[0] for r in rows.select("dim").distinct().collect())
    out = None
    for dim in dims:
        found = _search_dim(rows.where(F.col("dim") == dim), dim, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")).limit(0)
    if len(dims) > 1:
        out = _top(out.drop("rank"), k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


OP2_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum([q.e[i] * d.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.e) = len(d.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@query("op2_cover_tree", OP2_SQL)
def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
