"""Exact k nearest neighbours under Euclidean distance, without an all-pairs join.

Reference rows are grouped around a few pivots.  The triangle inequality bounds
the distance from a query row to everything in a group, so a row visits only the
groups that can still hold one of its k nearest.  Equal vectors are handled once:
copies share their neighbours, and of equal reference rows only the first k by id
can be among the k nearest.  Reference rows travel in a few large groups of whole
cells (a crowded cell is cut), query rows in a few parts, and a task compares one
part with one group block by block, so a row is copied a few times, not once per
block.  A block is screened by a matrix product with an error bound; what passes is
measured by plain differences, so each task's k candidates per row, and the k best
of all, are exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyward.functions.columns import literal_rows
from tallyward.operators.ordering import ordinals
from tallyward.operators.profile import sample_rows
from tallyward.session import settle

BLOCK_ROWS = 1024
MAX_PIVOTS = 256
# Rows of one side that a task holds at most, and the parts each side is cut into below that.
GROUP_ROWS = 65_536
SPLIT = 6


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Plain differences (not the dot-product shortcut), so equal vectors have distance 0."""
    out = np.empty((len(a), len(b)))
    for i in range(0, len(a), 32):
        out[i : i + 32] = np.sqrt(((a[i : i + 32, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return out


def _vectors(col: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in col]) if len(col) else np.zeros((0, 0))


def _nearest_pivot(pivots: np.ndarray):
    @F.pandas_udf("struct<cell: int, d: double>")
    def assign(features: pd.Series) -> pd.DataFrame:
        d = _distances(_vectors(features), pivots)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "d": d[np.arange(len(d)), cell]})

    return assign


def _reachable_cells(pivots: np.ndarray, radius: np.ndarray, nearest: np.ndarray, need: int, groups: dict[int, range]):
    """Cells that may hold one of the ``need`` nearest rows, and the groups that hold these cells.

    ``nearest[c]`` are the smallest pivot distances in cell c (inf padded): each
    such row is at most ``d(q, pivot) + nearest`` away, which bounds the answer.
    """

    @F.pandas_udf("struct<cells: array<int>, groups: array<int>>")
    def cells(features: pd.Series) -> pd.DataFrame:
        d = _distances(_vectors(features), pivots)
        reach, where = [], []
        for row in d:
            upper = np.partition((row[:, None] + nearest).ravel(), need - 1)[need - 1]
            keep = row - radius <= upper * (1 + 1e-9) + 1e-12
            mine = np.flatnonzero(keep & (radius >= 0)).astype("int32")
            reach.append(mine)
            where.append(sorted({g for c in mine.tolist() for g in groups[c]}))
        return pd.DataFrame({"cells": reach, "groups": where})

    return cells


def _group_rows(n: int, block_rows: int) -> int:
    """Rows of a group: a ``SPLIT``-th of the table, but a block at least and ``GROUP_ROWS`` at most."""
    return min(GROUP_ROWS, max(min(block_rows, BLOCK_ROWS), math.ceil(n / SPLIT)))


def _groups_of(size: dict[int, int], rows: int) -> dict[int, range]:
    """Groups of each cell: small cells share one of about ``rows`` rows, crowded cells are cut into several."""
    out, at, used = {}, 0, 0
    for cell, m in sorted(size.items()):
        if used and used + m > rows:
            at, used = at + 1, 0
        cuts = max(1, math.ceil(m / rows))
        out[cell] = range(at, at + cuts)
        if cuts > 1:
            at, used = at + cuts, 0
        else:
            used += m
    return out


class _Screen:
    """Reference rows in single precision around their mean: a product tells which are too far, with an error bound."""

    def __init__(self, f: np.ndarray):
        with np.errstate(all="ignore"):
            centre = f.mean(axis=0)
            self.centre = np.where(np.isfinite(centre), centre, 0.0)
            g = f - self.centre
            gg = (g * g).sum(axis=1)
            # q.f - |f|^2 / 2 grows as the distance shrinks
            self.f = np.column_stack([g, -0.5 * gg]).astype(np.float32)
        finite = gg[np.isfinite(gg)]
        self.top = finite.max() if len(finite) else 0.0
        self.buffer = np.empty(0, np.float32)

    def queries(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query rows, their squared lengths and the error of a squared distance, all around the mean."""
        with np.errstate(all="ignore"):
            g = q - self.centre
            gg = (g * g).sum(axis=1)
            error = 2.0**-24 * (2 * q.shape[1] + 16) * (gg + self.top) + 2.0**-100
            return np.column_stack([g, np.ones(len(g))]).astype(np.float32), gg, error

    def near(self, q: np.ndarray, block: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Flat positions (row of q, row of the block) whose product is not below ``least``."""
        size = len(q) * block.shape[1]
        if len(self.buffer) < size:
            self.buffer = np.empty(size, np.float32)
        with np.errstate(all="ignore"):
            product = np.matmul(q, block, out=self.buffer[:size].reshape(len(q), -1))
            return np.flatnonzero(~(product < least[:, None]))


# Queries of one product of the screen, so that it stays in a core's cache.
_SLAB = 256


class _Best:
    """The k nearest reference rows found so far for each row of a chunk of queries."""

    def __init__(self, q: np.ndarray, f: np.ndarray, ids: np.ndarray, k: int, once: bool, screen: _Screen):
        self.q, self.f, self.ids, self.k, self.once, self.screen = q, f, ids, k, once, screen
        self.qq, self.ff = (q * q).sum(axis=1), (f * f).sum(axis=1)
        # rounding error of |q|^2 + |f|^2 - 2 q.f, with room
        finite = self.ff[np.isfinite(self.ff)]
        self.slack = 1e-15 * (q.shape[1] + 8) * (self.qq + (finite.max() if len(finite) else 0.0))
        self.short, self.length, self.error = screen.queries(q)
        self.bound = np.full(len(q), np.inf)
        self.at, self.row, self.d = np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
        self.todo: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, here: np.ndarray, rows: np.ndarray, counts: Callable | None = None) -> None:
        """Compare the queries ``here`` with the reference rows ``rows`` (both as positions).

        ``counts`` tells which pairs are to be compared; without it all are.
        """
        known = np.isfinite(self.bound[here])
        if not known.all():
            self._plain(here[~known], rows, counts)
        here = here[known]
        if not len(here):
            return
        with np.errstate(all="ignore"):
            reach = self.bound[here] + 2.0 * self.slack[here] + self.error[here]
            least = (0.5 * (self.length[here] - reach)).astype(np.float32)
        block = self.screen.f[rows].T
        for a in range(0, len(here), _SLAB):
            some = here[a : a + _SLAB]
            hit = self.screen.near(self.short[some], block, least[a : a + _SLAB])
            if len(hit) > len(some) * len(rows) // 16:  # single precision tells too little here
                self._plain(some, rows, counts)
            elif len(hit):
                self._take(some[hit // len(rows)], rows[hit % len(rows)], counts)

    def _plain(self, here: np.ndarray, rows: np.ndarray, counts: Callable | None) -> None:
        d2 = self.qq[here, None] + self.ff[rows] - 2.0 * (self.q[here] @ self.f[rows].T)
        bound, slack = self.bound[here], 2.0 * self.slack[here]
        if counts is None and len(rows) > self.k and np.isinf(bound).any():
            bound = np.minimum(bound, np.partition(d2, self.k - 1, axis=1)[:, self.k - 1])
            if not self.once:
                self.bound[here] = bound + slack
        i, j = np.nonzero(~(d2 > (bound + slack)[:, None]))
        if len(i):
            self._take(here[i], rows[j], counts)

    def _take(self, at: np.ndarray, row: np.ndarray, counts: Callable | None) -> None:
        if counts is not None:
            keep = counts(at, row)
            at, row = at[keep], row[keep]
        if len(at):
            self.todo.append((at, row))
            self.waiting += len(at)
            if self.waiting > self.k * len(self.q):
                self.settle()

    def settle(self) -> None:
        if not self.todo:
            return
        at, row = np.concatenate([t[0] for t in self.todo]), np.concatenate([t[1] for t in self.todo])
        d = np.empty(len(at))
        for s in range(0, len(at), 65_536):  # plain differences, so equal vectors have distance 0
            d[s : s + 65_536] = np.sqrt(((self.q[at[s : s + 65_536]] - self.f[row[s : s + 65_536]]) ** 2).sum(axis=1))
        known = ~np.isnan(d)
        at, row = np.concatenate([self.at, at[known]]), np.concatenate([self.row, row[known]])
        d = np.concatenate([self.d, d[known]])
        if self.once:  # a pair may come from several hash tables
            order = np.lexsort((d, self.ids[row], at))
            at, row, d = at[order], row[order], d[order]
            first = np.ones(len(at), bool)
            first[1:] = (at[1:] != at[:-1]) | (self.ids[row[1:]] != self.ids[row[:-1]])
            at, row, d = at[first], row[first], d[first]
        order = np.lexsort((self.ids[row], d, at))
        at, row, d = at[order], row[order], d[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        last = rank == self.k - 1
        self.bound[at[last]] = np.minimum(self.bound[at[last]], d[last] ** 2 * (1 + 1e-12) + self.slack[at[last]])
        keep = rank < self.k
        self.at, self.row, self.d = at[keep], row[keep], d[keep]
        self.todo, self.waiting = [], 0


def _matrix(table: pa.Table, dims: int) -> np.ndarray:
    return table.column("f").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


_FOUND = "row_id bigint, neighbour bigint, distance double"
_CHUNK = 1024


def _compare(k: int, dims: int, once: bool, pairs: Callable[[pa.Table, pa.Table, np.ndarray, np.ndarray], Callable]):
    """One part of the queries against one group of reference rows: the k nearest of each query.

    ``pairs`` prepares both sides and gives, for a chunk of queries, (query positions
    in the chunk, reference positions) to compare, and where not all of these pairs
    count, a function that tells which do.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        qi, ri = (t.column("r").to_numpy() for t in (left, right))
        rows, near, dist = [], [], []
        if len(qi) and len(ri):
            q, f = _matrix(left, dims), _matrix(right, dims)
            chunk_pairs, screen = pairs(left, right, q, f), _Screen(f)
            for start in range(0, len(q), _CHUNK):
                best = _Best(q[start : start + _CHUNK], f, ri, k, once, screen)
                for here, there, *counts in chunk_pairs(start, min(start + _CHUNK, len(q))):
                    best.add(here, there, *counts)
                best.settle()
                rows.append(qi[start + best.at])
                near.append(ri[best.row])
                dist.append(best.d)
        joined = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((rows, "int64"), (near, "int64"), (dist, float))]
        return pa.table([pa.array(x, t) for x, t in zip(joined, (pa.int64(), pa.int64(), pa.float64()))], names=["row_id", "neighbour", "distance"])

    return run


def _blocks(rows: np.ndarray, block_rows: int) -> list[np.ndarray]:
    return [rows[i : i + block_rows] for i in range(0, len(rows), block_rows)]


def _cell_pairs(block_rows: int):
    """Pairs of the exact path: a query meets the blocks of the cells it can reach."""

    def pairs(left: pa.Table, right: pa.Table, q: np.ndarray, f: np.ndarray):
        cell = right.column("cell").to_numpy()
        blocks = {int(c): _blocks(np.flatnonzero(cell == c), block_rows) for c in np.unique(cell)}
        reach = left.column("cells").combine_chunks()
        at, cells = np.repeat(np.arange(len(left)), reach.value_lengths().to_numpy()), reach.flatten().to_numpy()

        def of(start: int, stop: int):
            a, b = np.searchsorted(at, [start, stop])
            mine, rows = cells[a:b], at[a:b] - start
            for c, parts in blocks.items():
                here = rows[mine == c]
                if len(here):
                    for part in parts:
                        yield here, part

        return of

    return pairs


def _carried(asked: DataFrame, parts: int) -> DataFrame:
    """Query rows, once for each group of reference rows they must meet."""
    part = F.pmod(F.xxhash64("r"), F.lit(parts)).cast("int")
    return asked.withColumn("part", part).withColumn("group", F.explode("groups")).drop("groups")


def _search(asked: DataFrame, ref: DataFrame, k: int, dims: int, once: bool, parts: int, pairs) -> DataFrame:
    """(row_id, neighbour, distance) of ``asked`` (r, f, groups, ...) against ``ref`` (r, f, group, ...)."""
    left = _carried(asked, parts).groupBy("part", "group")
    right = ref.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).groupBy("part", "group")
    found = left.cogroup(right).applyInArrow(_compare(k, dims, once, pairs), _FOUND)
    if once:
        found = found.groupBy("row_id", "neighbour").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("row_id").orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def nearest_neighbours(
    queries: DataFrame, reference: DataFrame, k: int, row: str = "row_id", features: str = "features",
    exclude_self: bool = False, pivots: int | None = None, block_rows: int = BLOCK_ROWS,
    approximate: Hashing | None = None,
) -> DataFrame:
    """(row_id, rank, neighbour, distance): the k nearest reference rows of every query row.

    Ties are broken by neighbour id.  Row ids are whole numbers or text; text ids are
    numbered in their order for the search.  With ``approximate`` the candidates come
    from the hash tables of :class:`Hashing` and are ranked by exact distance; a
    query row that finds fewer than k candidates is searched exactly.
    """
    if isinstance(queries.schema[row].dataType, StringType):
        ids = queries.select(row).union(reference.select(row)).where(F.col(row).isNotNull()).distinct()
        numbers = settle(ordinals(ids, row, row, out="__n"))
        named = lambda df: df.join(numbers, row).select(F.col("__n").alias(row), features)
        found = nearest_neighbours(
            named(queries), named(reference), k, row, features, exclude_self, pivots, block_rows, approximate
        )
        back = lambda column: numbers.select(F.col("__n").alias(column), F.col(row).alias(f"__{column}"))
        return found.join(back("row_id"), "row_id").join(back("neighbour"), "neighbour").select(
            F.col("__row_id").alias("row_id"), "rank", F.col("__neighbour").alias("neighbour"), "distance"
        )
    need = k + 1 if exclude_self else k
    rows = queries.select(F.col(row).cast("bigint").alias("r"), F.col(features).alias("f"))
    asked = rows.groupBy("f").agg(F.min("r").alias("r"))
    copies = Window.partitionBy("f").orderBy("r")
    ref = (
        reference.select(F.col(row).cast("bigint").alias("r"), F.col(features).alias("f"))
        .withColumn("i", F.row_number().over(copies))
        .where(F.col("i") <= need)
        .drop("i")
    )
    if approximate is None:
        found = _nearest(asked, ref, need, pivots, block_rows)
    else:
        found = _nearest_hashed(asked, ref, need, approximate, pivots, block_rows)
    # a table of vectors is never broadcast: it would pass the driver
    shared = rows.join(asked.select("f", F.col("r").alias("rep")).hint("merge"), "f").join(
        found.withColumnRenamed("row_id", "rep"), "rep"
    )
    if exclude_self:
        shared = shared.where(F.col("neighbour") != F.col("r"))
    order = Window.partitionBy("r").orderBy("distance", "neighbour")
    return shared.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("r").alias("row_id"), "rank", "neighbour", "distance"
    )


def _nearest(asked: DataFrame, ref: DataFrame, k: int, pivots: int | None, block_rows: int) -> DataFrame:
    """(row_id, neighbour, distance): the k nearest rows of ``ref`` for each distinct vector."""
    n = ref.count()
    if n == 0:
        raise ValueError("empty reference set")
    wanted = pivots or min(MAX_PIVOTS, math.ceil(math.sqrt(n / block_rows)))
    if wanted == 1:
        # a reference of one block has nothing to prune
        dims = len(ref.first()["f"])
        groups = {0: range(math.ceil(n / GROUP_ROWS))}
        ref = ref.withColumn("cell", F.lit(0))
        asked = asked.withColumn("cells", F.array(F.lit(0))).withColumn("groups", F.array(*[F.lit(g) for g in groups[0]]))
    else:
        dims, ref, asked, groups = _assign_cells(asked, ref, k, wanted, n, block_rows)
    total = asked.count()
    parts = max(1, math.ceil(total / _group_rows(total, block_rows)))
    spread = literal_rows([{"cell": c, "lo": g.start, "cuts": len(g)} for c, g in groups.items()], "cell: int, lo: int, cuts: int")
    # one small row per cell
    table = F.broadcast(ref.sparkSession.range(1).select(F.inline(spread)))
    group = F.col("lo") + F.pmod(F.xxhash64("r", "f"), F.col("cuts"))
    grouped = ref.join(table, "cell").select("r", "f", "cell", group.cast("int").alias("group"))
    return _search(asked, grouped, k, dims, False, parts, _cell_pairs(block_rows))


@dataclass(frozen=True)
class Hashing:
    """Parameters of the approximate path: random-projection hash tables with multi-probe.

    Each of ``tables`` tables hashes a vector by ``bits`` projections
    ``floor((a . x + b) / w)``, a Gaussian and b uniform in [0, w), drawn from ``seed``.
    ``w`` is ``width`` times the median k-th neighbour distance of ``sample`` query
    rows, measured exactly against all reference rows.  A query also probes, per
    table, the ``probes`` buckets one step over the boundaries it lies closest to.
    """

    tables: int = 10
    bits: int = 4
    width: float = 4.0
    probes: int = 2
    sample: int = 256
    seed: int = 11


def _scale(asked: DataFrame, ref: DataFrame, k: int, sample: int, seed: int) -> float:
    """Median k-th neighbour distance of a bounded sample of query vectors, exact over all of ``ref``."""
    probe = np.array([x["f"] for x in sample_rows(asked, sample, "r", seed).collect()], dtype=float)
    m = len(probe)

    def closest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.full((m, k), np.inf)
        for b in batches:
            if len(b):
                f = _vectors(b["f"])
                found = _Best(probe, f, np.arange(len(f)), k, False, _Screen(f))
                for rows in _blocks(np.arange(len(f)), BLOCK_ROWS):
                    found.add(np.arange(m), rows)
                found.settle()
                d = np.full((m, k), np.inf)
                d[found.at, np.arange(len(found.at)) - np.searchsorted(found.at, found.at)] = found.d
                best = np.sort(np.concatenate([best, d], axis=1), axis=1)[:, :k]
        yield pd.DataFrame({"s": np.repeat(np.arange(m), k), "d": best.ravel()})

    parts = ref.select("f").mapInPandas(closest, "s long, d double")
    kth = parts.where(F.col("d") < float("inf")).groupBy("s").agg(F.sort_array(F.collect_list("d")).alias("d"))
    kth = kth.select(F.element_at("d", F.least(F.lit(k), F.size("d"))).alias("d")).collect()
    values = sorted(x["d"] for x in kth)
    return values[len(values) // 2] if values else 1.0


def _codes(x: np.ndarray, a: np.ndarray, b: np.ndarray, w: float) -> tuple[np.ndarray, np.ndarray]:
    """Bucket coordinates of every vector under all projections, and the place within the bucket."""
    v = (x @ a.T + b) / w
    h = np.floor(v)
    return h.astype(np.int64), v - h


def _bucket_ids(theirs: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the buckets that hold the reference rows, and of those asked for (-1 where there is none)."""
    low, high = theirs.min(axis=0), theirs.max(axis=0)
    span = [int(h) - int(l) + 1 for l, h in zip(low, high)]
    if math.prod(span) < 1 << 62:
        step = np.array([math.prod(span[:i]) for i in range(len(span))])
        keys, at = np.unique((theirs - low) @ step, return_inverse=True)
        inside = ((asked >= low) & (asked <= high)).all(axis=-1)
        wanted = (np.clip(asked, low, high) - low) @ step
        found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at.ravel(), np.where(inside & (keys[found] == wanted), found, -1)
    keys, at = np.unique(theirs, axis=0, return_inverse=True)
    number = {key.tobytes(): i for i, key in enumerate(keys)}
    flat = [number.get(key.tobytes(), -1) for key in asked.reshape(-1, asked.shape[-1])]
    return at.ravel(), np.array(flat, dtype=np.int64).reshape(asked.shape[:-1])


def _probed(homes: np.ndarray, place: np.ndarray, probes: int) -> np.ndarray:
    """Home bucket and the probed ones of each row, one step over the boundaries it lies closest to: (row, 1 + probes, bits)."""
    closest = np.argsort(np.minimum(place, 1 - place), axis=1, kind="stable")
    step, rows = np.where(place < 0.5, -1, 1), np.arange(len(homes))
    out = [homes]
    for j in range(min(probes, homes.shape[1])):
        moved = homes.copy()
        moved[rows, closest[:, j]] += step[rows, closest[:, j]]
        out.append(moved)
    return np.stack(out, axis=1)


# Reference rows from which a chunk may be compared with all of them, and the share of all pairs in common buckets
# (counted once a table) that makes it so.
SCAN_ROWS = 4096
SCAN_SHARE = 0.25


def _bucket_pairs(a: np.ndarray, b: np.ndarray, w: float, p: Hashing, block_rows: int):
    """Pairs of the approximate path: a query meets the blocks of its home bucket and of the probed ones.

    Where buckets are so wide that most pairs share one, and some several, it is cheaper
    to screen all pairs by distance, once, and then look which share a bucket.
    """
    scan_rows, scan_share = SCAN_ROWS, SCAN_SHARE

    def pairs(left: pa.Table, right: pa.Table, q: np.ndarray, f: np.ndarray):
        theirs, _ = _codes(f, a, b, w)
        homes, place = _codes(q, a, b, w)
        lies, asks, tables = [], [], []
        for t in range(p.tables):
            cols = slice(t * p.bits, (t + 1) * p.bits)
            at, wanted = _bucket_ids(theirs[:, cols], _probed(homes[:, cols], place[:, cols], p.probes))
            order, size = np.argsort(at, kind="stable"), np.bincount(at)
            tables.append((np.split(order, np.cumsum(size)[:-1]), np.append(size, 0)))  # -1 has none
            lies.append(at.astype(np.int32))
            asks.append(wanted.astype(np.int32))
        lies, asks = np.stack(lies, axis=1), np.stack(asks, axis=1)
        everything = _blocks(np.arange(len(f)), block_rows)

        def of(start: int, stop: int):
            mine = asks[start:stop]
            met = sum(int(size[mine[:, t]].sum()) for t, (_, size) in enumerate(tables))
            scan = len(f) >= scan_rows and met > scan_share * len(mine) * len(f)
            for t, (buckets, _) in enumerate(tables[:1] if scan else tables):
                wanted = mine[:, t]
                for i in np.unique(wanted[wanted >= 0]):
                    here = np.flatnonzero((wanted == i).any(axis=1))
                    for part in _blocks(buckets[i], block_rows)[: 1 if scan else None]:
                        yield here, part  # when all pairs follow, only for a first bound
            if scan:
                def share(at: np.ndarray, row: np.ndarray) -> np.ndarray:
                    return (mine[at] == lies[row][:, :, None]).any(axis=(1, 2))

                for part in everything:
                    yield np.arange(len(mine)), part, share

        return of

    return pairs


def _nearest_hashed(asked: DataFrame, ref: DataFrame, k: int, p: Hashing, pivots: int | None, block_rows: int) -> DataFrame:
    """Like :func:`_nearest`, with candidates from hash buckets; the exact path serves rows left short.

    A task holds the tables of one group of reference rows, so a vector travels once
    per group and not once per table and probe.
    """
    n = ref.count()
    if n == 0:
        raise ValueError("empty reference set")
    dims = len(ref.first()["f"])
    rng = np.random.default_rng(p.seed)
    w = p.width * max(_scale(asked, ref, k, p.sample, p.seed), 1e-12)
    a = rng.normal(size=(p.tables * p.bits, dims))
    b = rng.uniform(0, w, size=p.tables * p.bits)
    groups, total = math.ceil(n / _group_rows(n, block_rows)), asked.count()
    parts = max(1, math.ceil(total / _group_rows(total, block_rows)))
    grouped = ref.select("r", "f", F.pmod(F.xxhash64("r", "f"), F.lit(groups)).cast("int").alias("group"))
    everywhere = asked.select("r", "f", F.array(*[F.lit(g) for g in range(groups)]).alias("groups"))
    found = settle(_search(everywhere, grouped, k, dims, True, parts, _bucket_pairs(a, b, w, p, block_rows)))
    enough = found.groupBy("row_id").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= min(k, n))
    short = asked.join(enough.select(F.col("row_id").alias("r")), "r", "left_anti")
    if short.limit(1).count() == 0:
        return found
    exact = _nearest(short, ref, k, pivots, block_rows)
    return found.join(enough.select("row_id"), "row_id", "left_semi").unionByName(exact)


def _assign_cells(asked: DataFrame, ref: DataFrame, k: int, wanted: int, n: int, block_rows: int):
    """Reference rows with their cell, query rows with the cells and groups they must visit, and the groups of each cell."""
    # at most MAX_PIVOTS vectors on the driver, whatever the size of the data
    points = np.array([x["f"] for x in sample_rows(ref, wanted, "r", 7).collect()], dtype=float)
    ref = settle(ref.withColumn("a", _nearest_pivot(points)("f")).select("r", "f", "a.cell", "a.d"))
    first = Window.partitionBy("cell").orderBy("d", "r")
    small = ref.select("cell", "d", "r").withColumn("i", F.row_number().over(first)).where(F.col("i") <= k)
    radius, nearest, size = np.full(len(points), -1.0), np.full((len(points), k), np.inf), {}
    for x in ref.groupBy("cell").agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("n")).collect():
        radius[x["cell"]], size[x["cell"]] = x["d"], x["n"]
    for x in small.select("cell", "i", "d").collect():
        nearest[x["cell"], x["i"] - 1] = x["d"]
    groups = _groups_of(size, _group_rows(n, block_rows))
    cells = _reachable_cells(points, radius, nearest, min(k, n), groups)
    asked = settle(asked.withColumn("a", cells("f")).select("r", "f", "a.cells", "a.groups"))
    return points.shape[1], ref, asked, groups


def local_outlier_factor(
    df: DataFrame, label: str = "label", k: int = 20, row: str = "row_id", features: str = "features",
    exclude_self: bool = False, pivots: int | None = None,
) -> DataFrame:
    """(row_id, score) against the class-0 rows; higher is more anomalous.

    A scored row that is itself a reference row counts as its own neighbour at
    distance 0 unless ``exclude_self``.
    """
    normal = df.where(F.col(label) == 0)
    inner = settle(nearest_neighbours(normal, normal, k, row, features, exclude_self=True, pivots=pivots))
    reach_k = inner.groupBy("row_id").agg(F.max("distance").alias("kd")).withColumnRenamed("row_id", "neighbour")

    def density(pairs: DataFrame) -> DataFrame:
        reach = pairs.join(reach_k, "neighbour").withColumn("reach", F.greatest("kd", "distance"))
        return reach.groupBy("row_id").agg((1.0 / (F.avg("reach") + 1e-10)).alias("lrd"))

    of_normal = density(inner).select(F.col("row_id").alias("neighbour"), F.col("lrd").alias("lrd_o"))
    outer = settle(nearest_neighbours(df, normal, k, row, features, exclude_self=exclude_self, pivots=pivots))
    around = outer.join(of_normal, "neighbour").groupBy("row_id").agg(F.avg("lrd_o").alias("around"))
    return density(outer).join(around, "row_id").select("row_id", (F.col("around") / F.col("lrd")).alias("score"))
