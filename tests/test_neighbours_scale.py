"""Vectors travel a bounded number of times, whatever the size of a block."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.operators import neighbours as N


def frame(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "row_id long, features array<double>")


def carried(monkeypatch, run):
    """Rows of both sides that a search sends to its tasks."""
    sent = []
    search = N._search

    def counted(asked, ref, k, dims, once, parts, pairs):
        sent.append(N._carried(asked, parts).count() + ref.count() * parts)
        return search(asked, ref, k, dims, once, parts, pairs)

    monkeypatch.setattr(N, "_search", counted)
    rows = run().collect()
    return rows, sum(sent)


@pytest.mark.parametrize("approximate", [None, N.Hashing(tables=4)])
def test_small_blocks_do_not_multiply_the_rows(spark, monkeypatch, approximate):
    x = np.random.default_rng(5).normal(size=(600, 8))
    df = frame(spark, x)
    rows, sent = carried(monkeypatch, lambda: N.nearest_neighbours(df, df, 3, pivots=4, block_rows=4, approximate=approximate))
    assert len(rows) == 1800
    # one copy per part or group (a cell that is cut adds a group); blocks of 4 rows would make 150 of each query row
    assert sent <= 600 * (3 * N.SPLIT + 4)


def test_cells_are_packed_and_cut():
    groups = N._groups_of({0: 3, 1: 4, 2: 25, 3: 2}, 10)
    assert [list(groups[c]) for c in range(4)] == [[0], [0], [1, 2, 3], [4]]


def test_screening_keeps_exact_distances_far_from_the_origin(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 4)) + 1e6  # the products lose most digits, the differences none
    df = frame(spark, x)
    got = {(r.row_id, r.rank): (r.neighbour, r.distance) for r in N.nearest_neighbours(df, df, 4, block_rows=32, pivots=3).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for i in range(300):
        best = sorted(zip(d[i], range(300)))[:4]
        assert [got[i, r + 1] for r in range(4)] == [(j, v) for v, j in best]
    assert N.nearest_neighbours(df, df, 4).agg(F.max("distance")).first()[0] < 100
