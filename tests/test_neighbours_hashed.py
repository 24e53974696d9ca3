"""The hashed neighbour path against the exact one."""

import numpy as np

from tallyward.operators import neighbours as N


def frame(spark, x, ids=None):
    ids = list(range(len(x))) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "row_id long, features array<double>")


def recall(exact, found):
    e = {(r.row_id, r.rank): r.distance for r in exact.collect()}
    f = {(r.row_id, r.rank): r.distance for r in found.collect()}
    return np.mean([abs(f.get(key, np.inf) - d) <= 1e-9 for key, d in e.items()])


def test_hashed_recall_on_clusters(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 5
    x = centres[rng.integers(0, 12, 600)] + rng.normal(size=(600, 16))
    x[:40] = x[0]  # a crowd of copies
    df = frame(spark, x)
    exact = N.nearest_neighbours(df, df, 5, exclude_self=True)
    found = N.nearest_neighbours(df, df, 5, exclude_self=True, approximate=N.Hashing(), block_rows=64)
    assert found.count() == 600 * 5
    assert recall(exact, found) >= 0.9


def test_rows_short_of_candidates_are_searched_exactly(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(size=(50, 8)), rng.normal(size=(3, 8)) * 1000])  # far rows share no bucket
    df = frame(spark, x)
    exact = N.nearest_neighbours(df, df, 4, exclude_self=True)
    found = N.nearest_neighbours(df, df, 4, exclude_self=True, approximate=N.Hashing(tables=2, probes=0, width=0.5))
    assert found.count() == 53 * 4
    far = {r.row_id: r.distance for r in found.where("row_id >= 50 AND rank = 4").collect()}
    assert far == {r.row_id: r.distance for r in exact.where("row_id >= 50 AND rank = 4").collect()}
