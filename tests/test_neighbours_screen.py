"""Pairs are screened in single precision and, where buckets are wide, once instead of once a table; results stay exact."""

import numpy as np
import pyarrow as pa
import pytest

from tallyward.operators import neighbours as N
from tallyward.plans import split_queries  # noqa: F401
from tallyward.plans.registry import QUERIES


def side(x, **more):
    return pa.table({"r": pa.array(np.arange(len(x))), "f": pa.array(list(x), pa.list_(pa.float64())), **more})


def found(table):
    return sorted(zip(*(table.column(c).to_pylist() for c in ("row_id", "neighbour", "distance"))))


def brute(q, f, k, counts=None):
    out = []
    with np.errstate(all="ignore"):
        for i, v in enumerate(q):
            d = np.sqrt(((v - f) ** 2).sum(axis=1))
            use = ~np.isnan(d) & (True if counts is None else counts[i])
            out += [(i, j, x) for x, j in sorted((x, j) for j, x in enumerate(d) if use[j])[:k]]
    return sorted(out)


def spread(kind):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(900, 6))
    if kind == "far":
        x += 1e6
    elif kind == "tight":
        x = rng.normal(size=(9, 6))[rng.integers(0, 9, 900)] * 100 + x * 1e-7
    elif kind == "tiny":
        x *= 1e-25
    elif kind == "huge":
        x[::50] *= 1e30
    elif kind == "odd":
        x[3, 2], x[700, 0], x[5] = np.nan, np.inf, x[6]
    return x


@pytest.mark.parametrize("kind", ["near", "far", "tight", "tiny", "huge", "odd"])
def test_exact_search_keeps_every_neighbour(kind):
    x = spread(kind)
    q = x[:300]
    cells = pa.array([[0]] * len(q), pa.list_(pa.int32()))
    got = found(N._compare(5, 6, False, N._cell_pairs(64))(side(q, cells=cells), side(x, cell=pa.array([0] * len(x)))))
    assert got == brute(q, x, 5)


@pytest.mark.parametrize("kind", ["near", "tight", "odd"])
def test_scanned_pairs_are_those_of_the_tables(monkeypatch, kind):
    x, p = spread(kind), N.Hashing(tables=4, bits=3, probes=2)
    q = x[:300]
    rng = np.random.default_rng(2)
    w = 16.0 * float(np.nanmedian(np.abs(x)))
    a, b = rng.normal(size=(12, 6)), rng.uniform(0, w, size=12)
    met, add = [], N._Best.add
    monkeypatch.setattr(N._Best, "add", lambda self, here, rows, counts=None: (met.append(len(here) * len(rows)), add(self, here, rows, counts))[1])
    outcome = []
    for scan in (0, 10**9):
        monkeypatch.setattr(N, "SCAN_ROWS", scan)
        monkeypatch.setattr(N, "SCAN_SHARE", 0.0)
        met.clear()
        outcome.append((found(N._compare(5, 6, True, N._bucket_pairs(a, b, w, p, 64))(side(q), side(x))), sum(met)))
    codes = lambda z: N._codes(z, a, b, w)
    (home, place), (theirs, _) = codes(q), codes(x)
    share = np.zeros((len(q), len(x)), bool)
    for t in range(p.tables):
        c = slice(3 * t, 3 * t + 3)
        asked = N._probed(home[:, c], place[:, c], p.probes)
        share |= (asked[:, :, None] == theirs[None, None, :, c]).all(axis=3).any(axis=1)
    assert outcome[0][0] == outcome[1][0] == brute(q, x, 5, share)
    if kind == "near":
        assert outcome[1][1] > 2 * len(q) * len(x)  # each table compares its own pairs
        assert outcome[0][1] < 1.5 * len(q) * len(x)


def test_buckets_far_apart_have_numbers_too():
    theirs = np.array([[0, 1], [2**62, -(2**62)], [0, 1], [5, 5]])
    asked = np.array([[[0, 1], [1, 0]], [[2**62, -(2**62)], [5, 5]]])
    at, wanted = N._bucket_ids(theirs, asked)
    assert at[0] == at[2] and len(set(at.tolist())) == 3
    assert wanted.tolist() == [[at[0], -1], [at[1], at[3]]]
    near, far = N._bucket_ids(theirs[[0, 2, 3]], asked)
    assert far.tolist() == [[near[0], -1], [-1, near[2]]]


def test_bucket_width_is_measured_exactly(spark):
    x = np.random.default_rng(9).normal(size=(600, 8))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "row_id long, features array<double>")
    got = N._scale(df.selectExpr("row_id as r", "features as f"), df.selectExpr("row_id as r", "features as f"), 4, 50, 3)
    picked = N.sample_rows(df.selectExpr("row_id as r", "features as f"), 50, "r", 3).collect()
    d = np.sort(np.sqrt(((np.array([r.f for r in picked])[:, None] - x[None]) ** 2).sum(axis=2)), axis=1)[:, 3]
    assert got == sorted(d)[25]


def test_recall_searches_once(spark, sf):
    df = QUERIES["C7_hashed_recall"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" not in plan
    rows = df.collect()
    each = [r.recall for r in rows if r.row_id is not None]
    total = [r.recall for r in rows if r.row_id is None]
    assert len(total) == 1 and total[0] == pytest.approx(np.mean(each))
