"""Embedding whitening by a weighted multiplicity covariance.

Method: identical x vectors are grouped once and carry their count as a fit weight
(weight one each where ``weighted=False``); the covariance is a weighted, centred
GEMM over the distinct vectors only; each distinct vector is whitened once and the
result is joined back to its rows.

Shape of the plan: grouping by the vector is a shuffle with map-side counting, so a
vector that holds a third of all rows arrives as partial counts.  Sums and the
GEMM are partial per task (numpy inside ``mapInPandas``) and meet as ``d x d``
figures: only those (``d`` = dimension) and the component matrix pass through the
driver.  Joining the distinct vectors back to their rows is an equi-join on the
vector; a distinct table counted to be small is broadcast, else a hot vector is cut
by adaptive skew splitting of the row side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import checked, query, table
from tallyward.session import settle

#: Fixed values of the contract: x = floor(SCALE * c) + OFFSET.
SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Eigenvalues at or below this share of the largest are not components (no finite whitening).
RANK_TOL = 1e-12


def _finite(vec: str):
    return F.col(vec).isNotNull() & F.forall(
        F.col(vec), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != F.lit(float("inf")))
    )


def _gemm(centre: np.ndarray, col: str, width: int):
    """Per task: sum of w * (v - centre)(v - centre)^T as (i, j, value) rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((width, width))
        for b in batches:
            if len(b) == 0:
                continue
            v = np.stack(b[col].to_numpy()).astype(np.float64) - centre
            acc += (v * b["w"].to_numpy(np.float64)[:, None]).T @ v
        i, j = np.indices((width, width))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": acc.ravel()})

    return run


def _matrix(parts: DataFrame, width: int) -> np.ndarray:
    m = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        m[r["i"], r["j"]] = r["v"]
    return m


def whiten(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    components: int = COMPONENTS,
    weighted: bool = True,
) -> DataFrame:
    """One row per kept input row and component: ``id_col``, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, holds a null or non-finite entry, or whose
    length is not the largest length present are dropped.  Entries become
    ``x = floor(64 c) + 1000000``.  With ``weighted`` the fit list is every kept row
    (identical vectors count with their multiplicity); without, each distinct vector
    counts once.  n is the fit list's size, deviation ``sum_d (n x_d - S_d)^2``
    exactly (null where it passes a long), whitened the centred vector projected on a
    unit eigenvector over the square root of its eigenvalue, explained the
    eigenvalue's share of the trace, identity_error the largest absolute entry of the
    whitened covariance minus the identity, measured over the fit list.  Components
    are ordered by falling eigenvalue, their sign fixed so that the largest entry is
    positive; those of eigenvalue not above ``1e-12`` times the largest are left out.
    Repeated rows and ids are each kept.  An empty input gives an empty output.  Other
    input columns are not carried.
    """
    spark = rows.sparkSession
    kept = rows.select(F.col(id_col).alias("__id"), F.col(vec_col).alias("__v")).where(_finite("__v"))
    kept = kept.where(F.size("__v") > 0)
    width = kept.agg(F.max(F.size("__v"))).first()[0]
    out_schema = (
        f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, "
        "whitened double, explained double, identity_error double"
    )
    if width is None:
        return spark.createDataFrame([], out_schema)
    kept = kept.where(F.size("__v") == width)
    shifted = F.transform("__v", lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long"))
    kept = kept.select("__id", shifted.alias("y"))
    groups = settle(kept.groupBy("y").agg(F.count(F.lit(1)).alias("m")))
    groups = groups.withColumn("w", F.col("m") if weighted else F.lit(1).cast("long"))
    # Exact sums: n and S over the fit list (shift by OFFSET does not change centred figures).
    sums = (
        groups.select("w", F.posexplode("y").alias("d", "yd"))
        .groupBy("d")
        .agg(F.sum(F.col("w") * F.col("yd")).alias("s"), F.sum("w").alias("n"))
        .collect()
    )
    n = int(sums[0]["n"])
    s_shift = [0] * width
    for r in sums:
        s_shift[r["d"]] = int(r["s"])
    centre = np.array(s_shift, dtype=np.float64) / n
    gemm_schema = "i int, j int, v double"
    cov = _matrix(groups.select("y", "w").mapInPandas(_gemm(centre, "y", width), gemm_schema), width) / n
    cov = (cov + cov.T) / 2
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(-vals, kind="stable")
    vals, vecs = vals[order], vecs[:, order]
    top = vals[0] if len(vals) else 0.0
    keep = [k for k in range(min(components, width)) if vals[k] > RANK_TOL * max(top, 0.0) and vals[k] > 0]
    vals, vecs = vals[keep], vecs[:, keep]
    for k in range(vecs.shape[1]):
        if vecs[np.argmax(np.abs(vecs[:, k])), k] < 0:
            vecs[:, k] = -vecs[:, k]
    trace = float(np.trace(cov))
    proj = vecs / np.sqrt(vals)
    m = proj.shape[1]

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = np.stack(b["y"].to_numpy()).astype(np.float64) - centre if len(b) else np.zeros((0, width))
            z = v @ proj
            yield pd.DataFrame({"y": b["y"], "w": b["w"], "z": list(z)})

    white = settle(groups.select("y", "w").mapInPandas(project, "y array<long>, w long, z array<double>"))
    ident = _matrix(white.mapInPandas(_gemm(np.zeros(m), "z", m), gemm_schema), m) / n if m else np.zeros((0, 0))
    identity_error = float(np.abs(ident - np.eye(m)).max()) if m else 0.0
    big = F.lit(n).cast("decimal(38,0)")
    s_lit = F.array(*[F.lit(s).cast("decimal(38,0)") for s in s_shift])
    dev = F.aggregate(
        F.zip_with("y", s_lit, lambda y, s: big * y.cast("decimal(38,0)") - s),
        F.lit(0).cast("decimal(38,0)"),
        lambda acc, e: acc + e * e,
    )
    white = white.select("y", "z", dev.try_cast("long").alias("deviation"))
    met = kept.join(checked(white), "y")
    explained = F.array(*[F.lit(float(v / trace)) for v in vals]) if m else F.array().cast("array<double>")
    out = met.select(
        F.col("__id").alias(id_col),
        F.posexplode("z").alias("k", "whitened"),
        "deviation",
    )
    return out.select(
        id_col,
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("k")).alias("explained"),
        F.lit(identity_error).alias("identity_error"),
    )


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
