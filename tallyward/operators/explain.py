"""Row-level and global explanations of scores."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions import scoring as S
from tallyward.functions.columns import literal_rows
from tallyward.functions.hashing import carried_int, carried_texts, hash_unit
from tallyward.operators.ordering import exact_quantiles, ordinals
from tallyward.operators.profile import pair_corr, sample_rows
from tallyward.operators.reports import top_per_row
from tallyward.session import settle


def stack(df: DataFrame, row: str, parts: dict[str, Column]) -> DataFrame:
    """Long contribution table (row, feature, contribution) from one expression per feature."""
    items = F.array(*[F.struct(F.lit(f).alias("feature"), c.cast("double").alias("contribution")) for f, c in parts.items()])
    return df.select(row, F.inline(items))


def rule_terms(df: DataFrame, row: str = "transaction_id") -> DataFrame:
    """Additive terms of the rule score per row."""
    return stack(df, row, {f: S.rule_term(f, F.col(f)) for f in S.RULE_FEATURES})


def top_factors(n: int, values: dict[str, Column] | None = None) -> Column:
    """Names of the ``n`` largest rule terms of a row, in one expression (no shuffle)."""
    cols = values or {f: S.rule_term(f, F.col(f)) for f in S.RULE_FEATURES}
    items = F.array(*[F.struct((-F.abs(c.cast("double"))).alias("k"), F.lit(f).alias("f")) for f, c in cols.items()])
    return F.transform(F.slice(F.array_sort(items), 1, n), lambda x: x["f"])


def global_importance(contrib: DataFrame) -> DataFrame:
    """(feature, importance): mean absolute contribution."""
    return contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))


def select_features(importance: DataFrame, n: int = 20, threshold: float | None = None) -> DataFrame:
    """Top ``n`` features, or all at least ``threshold`` if one is given."""
    if threshold is not None:
        return importance.where(F.col("importance") >= threshold)
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)


# Recommendation texts of the linearity check.
LINEAR = "Linear relationship"
NON_LINEAR = "Non-linear relationship - may require careful interpretation"

ScoreFn = Callable[[Mapping[str, Column]], Column]


def rule_fn(values: Mapping[str, Column]) -> Column:
    return S.rule_score(values)


def current(features: Sequence[str]) -> dict[str, Column]:
    return {f: F.col(f) for f in features}


def _means(df: DataFrame, parts: Mapping[str, Column]) -> Column:
    return df.agg(F.struct(*[F.avg(c).alias(f) for f, c in parts.items()]).alias("m")).scalar()


def additive_contributions(df: DataFrame, parts: Mapping[str, Column], row: str = "transaction_id") -> DataFrame:
    """Exact contributions of an additive score: each term minus its mean over the table."""
    base = df.withColumn("__m", _means(df, parts))
    return stack(base, row, {f: c - F.col(f"__m.{f}") for f, c in parts.items()})


def rule_contributions(df: DataFrame, row: str = "transaction_id") -> DataFrame:
    return additive_contributions(df, {f: S.rule_term(f, F.col(f)) for f in S.RULE_FEATURES}, row)


def linear_contributions(df: DataFrame, weights: Mapping[str, float], row: str = "transaction_id") -> DataFrame:
    """``w_i * (x_i - mean_i)`` for a linear model."""
    return additive_contributions(df, {f: F.col(f) * F.lit(float(w)) for f, w in weights.items()}, row)


def _spread(df: DataFrame, row: str) -> DataFrame:
    """Rows dealt over all tasks by their id.

    A small table is a file or two, so one task or two; unfolded into thousands of
    draws a row it is the largest step there is.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, row)


def sampled_shapley(
    df: DataFrame, background: DataFrame, features: Sequence[str], score: ScoreFn, draws: int = 20,
    row: str = "transaction_id", seed: int = 42, pool_size: int = 100,
) -> DataFrame:
    """Permutation-sampled Shapley values of any score expression: (row, feature, contribution).

    Draw d pairs every row with one background row (chosen by hash) and one
    feature order, and switches features from background to row values in that
    order.  The contributions of a row sum to its score minus the mean score of
    its background rows.  Draws are averaged before the shuffle ends, so only
    one record per row and feature leaves a task.  At most ``pool_size`` background
    rows are used, chosen by hash, so the pool fits in every task.
    """
    pool = sample_rows(background, pool_size, row, seed).select(F.struct(*[F.col(f).cast("double").alias(f) for f in features]).alias("b"))
    packed = pool.agg(F.array_sort(F.collect_list("b"))).scalar()
    rng = random.Random(seed)
    orders = [rng.sample(list(features), len(features)) for _ in range(draws)]
    rank = F.array(*[F.struct(*[F.lit(o.index(f)).alias(f) for f in features]) for o in orders])
    pick = F.pmod(F.xxhash64(F.col(row), F.col("d"), F.lit(seed)), F.size("__pool")).cast("int")
    drawn = (
        _spread(df.select(row, *features), row).withColumn("__pool", packed)
        .withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
        .withColumn("__b", F.get("__pool", pick))
        .withColumn("__o", F.get(rank, F.col("d")))
        .select(row, *features, "__b", "__o")
    )

    def at(upto: Column) -> Column:
        """Score with the features of rank < upto taken from the row."""
        return score({f: F.when(F.col(f"__o.{f}") < upto, F.col(f)).otherwise(F.col(f"__b.{f}")) for f in features})

    parts = {f: at(F.col(f"__o.{f}") + 1) - at(F.col(f"__o.{f}")) for f in features}
    mean = drawn.groupBy(row).agg(*[F.avg(c).alias(f"__c_{f}") for f, c in parts.items()])
    return stack(mean, row, {f: F.col(f"__c_{f}") for f in features})


def permutation_effect(
    df: DataFrame, features: Sequence[str], score: ScoreFn, row: str = "transaction_id", seed: int = 42
) -> DataFrame:
    """(feature, effect): mean score minus mean score with that column shuffled.

    A shuffle is a re-pairing by rank: the row at position i of one hash order
    receives the value at position i of another.  Row ids are numeric.
    """
    rows = settle(df.select(row, *features, hash_unit(F.col(row), seed).alias("__h")))
    here = settle(ordinals(rows, "__h", row, out="__i"))
    base = here.agg(F.avg(score(current(features)))).scalar()
    out = None
    for f in features:
        drawn = rows.select(row, F.col(f).alias("__v"), hash_unit(F.col(row), f"{seed}:{f}").alias("__g"))
        there = ordinals(drawn, "__g", row, out="__i").select("__i", "__v")
        paired = here.join(there, "__i")
        part = paired.agg(F.lit(f).alias("feature"), (base - F.avg(score({**current(features), f: F.col("__v")}))).alias("effect"))
        out = part if out is None else out.unionByName(part)
    return out


# partial dependence

def feature_grids(
    df: DataFrame, features: Sequence[str], points: int = 100, low: float = 0.05, high: float = 0.95,
    percentiles: bool = False,
) -> dict[str, list[float]]:
    """Grid values per feature: the distinct values if fewer than ``points``, else evenly between
    two percentiles (or at evenly spaced percentiles).

    At most ``points`` numbers per feature reach the driver.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])
    values = df.select(F.inline(pairs)).where(F.col("v").isNotNull()).distinct()
    first = Window.partitionBy("feature").orderBy("v")
    few = values.withColumn("i", F.row_number().over(first)).where(F.col("i") <= points)
    grids: dict[str, list[float]] = {f: [] for f in features}
    for r in few.collect():
        grids[r["feature"]].append(r["v"])
    many = [f for f in features if len(grids[f]) >= points]
    if many:
        shares = [i / (points - 1) for i in range(points)] if percentiles else [low, high]
        found: dict[str, dict[float, float]] = {f: {} for f in many}
        for r in exact_quantiles(df, many, shares).collect():
            found[r["column"]][r["share"]] = r["value"]
        for f in many:
            a, b = found[f][shares[0]], found[f][shares[-1]]
            grids[f] = list(found[f].values()) if percentiles else [a + (b - a) * i / (points - 1) for i in range(points)]
    return {f: sorted(set(g)) for f, g in grids.items()}


def feature_grid(df: DataFrame, feature: str, points: int = 100, **options) -> list[float]:
    return feature_grids(df, [feature], points, **options)[feature]


def _on_grid(df: DataFrame, grids: Mapping[str, Sequence[float]], features: Sequence[str], score: ScoreFn, keep: Sequence[str] = ()) -> DataFrame:
    """Every row at every grid point of every gridded feature: (keep..., feature, point, value, score).

    The grid is a literal array that is unfolded inside the scan stage, so there
    is no join and an average right after it shuffles only one record per point.
    """
    items = literal_rows(
        [{"feature": f, "point": i, "value": float(v)} for f, grid in grids.items() for i, v in enumerate(grid)],
        "feature: string, point: int, value: double",
    )
    wide = df.select(*dict.fromkeys([*keep, *features]), F.inline(items))
    swapped = {
        f: F.when(F.col("feature") == f, F.col("value")).otherwise(F.col(f)) if f in grids else F.col(f) for f in features
    }
    return wide.select(*keep, "feature", "point", "value", score(swapped).alias("score"))


def partial_dependence(df: DataFrame, grids: Mapping[str, Sequence[float]], features: Sequence[str], score: ScoreFn) -> DataFrame:
    """(feature, point, value, average)."""
    return _on_grid(df, grids, features, score).groupBy("feature", "point", "value").agg(F.avg("score").alias("average"))


def dependence_summary(pd: DataFrame) -> DataFrame:
    """(feature, min/max value, min/max prediction, range)."""
    return pd.groupBy("feature").agg(
        F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        F.min("average").alias("min_prediction"), F.max("average").alias("max_prediction"),
        (F.max("average") - F.min("average")).alias("range"),
    )


def individual_curves(df: DataFrame, grids, features, score: ScoreFn, row: str = "transaction_id") -> DataFrame:
    """(row, feature, point, value, score): one curve per row."""
    return _on_grid(df, grids, features, score, keep=[row])


def two_way_dependence(
    df: DataFrame, first: str, second: str, grid_a: Sequence[float], grid_b: Sequence[float],
    features: Sequence[str], score: ScoreFn,
) -> DataFrame:
    """(value_a, value_b, average) over the product of two grids."""
    items = literal_rows(
        [{"value_a": float(a), "value_b": float(b)} for a in grid_a for b in grid_b], "value_a: double, value_b: double"
    )
    wide = df.select(*features, F.inline(items))
    swapped = {**current(features), first: F.col("value_a"), second: F.col("value_b")}
    return wide.groupBy("value_a", "value_b").agg(F.avg(score(swapped)).alias("average"))


def range_importance(pd: DataFrame, top_n: int = 10) -> DataFrame:
    return dependence_summary(pd).select("feature", "range").orderBy(F.col("range").desc(), "feature").limit(top_n)


def linearity(pd: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(feature, correlation, pdp_range, is_linear, recommendation); a flat curve has no correlation (NaN)."""
    c = pd.groupBy("feature").agg(
        F.coalesce(pair_corr("value", "average"), F.lit(float("nan"))).alias("correlation"), (F.max("average") - F.min("average")).alias("pdp_range")
    )
    linear = (F.abs("correlation") >= threshold) & ~F.isnan("correlation")
    return c.select(
        "feature", "correlation", "pdp_range", linear.alias("is_linear"),
        F.when(linear, LINEAR).otherwise(NON_LINEAR).alias("recommendation"),
    )


# local surrogates

def local_surrogate(
    df: DataFrame, features: Sequence[str], score: ScoreFn, draws: int = 5000, top_n: int | None = 5,
    row: str = "transaction_id", seed: int = 42, preset: str = "surrogate", ridge: float = 1.0, arrays: bool = False,
) -> DataFrame:
    """(row, feature, contribution): weights of a linear model fitted around each row.

    Draws come from hashed normals.  The sums of the normal equations are built
    next to the draws, so one record per row is kept, and the small systems
    are solved in Arrow batches.  ``surrogate``: unit noise on standardised
    features, proximity width ``0.75 * sqrt(d)``.  ``half_std``: noise of half a
    standard deviation, width = std of the distances; the draws are made twice, once
    for the widths (one number a row) and once with them, and never stored.

    With ``arrays`` the score also takes numpy arrays (NaN where there is no value); it is
    null where the row's own score is.  The same draws are then made, scored and summed
    a row at a time over arrays, and only once.
    """
    d = len(features)
    fields = [F.struct(F.avg(f).alias("m"), F.coalesce(F.nullif(F.stddev_pop(f), F.lit(0.0)), F.lit(1.0)).alias("s")).alias(f) for f in features]
    stats = df.agg(F.struct(*fields).alias("t")).scalar()
    scale = 0.5 if preset == "half_std" else 1.0

    def unit(i: int, side: str) -> Column:
        # the low 31 bits, as a share of 2^31
        h = F.xxhash64(F.col(row), F.col("__d"), F.lit(f"{seed}:{i}:{side}")).bitwiseAND(F.lit((1 << 31) - 1))
        return (h + 0.5) * F.lit(2.0**-31)

    noise = {f: F.sqrt(-2.0 * F.log(unit(i, "r"))) * F.cos(2.0 * math.pi * unit(i, "a")) * scale for i, f in enumerate(features)}
    square = None
    for f in features:
        square = F.col(f"__e_{f}") ** 2 if square is None else square + F.col(f"__e_{f}") ** 2

    def draw(rows: DataFrame) -> DataFrame:
        unfolded = rows.withColumn("__d", F.explode(F.sequence(F.lit(1), F.lit(draws))))
        return unfolded.withColumns({f"__e_{f}": e for f, e in noise.items()}).withColumn("__q", square)

    if arrays:
        kept = df.where(F.col(row).isNotNull()) if preset == "half_std" else df
        record = _spread(
            kept.select(
                row, F.xxhash64(row).alias("__h"), score(current(features)).isNull().alias("__none"),
                *[F.col(f).cast("double").alias(f"__x_{f}") for f in features],
            ), row,
        ).sortWithinPartitions(row)
        record = record.withColumn("__t", stats).select(*record.columns, *[F.col(f"__t.{f}.s").alias(f"__s_{f}") for f in features])
        coefs = record.mapInArrow(
            _surrogates(list(features), score, draws, seed, scale, preset == "half_std", ridge),
            f"{row} {df.schema[row].dataType.simpleString()}, coefs array<double>",
        )
        return stack(coefs, row, _coefs(features)) if top_n is None else _top_coefs(coefs, row, features, top_n)
    base = _spread(df.select(row, *features), row)
    if preset == "half_std":
        width = draw(base).groupBy(row).agg(F.stddev_pop(F.sqrt("__q")).alias("__w"))
        base = base.join(width, row)
        w = F.sqrt(F.exp(-F.col("__q") / F.greatest(F.col("__w") ** 2, F.lit(1e-12))))
    else:
        w = F.sqrt(F.exp(-F.col("__q") / F.lit((0.75 * math.sqrt(d)) ** 2)))
    moved = {f: F.col(f) + F.col(f"__e_{f}") * F.col(f"__t.{f}.s") for f in features}
    scored = draw(base.withColumn("__t", stats)).select(
        row, *[F.col(f"__e_{f}") for f in features], score(moved).alias("__y"), w.alias("__p0")
    )
    scored = scored.withColumns({f"__p{i}": F.col("__p0") * F.col(f"__e_{f}") for i, f in enumerate(features, 1)})
    terms = [F.lit(1.0), *[F.col(f"__e_{f}") for f in features]]
    weighed = [F.col(f"__p{i}") for i in range(d + 1)]
    sums = [F.sum(p * b) for i, p in enumerate(weighed) for b in terms[i:]] + [F.sum(p * F.col("__y")) for p in weighed]
    packed = scored.groupBy(row).agg(F.array(*sums).alias("sums"))
    coefs = packed.mapInPandas(
        _solver(row, d, ridge), f"{row} {df.schema[row].dataType.simpleString()}, coefs array<double>"
    )
    long = stack(coefs, row, _coefs(features))
    return long if top_n is None else top_per_row(long, top_n, row).drop("rank")


def _coefs(features: Sequence[str]) -> dict[str, Column]:
    return {f: F.get("coefs", F.lit(i)) for i, f in enumerate(features)}


def _top_coefs(coefs: DataFrame, row: str, features: Sequence[str], n: int) -> DataFrame:
    """:func:`top_per_row` where all contributions of a row are one record: same order, no shuffle."""
    items = [
        F.struct(
            F.when(c.isNull(), 2).when(F.isnan(c), 0).otherwise(1).alias("k"), (-F.abs(c)).alias("s"),
            F.lit(f).alias("feature"), c.alias("contribution"),
        )
        for f, c in _coefs(features).items()
    ]
    top = F.slice(F.array_sort(F.array(*items)), 1, n)
    return coefs.select(row, F.inline(F.transform(top, lambda x: F.struct(x["feature"], x["contribution"]))))


def _solver(row: str, d: int, ridge: float):
    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(d + 1)
        for pdf in frames:
            if not len(pdf):
                continue
            s = np.stack(pdf["sums"].to_numpy())
            k = len(upper[0])
            a = np.zeros((len(s), d + 1, d + 1))
            a[:, upper[0], upper[1]] = s[:, :k]
            a[:, upper[1], upper[0]] = s[:, :k]
            yield pd.DataFrame({row: pdf[row], "coefs": list(_solved(a, s[:, k:], ridge))})

    return solve


def _solved(a: np.ndarray, b: np.ndarray, ridge: float) -> np.ndarray:
    """Weights without the intercept, which is not penalised."""
    penalty = np.diag([0.0] + [ridge] * (a.shape[1] - 1))
    return np.linalg.solve(a + penalty, b[:, :, None])[:, 1:, 0]


# Draws that are worked on at once: the arrays of a block stay in a core's cache.
_BLOCK_DRAWS = 16_384
# Cosine and sine in the middle of 2048 equal parts of the circle.
_TURNS = (np.arange(2048) + 0.5) * (2.0 * math.pi / 2048)
_COS, _SIN = np.cos(_TURNS), np.sin(_TURNS)


def _low31(h: np.ndarray) -> np.ndarray:
    """The low 31 bits of each hash."""
    return h.astype("<u8", copy=False).view("<u4")[..., ::2] & np.uint32((1 << 31) - 1)


def _cosine(a: np.ndarray) -> np.ndarray:
    """``cos(2 pi (a + 0.5) / 2^31)``, to the last bits: the table's angle plus one of at most 0.0016."""
    part = (a >> np.uint32(20)).astype(np.intp)
    t = (a & np.uint32((1 << 20) - 1)) - (2.0**19 - 0.5)
    t *= 2.0 * math.pi / 2.0**31
    t2 = t * t
    c = t2 / 24.0
    c -= 0.5
    c *= t2
    c += 1.0
    c *= _COS.take(part)
    t2 *= -1.0 / 6.0
    t2 += 1.0
    t *= t2
    t *= _SIN.take(part)
    c -= t
    return c


def _surrogates(features: list[str], score, draws: int, seed: int, scale: float, half: bool, ridge: float):
    """Weights per row from (row, hash of the row, whether its score is null, features, deviations), sorted by row.

    Records of one row are neighbours; their sums are added up, across batches too.
    """
    d = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0)
            h = batch.column(1).to_numpy().view(np.uint64)
            none = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            x, s = (
                np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in range(at, at + d)])
                for at in (3, 3 + d)
            )
            sums = _draw_sums(h, x, s, features, score, draws, seed, scale, half)
            sums[none, :, -1] = 0.0
            begins = _begins(keys)
            sums, some = np.add.reduceat(sums, begins), np.logical_or.reduceat(~none, begins)
            keys = keys.take(pa.array(begins))
            if held is not None:
                old, of_old, some_old = held
                if len(_begins(pa.concat_arrays([old, keys.slice(0, 1)]))) == 1:
                    sums[0] += of_old[0]
                    some[0] |= some_old[0]
                else:
                    keys = pa.concat_arrays([old, keys])
                    sums, some = np.concatenate([of_old, sums]), np.concatenate([some_old, some])
            yield solved(keys.slice(0, len(keys) - 1), sums[:-1], some[:-1])
            held = keys.slice(len(keys) - 1), sums[-1:], some[-1:]
        if held is not None:
            yield solved(*held)

    def solved(keys: pa.Array, sums: np.ndarray, some: np.ndarray) -> pa.RecordBatch:
        b = np.where(some[:, None], sums[:, :, -1], np.nan)
        beta = _solved(sums[:, :, :-1], b, ridge)
        values = pa.array(beta.ravel(), from_pandas=True)  # NaN becomes null, as in Arrow batches made of frames
        coefs = pa.ListArray.from_arrays(pa.array(np.arange(0, beta.size + 1, d, dtype=np.int32)), values)
        return pa.RecordBatch.from_arrays([keys, coefs], names=["row", "coefs"])

    return run


def _begins(keys: pa.Array) -> np.ndarray:
    """Positions at which another key begins; nulls are one key."""
    if len(keys) < 2:
        return np.arange(len(keys))
    a, b = keys.slice(0, len(keys) - 1), keys.slice(1)
    equal = pc.or_kleene(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    return np.append(0, 1 + np.flatnonzero(~equal.to_numpy(zero_copy_only=False).astype(bool)))


def _draw_sums(
    h: np.ndarray, x: np.ndarray, s: np.ndarray, features: list[str], score, draws: int, seed: int, scale: float, half: bool
) -> np.ndarray:
    """Sums of the normal equations per record: [1, e] x [1, e, y] over its weighted draws."""
    d = len(features)
    out = np.empty((len(h), d + 1, d + 2))
    step = max(1, _BLOCK_DRAWS // draws)
    number = np.arange(1, draws + 1)
    for at in range(0, len(h), step):
        of = slice(at, at + step)
        root = carried_int(number, h[of, None])
        spare = np.empty_like(root)
        e = np.empty((d + 2, *root.shape))  # 1, the noise of each feature, the score
        e[0] = 1.0
        square = None
        for i in range(d):
            r, a = (_low31(u) for u in carried_texts([f"{seed}:{i}:r", f"{seed}:{i}:a"], root, spare))
            noise = np.add(r, 0.5, out=e[i + 1])
            noise *= 2.0**-31
            np.log(noise, out=noise)
            noise *= -2.0
            np.sqrt(noise, out=noise)
            noise *= _cosine(a)
            if scale != 1.0:
                noise *= scale
            square = noise * noise if square is None else np.add(square, noise * noise, out=square)
        if half:
            wide = np.maximum(np.sqrt(square).std(axis=1, keepdims=True) ** 2, 1e-12)
        else:
            wide = (0.75 * math.sqrt(d)) ** 2
        square /= -wide
        w = np.sqrt(np.exp(square, out=square), out=square)
        e[-1] = score({f: x[of, i, None] + e[i + 1] * s[of, i, None] for i, f in enumerate(features)})
        weighed, e = (part.transpose(1, 0, 2) for part in (e[:-1] * w, e))
        # products this small stay in the task's own thread
        k = max(1, 4 * 65_536 // ((d + 1) * (d + 2)))
        out[of] = sum(weighed[:, :, j : j + k] @ e[:, :, j : j + k].transpose(0, 2, 1) for j in range(0, draws, k))
    return out


def surrogate_importance(local: DataFrame, row: str = "transaction_id") -> DataFrame:
    """(feature, importance): summed absolute weights over the number of explained rows.

    The weights are written once: both the number of rows and the sums read them.
    """
    local = settle(local.select(row, "feature", "contribution"))
    n = local.agg(F.count_distinct(row)).scalar()
    return local.groupBy("feature").agg((F.sum(F.abs("contribution")) / n).alias("importance"))


# checks on explanation tables

def merge_bins(contrib: DataFrame, row: str = "transaction_id") -> DataFrame:
    """Sum absolute contributions of ``name <= 5``-style bins by their base feature."""
    base = F.split_part("feature", F.lit(" "), F.lit(1))
    return contrib.groupBy(row, base.alias("feature")).agg(F.sum(F.abs("contribution")).alias("contribution"))


def consistency(runs: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """(feature, variance, max_variance, is_consistent) over repeated runs (run, feature, contribution)."""
    v = runs.groupBy("feature").agg(F.var_pop("contribution").alias("variance"))
    worst = v.agg(F.max("variance")).scalar()
    return v.withColumn("max_variance", worst).withColumn("is_consistent", F.col("max_variance") <= tolerance)


def explanation_quality(contrib: DataFrame, row: str = "transaction_id") -> DataFrame:
    """One row of quality figures of a contribution table."""
    c = F.col("contribution")
    bad = c.isNull() | F.isnan(c)
    infinite = c.isin(float("inf"), float("-inf"))
    per_row = contrib.groupBy(row).agg(
        F.count(F.lit(1)).alias("k"), F.count_if(bad).alias("b"), F.count_if(infinite).alias("i")
    )
    used = contrib.agg(F.count_distinct("feature")).scalar()
    out = per_row.agg(
        F.count(F.lit(1)).alias("total_explanations"), F.sum("b").alias("null_values"),
        F.sum("i").alias("infinite_values"), F.avg("k").alias("features_per_explanation"),
    )
    return out.withColumn("unique_features", used).select(
        "total_explanations", "null_values", "infinite_values", "unique_features",
        (F.col("unique_features") / F.greatest("total_explanations", F.lit(1))).alias("avg_features_per_explanation"),
        "features_per_explanation", ((F.col("null_values") == 0) & (F.col("infinite_values") == 0)).alias("passed"),
    )


def feature_coverage(contrib: DataFrame, row: str = "transaction_id") -> DataFrame:
    """(feature, coverage): share of explanations that mention the feature."""
    n = contrib.agg(F.count_distinct(row)).scalar()
    return contrib.groupBy("feature").agg((F.count_distinct(row) / n).alias("coverage"))


def rank_stability(base: DataFrame, perturbed: DataFrame, row: str = "transaction_id", stable_above: float = 0.7) -> DataFrame:
    """Overlap of top-feature sets between a baseline (row, top) and perturbed runs (row, run, top)."""
    both = perturbed.join(base.select(row, F.col("top").alias("__b")), row)
    overlap = F.size(F.array_intersect("top", "__b")) / F.greatest(F.size("top"), F.size("__b"))
    return both.select(overlap.alias("o")).agg(
        F.avg("o").alias("mean_overlap"), F.stddev_pop("o").alias("std_overlap"), F.min("o").alias("min_overlap"),
        F.count("o").alias("runs"), (F.avg("o") > stable_above).alias("is_stable"),
    )


# Two-sided 95 % quantiles of Student's t for 1 to 28 degrees of freedom, and of the normal law.
T_975 = [
    12.706204736432095, 4.302652729911275, 3.182446305284263, 2.7764451051977987, 2.5705818366147395,
    2.4469118487916806, 2.3646242510102993, 2.3060041350333704, 2.2621571627409915, 2.2281388519649385,
    2.200985160082949, 2.1788128296634177, 2.1603686564610127, 2.1447866879169273, 2.131449545559323,
    2.1199052992210112, 2.1098155778331806, 2.10092204024096, 2.093024054408263, 2.0859634472658364,
    2.079613844727662, 2.0738730679040147, 2.0686576104190406, 2.0638985616280205, 2.059538552753294,
    2.055529438642871, 2.0518305164802833, 2.048407141795244,
]
Z_975 = 1.959963984540054


def confidence_intervals(contrib: DataFrame, by: str = "feature", value: str = "contribution") -> DataFrame:
    """(by, n, mean, lower, upper, margin) at 95 %: t quantile below 30 values, normal otherwise."""
    s = contrib.groupBy(by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))
    t = F.get(F.array(*[F.lit(x) for x in T_975]), (F.col("n") - 2).cast("int"))
    quantile = F.when(F.col("n") < 30, t).otherwise(F.lit(Z_975))
    margin = quantile * F.col("sd") / F.sqrt(F.col("n").cast("double"))
    return s.select(
        by, "n", "mean", (F.col("mean") - margin).alias("lower"), (F.col("mean") + margin).alias("upper"),
        margin.alias("margin"),
    )


def timing_summary(df: DataFrame, seconds: str, target: float = 2.0) -> DataFrame:
    """Mean, median, p95, p99, min, max, std of a duration column, and whether the mean meets the target."""
    q = exact_quantiles(df, [seconds], [0.5, 0.95, 0.99])
    wide = q.agg(
        *[F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for s, n in ((0.5, "median"), (0.95, "p95"), (0.99, "p99"))]
    )
    basic = df.agg(
        F.struct(
            F.avg(seconds).alias("mean"), F.stddev_pop(seconds).alias("std"), F.min(seconds).alias("min"), F.max(seconds).alias("max")
        ).alias("b")
    ).scalar()
    return wide.withColumn("b", basic).select(
        "b.mean", "median", "p95", "p99", "b.std", "b.min", "b.max",
        (F.col("b.mean") <= target).alias("meets_target"), F.lit(float(target)).alias("target"),
    )


def model_shapley(
    df: DataFrame, background: DataFrame, features: Sequence[str], scorer: Callable[[DataFrame], DataFrame],
    draws: int = 10, row: str = "transaction_id", seed: int = 42, pool_size: int = 100,
) -> DataFrame:
    """Permutation-sampled Shapley values of a fitted model: (row, feature, contribution).

    ``scorer`` adds a ``score`` column to rows with a ``features`` array.  Each
    draw unfolds into the steps between the background row and the row itself; a
    step's score counts for the feature switched on before it and against the
    one switched on next, and these signed scores are summed before the shuffle.
    The ends of a draw are not scored again: background rows are scored once for
    all rows, and a row itself once for all its draws.

    A scorer that can list all its scores (``scorer.table(spark, points)``, as of a
    forest) is asked for them if fewer than the points to score; the same steps are
    then looked up and summed a row at a time.
    """
    d = len(features)
    names = F.array(*[F.lit(f) for f in features])
    vector = lambda cols: F.array(*[c.cast("double") for c in cols])
    pool = sample_rows(background, pool_size, row, seed).select(vector([F.col(f) for f in features]).alias("features"))
    packed = scorer(pool).agg(F.array_sort(F.collect_list(F.struct("features", "score"))).alias("p"))
    rng = random.Random(seed)
    steps = _steps([rng.sample(range(d), d) for _ in range(draws)], d)
    table = scorer.table(df.sparkSession, df.count() * len(steps)) if hasattr(scorer, "table") else None
    if table is not None and (others := packed.first()["p"]):
        record = _spread(df.select(row, F.xxhash64(row).alias("__h"), *[F.col(f).cast("double").alias(f"__x_{f}") for f in features]), row)
        sums = record.sortWithinPartitions(row).mapInArrow(
            _looked_up(table, np.array([x["features"] for x in others], dtype=float), np.array([x["score"] for x in others]), steps, draws, seed),
            f"{row} {df.schema[row].dataType.simpleString()}, sums array<double>",
        )
        return stack(sums, row, {f: F.get("sums", F.lit(i)) for i, f in enumerate(features)})
    packed = packed.scalar()
    pick = F.pmod(F.xxhash64(F.col(row), F.col("draw"), F.lit(seed)), F.size(packed)).cast("int")
    mixed = [F.when(F.get("own", F.lit(i)), F.get("__x", F.lit(i))).otherwise(F.get("__b.features", F.lit(i))) for i in range(d)]
    unfolded = (
        _spread(df.select(row, vector([F.col(f) for f in features]).alias("__x")), row)
        .select(row, "__x", F.inline(literal_rows(steps, "draw: int, first: boolean, own: array<boolean>, effects: array<struct<i: int, w: double>>")))
        .withColumn("__b", F.get(packed, pick))
        .select(row, "effects", F.when(F.col("first"), F.col("__b.score")).otherwise(F.lit(0.0)).alias("__base"), F.array(*mixed).alias("features"))
    )
    signed = scorer(unfolded).select(row, "score", "__base", F.inline("effects"))
    value = F.col("w") * F.col("score") - F.when(F.col("w") > 0, F.col("__base")).otherwise(F.lit(0.0))
    return signed.groupBy(row, "i").agg((F.sum(value) / F.lit(float(draws))).alias("contribution")).select(
        row, F.get(names, F.col("i")).alias("feature"), "contribution"
    )


def _looked_up(table, others: np.ndarray, base: np.ndarray, steps: list[dict], draws: int, seed: int):
    """Contributions per row from (row, hash of the row, features), sorted by row, by a table of all scores."""
    theirs = table.parts(others)
    d = others.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if any(c.null_count for c in batch.columns[2:]):
                raise ValueError("a feature is null")  # the trees take none either
            h = batch.column(1).to_numpy().view(np.uint64)
            own = table.parts(np.column_stack([batch.column(2 + c).to_numpy(zero_copy_only=False).astype(float) for c in range(d)]))
            picks = [carried_int(seed, carried_int(n, h)).view(np.int64) % len(others) for n in range(draws)]
            sums = np.zeros((len(h), d))
            for step in steps:
                pick = picks[step["draw"]]
                at = sum(own[:, i] if mine else theirs[pick, i] for i, mine in enumerate(step["own"]))
                score = table.scores[at]
                for effect in step["effects"]:
                    sums[:, effect["i"]] += effect["w"] * score - (base[pick] if step["first"] and effect["w"] > 0 else 0.0)
            begins = _begins(batch.column(0))
            keys, sums = batch.column(0).take(pa.array(begins)), np.add.reduceat(sums, begins)
            if held is not None:
                old, before = held
                if len(_begins(pa.concat_arrays([old, keys.slice(0, 1)]))) == 1:
                    sums[0] += before[0]
                else:
                    keys, sums = pa.concat_arrays([old, keys]), np.concatenate([before, sums])
            yield shared(keys.slice(0, len(keys) - 1), sums[:-1])
            held = keys.slice(len(keys) - 1), sums[-1:]
        if held is not None:
            yield shared(*held)

    def shared(keys: pa.Array, sums: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, d, dtype=np.int32)), pa.array(sums.ravel() / draws))
        return pa.RecordBatch.from_arrays([keys, lists], names=["row", "sums"])

    return run


def _steps(orders: list[list[int]], d: int) -> list[dict]:
    """Points to score for a row: which features are its own there, and how the score counts for each feature.

    ``first`` steps also count the background row's score against the feature they switch on.
    """
    out = []
    for draw, o in enumerate(orders):
        for s in range(1, max(d, 2)):
            effects = [{"i": o[s - 1], "w": 1.0}] + ([{"i": o[s], "w": -1.0}] if s < d else [])
            out.append({"draw": draw, "first": s == 1, "own": [i in o[:s] for i in range(d)], "effects": effects})
    if d > 1:
        ends = [{"i": i, "w": float(sum(o[-1] == i for o in orders))} for i in range(d)]
        out.append({"draw": 0, "first": False, "own": [True] * d, "effects": [e for e in ends if e["w"]]})
    return out
