"""Rolling windows per entity: velocity features, generic rolling statistics, gaps.

A window ``(t - w, t]`` is turned into two events per row: it enters at ``t`` and
leaves at ``t + w``.  Count and sum of the window are then running sums over the
event stream of a key, one addition per event, however long the window is (a
sliding frame re-adds the whole window for every row).  Running sums also split:
the stream of a heavy key is cut into time chunks, each chunk is summed on its
own, and a small table of chunk totals supplies what came before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.heavy import Heavy, chunk_of, split_heavy

# Unit -> microseconds, default windows, features and first-row gap.
UNIT_US = {"s": 1_000_000, "min": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000}
DEFAULT_WINDOWS = [(1, "h"), (24, "h"), (7, "d")]
DEFAULT_FEATURES = ["count", "sum", "mean", "time_since_last"]
NO_PREVIOUS_S = 999999.0


def require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def known(value: Column) -> Column:
    """The value, null where it is NaN or infinite."""
    return F.when(F.abs(value.cast("double")) < F.lit(float("inf")), value)


def window_us(window: tuple[int, str]) -> int:
    size, unit = window
    if unit not in UNIT_US:
        raise ValueError(f"Unknown window unit: {unit}")
    return int(size) * UNIT_US[unit]


def velocity_names(windows=DEFAULT_WINDOWS, features=DEFAULT_FEATURES) -> list[str]:
    """Output columns, window by window, in a fixed feature order."""
    order = [f for f in ("count", "sum", "mean", "std") if f in features]
    names = [f"velocity_{f}_{n}{u}" for n, u in windows for f in order]
    return names + (["velocity_time_since_last_s"] if "time_since_last" in features else [])


def _finish(func: str, n: Column, s: Column, q: Column | None, unit: int) -> Column:
    """Turn exact window totals (in units of 1/unit) into the reported statistic."""
    if func == "count":
        return n.cast("bigint")
    if func == "sum":
        return F.when(n > 0, s / F.lit(float(unit)))
    if func == "mean":
        return F.when(n > 0, s / F.lit(float(unit)) / n)
    wide = s.cast("decimal(19,0)")
    spread = (n.cast("decimal(10,0)") * q.cast("decimal(27,0)") - wide * wide).cast("double")
    return F.when(n > 1, F.sqrt(spread / (n * (n - 1)).cast("double")) / F.lit(float(unit)))


def _windowed(
    df: DataFrame, group: str, value: str, at: str, row_id: str, windows, funcs, gap: bool,
    ties: str, scale: int, rule: Heavy, chunk_us: int, keep: Sequence[str] = (),
) -> DataFrame:
    """(row_id or ``keep``, one column per (window, func), gap) for rows with a key and a time."""
    unit = 10**scale
    rows = df.where(F.col(group).isNotNull() & F.col(at).isNotNull()).select(
        F.col(row_id).alias("__id"),
        F.col(group).alias("__g"),
        F.unix_micros(F.col(at)).alias("__us"),
        F.round(known(F.col(value)) * F.lit(float(unit))).cast("bigint").alias("__v"),
        *([F.struct(*keep).alias("__keep")] if keep else []),
    )
    spans = [window_us(w) for w in windows]
    moves = [F.struct(F.col("__us").alias("at"), F.lit(-1).alias("w"))]
    moves += [F.struct((F.col("__us") + F.lit(s)).alias("at"), F.lit(i).alias("w")) for i, s in enumerate(spans)]

    carried = ["__id", *(["__keep"] if keep else [])]

    def events_of(part: DataFrame) -> DataFrame:
        # only arrivals carry the id and the kept columns
        events = part.select("__g", *carried, "__v", F.inline(F.array(*moves)))
        return events.withColumns({c: F.when(F.col("w") == -1, F.col(c)) for c in carried})

    need_std = "std" in funcs
    present = F.col("__v").isNotNull()
    square = F.col("__v").cast("decimal(19,0)") * F.col("__v").cast("decimal(19,0)")
    totals: dict[str, Column] = {}
    for i in range(len(spans)):
        sign = F.when(F.col("w") == -1, 1).when(F.col("w") == i, -1).otherwise(0)
        totals[f"n{i}"] = F.when(present, sign).otherwise(0).cast("bigint")
        totals[f"s{i}"] = F.when(present, sign * F.col("__v")).otherwise(F.lit(0)).cast("bigint")
        if need_std:
            totals[f"q{i}"] = F.when(present & (sign != 0), sign * square.cast("decimal(27,0)"))
    arrivals = F.when(F.col("w") == -1, F.col("at"))

    def windowed(events: DataFrame, keys: list[str]) -> DataFrame:
        key = Window.partitionBy(*keys)
        step = [F.col("at"), F.when(F.col("w") == -1, 1).otherwise(0), F.col("__id")]
        if ties == "row":
            upto = key.orderBy(*step).rowsBetween(Window.unboundedPreceding, 0)
        else:
            upto = key.orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
        if gap:
            # the finer order first: its sort also serves the window by time alone
            earlier = key.orderBy(*step).rowsBetween(Window.unboundedPreceding, -1)
            events = events.withColumn("prev", F.max(arrivals).over(earlier))
        return events.withColumns({n: F.sum(e).over(upto) for n, e in totals.items()}).where(F.col("w") == -1)

    names = [*totals, *(["prev"] if gap else [])]
    light, heavy = split_heavy(rows, ["__g"], rule)
    # rows are shuffled once and only then unfolded into events
    plain = windowed(events_of(light.repartition("__g")), ["__g"]).select(*carried, "at", *names)

    chunked = events_of(heavy).withColumn("__chunk", chunk_of(F.col("at"), chunk_us))
    before = Window.partitionBy("__g").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.sum(e).alias(n) for n, e in totals.items()] + ([F.max(arrivals).alias("prev")] if gap else [])
    carry = chunked.groupBy("__g", "__chunk").agg(*sums).select(
        "__g", "__chunk",
        *[F.sum(n).over(before).alias(f"c_{n}") for n in totals],
        *([F.max("prev").over(before).alias("c_prev")] if gap else []),
    )
    zero = F.lit(0)
    parts = windowed(chunked, ["__g", "__chunk"]).join(carry, ["__g", "__chunk"]).select(
        *carried, "at",
        *[(F.coalesce(F.col(n), zero) + F.coalesce(F.col(f"c_{n}"), zero)).alias(n) for n in totals],
        *([F.coalesce("prev", "c_prev").alias("prev")] if gap else []),
    )
    full = plain.unionByName(parts)

    def total(name: str) -> Column:
        return F.coalesce(F.col(name), zero)

    out = [F.col("__keep").getField(c).alias(c) for c in keep] if keep else [F.col("__id").alias(row_id)]
    for i, _ in enumerate(spans):
        for f in funcs:
            q = total(f"q{i}") if need_std else None
            out.append(_finish(f, total(f"n{i}"), total(f"s{i}"), q, unit).alias(f"__{f}_{i}"))
    if gap:
        out.append(F.coalesce((F.col("at") - F.col("prev")) / F.lit(1e6), F.lit(NO_PREVIOUS_S)).alias("__gap"))
    return full.select(*out)


def velocity(
    df: DataFrame,
    user_col: str = "user_id",
    datetime_col: str = "timestamp",
    amount_col: str = "amount",
    id_col: str = "transaction_id",
    windows: Sequence[tuple[int, str]] = tuple(DEFAULT_WINDOWS),
    features: Sequence[str] = tuple(DEFAULT_FEATURES),
    ties: str = "peers",
    scale: int = 4,
    rule: Heavy = Heavy(),
    chunk_us: int = UNIT_US["h"],
    keep: Sequence[str] = (),
) -> DataFrame:
    """(id, velocity columns) per row; with ``keep``, these columns instead of the id alone.

    Kept columns travel with their row through the windows, which saves a join of
    the table with itself.

    ``ties='peers'`` lets rows of equal time see each other; ``ties='row'`` orders
    them by id.  Amounts are summed exactly at ``scale`` decimal places; more places
    are rounded off first, so raise it where they matter.  NaN and infinite amounts
    count as missing.  Rows without user or time keep their id, with null velocity.
    """
    require(df, [user_col, datetime_col, amount_col, id_col])
    funcs = [f for f in ("count", "sum", "mean", "std") if f in features]
    gap = "time_since_last" in features
    done = _windowed(df, user_col, amount_col, datetime_col, id_col, windows, funcs, gap, ties, scale, rule, chunk_us, keep)
    renamed = done.select(
        *(keep or [id_col]),
        *[
            F.col(f"__{f}_{i}").alias(f"velocity_{f}_{n}{u}")
            for i, (n, u) in enumerate(windows)
            for f in funcs
        ],
        *([F.col("__gap").alias("velocity_time_since_last_s")] if gap else []),
    )
    return renamed.unionByName(_bare(df, user_col, datetime_col, *(keep or [id_col])), allowMissingColumns=True)


def _bare(df: DataFrame, key_col: str, datetime_col: str, *columns: str) -> DataFrame:
    """The given columns of the rows that no window can hold."""
    return df.where(F.col(key_col).isNull() | F.col(datetime_col).isNull()).select(*columns)


def rolling_stats(
    df: DataFrame,
    group_col: str,
    value_col: str,
    datetime_col: str,
    id_col: str,
    windows: Sequence[tuple[int, str]],
    agg_funcs: Sequence[str] = ("count", "sum", "mean"),
    ties: str = "peers",
    scale: int = 4,
    rule: Heavy = Heavy(),
    chunk_us: int = UNIT_US["h"],
    pieces: int = 24,
) -> DataFrame:
    """Generic rolling count/sum/mean/std/max/min: (id, ``{group}_{value}_{f}_{n}{u}``).

    Rows without key or time keep their id, with nulls.  Values as in ``velocity``.
    """
    require(df, [group_col, value_col, datetime_col, id_col])
    sums = [f for f in ("count", "sum", "mean", "std") if f in agg_funcs]
    out = df.select(id_col)
    if sums:
        done = _windowed(
            df, group_col, value_col, datetime_col, id_col, windows, sums, False, ties, scale, rule, chunk_us
        )
        out = done.unionByName(_bare(df, group_col, datetime_col, id_col), allowMissingColumns=True)
    extremes = [f for f in ("max", "min") if f in agg_funcs]
    for i, w in enumerate(windows if extremes else []):
        part = rolling_extremes(df, group_col, value_col, datetime_col, id_col, window_us(w), extremes, pieces)
        out = out.join(part.withColumnsRenamed({f: f"__{f}_{i}" for f in extremes}), id_col, "left")
    return out.select(
        id_col,
        *[
            F.col(f"__{f}_{i}").alias(f"{group_col}_{value_col}_{f}_{n}{u}")
            for i, (n, u) in enumerate(windows)
            for f in agg_funcs
        ],
    )


def rolling_extremes(
    df: DataFrame, group_col: str, value_col: str, datetime_col: str, id_col: str,
    span_us: int, funcs: Sequence[str] = ("max", "min"), pieces: int = 24,
) -> DataFrame:
    """(id, max, min) over ``(t - w, t]`` with peers, from three parts.

    Time is cut into slices of ``w / pieces``.  A window is the end of its first
    slice, some whole slices, and the start of its last one: a running extreme
    backwards, a frame over slice extremes, and a running extreme forwards.  No
    task sees more than one slice of one key.
    """
    # slices of a minute or more, so that a key has few of them
    pieces = max(1, min(pieces, span_us // UNIT_US["min"]))
    while span_us % pieces:
        pieces -= 1
    width = span_us // pieces
    best = {"max": F.max, "min": F.min}
    pick = {"max": F.greatest, "min": F.least}
    rows = df.where(F.col(group_col).isNotNull() & F.col(datetime_col).isNotNull()).select(
        F.col(id_col).alias("__id"),
        F.col(group_col).alias("__g"),
        F.unix_micros(F.col(datetime_col)).alias("at"),
        known(F.col(value_col)).alias("__v"),
    )
    # a probe stands at t - w, in the first slice of the window of its row
    moves = F.array(
        F.struct(F.col("at").alias("at"), F.lit(False).alias("__probe")),
        F.struct((F.col("at") - F.lit(span_us)).alias("at"), F.lit(True).alias("__probe")),
    )
    both = rows.select("__id", "__g", "__v", F.inline(moves)).withColumn("__slot", F.floor(F.col("at") / F.lit(width)))
    key = Window.partitionBy("__g", "__slot")
    forward = key.orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    backward = key.orderBy(F.col("at").desc()).rangeBetween(Window.unboundedPreceding, -1)
    value = F.when(~F.col("__probe"), F.col("__v"))
    marked = both.withColumns(
        {f"__head_{f}": best[f](value).over(forward) for f in funcs} | {f"__tail_{f}": best[f](value).over(backward) for f in funcs}
    )
    head = marked.where(~F.col("__probe")).select("__id", "__g", "__slot", *[f"__head_{f}" for f in funcs])
    tail = marked.where(F.col("__probe")).select("__id", *[f"__tail_{f}" for f in funcs])

    slot = F.floor(F.col("at") / F.lit(width)).alias("__slot")
    slices = rows.groupBy("__g", slot).agg(*[best[f]("__v").alias(f"__whole_{f}") for f in funcs])
    between = Window.partitionBy("__g").orderBy("__slot").rangeBetween(-(pieces - 1), -1)
    middle = slices.select(
        "__g", "__slot",
        *[
            (best[f](f"__whole_{f}").over(between) if pieces > 1 else F.lit(None).cast("double")).alias(f"__middle_{f}")
            for f in funcs
        ],
    )
    return (
        head.join(middle, ["__g", "__slot"])
        .join(tail, "__id")
        .select(
            F.col("__id").alias(id_col),
            *[pick[f](f"__head_{f}", f"__middle_{f}", f"__tail_{f}").alias(f) for f in funcs],
        )
    )


def gaps(df: DataFrame, key_col: str, datetime_col: str, id_col: str, rule: Heavy = Heavy()) -> DataFrame:
    """Seconds since the key's previous row, null for its first and for rows without key or time: (id, gap_s)."""
    require(df, [key_col, datetime_col, id_col])
    done = _windowed(
        df.withColumn("__one", F.lit(0.0)), key_col, "__one", datetime_col, id_col, [], [], True, "row", 0,
        rule, UNIT_US["h"],
    )
    out = done.select(id_col, F.when(F.col("__gap") != NO_PREVIOUS_S, F.col("__gap")).alias("gap_s"))
    return out.unionByName(_bare(df, key_col, datetime_col, id_col), allowMissingColumns=True)


def global_gaps(df: DataFrame, datetime_col: str, id_col: str) -> DataFrame:
    """Seconds since the previous row of the whole table, without one sorting task.

    Rows are ranked with split running totals; consecutive ranks then meet in an
    equi-join.
    """
    from tallyward.operators.ordering import ordinals

    rows = df.select(id_col, F.unix_micros(datetime_col).alias("__us"))
    ranked = ordinals(rows, "__us", id_col)
    nxt = ranked.select((F.col("ordinal") + 1).alias("ordinal"), F.col("__us").alias("__before"))
    return ranked.join(nxt, "ordinal", "left").select(
        id_col, ((F.col("__us") - F.col("__before")) / F.lit(1e6)).alias("gap_s")
    )
