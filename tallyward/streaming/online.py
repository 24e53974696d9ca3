"""Online operators: rate limits, repeat suppression, rolling features, sequence buffers, alerts.

Stateful operators keep their state in RocksDB, so a restarted or lost executor
resumes from the last commit.  Keys with little state share it in hash buckets, so a key
with few rows costs no call of its own.  The work of one bucket in one micro-batch runs in one
task; the trigger (``maxFilesPerTrigger`` and the like) bounds how much that is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyward.functions import scoring as S
from tallyward.operators.explain import top_factors
from tallyward.operators.heavy import Heavy, heavy_keys
from tallyward.operators.velocity import DEFAULT_WINDOWS, NO_PREVIOUS_S, window_us
from tallyward.session import fresh_path, settle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Request limit per window, window length, repeat time-to-live.
MAX_REQUESTS = 100
WINDOW_SECONDS = 60
TTL_SECONDS = 300
# Hash buckets that keys share their state in.
BUCKETS = 1024


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything available, write it to the shared folder, read the result."""
    spark = stream.sparkSession
    use_rocksdb(spark)
    path, marks = fresh_path(spark, name), fresh_path(spark, f"{name}-marks")
    q = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", marks)
        .outputMode(mode).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _gather(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    parts = list(rows)
    pdf = parts[0] if len(parts) == 1 else pd.concat(parts)
    return pdf if len(pdf) == 1 else pdf.sort_values(list(order), kind="stable")


def _expire_at(state: GroupState, ms: int) -> None:
    """Drop the state once the watermark passes ``ms``."""
    state.setTimeoutTimestamp(max(int(ms), state.getCurrentWatermarkMs() + 1))


def _id_field(rows: DataFrame) -> str:
    """The id column as a schema field; ids keep their type."""
    return "id " + rows.schema["id"].dataType.simpleString()


def _text(key) -> str | None:
    """A key as text; a null key stays null."""
    return None if key is None or key != key else str(key)


# K1: fixed-window limit

def window_start(ts: Column, seconds: int) -> Column:
    """Start of the aligned window, in seconds since the epoch."""
    return (F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)) * F.lit(seconds)).cast("bigint")


def _bucket() -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int")


def _limit(limit: int, seconds: int):
    slot = ["key", "window_start"]

    def verdicts(bucket, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names = [*slot, "used"]
        held = pd.DataFrame(dict(zip(names, map(list, state.get))) if state.exists else {n: [] for n in names})
        held = held.astype({"key": object, "window_start": "int64", "used": "int64"})
        if not state.hasTimedOut:
            pdf = _gather(rows, ["us", "id"]).astype({"key": object})
            used = pdf[slot].merge(held, "left", on=slot)["used"].fillna(0).to_numpy(dtype="int64")
            rank = used + pdf.groupby(slot, dropna=False, sort=False).cumcount().to_numpy() + 1
            now = pdf[slot].assign(used=np.minimum(limit, rank))
            held = pd.concat([held, now]) if len(held) else now
            held = held.groupby(slot, dropna=False, sort=False, as_index=False)["used"].max()
            yield pd.DataFrame(
                {
                    "id": pdf["id"].to_numpy(), "key": [_text(k) for k in pdf["key"]],
                    "window_start": pdf["window_start"].to_numpy(), "allowed": rank <= limit,
                    "remaining": np.maximum(0, limit - rank).astype("int64"),
                    "reset_at": pdf["window_start"].to_numpy() + seconds,
                }
            )
        ends = (held["window_start"].to_numpy(dtype="int64") + seconds) * 1000
        _keep(state, held, ends, names)

    return verdicts


def _keep(state: GroupState, held: pd.DataFrame, ends: np.ndarray, names: Sequence[str]) -> None:
    """Store the entries that end after the watermark, and come back when the first of them ends."""
    open_ = ends > state.getCurrentWatermarkMs()
    if not open_.any():
        state.remove()
        return
    kept = held[open_]
    state.update(tuple([_text(x) for x in kept[n]] if n == "key" else kept[n].astype("int64").tolist() for n in names))
    _expire_at(state, ends[open_].min())


LIMIT_OUT = "key string, window_start bigint, allowed boolean, remaining bigint, reset_at bigint"


def rate_limit_stream(
    stream: DataFrame, key_col: str, datetime_col: str, id_col: str,
    limit: int = MAX_REQUESTS, seconds: int = WINDOW_SECONDS, delay: str = "1 hour",
) -> DataFrame:
    """Verdict per event: the first ``limit`` events of a key in an aligned window pass.

    State is kept by key and window, and each entry is dropped once the watermark
    passes its end.
    """
    rows = stream.withWatermark(datetime_col, delay).select(
        F.col(key_col).cast("string").alias("key"), window_start(F.col(datetime_col), seconds).alias("window_start"),
        F.unix_micros(datetime_col).alias("us"), F.col(id_col).alias("id"), F.col(datetime_col),
    )
    return rows.withColumn("bucket", _bucket()).groupBy("bucket").applyInPandasWithState(
        _limit(limit, seconds), f"{_id_field(rows)}, {LIMIT_OUT}", "key array<string>, window_start array<bigint>, used array<bigint>",
        "append", GroupStateTimeout.EventTimeTimeout,
    )


def rate_limit_batch(
    df: DataFrame, key_col: str, datetime_col: str, id_col: str, limit: int = MAX_REQUESTS, seconds: int = WINDOW_SECONDS
) -> DataFrame:
    """The same verdicts for a finished table."""
    rows = df.select(
        F.col(id_col).alias("id"), F.col(key_col).cast("string").alias("key"),
        window_start(F.col(datetime_col), seconds).alias("window_start"), F.unix_micros(datetime_col).alias("us"),
    )
    w = Window.partitionBy("key", "window_start").orderBy("us", "id")
    rank = F.row_number().over(w)
    return rows.withColumn("__r", rank).select(
        "id", "key", "window_start", (F.col("__r") <= limit).alias("allowed"),
        F.greatest(F.lit(0), F.lit(limit) - F.col("__r")).cast("bigint").alias("remaining"),
        (F.col("window_start") + seconds).alias("reset_at"),
    )


def window_counts(df: DataFrame, key_col: str, datetime_col: str, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Requests per key and window of a finished table."""
    return (
        df.groupBy(F.col(key_col).alias("key"), window_start(F.col(datetime_col), seconds).alias("window_start"))
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def window_counts_stream(stream: DataFrame, key_col: str, datetime_col: str, seconds: int = WINDOW_SECONDS, delay: str = "1 hour") -> DataFrame:
    """Requests per key and window, emitted when the watermark closes the window.

    A file sink appends, so windows still open when a source ends are not emitted.
    """
    return (
        stream.withWatermark(datetime_col, delay)
        .groupBy(F.col(key_col).alias("key"), F.window(datetime_col, f"{seconds} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .select("key", F.unix_seconds("w.start").alias("window_start"), "requests")
    )


# K2: suppress repeats inside the time to live

def _repeats(ttl_us: int):
    def marks(bucket, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = dict(zip(*state.get)) if state.exists else {}
        if not state.hasTimedOut:
            pdf = _gather(rows, ["us", "id"])
            keys, us = [_text(k) for k in pdf["key"]], pdf["us"].to_numpy()
            computed = np.zeros(len(us), dtype=bool)
            places: dict[str | None, list[int]] = {}
            for i, k in enumerate(keys):
                places.setdefault(k, []).append(i)
            for k, at in places.items():
                computed[at], newest = fresh_marks(us[at], last.get(k), ttl_us)
                last[k] = int(newest)
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "key": keys, "us": us, "computed": computed})
        held = pd.DataFrame({"key": list(last), "last": list(last.values())}, dtype=object)
        ends = np.array([t // 1000 + ttl_us // 1000 + 1 for t in last.values()], dtype="int64")
        _keep(state, held, ends, ["key", "last"])

    return marks


def fresh_marks(us: np.ndarray, last: int | None, ttl_us: int) -> tuple[np.ndarray, int]:
    """Which sorted times are computed anew: the first, and each at least the TTL after the last computed one."""
    keep = np.zeros(len(us), dtype=bool)
    i = 0 if last is None else int(np.searchsorted(us, last + ttl_us))
    while i < len(us):
        keep[i], last = True, int(us[i])
        i = max(i + 1, int(np.searchsorted(us, last + ttl_us)))
    return keep, last


def suppress_repeats_stream(
    stream: DataFrame, key_col: str, datetime_col: str, id_col: str, ttl_seconds: int = TTL_SECONDS, delay: str = "1 hour"
) -> DataFrame:
    """(id, key, us, computed): false where an answer not older than the TTL would be served again."""
    rows = stream.withWatermark(datetime_col, delay).select(
        F.col(key_col).cast("string").alias("key"), F.unix_micros(datetime_col).alias("us"),
        F.col(id_col).alias("id"), F.col(datetime_col),
    )
    return rows.withColumn("bucket", _bucket()).groupBy("bucket").applyInPandasWithState(
        _repeats(ttl_seconds * 1_000_000), f"{_id_field(rows)}, key string, us bigint, computed boolean", "key array<string>, last array<bigint>",
        "append", GroupStateTimeout.EventTimeTimeout,
    )


def suppress_repeats_batch(
    df: DataFrame, key_col: str, datetime_col: str, id_col: str, ttl_seconds: int = TTL_SECONDS, rule: Heavy = Heavy(),
) -> DataFrame:
    """The same marks for a finished table.

    An ordinary key is walked in one pass over its sorted rows, which are
    streamed, not held.  A heavy key is a chain in which each
    computed event points to the first event at least a TTL later; the chain is
    followed with pointer doubling, a logarithmic number of equi-joins.
    """
    ttl = ttl_seconds * 1_000_000
    rows = df.select(
        F.col(id_col).alias("id"), F.col(key_col).cast("string").alias("key"),
        F.unix_micros(datetime_col).alias("us"),
    )
    heavy = settle(heavy_keys(rows, ["key"], rule))
    light = rows.join(F.broadcast(heavy), "key", "left_anti").select("id", "key", "us")
    ordered = light.repartition("key").sortWithinPartitions("key", "us", "id")
    out = ordered.select("id", "key", "us").mapInArrow(_walk(ttl), f"{_id_field(rows)}, key string, us bigint, computed boolean")
    if heavy.isEmpty():
        return out
    busy = rows.join(F.broadcast(heavy), "key")
    times = settle(busy.groupBy("key", "us").agg(F.min("id").alias("first_id")))
    marks = _follow_chain(times.select("key", "us"), ttl).withColumn("__hit", F.lit(True))
    done = busy.join(times.join(marks, ["key", "us"], "left"), ["key", "us"]).select(
        "id", "key", "us", (F.coalesce("__hit", F.lit(False)) & (F.col("id") == F.col("first_id"))).alias("computed")
    )
    return out.unionByName(done)


def _walk(ttl: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last = None, None
        for b in batches:
            keys = np.array(b.column("key").to_pylist(), dtype=object)
            timed = ~np.array(b.column("us").is_null())
            us = b.column("us").fill_null(0).to_numpy(zero_copy_only=False)
            marks = np.ones(len(keys), dtype=bool)  # without a time nothing is known to be recent
            starts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else []
            for first, stop in zip(starts, starts[1:], strict=False):
                last = last if keys[first] == key else None
                key = keys[first]
                here = np.flatnonzero(timed[first:stop]) + first
                marks[here], last = fresh_marks(us[here], last, ttl)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(marks)], names=["id", "key", "us", "computed"])

    return run


def _follow_chain(times: DataFrame, ttl: int) -> DataFrame:
    """(key, us) of the events on the chain that starts at each key's first event."""
    # the first event at or after us + ttl: look back from the slice ends, then to later slices
    width = max(ttl, 1)
    slot = F.floor(F.col("at") / F.lit(width))
    points = times.select("key", F.col("us").alias("at"), F.lit(None).cast("bigint").alias("source")).unionByName(
        times.select("key", (F.col("us") + ttl).alias("at"), F.col("us").alias("source"))
    ).withColumn("slot", slot)
    later = Window.partitionBy("key", "slot").orderBy(F.col("at").desc()).rangeBetween(Window.unboundedPreceding, 0)
    event = F.when(F.col("source").isNull(), F.col("at"))
    inside = points.withColumn("hit", F.min(event).over(later)).where(F.col("source").isNotNull())
    firsts = points.groupBy("key", "slot").agg(F.min(event).alias("lo"))
    after = Window.partitionBy("key").orderBy(F.col("slot").desc()).rowsBetween(Window.unboundedPreceding, -1)
    nexts = firsts.withColumn("next_lo", F.min("lo").over(after)).select("key", "slot", "next_lo")
    jump = inside.join(nexts, ["key", "slot"]).select(
        "key", F.col("source").alias("us"), F.coalesce("hit", "next_lo").alias("to")
    ).where(F.col("to").isNotNull())
    levels = [settle(jump)]
    while True:
        a = levels[-1]
        twice = settle(
            a.join(a.select("key", F.col("us").alias("to"), F.col("to").alias("then")), ["key", "to"]).select(
                "key", "us", F.col("then").alias("to")
            )
        )
        if twice.isEmpty():
            break
        levels.append(twice)
    reached = times.groupBy("key").agg(F.min("us").alias("us"))
    for step in reversed(levels):
        reached = settle(reached.unionByName(reached.join(step, ["key", "us"]).select("key", F.col("to").alias("us"))))
    return reached


def drop_repeated_keys(stream: DataFrame, key_col: str, datetime_col: str, ttl_seconds: int = TTL_SECONDS) -> DataFrame:
    """Keep the first event per key within the watermark delay (Spark's own deduplication)."""
    return stream.withWatermark(datetime_col, f"{ttl_seconds} seconds").dropDuplicatesWithinWatermark([key_col])


# K3: velocity on arrival

SLICE_US = 3_600_000_000


def _velocity(spans: Sequence[int], unit: int):
    """State per user: the sorted rows that a window may still reach, in whole slices, and the newest slice.

    A window is the difference of two running totals, found by binary search.
    """

    def features(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            return
        pdf = _gather(rows, ["us", "id"])
        us, amount = pdf["us"].to_numpy(), pdf["amount"].to_numpy(dtype=float)
        # Missing, NaN and infinite amounts count for the gap, not for the window.
        counted = np.isfinite(amount)
        v = np.round(np.where(counted, amount, 0.0) * unit).astype("int64")
        held = [np.asarray(x, dtype="int64") for x in state.get] if state.exists else [np.zeros(0, "int64")] * 3
        # the latest time not after a row, of those known before it
        seen = np.searchsorted(held[0], us, side="right")
        none = np.iinfo("int64").min
        previous = np.append(held[0], none)[seen - 1]
        previous[seen == 0] = none
        previous[1:] = np.maximum(previous[1:], us[:-1])

        times, values, counts = (np.concatenate(x) for x in zip(held, (us, v, counted.astype("int64"))))
        order = np.argsort(times, kind="stable")
        times, values, counts = times[order], values[order], counts[order]
        total, number = (np.concatenate([[0], np.cumsum(x)]) for x in (values, counts))
        upto = np.searchsorted(times, us, side="right")
        out = {"id": pdf["id"].to_numpy(), "user": [key[0]] * len(us)}
        for j, span in enumerate(spans):
            start = np.searchsorted(times, us - span, side="right")
            out[f"n{j}"], out[f"s{j}"] = number[upto] - number[start], total[upto] - total[start]
        out["gap"] = np.where(previous == none, NO_PREVIOUS_S, (us - np.where(previous == none, us, previous)) / 1e6)

        # slices older than the longest window, counted from the watermark, are never read again
        horizon = (state.getCurrentWatermarkMs() * 1000 - max(spans)) // SLICE_US
        kept = times // SLICE_US >= min(horizon, times[-1] // SLICE_US)
        state.update((times[kept].tolist(), values[kept].tolist(), counts[kept].tolist()))
        yield pd.DataFrame(out)

    return features


def velocity_stream(
    stream: DataFrame, user_col: str = "user_id", datetime_col: str = "timestamp", amount_col: str = "amount",
    id_col: str = "transaction_id", windows: Sequence[tuple[int, str]] = tuple(DEFAULT_WINDOWS), scale: int = 4,
    delay: str = "1 hour",
) -> DataFrame:
    """Count, sum and mean per window and the gap, emitted when a transaction arrives.

    Equals the batch operator (equal times as peers within a micro-batch) for
    events that arrive in time order; events behind the watermark are dropped.
    """
    rows = stream.withWatermark(datetime_col, delay).select(
        F.col(user_col).alias("user"), F.unix_micros(datetime_col).alias("us"), F.col(amount_col).alias("amount"),
        F.col(id_col).alias("id"), F.col(datetime_col),
    )
    unit = 10**scale
    spans = [window_us(w) for w in windows]
    kind = rows.schema["user"].dataType.simpleString()
    schema = f"{_id_field(rows)}, user {kind}, " + ", ".join(f"n{j} bigint, s{j} bigint" for j in range(len(spans))) + ", gap double"
    done = rows.groupBy("user").applyInPandasWithState(
        _velocity(spans, unit), schema, "us array<bigint>, v array<bigint>, c array<bigint>", "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    cols = [F.col("id").alias(id_col)]
    for j, (n, u) in enumerate(windows):
        total = F.when(F.col(f"n{j}") > 0, F.col(f"s{j}") / F.lit(float(unit)))
        cols += [
            F.col(f"n{j}").alias(f"velocity_count_{n}{u}"), total.alias(f"velocity_sum_{n}{u}"),
            (total / F.col(f"n{j}")).alias(f"velocity_mean_{n}{u}"),
        ]
    return done.select(*cols, F.col("gap").alias("velocity_time_since_last_s"))


# K4: last rows per user

class _Buffer(StatefulProcessor):
    def __init__(self, length: int, minimum: int, width: int):
        self.length, self.minimum, self.width = length, minimum, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.steps = handle.getValueState("steps", "steps array<array<double>>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _gather(rows, ["us", "id"])
        held = [list(s) for s in self.steps.get()[0]] if self.steps.exists() else []
        start = len(held)
        line = held + [list(s) for s in pdf["step"]]
        out = []
        for i, row_id in enumerate(pdf["id"]):
            seq = line[max(0, start + i + 1 - self.length) : start + i + 1]
            if len(seq) >= self.minimum:
                pad = [[0.0] * self.width] * (self.length - len(seq))
                out.append((row_id, key[0], len(seq), pad + seq))
        self.steps.update((line[-self.length :],))
        yield pd.DataFrame(out, columns=["id", "user", "length", "sequence"])

    def close(self) -> None:
        pass


def sequence_stream(
    stream: DataFrame, length: int, features: Sequence[str], minimum: int = 3, user_col: str = "user_id",
    datetime_col: str = "timestamp", id_col: str = "transaction_id",
) -> DataFrame:
    """The padded sequence that ends in each arriving transaction: (id, user, length, sequence)."""
    rows = stream.select(
        F.col(user_col).alias("user"), F.unix_micros(datetime_col).alias("us"), F.col(id_col).alias("id"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("step"),
    )
    kind = rows.schema["user"].dataType.simpleString()
    done = rows.groupBy("user").transformWithStateInPandas(
        _Buffer(length, minimum, len(features)),
        outputStructType=f"{_id_field(rows)}, user {kind}, length int, sequence array<array<double>>",
        outputMode="Append", timeMode="None",
    )
    return done.select(F.col("id").alias(id_col), F.col("user").alias(user_col), "length", "sequence")


# K5: scoring to an alert sink

def score_rows(df: DataFrame, id_col: str = "transaction_id") -> DataFrame:
    """Rule score, tier, decision, reasons and top factors; works on streams and tables alike."""
    p = S.clamp_probability(S.rule_score())
    return df.select(
        id_col, p.alias("fraud_probability"), S.decision(p).alias("prediction"), S.risk_tier(p).alias("risk_tier"),
        F.concat_ws("|", S.reasons()).alias("reasons"), F.concat_ws("|", top_factors(3)).alias("top_factors"),
    )
