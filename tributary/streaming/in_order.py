"""Per-key histories on streams, in the order of event time.

Rows wait in state until the watermark has passed them and are then taken in
order of time, so results do not depend on how they arrived: they equal those
of the table forms in :mod:`tributary.operators.keyed` for all rows up to the
watermark.  Keys are dealt into ``buckets``; a bucket is one grouping key of
the state operator, and everything that is due in it is computed at once, for
all of its keys, on arrays.  State is a list of waiting pieces, a value
with what is kept of earlier rows, both as Arrow streams, and a value with the time of the bucket's
only timer.  Timers release waiting rows, close limiter windows and cool-downs,
and forget keys: a key whose history can no longer matter is dropped, and
``idle_seconds`` drops those that count rows, whose answers it would change.
Once every timer has fired such a bucket has no state.

A task holds one bucket at a time, so the more rows there are, the more buckets
there should be (:func:`buckets_for`).  ``buckets`` is fixed for the life of a checkpoint.  Rows without a time are
left out; rows later than the watermark are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tributary.operators.keyed import ADVICE
from tributary.session import ship_package

BUCKETS = 64
BUCKET_ROWS = 10_000  # of a whole table, however they are spread over time
LARGE = 1 << 16  # bytes from which a piece of state is compressed
BLOCK_ROWS = 4_096
Arrays = dict[str, np.ndarray]
NEVER = np.iinfo(np.int64).max

_ARRAY_OF = {"bigint": "int64", "double": "float64", "string": object}
_ARROW_OF = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "array<double>": pa.list_(pa.float64())}


def buckets_for(rows: int, least: int) -> int:
    """Buckets for a table of ``rows``, so that what is held of one at a time does not grow with the table."""
    return max(least, -(-rows // BUCKET_ROWS))


def packed(values: dict, columns: dict[str, str]) -> tuple[bytes]:
    """Columns as the bytes of an Arrow stream; every different string is in it once, and a large one is compressed."""
    arrays = [pa.array(values[c], _ARROW_OF[k], from_pandas=False) for c, k in columns.items()]
    batch = pa.RecordBatch.from_arrays([a.dictionary_encode() if k == "string" else a for a, k in zip(arrays, columns.values())], list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd" if batch.nbytes > LARGE else None)) as out:
        out.write_batch(batch)
    return (sink.getvalue().to_pybytes(),)


def unpacked(pieces: Sequence[tuple[bytes]], columns: dict[str, str]) -> dict:
    """The columns of packed pieces, one after the other; numbers without nulls and strings as arrays, others as lists."""
    batches = [batch for (data,) in pieces for batch in pa.ipc.open_stream(data)]
    out = {}
    for i, (c, k) in enumerate(columns.items()):
        parts = [b.column(i) for b in batches]
        if k == "string":
            words: dict[str, str] = {}  # one object for every different string
            own = [np.array([words.setdefault(w, w) for w in p.dictionary.to_pylist()], dtype=object) for p in parts]
            arrays = [w[p.indices.to_numpy()] for w, p in zip(own, parts)]
        elif k in _ARRAY_OF and not any(p.null_count for p in parts):
            arrays = [p.to_numpy() for p in parts]
        else:
            out[c] = [v for p in parts for v in p.to_pylist()]
            continue
        out[c] = np.concatenate([np.zeros(0, dtype=_ARRAY_OF[k]), *arrays])
    return out


class InOrder(StatefulProcessor):
    """Holds rows until the watermark has passed them; see the module.

    ``step(rows, held, watermark)`` gets the due rows as arrays, sorted by key,
    time and id, what was kept (lists by name) and the watermark, all times in
    microseconds.  It returns output arrays, what to keep, and the time at
    which some of that can be dropped (NEVER if none can).
    """

    def __init__(self, columns: dict[str, str], held: dict[str, str], step: Callable):
        self.columns, self.kept_columns, self.step = columns, held, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.kept = handle.getValueState("kept", "rows binary")
        self.due = handle.getValueState("due", "ms bigint")

    def wake(self, us: int) -> None:
        """Have the bucket's only timer fire once the watermark reaches this time, if it would fire later."""
        ms = -(-us // 1000)
        if self.due.exists():
            (set_for,) = self.due.get()
            if set_for <= ms:
                return
            self.handle.deleteTimer(set_for)
        self.handle.registerTimer(ms)
        self.due.update((ms,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = NEVER
        for frame in rows:
            self.waiting.appendValue(packed({c: frame[c].to_numpy() for c in self.columns}, self.columns))
            first = min(first, int(frame["us"].min()))
        if first < NEVER:
            self.wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        self.due.clear()
        rows = unpacked(list(self.waiting.get()) if self.waiting.exists() else [], self.columns)
        waited = len(rows["us"])
        ready = rows["us"] <= watermark
        later = {c: v[~ready] for c, v in rows.items()}
        rows = {c: v[ready] for c, v in rows.items()}
        order = np.lexsort((rows["id"], rows["us"], pd.factorize(rows["k"], sort=True)[0]))
        rows = {c: v[order] for c, v in rows.items()}
        held = unpacked([self.kept.get()] if self.kept.exists() else [], self.kept_columns)
        out, keep, expiry = self.step(rows, held, watermark)
        if len(later["us"]) < waited:
            self.waiting.clear()
            if len(later["us"]):
                self.waiting.appendValue(packed(later, self.columns))
        if len(next(iter(keep.values()))):
            self.kept.update(packed(keep, self.kept_columns))
        else:
            self.kept.clear()
        following = min([expiry, *later["us"].tolist()])
        if following < NEVER:
            self.wake(max(following, watermark + 1))
        size = len(next(iter(out.values()))) if out else 0
        if size:
            yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def plain(values, kind: str) -> list:
    values = values.tolist() if isinstance(values, np.ndarray) else list(values)
    return [None if v is None or v != v else v for v in values] if kind == "double" else values


def released(df: DataFrame, keys: Sequence[str], time: str, delay: str, columns: dict[str, str], held: dict[str, str], step: Callable, output: str, buckets: int) -> DataFrame:
    """``step`` over the rows of ``df`` in order; the output gets the columns of the key in place of ``k``."""
    ship_package(df.sparkSession)
    key = F.to_json(F.struct(*keys))
    rows = df.withWatermark(time, delay).where(F.col(time).isNotNull()).select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"), time, key.alias("k"), F.unix_micros(time).alias("us"), *[F.col(s).cast(k).alias(c) for c, s, k in columns_of(columns)])
    typed = {"k": "string", "us": "bigint", **{c: k for c, _, k in columns_of(columns)}}
    out = rows.groupBy("bucket").transformWithStateInPandas(InOrder(typed, held, step), f"k string, {output}", "append", "eventTime")
    kinds = StructType([df.schema[k] for k in keys])
    return out.withColumn("__key", F.from_json("k", kinds)).drop("k").select("__key.*", *[c for c in out.columns if c != "k"])


def columns_of(columns: dict[str, str]) -> list[tuple[str, str, str]]:
    """(name inside, column of the stream, kind): ids are whole numbers and values doubles."""
    return [(c, s, "bigint" if c == "id" else "double") for c, s in columns.items()]


# rows kept as they are


def runs(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and end of the run of equal keys that every row is in."""
    if not len(k):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    lengths = np.diff(np.append(starts, len(k)))
    return np.repeat(starts, lengths), np.repeat(starts + lengths, lengths)


def with_tail(rows: Arrays, held: Arrays, names: Sequence[str]) -> tuple[Arrays, np.ndarray]:
    """Kept and due rows together, sorted by key, time and id, and which of them are new.

    Kept rows are no later than due ones, so a stable sort by key keeps their order.
    """
    both = {c: np.concatenate([np.array(held[c], dtype=_ARRAY_OF[TAIL[c]]), rows[c]]) for c in names}
    new = np.concatenate([np.zeros(len(held["k"]), dtype=bool), np.ones(len(rows["k"]), dtype=bool)])
    code, _ = pd.factorize(both["k"], sort=True)
    order = np.argsort(code, kind="stable")
    return {c: v[order] for c, v in both.items()} | {"code": code[order]}, new[order]


def last_rows(code: np.ndarray, n: int) -> np.ndarray:
    _, end = runs(code)
    return np.arange(len(code)) >= end - n


def newest(both: Arrays) -> np.ndarray:
    _, end = runs(both["code"])
    return both["us"][end - 1] if len(end) else end


def expire(keep: Arrays, watermark: int, idle_seconds: float | None) -> tuple[Arrays, int]:
    """Without keys whose newest row is ``idle_seconds`` behind the watermark, and when the next one will be."""
    if idle_seconds is None or not len(keep["k"]):
        return keep, NEVER
    age = round(idle_seconds * 1_000_000)
    last = newest(keep)
    live = last + age > watermark
    return {c: v[live] for c, v in keep.items()}, int((last[live] + age).min()) if live.any() else NEVER


def trailing_means(both: Arrays, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of the last ``n`` values of each row's key, nulls left out, and which rows have ``n``."""
    start, _ = runs(both["code"])
    x, place = both["x"], np.arange(len(start))
    known = ~np.isnan(x)
    total, count = np.zeros(len(x)), np.zeros(len(x), dtype=np.int64)
    for back in range(min(n, len(x)) - 1, -1, -1):  # in order of time, as a window sums
        there = place - back >= start
        at = np.where(there, place - back, 0)
        some = there & known[at]
        total += np.where(some, x[at], 0.0)
        count += some
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(count > 0, total / count, np.nan), place - start + 1 >= n


TAIL = {"k": "string", "us": "bigint", "x": "double"}


def means_step(windows: Sequence[int], finish: Callable, idle_seconds: float | None) -> Callable:
    most = max(windows)

    def step(rows, held, watermark):
        both, new = with_tail(rows, held, ("k", "us", "x"))
        means = [trailing_means(both, n)[0] for n in windows]
        ready = new & trailing_means(both, most)[1]
        fresh = np.zeros(len(new), dtype=np.int64)
        fresh[new] = rows["id"]
        out = {"k": both["k"][ready], "id": fresh[ready], **finish(*[m[ready] for m in means])}
        tail = last_rows(both["code"], most - 1)
        keep, expiry = expire({c: v[tail] for c, v in both.items()}, watermark, idle_seconds)
        return out, keep, expiry

    return step


def rolling_avg(df: DataFrame, keys: Sequence[str], time: str, ident: str, value: str, n: int = 3, delay: str = "1 hour", idle_seconds: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Mean of the last ``n`` values of a key, from its n-th row on."""
    step = means_step([n], lambda a: {"rolling_avg": a}, idle_seconds)
    return released(df, keys, time, delay, {"id": ident, "x": value}, TAIL, step, "id bigint, rolling_avg double", buckets).withColumnRenamed("id", ident)


def multi_window_trend(df: DataFrame, keys: Sequence[str], time: str, ident: str, value: str, delay: str = "1 hour", idle_seconds: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Means of the last 3, 5 and 10 values and their trend."""

    def finish(a, b, c):
        trend = np.select([(a < b) & (b < c), (a > b) & (b > c), (np.abs(a - b) < 50) & (np.abs(b - c) < 50)], ["improving", "degrading", "stable"], "fluctuating")
        return {"avg3": a, "avg5": b, "avg10": c, "trend": trend}

    output = "id bigint, avg3 double, avg5 double, avg10 double, trend string"
    return released(df, keys, time, delay, {"id": ident, "x": value}, TAIL, means_step([3, 5, 10], finish, idle_seconds), output, buckets).withColumnRenamed("id", ident)


def fraud_alerts(
    df: DataFrame, keys: Sequence[str], time: str, ident: str, amount: str, window_seconds: int = 60, max_count: int = 5, max_total: float = 10_000.0,
    times_average: float = 5.0, delay: str = "1 hour", buckets: int = BUCKETS,
) -> DataFrame:
    """Alerts per transaction over the key's last ``window_seconds``; rows are kept for one window."""
    reach = window_seconds * 1_000_000

    def step(rows, held, watermark):
        both, new = with_tail(rows, held, ("k", "us", "x"))
        start, end = runs(both["code"])
        us, x = both["us"], both["x"]
        # keys one after the other on one axis of time, so that one search serves all of them
        low = int(us.min()) - reach if len(us) else 0
        span = int(us.max()) - low + reach + 1 if len(us) else 1
        axis = both["code"] * span + (us - low)
        first, after = np.searchsorted(axis, axis - reach, side="left"), np.searchsorted(axis, axis, side="right")
        first = np.maximum(first, start)
        known = ~np.isnan(x)
        sums, some = np.concatenate([[0.0], np.cumsum(np.where(known, x, 0.0))]), np.concatenate([[0], np.cumsum(known)])
        count = after - first
        total = np.where(some[after] > some[first], sums[after] - sums[first], np.nan)
        with np.errstate(invalid="ignore"):
            rules = {"too many transactions": count > max_count, "high amount": total > max_total, "unusual large transaction": x > total / np.maximum(count, 1) * times_average}
        hits = [np.flatnonzero(rule & new) for rule in rules.values()]
        at = np.concatenate(hits)
        fresh = np.zeros(len(new), dtype=np.int64)
        fresh[new] = rows["id"]
        out = {"k": both["k"][at], "id": fresh[at], "recent_count": count[at], "recent_total": total[at], "reason": np.repeat(np.array(list(rules), dtype=object), [len(h) for h in hits])}
        live = us + reach > watermark  # others are in no later row's window
        keep = {c: v[live] for c, v in both.items()}
        return out, keep, int(keep["us"].min()) + reach if live.any() else NEVER

    output = "id bigint, recent_count bigint, recent_total double, reason string"
    return released(df, keys, time, delay, {"id": ident, "x": amount}, TAIL, step, output, buckets).withColumnRenamed("id", ident)


def adaptive_threshold(
    df: DataFrame, keys: Sequence[str], time: str, ident: str, value: str, start: float = 80.0, keep: int = 100, needed: int = 10,
    delay: str = "1 hour", idle_seconds: float | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """Readings over mean + 2 deviations of the key's last ``keep`` readings, this one included."""

    def step(rows, held, watermark):
        both, new = with_tail(rows, held, ("k", "us", "x"))
        first, _ = runs(both["code"])
        threshold = np.full(len(new), start)
        known = np.arange(1, len(new) + 1) - first  # readings of the key up to this one
        at = np.flatnonzero(new & (known >= needed))
        # a row of the matrix is the span that ends at a reading; places before the key's first are null
        ends = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(keep - 1, np.nan), both["x"]]), keep)
        for a in range(0, len(at), BLOCK_ROWS):
            some = at[a : a + BLOCK_ROWS]
            spans = ends[some]
            spans[np.arange(keep, 0, -1) > known[some][:, None]] = np.nan
            enough = (~np.isnan(spans)).sum(axis=1) >= needed
            if enough.any():
                threshold[some[enough]] = np.nanmean(spans[enough], axis=1) + 2 * np.nanstd(spans[enough], axis=1)
        over = new & (both["x"] > threshold)
        x, limit = both["x"][over], threshold[over]
        fresh = np.zeros(len(new), dtype=np.int64)
        fresh[new] = rows["id"]
        out = {"k": both["k"][over], "id": fresh[over], "x": x, "threshold": limit, "severity": np.select([x > limit * 1.5, x > limit * 1.2], ["CRITICAL", "HIGH"], "MEDIUM")}
        tail = last_rows(both["code"], keep - 1)
        kept, expiry = expire({c: v[tail] for c, v in both.items()}, watermark, idle_seconds)
        return out, kept, expiry

    output = "id bigint, x double, threshold double, severity string"
    return released(df, keys, time, delay, {"id": ident, "x": value}, TAIL, step, output, buckets).withColumnsRenamed({"id": ident, "x": value})


# a summary per key


def per_key(names: Sequence[str], one: Callable, idle_seconds: float | None) -> Callable:
    """A step that folds each key's due rows into its summary.

    ``one(summary, rows)`` gets a key's summary (None at first) and its rows,
    and returns output columns, the new summary, and the time from which the
    summary means nothing (NEVER if it always does).  Summaries end with the
    time of the newest row.
    """
    age = None if idle_seconds is None else round(idle_seconds * 1_000_000)

    def step(rows, held, watermark):
        past = [held[c].tolist() if isinstance(held[c], np.ndarray) else held[c] for c in ("k", "ends", *names)]
        summaries = {k: s for k, *s in zip(*past)}
        start, end = runs(rows["k"])
        outs: list[Arrays] = []
        for a, b in sorted(set(zip(start.tolist(), end.tolist()))):
            key = rows["k"][a]
            past = summaries.get(key)
            out, summary, ends = one(None if past is None else past[1:], {c: v[a:b] for c, v in rows.items()})
            if age is not None:
                ends = min(ends, int(rows["us"][b - 1]) + age)
            summaries[key] = [ends, *summary]
            outs.append({"k": np.full(len(next(iter(out.values()))), key, dtype=object), **out})
        live = {k: s for k, s in summaries.items() if s[0] > watermark}
        keep = {"k": list(live), "ends": [s[0] for s in live.values()], **{c: [s[i + 1] for s in live.values()] for i, c in enumerate(names)}}
        joined = {c: np.concatenate([o[c] for o in outs]) for c in outs[0]} if outs else {}
        return joined, keep, min(keep["ends"], default=NEVER)

    return step


def rate_limit(df: DataFrame, keys: Sequence[str], time: str, ident: str, limit: int = 100, window_seconds: int = 60, delay: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """Whether a request is among the first ``limit`` of its window, which its first request opens; a timer closes it."""
    width = window_seconds * 1_000_000

    def one(past, rows):
        us = rows["us"]
        count, opened = past if past else (0, None)
        counts, at = np.empty(len(us), dtype=np.int64), 0
        while at < len(us):  # one turn a window, not one a row
            if opened is None or us[at] - opened > width:
                count, opened = 0, int(us[at])
            end = int(np.searchsorted(us, opened + width, side="right"))
            counts[at:end] = np.arange(count + 1, count + 1 + end - at)
            count, at = count + end - at, end
        out = {"id": rows["id"], "accepted": counts <= limit, "remaining": limit - counts}
        return out, (count, opened), opened + width

    held = {"k": "string", "ends": "bigint", "count": "bigint", "opened": "bigint"}
    out = released(df, keys, time, delay, {"id": ident}, held, per_key(("count", "opened"), one, None), "id bigint, accepted boolean, remaining bigint", buckets)
    return out.withColumnRenamed("id", ident)


def baseline_anomalies(
    df: DataFrame, keys: Sequence[str], time: str, ident: str, value: str, cooldown_seconds: float = 5.0, needed: int = 10, recent: int = 20,
    delay: str = "1 hour", idle_seconds: float | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """Readings that leave the key's running baseline, at most one a cool-down."""
    pause = round(cooldown_seconds * 1_000_000)

    def one(past, rows):
        n, total, squares, seen, last = past if past else (0, 0.0, 0.0, [], None)
        us, x = rows["us"], rows["x"]
        value = np.where(np.isnan(x), 0.0, x)
        counts = n + np.cumsum(~np.isnan(x))
        totals, powers = np.cumsum(np.concatenate([[total], value]))[1:], np.cumsum(np.concatenate([[squares], value * value]))[1:]
        mean = totals / np.maximum(counts, 1)
        deviation = np.sqrt(np.maximum(powers / np.maximum(counts, 1) - mean * mean, 0.0))
        tail = np.concatenate([np.array(seen, dtype=float), x])
        spans = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(recent, np.nan), tail]), recent)[-len(x) :]
        with np.errstate(invalid="ignore", divide="ignore"):
            drift = np.nansum(spans, axis=1) / np.maximum((~np.isnan(spans)).sum(axis=1), 1)
            z = np.where(deviation > 0, np.abs(x - mean) / deviation, 0.0)
        limit = np.where(np.abs(drift - mean) > deviation * 0.5, 2.0, 2.5)
        hits, at = np.flatnonzero((counts >= needed) & (z > limit)), 0
        chosen = []
        while at < len(hits):  # one turn an alert: those inside its cool-down are passed over
            if last is None or us[hits[at]] - last > pause:
                chosen.append(hits[at])
                last = int(us[hits[at]])
            at = max(at + 1, int(np.searchsorted(us[hits], last + pause, side="right")))
        c = np.array(chosen, dtype=np.int64)
        out = {
            "id": rows["id"][c], "zscore": z[c], "severity": np.select([z[c] > 3.5, z[c] > 2.8], ["high", "medium"], "low"),
            "confidence": np.minimum(0.99, (z[c] - limit[c]) / (4.0 - limit[c])), "expected_low": mean[c] - 2 * deviation[c], "expected_high": mean[c] + 2 * deviation[c],
        }
        return out, (int(counts[-1]), float(totals[-1]), float(powers[-1]), plain(tail[-recent:], "double"), last), NEVER

    held = {"k": "string", "ends": "bigint", "n": "bigint", "total": "double", "squares": "double", "seen": "array<double>", "last": "bigint"}
    output = "id bigint, zscore double, severity string, confidence double, expected_low double, expected_high double"
    names = ("n", "total", "squares", "seen", "last")
    return released(df, keys, time, delay, {"id": ident, "x": value}, held, per_key(names, one, idle_seconds), output, buckets).withColumnRenamed("id", ident)


def session_quality(df: DataFrame, keys: Sequence[str], time: str, ident: str, value: str, delay: str = "1 hour", idle_seconds: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Reports of engagement and fatigue over a key's answers; ``idle_seconds`` ends a session."""

    def streak(hit: np.ndarray, before: int) -> np.ndarray:
        """Length of the run of hits that ends at each place, ``before`` of them earlier."""
        place = np.arange(1, len(hit) + 1)
        return place - np.maximum.accumulate(np.where(hit, -before, place))

    def one(past, rows):
        n, slow0, best0, fast0, history, last, began = past if past else (0, 0, 0, 0, [], None, None)
        us, x = rows["us"], rows["x"]
        began = int(us[0]) if began is None else began
        before = np.concatenate([[us[0] if last is None else last], us[:-1]])
        gap = us // 1000 - before // 1000
        count = n + np.arange(1, len(x) + 1)
        slow, fast = streak(x > 1000, slow0), streak(x < 500, fast0)
        best = np.maximum.accumulate(np.concatenate([[best0], fast]))[1:]
        tail = np.concatenate([np.array(history, dtype=float), x])
        spans = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(50, np.nan), tail]), 50)[-len(x) :]
        with np.errstate(invalid="ignore"):
            worse = (count >= 10) & (spans[:, -5:].mean(axis=1) > spans[:, -10:-5].mean(axis=1) * 1.3)
            average, deviation = np.nanmean(spans, axis=1), np.nanstd(spans, axis=1)
        fatigue = np.minimum(1.0, np.minimum(1.0, slow / 10.0) + np.where(gap > 10000, 0.3, 0.0) + np.where(worse, 0.4, 0.0))
        steady = np.where(count >= 5, np.maximum(0.0, 1 - deviation / 1000.0) * 0.4, 0.0)
        engagement = np.maximum(0.0, np.minimum(1.0, 1 - fatigue + steady + np.minimum(0.4, best / 20.0)))
        c = (count % 10 == 0) | (slow >= 5) | (fatigue > 0.7)
        level = lambda v, high, some: np.select([v > high, v > some], ["high", "moderate"], "low")
        tired, keen = level(fatigue[c], 0.7, 0.4), level(engagement[c], 0.8, 0.5)
        advice = np.select([tired == "high", (tired == "moderate") & (keen == "low"), keen == "high"], [ADVICE["rest"], ADVICE["pause"], ADVICE["praise"]], ADVICE["go on"])
        out = {
            "id": rows["id"][c], "overall": engagement[c] * 0.7 + (1 - fatigue[c]) * 0.3, "average": average[c], "fatigue_level": tired, "engagement_level": keen,
            "duration_ms": us[c] // 1000 - began // 1000, "recommendation": advice,
        }
        return out, (int(count[-1]), int(slow[-1]), int(best[-1]), int(fast[-1]), plain(tail[-50:], "double"), int(us[-1]), began), NEVER

    held = {"k": "string", "ends": "bigint", "n": "bigint", "slow": "bigint", "best": "bigint", "fast": "bigint", "history": "array<double>", "last": "bigint", "began": "bigint"}
    output = "id bigint, overall double, average double, fatigue_level string, engagement_level string, duration_ms bigint, recommendation string"
    names = ("n", "slow", "best", "fast", "history", "last", "began")
    return released(df, keys, time, delay, {"id": ident, "x": value}, held, per_key(names, one, idle_seconds), output, buckets).withColumnRenamed("id", ident)
