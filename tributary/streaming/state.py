"""Per-key state on streams.

Each function sorts the rows of a key in a micro-batch by time, joins them to
the bounded history kept in state, and computes the new rows from both.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tributary.operators.keyed import ADVICE


Arrays = dict[str, np.ndarray]


def _sorted(pdfs: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    parts = list(pdfs)
    rows = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    columns = [rows[c].astype(str) if rows[c].dtype == object else rows[c] for c in reversed(order)]
    return rows.iloc[np.lexsort([c.to_numpy() for c in columns])]


def _history(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], keep: Callable[[Arrays], slice | np.ndarray],
    compute: Callable[[Arrays, Arrays, int], Arrays], output: str,
) -> DataFrame:
    """State = a short table of earlier rows (``columns``, as arrays of double).

    ``compute(rows, new, old)`` sees the columns of history and new rows
    together (the first ``old`` are history) and all columns of the new rows.
    ``keep`` picks what the next batch needs.
    """
    fields = ", ".join(f"{c} array<double>" for c in columns)

    def step(key, pdfs, state: GroupState):
        frame = _sorted(pdfs, order)
        new = {c: frame[c].to_numpy() for c in frame.columns}
        past = state.get if state.exists else ([],) * len(columns)
        rows = {c: np.concatenate([np.asarray(v, dtype="float64"), new[c].astype("float64")]) for c, v in zip(columns, past)}
        chosen = keep(rows)
        state.update(tuple(rows[c][chosen].tolist() for c in columns))
        out = compute(rows, new, len(past[0]))
        size = len(next(iter(out.values())))
        if size:
            yield pd.DataFrame({**out, **{k: [v] * size for k, v in zip(keys, key)}})

    return df.groupBy(*keys).applyInPandasWithState(step, output, fields, "append", GroupStateTimeout.NoTimeout)


def _last(n: int) -> Callable[[Arrays], slice]:
    return lambda rows: slice(max(0, len(next(iter(rows.values()))) - n), None)


def _means(x: np.ndarray, n: int, old: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of the last ``n`` rows' values (nulls left out) at every new row, and which rows have ``n``."""
    known = ~np.isnan(x)
    padded = np.concatenate([np.zeros(n - 1), np.where(known, x, 0.0)])
    counted = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.zeros(n - 1), known]), n).sum(axis=1)
    sums = np.lib.stride_tricks.sliding_window_view(padded, n).sum(axis=1)
    means = np.where(counted > 0, sums / np.maximum(counted, 1), np.nan)
    return means[old:], (np.arange(1, len(x) + 1) >= n)[old:]


def _nulls(x: np.ndarray) -> list:
    return [None if np.isnan(v) else v for v in x.tolist()]


def rolling_avg(df: DataFrame, key: str, order: Sequence[str], ident: str, value: str, n: int = 3) -> DataFrame:
    """Mean of the last ``n`` values, across micro-batches."""

    def compute(rows, new, old):
        mean, ready = _means(rows[value], n, old)
        return {ident: new[ident][ready], "rolling_avg": _nulls(mean[ready])}

    kind = df.schema[key].dataType.simpleString()
    return _history(df, [key], order, [value], _last(n - 1), compute, f"{ident} bigint, rolling_avg double, {key} {kind}")


def multi_window_trend(df: DataFrame, key: str, order: Sequence[str], ident: str, value: str) -> DataFrame:
    def compute(rows, new, old):
        (a, _), (b, _), (c, ready) = (_means(rows[value], n, old) for n in (3, 5, 10))
        trend = np.select(
            [(a < b) & (b < c), (a > b) & (b > c), (np.abs(a - b) < 50) & (np.abs(b - c) < 50)], ["improving", "degrading", "stable"], "fluctuating"
        )
        return {ident: new[ident][ready], "avg3": _nulls(a[ready]), "avg5": _nulls(b[ready]), "avg10": _nulls(c[ready]), "trend": trend[ready]}

    kind = df.schema[key].dataType.simpleString()
    return _history(df, [key], order, [value], _last(9), compute,
                    f"{ident} bigint, avg3 double, avg5 double, avg10 double, trend string, {key} {kind}")


def fraud_alerts(df: DataFrame, user: str, micros: str, ident: str, amount: str, window_seconds: int = 60, max_count: int = 5,
                 max_total: float = 10_000.0, times_average: float = 5.0) -> DataFrame:
    """As the table form; ``micros`` is the event time in microseconds.

    A row that arrives late is placed by its time among those kept, which are
    the ones of the last window and of one before it.
    """
    reach = window_seconds * 1_000_000

    def keep(rows):
        return np.flatnonzero(rows[micros] >= rows[micros].max() - 2 * reach)

    def compute(rows, new, old):
        x, asked = rows[amount][old:], rows[micros][old:]
        order = np.argsort(rows[micros], kind="stable")
        at, known = rows[micros][order], ~np.isnan(rows[amount][order])
        first, after = np.searchsorted(at, asked - reach, side="left"), np.searchsorted(at, asked, side="right")
        sums = np.concatenate([[0.0], np.cumsum(np.where(known, rows[amount][order], 0.0))])
        some = np.concatenate([[0], np.cumsum(known)])
        count = after - first
        total = np.where(some[after] > some[first], sums[after] - sums[first], np.nan)
        rules = {
            "too many transactions": count > max_count, "high amount": total > max_total,
            "unusual large transaction": x > total / count * times_average,
        }
        hits = [np.flatnonzero(rule) for rule in rules.values()]
        at_row = np.concatenate(hits)
        reason = np.repeat(list(rules), [len(h) for h in hits])
        return {ident: new[ident][at_row], "recent_count": count[at_row], "recent_total": _nulls(total[at_row]), "reason": reason}

    kind = df.schema[user].dataType.simpleString()
    return _history(df, [user], [micros, ident], [micros, amount], keep, compute,
                    f"{ident} bigint, recent_count bigint, recent_total double, reason string, {user} {kind}")


def adaptive_threshold(df: DataFrame, keys: Sequence[str], order: Sequence[str], ident: str, value: str, start: float = 80.0,
                       keep: int = 100, needed: int = 10) -> DataFrame:
    def compute(rows, new, old):
        x = rows[value]
        threshold = np.full(len(x) - old, start)
        for i in range(max(old, needed - 1), len(x)):
            span = x[max(0, i - keep + 1) : i + 1]
            threshold[i - old] = span.mean() + 2 * span.std()
        over = x[old:] > threshold
        hit, limit = x[old:][over], threshold[over]
        severity = np.select([hit > limit * 1.5, hit > limit * 1.2], ["CRITICAL", "HIGH"], "MEDIUM")
        return {ident: new[ident][over], value: hit, "threshold": limit, "severity": severity}

    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    return _history(df, keys, order, [value], _last(keep - 1), compute, f"{ident} bigint, {value} double, threshold double, severity string, {kinds}")


def baseline_anomalies(df: DataFrame, key: str, micros: str, ident: str, value: str, cooldown_seconds: float = 5.0) -> DataFrame:
    """Running baseline, drift-aware threshold and cool-down per key."""
    kind = df.schema[key].dataType.simpleString()
    pause = cooldown_seconds * 1_000_000

    def step(k, pdfs, state: GroupState):
        rows = _sorted(pdfs, [micros, ident])
        n, total, squares, recent, last = state.get if state.exists else (0, 0.0, 0.0, [], None)
        recent, out = list(recent), []
        for who, at, x in zip(rows[ident], rows[micros], rows[value].astype(float)):
            n, total, squares = n + 1, total + x, squares + x * x
            recent = (recent + [x])[-20:]
            if n < 10:
                continue
            mean = total / n
            sd = max(squares / n - mean * mean, 0.0) ** 0.5
            z = abs(x - mean) / sd if sd > 0 else 0.0
            limit = 2.0 if abs(sum(recent) / len(recent) - mean) > sd * 0.5 else 2.5
            if z > limit and (last is None or at - last > pause):
                last = int(at)
                severity = "high" if z > 3.5 else "medium" if z > 2.8 else "low"
                out.append((int(who), z, severity, min(0.99, (z - limit) / (4.0 - limit)), mean - 2 * sd, mean + 2 * sd, k[0]))
        state.update((n, total, squares, recent, last))
        if out:
            yield pd.DataFrame(out, columns=[ident, "zscore", "severity", "confidence", "expected_low", "expected_high", key])

    return df.groupBy(key).applyInPandasWithState(
        step, f"{ident} bigint, zscore double, severity string, confidence double, expected_low double, expected_high double, {key} {kind}",
        "n bigint, total double, squares double, recent array<double>, last bigint", "append", GroupStateTimeout.NoTimeout,
    )


def session_quality(df: DataFrame, key: str, micros: str, ident: str, value: str) -> DataFrame:
    """Reports of engagement and fatigue, state carried across micro-batches."""
    kind = df.schema[key].dataType.simpleString()

    def step(k, pdfs, state: GroupState):
        rows = _sorted(pdfs, [micros, ident])
        n, slow, best, fast, history, last, began = state.get if state.exists else (0, 0, 0, 0, [], None, None)
        history, out = list(history), []
        for who, at, x in zip(rows[ident], rows[micros], rows[value].astype(float)):
            began = int(at) if began is None else began
            gap = 0 if last is None else at // 1000 - last // 1000
            n, last, history = n + 1, int(at), (history + [x])[-50:]
            slow, fast = (slow + 1 if x > 1000 else 0), (fast + 1 if x < 500 else 0)
            best = max(best, fast)
            worse = n >= 10 and np.mean(history[-5:]) > np.mean(history[-10:-5]) * 1.3
            fatigue = min(1.0, min(1.0, slow / 10.0) + (0.3 if gap > 10000 else 0.0) + (0.4 if worse else 0.0))
            steady = max(0.0, 1 - np.std(history) / 1000.0) * 0.4 if n >= 5 else 0.0
            engagement = max(0.0, min(1.0, 1 - fatigue + steady + min(0.4, best / 20.0)))
            if n % 10 == 0 or slow >= 5 or fatigue > 0.7:
                tired = "high" if fatigue > 0.7 else "moderate" if fatigue > 0.4 else "low"
                keen = "high" if engagement > 0.8 else "moderate" if engagement > 0.5 else "low"
                advice = "rest" if tired == "high" else "pause" if (tired, keen) == ("moderate", "low") else "praise" if keen == "high" else "go on"
                out.append((int(who), engagement * 0.7 + (1 - fatigue) * 0.3, float(np.mean(history)), tired, keen,
                            int(at // 1000 - began // 1000), ADVICE[advice], k[0]))
        state.update((n, slow, best, fast, history, last, began))
        if out:
            yield pd.DataFrame(out, columns=[ident, "overall", "average", "fatigue_level", "engagement_level", "duration_ms", "recommendation", key])

    return df.groupBy(key).applyInPandasWithState(
        step, f"{ident} bigint, overall double, average double, fatigue_level string, engagement_level string, duration_ms bigint, recommendation string, {key} {kind}",
        "n bigint, slow bigint, best bigint, fast bigint, history array<double>, last bigint, began bigint", "append", GroupStateTimeout.NoTimeout,
    )


def rate_limit(df: DataFrame, key: str, micros: str, ident: str, limit: int = 100, window_seconds: int = 60) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()
    width = window_seconds * 1_000_000

    def step(k, pdfs, state: GroupState):
        rows = _sorted(pdfs, [micros, ident])
        count, opened = state.get if state.exists else (0, None)
        counts = []
        for at in rows[micros]:
            if opened is None or at - opened > width:
                count, opened = 1, int(at)
            else:
                count += 1
            counts.append(count)
        state.update((count, opened))
        yield pd.DataFrame({ident: rows[ident], "accepted": [c <= limit for c in counts], "remaining": [limit - c for c in counts], key: k[0]})

    return df.groupBy(key).applyInPandasWithState(
        step, f"{ident} bigint, accepted boolean, remaining bigint, {key} {kind}", "count bigint, opened bigint", "append", GroupStateTimeout.NoTimeout
    )


def session_expiry(df: DataFrame, user: str, time: str, action: str, limit_seconds: float, delay: str, buckets: int = 256) -> DataFrame:
    """Sessions, emitted when they are over.

    Gaps inside a micro-batch close sessions at once; a session that is still
    open closes by event-time timeout when the watermark passes its limit.
    Users are dealt into ``buckets``, each one group of the state operator with
    the open sessions of its users, since a call costs far more than a row.
    Output: user, start and last (microseconds), actions in order.
    """
    limit = round(limit_seconds * 1_000_000)

    def step(k, pdfs, state: GroupState):
        watermark = state.getCurrentWatermarkMs()
        past = list(zip(*state.get)) if state.exists else []
        held, dues = {u: (start, last, list(actions)) for u, start, last, _, actions in past}, {u: due for u, _, _, due, _ in past}
        closed, fresh, timeless = [], set(), set()
        if not state.hasTimedOut:
            rows = _sorted(pdfs, ["k", "__us", action])  # equal times by name, however they arrived
            for u, at, what in zip(rows["k"].tolist(), rows["__us"].tolist(), rows[action].tolist()):
                start, last, actions = held.get(u, (None, None, []))
                fresh.add(u)
                if at != at:  # without a time: the last of the micro-batch; what is still open after it takes its start from later rows
                    timeless.add(u)
                    held[u] = (start, last, [*actions, what])
                    continue
                at = int(at)
                if last is not None and start - at >= limit:  # late, and of a session before the open one
                    closed.append((u, at, at, [what]))
                    continue
                if last is not None and at - last >= limit:
                    closed.append((u, start, last, actions))
                    start, last, actions = None, None, []
                actions.append(what)
                held[u] = (at if start is None else min(start, at), at if last is None else max(last, at), actions)
        # a session without new rows times out when the watermark is past its limit, one with new rows when it is there
        for u in fresh:
            last = held[u][1]
            dues[u] = watermark if last is None else (last + limit) // 1000
        over = [u for u in held if dues[u] < watermark or (dues[u] == watermark and u in fresh)]
        closed.extend((u, *held.pop(u)) for u in over)
        if held:
            kept = [(u, *((None, None) if u in timeless else (start, last)), dues[u], actions) for u, (start, last, actions) in held.items()]
            state.update(tuple(map(list, zip(*kept))))
            state.setTimeoutTimestamp(max(min(dues[u] for u in held), watermark + 1))
        elif state.exists:
            state.remove()
        if closed:
            yield pd.DataFrame(closed, columns=["k", "started", "ended", "actions"])

    stamped = df.withWatermark(time, delay).select(
        F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int").alias("bucket"), F.to_json(F.struct(user)).alias("k"), time, action, F.unix_micros(time).alias("__us"))
    out = stamped.groupBy("bucket").applyInPandasWithState(
        step, "k string, started bigint, ended bigint, actions array<string>",
        "users array<string>, starts array<bigint>, lasts array<bigint>, dues array<bigint>, actions array<array<string>>", "append", GroupStateTimeout.EventTimeTimeout,
    )
    return out.select("started", "ended", "actions", F.from_json("k", StructType([df.schema[user]]))[user].alias(user))


def trending_decay(df: DataFrame, tag: str, micros: str, decay: float = 0.95, unit_seconds: float = 1.0) -> DataFrame:
    """Score per tag, decayed between mentions; update mode, one row per tag and batch."""
    kind = df.schema[tag].dataType.simpleString()

    def step(k, pdfs, state: GroupState):
        at = np.sort(np.concatenate([p[micros].to_numpy(dtype="float64") for p in pdfs]))
        score, last = state.get if state.exists else (0.0, at[-1])
        newest = max(last, at[-1])
        age = 1_000_000.0 * unit_seconds
        score = score * decay ** ((newest - last) / age) + float(np.sum(decay ** ((newest - at) / age)))
        state.update((float(score), float(newest)))
        yield pd.DataFrame({tag: [k[0]], "score": [score], "at": [int(newest)]})

    return df.groupBy(tag).applyInPandasWithState(
        step, f"{tag} {kind}, score double, at bigint", "score double, last double", "update", GroupStateTimeout.NoTimeout
    )
