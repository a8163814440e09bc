"""Per-key histories on streams: shuffled arrival, restarts, and state that ends."""

import random
import time as clock
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.operators import keyed
from tributary.session import bounded_state, streaming_session, work_dir
from tributary.streaming import in_order as O
from tributary.streaming.replay import replay, run

SCHEMA = "id long, user long, kind string, ms long, x double"
DELAY = 40_000  # milliseconds a row may be late
END = 10**9


def events(n=700, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = rng.choice([1, 1, 1, 2, 3, None])
        x = None if rng.random() < 0.05 else round(rng.choice([rng.gauss(400, 60), rng.gauss(400, 60), rng.uniform(0, 3000)]), 3)
        rows.append((i, user, rng.choice("ab"), rng.randrange(0, 900_000) // 7 * 7, x))
    return rows


def arrivals(rows, seed):
    """The rows in micro-batches, none more than DELAY behind, in any order; then one row far ahead."""
    rng = random.Random(seed)
    late = sorted(rows, key=lambda r: r[3] + rng.randrange(DELAY))
    parts = [late[i : i + 180] for i in range(0, len(late), 180)]
    return [*[rng.sample(p, len(p)) for p in parts], [(END, 99, "a", 5_000_000, None)]]


def stream_of(spark, tmp_path, parts, name="in"):
    path = str(tmp_path / name)
    for p in parts:
        spark.createDataFrame(p, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return lambda s: s.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path).withColumn("ts", F.timestamp_millis("ms"))


def key(df, digits=7):
    out = [tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()]
    return sorted((r for r in out if END not in r), key=repr)


CASES = {
    "rolling": (
        lambda s: O.rolling_avg(s, ["user"], "ts", "id", "x", delay="40 seconds"),
        lambda t: keyed.rolling_avg(t, "user", "ts", ["ts", "id"], "x"), ["user", "id", "rolling_avg"]),
    "trend": (
        lambda s: O.multi_window_trend(s, ["user"], "ts", "id", "x", delay="40 seconds"),
        lambda t: keyed.multi_window_trend(t, "user", "ts", ["ts", "id"], "x"), ["user", "id", "avg3", "avg5", "avg10", "trend"]),
    "fraud": (
        lambda s: O.fraud_alerts(s, ["user"], "ts", "id", "x", 30, 5, 3000.0, 3.0, delay="40 seconds"),
        lambda t: keyed.fraud_alerts(t, "user", "ts", "x", 30, 5, 3000.0, 3.0), ["user", "id", "recent_count", "recent_total", "reason"]),
    "threshold": (
        lambda s: O.adaptive_threshold(s, ["user", "kind"], "ts", "id", "x", keep=30, delay="40 seconds"),
        lambda t: keyed.adaptive_threshold(t, ["user", "kind"], "ts", ["ts", "id"], "x", keep=30).where("severity is not null"), ["user", "kind", "id", "x", "threshold", "severity"]),
    "baseline": (
        lambda s: O.baseline_anomalies(s.fillna(300.0, ["x"]), ["user"], "ts", "id", "x", 20.0, delay="40 seconds"),
        lambda t: keyed.baseline_anomalies(t.fillna(300.0, ["x"]), "user", "ts", ["ts", "id"], "x", 20.0), ["user", "id", "zscore", "severity", "confidence", "expected_low", "expected_high"]),
    "quality": (
        lambda s: O.session_quality(s.fillna(300.0, ["x"]), ["user"], "ts", "id", "x", delay="40 seconds"),
        lambda t: keyed.session_quality(t.fillna(300.0, ["x"]), "user", "ts", ["ts", "id"], "x"),
        ["user", "id", "overall", "average", "fatigue_level", "engagement_level", "duration_ms", "recommendation"]),
    "limit": (
        lambda s: O.rate_limit(s, ["user"], "ts", "id", 3, 25, delay="40 seconds"),
        lambda t: keyed.rate_limit(t.withColumn("order", F.col("id")), "user", "ts", 3, 25), ["user", "id", "accepted", "remaining"]),
}


@pytest.mark.parametrize("case", CASES)
def test_shuffled_arrival_equals_the_table_form(spark, tmp_path, case):
    build, plain, columns = CASES[case]
    rows = events()
    if case == "limit":  # requests at one time are alike in the table form
        rows = list({(r[1], r[3]): r for r in rows}.values())
    want = key(plain(spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_millis("ms"))).select(*columns))
    assert want
    source = stream_of(spark, tmp_path, arrivals(rows, len(case)))
    assert key(replay(spark, lambda s: build(source(s)).select(*columns))) == want


def keys_left(spark, checkpoint):
    left = 0
    for name in ("waiting", "kept", "due"):
        left += spark.read.format("statestore").option("stateVarName", name).load(checkpoint).count()
    return left


def stored(spark, source, build, checkpoint, out):
    s = streaming_session(spark)
    query = build(source(s)).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).format("parquet").option("path", out).start()
    return run(query)


@pytest.mark.parametrize("case", ["limit", "fraud", "rolling", "baseline"])
def test_restart_goes_on_and_state_ends(spark, tmp_path, case):
    """A restart between micro-batches changes nothing; once all timers have fired nothing is left."""
    idle = {
        "limit": CASES["limit"][0], "fraud": CASES["fraud"][0],
        "rolling": lambda s: O.rolling_avg(s, ["user"], "ts", "id", "x", delay="40 seconds", idle_seconds=3600),
        "baseline": lambda s: O.baseline_anomalies(s, ["user"], "ts", "id", "x", 20.0, delay="40 seconds", idle_seconds=3600),
    }[case]
    columns = CASES[case][2]
    parts = arrivals(events(300), 3)
    checkpoint, out, path = work_dir(spark, "checkpoint"), work_dir(spark, "out"), str(tmp_path / "in")
    source = lambda s: s.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path).withColumn("ts", F.timestamp_millis("ms"))
    for some in (parts[:1], parts[1:]):
        for p in some:
            spark.createDataFrame(p, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        stored(spark, source, lambda s: idle(s).select(*columns), checkpoint, out)
    assert keys_left(spark, checkpoint) > 0
    whole = stream_of(spark, tmp_path, parts, "whole")
    assert key(spark.read.parquet(out)) == key(replay(spark, lambda s: idle(whole(s)).select(*columns)))
    # two rows without a key of their own move the watermark past every timer
    for at in (50_000_000, 500_000_000):
        spark.createDataFrame([(END, 98, "a", at, None)], SCHEMA).coalesce(1).write.mode("append").parquet(path)
        stored(spark, source, lambda s: idle(s).select(*columns), checkpoint, out)
    left = spark.read.format("statestore").option("stateVarName", "kept").load(checkpoint)
    assert left.count() <= 1  # the last row's own
    assert all("98" in str(r) or '"user":98' in str(r) for r in left.collect())


def test_threshold_work_grows_with_the_rows(monkeypatch):
    """Four times the keys take about four times as long, not sixteen times."""
    steps = []
    monkeypatch.setattr(O, "released", lambda df, keys, time, delay, columns, held, step, *more: steps.append(step) or spark_free())
    spark_free = lambda: type("Out", (), {"withColumnsRenamed": lambda self, names: self})()
    O.adaptive_threshold(None, ["user"], "ts", "id", "x", keep=5, needed=50)

    def spent(keys, each=40):
        n = keys * each
        rows = {"k": np.repeat(np.array([f"{i:06}" for i in range(keys)], dtype=object), each), "us": np.tile(np.arange(each), keys), "id": np.arange(n), "x": np.ones(n)}
        begun = clock.process_time()
        steps[0](rows, {"k": [], "us": [], "x": []}, 10**9)
        return clock.process_time() - begun

    spent(100)
    assert spent(8_000) < 9 * spent(2_000)


def steps_of(monkeypatch, **options):
    steps = []
    monkeypatch.setattr(O, "released", lambda df, keys, time, delay, columns, held, step, *more: steps.append(step) or type("Out", (), {"withColumnsRenamed": lambda self, names: self})())
    O.adaptive_threshold(None, ["user"], "ts", "id", "x", **options)
    return steps[0]


def test_threshold_of_a_long_key_takes_blocks_of_its_rows(monkeypatch):
    """The spans of all rows of a key would be 100 values a row; the results are those of a plain walk."""
    step, n = steps_of(monkeypatch), 60_000
    x = np.random.default_rng(2).normal(100, 30, n)
    x[::17] = np.nan
    rows = {"k": np.full(n, "a", dtype=object), "us": np.arange(n), "id": np.arange(n), "x": x}
    tracemalloc.start()
    out, keep, _ = step(rows, {"k": [], "us": [], "x": []}, 10**9)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 30_000_000 and keep["x"].tolist()[1:] == pytest.approx(x[-98:].tolist(), nan_ok=True)
    found = dict(zip(out["id"].tolist(), out["threshold"].tolist()))
    for i in range(0, n, 97):
        span = x[max(0, i - 99) : i + 1]
        limit = np.nanmean(span) + 2 * np.nanstd(span) if (~np.isnan(span)).sum() >= 10 else 80.0
        assert (i in found) == bool(x[i] > limit) and found.get(i, limit) == pytest.approx(limit)


def test_state_of_many_rows_is_small_and_comes_back_whole():
    """What waits and what is kept is a few bytes a row, whatever the names of the keys; a bucket's share does not grow with the table."""
    columns = {"k": "string", "us": "bigint", "x": "double"}
    rows = {"k": np.repeat(np.array([f'{{"user_id":{i},"event_type":"purchase"}}' for i in range(500)], dtype=object), 40), "us": np.arange(20_000) + 10**15, "x": np.where(np.arange(20_000) % 9 == 0, np.nan, 1.5)}
    pieces = [O.packed({c: v[a : a + 7_000] for c, v in rows.items()}, columns) for a in range(0, 20_000, 7_000)]
    back = O.unpacked(pieces, columns)
    assert all(back[c].tolist() == pytest.approx(rows[c].tolist(), nan_ok=True) if c == "x" else (back[c] == rows[c]).all() for c in columns)
    assert sum(len(data) for (data,) in pieces) < 25 * 20_000 and len({id(k) for k in back["k"]}) == 500
    some = {"k": ["a", "b"], "seen": [[1.0, None], []], "last": [None, 2**60 + 1]}
    assert O.unpacked([O.packed(some, kinds := {"k": "string", "seen": "array<double>", "last": "bigint"})], kinds)["last"] == [None, 2**60 + 1]
    assert O.unpacked([O.packed(some, kinds)], kinds)["seen"] == some["seen"] and O.unpacked([], columns)["us"].dtype == "int64"
    for n in (1, 100_000, 6_000_000, 36_000_000):
        assert O.buckets_for(n, 16) >= 16 and n / O.buckets_for(n, 16) <= O.BUCKET_ROWS


def test_many_buckets_give_the_rows_of_few(spark, tmp_path):
    build = lambda n: lambda s: O.adaptive_threshold(s, ["user", "kind"], "ts", "id", "x", keep=30, delay="40 seconds", buckets=n)
    source = stream_of(spark, tmp_path, arrivals(events(400, 8), 4))
    few, many = (key(replay(spark, lambda s: build(n)(source(s)), conf=bounded_state(spark))) for n in (1, 200))
    assert few == many and few
