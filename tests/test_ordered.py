"""The cut of hot keys must not change results."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import aggregates, keyed, ordered, ranking, sessions
from tributary.operators.joins import cogroup_lists

DIRECT = ordered.ROWS_PER_TASK


@pytest.fixture(scope="module")
def skewed(spark):
    """700 rows, a third of them of one key, in bursts."""
    rng = random.Random(7)
    rows, at = [], 0.0
    for i in range(700):
        at += rng.choice([0.001, 0.5, 3, 40, 400])
        user = 1 if rng.random() < 0.35 else rng.randint(2, 20)
        rows.append((i, at, user, round(rng.random() * 120, 2), rng.choice("abc")))
    df = spark.createDataFrame(rows, "id long, sec double, user long, x double, kind string")
    return df.withColumn("ts", F.timestamp_micros((F.col("sec") * 1000).cast("long") * 1000 + 1_700_000_000_000_000)).drop("sec").cache()


def rows(df, digits=7):
    def plain(v):
        return round(v, digits) + 0.0 if isinstance(v, float) else v

    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)


CASES = {
    "rolling": lambda d, n: keyed.rolling_avg(d, "user", "ts", ["ts", "id"], "x", 3, n).select("id", "position", "rolling_avg"),
    "trend": lambda d, n: keyed.multi_window_trend(d, "user", "ts", ["ts", "id"], "x", n).select("id", "avg3", "avg5", "avg10", "trend"),
    "fraud": lambda d, n: keyed.fraud_alerts(d, "user", "ts", "x", 60, 3, 150.0, 2.0, n).select("id", "recent_count", "recent_total", "reason"),
    "threshold": lambda d, n: keyed.adaptive_threshold(d, ["user"], "ts", ["ts", "id"], "x", keep=12, rows_per_task=n).select("id", "threshold", "adjustments", "severity"),
    "baseline": lambda d, n: keyed.baseline_scores(d.withColumn("x", F.pow("x", 4)), "user", "ts", ["ts", "id"], "x", recent=9, rows_per_task=n).select("id", "severity", "limit"),
    "cooldown": lambda d, n: keyed.baseline_anomalies(d.withColumn("x", F.pow("x", 4)), "user", "ts", ["ts", "id"], "x", 600, n).select("id", "severity"),
    "limit": lambda d, n: keyed.rate_limit(d, "user", "ts", 2, 100, n, ["id"]).select("id", "accepted", "remaining"),
    "sessions": lambda d, n: sessions.purchase_sessions(d, "user", "ts", "kind", "x", 90, n),
    "actions": lambda d, n: sessions.session_actions(d, "user", "ts", "kind", 90, rows_per_task=n),
    "seconds": lambda d, n: sessions.session_seconds(d, "user", "ts", 90, n),
    "cogroup": lambda d, n: cogroup_lists(d.where("kind = 'a'"), d.where("kind = 'b'"), "user", "ts", "id", "id", ["ts", "id"], 1000, n),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("per_task", [23])
def test_cut_equals_plain(skewed, name, per_task):
    plain = rows(CASES[name](skewed, DIRECT))
    assert plain and rows(CASES[name](skewed, per_task)) == plain


def test_quality_cut(skewed):
    run = lambda n: rows(
        keyed.session_quality(skewed.withColumn("y", F.col("x") * 12), "user", "ts", ["ts", "id"], "y", n).select("id", "overall", "average", "recommendation", "duration_ms")
    )
    assert run(DIRECT) and run(60) == run(DIRECT)


def test_measured_width(skewed):
    assert ordered.bucket_cuts(skewed, ["user"], "ts") is None
    assert ordered.bucket_cuts(skewed, ["user"], "ts", 1000) is None
    assert len(ordered.bucket_cuts(skewed, ["user"], "ts", 50)) > 3


def test_a_burst_and_a_stray_time_are_cut_by_rows(spark):
    """5,000 rows within 5 ms and one of 1970: no bucket holds twice the rows asked for."""
    burst = spark.range(5000).select("id", F.lit(1).alias("user"), F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id")).alias("ts"))
    df = burst.unionByName(spark.createDataFrame([(-1, 1, dt.datetime(1970, 1, 1))], burst.schema))
    cuts = ordered.bucket_cuts(df, ["user"], "ts", 100)
    sizes = [r["count"] for r in df.groupBy(ordered._bucket(F.unix_micros("ts"), cuts)).count().collect()]
    assert max(sizes) <= 200 and sum(sizes) == 5001


@pytest.fixture(scope="module")
def odd(skewed):
    """Rows without a time, tied times and null values."""
    return (
        skewed.withColumn("ts", F.when(F.col("id") % 50 != 7, F.col("ts")))
        .withColumn("x", F.when(F.col("id") % 31 != 3, F.col("x"))).cache()
    )


@pytest.mark.parametrize("name", ["rolling", "trend", "fraud", "threshold", "limit", "sessions", "actions", "seconds"])
@pytest.mark.parametrize("per_task", [23, 120])
def test_null_times_survive_the_cut(odd, name, per_task):
    plain = rows(CASES[name](odd, DIRECT))
    assert plain and rows(CASES[name](odd, per_task)) == plain


def test_percentiles_are_exact(skewed):
    exact = {}
    for r in skewed.collect():
        exact.setdefault(r["kind"], []).append(r["x"])
    for per_task in (DIRECT, 20):
        for r in aggregates.percentile_table(skewed, "x", ["kind"], rows_per_task=per_task).collect():
            values = sorted(exact[r["kind"]])
            for name, p in {"median": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}.items():
                assert r[name] == values[math.ceil(len(values) * p) - 1]


def test_percent_rank_cut(skewed):
    run = lambda n: rows(ranking.percent_rank_limit(skewed, "kind", "x", 0.1, rows_per_task=n))
    assert run(DIRECT) == run(15) and len(run(15)) == 3


def test_lists_in_chunks(skewed):
    out = ordered.collect_in_chunks(skewed, ["user"], "ts", "id", ["ts", "id"], "ids", chunk_size=20, rows_per_task=30).collect()
    assert max(len(r["ids"]) for r in out) == 20
    ids = [i for r in sorted(out, key=lambda r: (r["user"], r["chunk"])) if r["user"] == 1 for i in r["ids"]]
    assert ids == [r["id"] for r in skewed.where("user = 1").orderBy("ts", "id").collect()]


def test_rate_limit_against_a_walk(skewed):
    seen, expected = {}, {}
    for r in skewed.orderBy("ts").collect():
        opened, count = seen.get(r["user"], (None, 0))
        if opened is None or (r["ts"] - opened).total_seconds() > 100:
            opened, count = r["ts"], 0
        seen[r["user"]] = (opened, count + 1)
        expected[r["id"]] = count + 1 <= 2
    got = {r["id"]: r["accepted"] for r in keyed.rate_limit(skewed, "user", "ts", 2, 100, 40).collect()}
    assert got == expected


def test_running_without_keys(skewed):
    out = ordered.with_running(skewed, [], "ts", ["ts", "id"], {"n": ("sum", F.lit(1)), "top": ("max", F.col("x"))}, 50_000_000).orderBy("ts", "id").collect()
    assert [r["n"] for r in out] == list(range(1, 701))
    assert out[-1]["top"] == max(r["x"] for r in out)


def test_null_keys_keep_their_own_history(skewed):
    holes = skewed.withColumn("user", F.when(F.col("user") != 3, F.col("user")).otherwise(F.when(F.col("id") < 0, 1)))
    holes = holes.withColumn("user", F.when(F.col("user") == 1, None).otherwise(F.col("user")))
    run = lambda n: rows(keyed.rolling_avg(holes, "user", "ts", ["ts", "id"], "x", 3, n).select("id", "position", "rolling_avg"))
    assert run(40) == run(DIRECT) and len(run(DIRECT)) > 600


@pytest.mark.parametrize("rows_per_task", [1, 7, 60, 10**6])
def test_sequential_rules_do_not_depend_on_the_cut(spark, rows_per_task):
    """A key without any pause, ties, a burst: windows and cool-downs as in a walk by hand."""
    import random

    rng = random.Random(6)
    times = {1: [i * 3 + rng.randrange(3) for i in range(300)], 2: [rng.randrange(4000) for _ in range(80)], 3: [50] * 40 + [51, 60, 61, 500]}
    rows = [(k * 10_000 + i, k, t) for k, ts in times.items() for i, t in enumerate(ts)]
    df = spark.createDataFrame(rows, "id long, user long, sec long").withColumn("ts", F.timestamp_seconds("sec")).repartition(3)
    want = {}
    for k in times:
        opened, n = None, 0
        for t, i in sorted((t, i) for i, u, t in rows if u == k):
            if opened is None or t - opened > 10:
                opened, n = t, 0
            n += 1
            want[i] = (n <= 3, 3 - n)
    got = keyed.rate_limit(df, "user", "ts", 3, 10, rows_per_task, ["id"]).collect()
    assert {r.id: (r.accepted, r.remaining) for r in got} == want and len(got) == len(rows)
    kept = keyed._sequential(df, "user", "ts", 10_000_000, True, rows_per_task, ["id"]).where("__keep").collect()
    assert {r.id for r in kept} == {i for i, (_, left) in want.items() if left == 2}


def test_the_number_of_cuts_is_bounded(spark):
    """The driver's list of cuts and the plan's search tree do not grow with the table."""
    df = spark.range(40_000).select("id", (F.col("id") % 2).alias("user"), F.timestamp_micros(F.col("id") * 1_000).alias("ts"))
    cuts = ordered.bucket_cuts(df, ["user"], "ts", 3)
    assert 900 <= len(cuts) < ordered.MOST_BUCKETS
    got = keyed.rolling_avg(df.withColumn("x", F.col("id").cast("double")), "user", "ts", ["ts", "id"], "x", 3, 3)
    assert got.agg(F.count("*"), F.sum("rolling_avg")).first() == (39_996, sum(i - 2.0 for i in range(4, 40_000)))
