"""Mergeable sketches and summaries against exact answers."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tributary.operators import aggregates as A
from tributary.operators import heavy as H
from tributary.operators import sketches as S

MINUTE = 60


def frame(spark, rows, schema="sec long, key string, x double"):
    return spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("sec")).repartition(5)


def test_merged_quantiles_keep_their_rank(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(0, 6 * 3600), "hot" if rng.random() < 0.9 else "cold", rng.gauss(0, 1) if rng.random() < 0.97 else None) for _ in range(40_000)]
    df, shares = frame(spark, rows), {"low": 0.01, "median": 0.5, "high": 0.99}
    panes = S.panes(df, "ts", "10 minutes", ["key"], {"sketch": S.quantile_sketch("x")})
    for size, slide in (("2 hours", None), ("2 hours", "30 minutes"), ("1 hour", "10 minutes")):
        windows = S.merged(panes, size, ["key"], {"sketch": S.quantile_merge()}, slide, "10 minutes")
        counts = {(r.start, r.key): r.n for r in windows.select("start", "key", S.sketched_count().alias("n")).collect()}
        exact = df.where("x is not null").groupBy(F.window("ts", size, slide).start.alias("start") if slide else F.window("ts", size).start.alias("start"), "key").count().collect()
        assert counts == {(r.start, r.key): r["count"] for r in exact}
        rows_in = df.withColumn("start", F.window("ts", size, slide).start if slide else F.window("ts", size).start)
        errors = S.rank_errors(rows_in, "x", ["start", "key"], S.sketched_quantiles(windows, shares), shares).collect()
        assert len(errors) == len(exact) and max(max(r.low, r.median, r.high) for r in errors) < 3 * S.RANK_ERROR
    with pytest.raises(ValueError):
        S.merged(panes, "25 minutes", ["key"], {"sketch": S.quantile_merge()}, "10 minutes", "10 minutes")


def test_audiences_of_thousands(spark):
    rows = [(day * 86400 + i % 86400, k, float(user)) for day in range(2) for k, low, high in (("a", 0, 30_000), ("b", 20_000, 50_000), ("c", 60_000, 61_000)) for i, user in enumerate(range(low, high))]
    days = S.panes(frame(spark, rows), "ts", "1 day", ["key"], {"sketch": S.audience_sketch("x")})
    both = days.groupBy("key").agg(S.audience_merge().alias("sketch")).withColumn("all", F.lit(1))
    got = {(r.one, r.two): (r.shared, r.either) for r in S.overlaps(both, ["all"], "key").collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    shared, either = got[("a", "b")]
    assert abs(shared - 10_000) < 50_000 * 3 / 64 and abs(either - 50_000) < 50_000 * 3 / 64 and got[("a", "c")][0] == 0


def test_granularities_equal_the_exact_form(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(0, 3 * 86400), rng.choice("abc") if rng.random() < 0.9 else None, rng.choice([None, 1.0, 2.5])) for _ in range(3000)]
    df = frame(spark, rows)
    key = lambda d: sorted(((r.granularity, r.start, r.end, r.total, r["count"], r["items"], r.average) for r in d.collect()), key=str)
    assert key(S.granularities(df, "ts", "key", "x", A.GRANULARITIES)) == key(A.multi_granularity(df, "ts", "key", "x"))


def exact_top(rows, k, size, slide):
    windows = defaultdict(Counter)
    for sec, item, _ in rows:
        if item is None:
            continue
        pane = sec // slide * slide
        for s in range(pane - size + slide, pane + 1, slide):
            windows[s][item] += 1
    return {(s, rank, item, n) for s, c in windows.items() for rank, (n, item) in enumerate(sorted((-n, i) for i, n in c.items())[:k], 1) for n in [-n]}


@pytest.mark.parametrize("counters", [2, 16, 1000])
def test_frequent_items_are_exact_for_any_table_size(spark, monkeypatch, counters):
    monkeypatch.setattr(H, "ROWS_HELD", 40)
    rng = random.Random(counters)
    rows = [(rng.randrange(0, 40 * MINUTE), rng.choice([None, "hot", "warm", f"t{rng.randrange(2000)}", f"t{int(rng.paretovariate(1))}"]), 0.0) for _ in range(6000)]
    rows += [(7 * MINUTE + i % 60, "burst", 0.0) for i in range(3000)] + [(90 * MINUTE, f"once{i}", 0.0) for i in range(30)]
    got = H.top_items(frame(spark, rows), "ts", "key", 4, "10 minutes", "2 minutes", counters).collect()
    assert {(int(r.start.timestamp()), r.rank, r.key, r["count"]) for r in got} == exact_top(rows, 4, 10 * MINUTE, 2 * MINUTE)


def test_summaries_do_not_grow_with_the_items(spark):
    rows = [(i % 60, f"t{i}", 0.0) for i in range(20_000)] + [(1, "often", 0.0)] * 3000
    tables = H.summaries(frame(spark, rows), "ts", "key", 60, 50).collect()
    items = {r.item: r.lower for r in tables if r.item is not None}
    (missed,) = {r.missed for r in tables}
    assert len(items) <= 50 and 3000 - missed <= items["often"] <= 3000 and 0 < missed < 23_000 / 20
    assert H.top_items(frame(spark, []), "ts", "key", 3, "10 minutes", "2 minutes").collect() == []


def test_mergeable_tables():
    rng = random.Random(3)
    for _ in range(50):
        truth, counts, missed = Counter(), Counter(), 0
        for _ in range(rng.randrange(1, 6)):
            part = Counter({f"i{rng.randrange(40)}": rng.randrange(1, 50) for _ in range(rng.randrange(40))})
            truth += part
            missed += H.reduced(part, 5)
            counts += part
        missed += H.reduced(counts, 5)
        assert len(counts) <= 5 and all(truth[i] - missed <= counts[i] <= truth[i] for i in truth)
        assert missed <= truth.total() / 6
