import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import joins as J
from tributary.operators import ranking, windows


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(3)
    make = lambda n: [(i, 1 if rng.random() < 0.4 else rng.randint(2, 6), rng.randint(0, 5000)) for i in range(n)]
    left, right = make(200), make(200)
    frame = lambda rows, p: spark.createDataFrame(rows, f"{p}_id int, {p}_key int, sec int").select(f"{p}_id", f"{p}_key", F.timestamp_seconds("sec").alias(f"{p}_ts"))
    return left, right, frame(left, "l"), frame(right, "r")


@pytest.mark.parametrize("lo,hi", [(0, 600), (10, 30), (-300, 0), (-50, 50)])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join(sides, lo, hi, how):
    left, right, l, r = sides
    expected = [(a[0], b[0]) for a in left for b in right if a[1] == b[1] and a[2] + lo <= b[2] <= a[2] + hi]
    if how == "left":
        hit = {a for a, _ in expected}
        expected += [(a[0], None) for a in left if a[0] not in hit]
    got = J.interval_join(l, r, "l_key", "r_key", "l_ts", "r_ts", lo, hi, how).select("l_id", "r_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("lo,hi", [(0, 3), (-2, 2), (5, 60)])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_burst_of_one_key_is_cut(spark, lo, hi, how):
    """One key holds half of all rows in one minute; null keys and times match nothing."""
    rng = random.Random(8)
    make = lambda: [(i, *((1, 1000 + rng.randrange(60_000) / 1000) if i % 2 else (rng.randrange(2, 6), rng.randrange(5000) / 1.0))) for i in range(240)] + [(900, None, 3.0), (901, 1, None)]
    left, right = make(), make()
    frame = lambda rows, p: spark.createDataFrame(rows, f"{p}_id int, {p}_key int, sec double").select(f"{p}_id", f"{p}_key", F.timestamp_micros((F.col("sec") * 1_000_000).cast("long")).alias(f"{p}_ts"))
    us = lambda x: int(x * 1_000_000)
    want = [(a[0], b[0]) for a in left for b in right if a[1] is not None and a[1] == b[1] and None not in (a[2], b[2]) and lo * 10**6 <= us(b[2]) - us(a[2]) <= hi * 10**6]
    if how == "left":
        want += [(a[0], None) for a in left if a[0] not in {x for x, _ in want}]
    l, r = frame(left, "l"), frame(right, "r")
    placed = l.withColumn("__lb", F.floor(F.unix_micros("l_ts") / ((hi - lo) * 10**6)))
    assert J._bursts(placed, "l_key", F.unix_micros("l_ts"), 4).where("size(__cuts) > 1").count() > 0
    got = J.interval_join(l, r, "l_key", "r_key", "l_ts", "r_ts", lo, hi, how, rows_per_task=4)
    assert "Cartesian" not in (plan := got._jdf.queryExecution().executedPlan().toString()) and "NestedLoop" not in plan
    assert sorted(map(tuple, got.select("l_id", "r_id").collect()), key=repr) == sorted(want, key=repr)


def test_no_cross_join(sides):
    _, _, l, r = sides
    plan = J.interval_join(l, r, "l_key", "r_key", "l_ts", "r_ts", 0, 600)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_click_golden(spark):
    ads = spark.createDataFrame([("ad1", 1640995200000)], "ad string, ms long").select("ad", F.timestamp_millis("ms").alias("at"))
    clicks = spark.createDataFrame([("ad1", 1640995210000)], "click string, ms long").select("click", F.timestamp_millis("ms").alias("clicked"))
    assert J.interval_join(ads, clicks, "ad", "click", "at", "clicked", 0, 600).count() == 1
    assert J.interval_join(ads, clicks, "ad", "click", "at", "clicked", 11, 600).count() == 0


def test_bands_golden(spark):
    players = spark.createDataFrame(
        [(0, "Jimmy Page", [0], 0), (1, "Angus Young", [1], 1), (2, "Eric Clapton", [1, 5], 2), (3, "Kirk Hammett", [3], 3)],
        "player_id long, player string, guitars array<long>, band long",
    )
    bands = spark.createDataFrame([(1, "AC/DC"), (0, "Led Zeppelin"), (3, "Metallica"), (4, "The Beatles")], "id long, name string")
    got = {(r["player"], r["name"]) for r in J.join_on(players, bands, "band", "id").collect()}
    assert got == {("Jimmy Page", "Led Zeppelin"), ("Angus Young", "AC/DC"), ("Kirk Hammett", "Metallica")}
    assert J.join_on(bands, players, "id", "band", "left_anti").count() == 1
    owners = players.where(F.array_contains("guitars", 1)).count()
    assert owners == 2


def test_join_support(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "t"))
    static = spark.range(3)
    ss = J.stream_join_support(stream, static, "id")
    assert ss["inner"] and ss["left_outer"] and not ss["right_outer"] and not ss["full_outer"]
    two = J.stream_join_support(stream, stream, "id")
    assert two["inner"] and not two["left_anti"] and not two["left_outer"]  # outer needs a watermark


def test_percent_rank_limit(spark):
    rng = random.Random(5)
    rows = [("a", rng.choice([1.0, 2.0, 2.5, 100.0, rng.random() * 1000])) for _ in range(300)] + [("b", 3.0)] + [("c", 7.0)] * 20
    df = spark.createDataFrame(rows, "g string, v double")
    from pyspark.sql import Window

    for p in (0.0, 0.1, 0.37, 1.0):
        plain = df.withColumn("r", F.percent_rank().over(Window.partitionBy("g").orderBy("v"))).where(F.col("r") <= p)
        expected = {r["g"]: r["m"] for r in plain.groupBy("g").agg(F.max("v").alias("m")).collect()}
        for per_task in (3, 40, ranking.ROWS_PER_TASK):
            assert {r["g"]: r["limit"] for r in ranking.percent_rank_limit(df, "g", "v", p, rows_per_task=per_task).collect()} == expected


def test_sliding_equals_spark_window(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 4000), rng.random(), rng.choice("xy")) for _ in range(300)]
    df = spark.createDataFrame(rows, "sec int, v double, k string").withColumn("ts", F.timestamp_seconds("sec"))
    aggs = {"n": ("count", "*"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v")}
    ours = windows.sliding(df, "ts", "10 minutes", "1 minute", aggs, ["k"])
    plain = df.groupBy("k", F.window("ts", "10 minutes", "1 minute")).agg(
        F.count("*").alias("n"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("m")
    ).select("window.start", "window.end", "k", "n", "s", "lo", "hi", "m")
    key = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(map(key, ours.collect())) == sorted(map(key, plain.collect()))
