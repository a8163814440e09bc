"""Joins of streams over stored rows, and the number of state partitions."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from tributary.session import python_state, state_partitions
from tributary.streaming.replay import for_each_batch
from tributary.streaming.stored import joined_to, two_sides


def streams(spark, tmp_path, left, right):
    """One micro-batch per list of (key, value, second) of each side."""

    def make(name, parts):
        for rows in parts:
            spark.createDataFrame(rows, f"{name}k long, {name} string, {name}s long").coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        schema = f"{name}k long, {name} string, {name}s long"
        return lambda s: s.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name)).withColumn(f"{name}t", F.timestamp_seconds(f"{name}s"))

    a, b = make("a", left), make("b", right)
    return lambda s: two_sides(a(s), b(s))


def joined(spark, tmp_path, build, **late):
    kept, out = str(tmp_path / "kept"), str(tmp_path / "out")
    for_each_batch(spark, build, joined_to(spark, kept, out, "ak", "bk", ["a", "b"], **late))
    return sorted(tuple(r) for r in spark.read.parquet(out).select("a", "b").collect())


LEFT = [[(1, "p", 100), (1, "p", 100), (None, "n", 5)], [(2, "q", 200), (1, "late", 10)], [(3, "r", None)]]
RIGHT = [[(2, "x", 100), (None, "m", 100)], [(1, "y", 200), (3, "z", 300)]]
PAIRS = [("p", "y"), ("p", "y"), ("q", "x"), ("r", "z")]


def test_pairs_meet_across_micro_batches_once(spark, tmp_path):
    assert joined(spark, tmp_path, streams(spark, tmp_path, LEFT, RIGHT)) == sorted([*PAIRS, ("late", "y")])


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    got = joined(spark, tmp_path, streams(spark, tmp_path, LEFT, RIGHT), times=("at", "bt"), delay_seconds=60)
    assert got == sorted(PAIRS)


def test_a_repeated_micro_batch_replaces_itself(spark, tmp_path):
    build = streams(spark, tmp_path, LEFT, RIGHT)
    kept, out = str(tmp_path / "kept"), str(tmp_path / "out")
    write = joined_to(spark, kept, out, "ak", "bk", ["a", "b"])

    def twice(batch, n):
        write(batch, n)
        write(batch, n)

    for_each_batch(spark, build, twice)
    assert sorted(tuple(r) for r in spark.read.parquet(out).select("a", "b").collect()) == sorted([*PAIRS, ("late", "y")])


def test_executors_on_one_host_share_the_state_by_cores():
    conf = SimpleNamespace(get=lambda name, other=None: {"spark.sql.shuffle.partitions": "200"}.get(name, other))
    session = lambda master: SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, defaultParallelism=12, getConf=lambda: conf_of_context))
    conf_of_context = SimpleNamespace(get=lambda name, other=None: other)
    assert state_partitions(session("local-cluster[3,4,10240]")) == 12 and python_state(session("local-cluster[3,4,10240]")) == {}
    assert state_partitions(session("local[12]")) == 3 and python_state(session("local[12]")) == {"spark.sql.shuffle.partitions": "6"}
