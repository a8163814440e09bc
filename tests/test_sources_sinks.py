import random
import time
from pathlib import Path

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from tributary.sources import files, messages
from tributary.sources.tables import read_table
from tributary.sources.tailing import Span, TailedLines, TailReader, complete_bytes
from tributary.streaming import monitor, sinks
from tributary.streaming.control import dynamic_keywords, dynamic_threshold, threshold_file
from tributary.streaming.receivers import FolderReceiver
from tributary.streaming.replay import for_each_batch, replay, stage


def collected(into):
    return lambda batch, n: into.append((n, sorted(tuple(r) for r in batch.collect())))


def test_csv_stream(spark, tmp_path):
    for name, text in {"a": "AAPL,Jan 1 2000,25.94\nAAPL,Feb 1 2000,28.66\n", "b": "IBM,Mar 10 2001,106.11\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    out = replay(spark, lambda s: files.read_csv_stream(s, str(tmp_path), "company string, date date, value double", max_files=1))
    assert {(r["company"], str(r["date"]), r["value"]) for r in out.collect()} == {
        ("AAPL", "2000-01-01", 25.94), ("AAPL", "2000-02-01", 28.66), ("IBM", "2001-03-10", 106.11)}


def test_json_static(spark, tmp_path):
    (tmp_path / "bands.json").write_text('{"id":1,"name":"AC/DC","year":1973}\n{"id":0,"name":"Led Zeppelin","year":1968}\n')
    assert files.read_json_static(spark, str(tmp_path)).where("year < 1970").count() == 1
    assert files.read_json_static(spark, str(tmp_path), "id long, name string").columns == ["id", "name"]


def test_watch_directory_one_file_per_batch(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.txt").write_text(f"line {i}\n")
    seen = []
    for_each_batch(spark, lambda s: files.watch_directory(s, str(tmp_path)), collected(seen))
    assert [len(rows) for _, rows in seen] == [1, 1, 1]


def test_new_folders_are_found(spark, tmp_path):
    (tmp_path / "in" / "a").mkdir(parents=True)
    (tmp_path / "in" / "a" / "x.txt").write_text("one\n")
    seen, check = [], str(tmp_path / "check")
    build = lambda s: files.watch_many(s, str(tmp_path / "in" / "*"))
    for_each_batch(spark, build, collected(seen), checkpoint=check)
    (tmp_path / "in" / "b").mkdir()
    (tmp_path / "in" / "b" / "y.txt").write_text("two\n")
    for_each_batch(spark, build, collected(seen), checkpoint=check)
    assert [rows for _, rows in seen] == [[("one",)], [("two",)]]


def test_restart_continues_after_the_checkpoint(spark, tmp_path):
    src, out, check = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    for i in range(3):
        (src / f"{i}.txt").write_text(f"{i}\n")
        query = for_each_batch(spark, lambda s: files.read_lines(s, str(src), 1), sinks.exactly_once(out), checkpoint=check)
    rows = spark.read.parquet(out).collect()
    assert sorted(r["value"] for r in rows) == ["0", "1", "2"] and {r["batch_id"] for r in rows} == {0, 1, 2}
    ranges = [r for r in monitor.offset_ranges(query) if r["start"] is not None]
    assert ranges and ranges[-1]["batch_id"] == 2


def test_failure_in_a_batch_is_repaired_by_the_retry(spark, tmp_path):
    src, out, check = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    for i in range(2):
        (src / f"{i}.txt").write_text(f"{i}\n")
    write, failed = sinks.exactly_once(out), []

    def flaky(batch, n):
        write(batch, n)
        if n == 1 and not failed:
            failed.append(n)
            raise RuntimeError("lost after the write")

    build = lambda s: files.read_lines(s, str(src), 1)
    with pytest.raises(Exception, match="lost after the write"):
        for_each_batch(spark, build, flaky, checkpoint=check)
    for_each_batch(spark, build, flaky, checkpoint=check)
    assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == ["0", "1"]


def test_file_position(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n")
    out = replay(spark, lambda s: files.with_file_position(files.read_lines(s, str(tmp_path))))
    assert [(r["value"], r["file_name"]) for r in out.collect()] == [("x", "a.txt")]


def test_rate_sources(spark):
    assert files.read_rate(spark, 5).columns == ["timestamp", "value"]
    seen = []
    stream = files.read_rate_batches(spark, 10)
    q = stream.writeStream.foreachBatch(lambda b, n: seen.append(b.count())).start()
    try:
        while len(seen) < 2:
            q.awaitTermination(1)
    finally:
        q.stop()
    assert seen[:2] == [10, 10]


def test_rows_and_sql(spark):
    cars = files.rows_to_df(spark, [("chevy", 18.0), ("buick", 15.0)], "name string, mpg double")
    files.register_sql(cars, "cars_for_test")
    assert files.run_sql(spark, "select name from cars_for_test where mpg > 16").first()["name"] == "chevy"


def test_tailed_lines_restart(spark, tmp_path):
    log, check, seen = tmp_path / "log", str(tmp_path / "check"), []
    log.mkdir()
    (log / "a.log").write_text("one\ntwo\nhalf")
    spark.dataSource.register(TailedLines)

    def run():
        stream = spark.readStream.format("tailed_lines").option("path", str(log)).load()
        q = stream.writeStream.option("checkpointLocation", check).foreachBatch(collected(seen)).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    run()
    with open(log / "a.log", "a") as f:
        f.write(" done\n")
    (log / "b.log").write_text("three\n")
    run()
    assert sorted(r for _, rows in seen for r in rows) == [("a.log", 0, "one"), ("a.log", 4, "two"), ("a.log", 8, "half done"), ("b.log", 0, "three")]


def test_tailed_spans_split_between_lines(tmp_path):
    rng = random.Random(2)
    lines = ["x" * rng.randint(0, 9) for _ in range(200)]
    path = tmp_path / "f.log"
    path.write_text("".join(line + "\n" for line in lines) + "unfinished")
    end, reader = complete_bytes(*pafs.FileSystem.from_uri(str(path))), TailReader(str(tmp_path))
    for step in (1, 3, 7, 50, 10_000):
        got = [v for at in range(0, end, step) for b in reader.read(Span(path.name, 0, at, min(at + step, end))) for v in b.column("value").to_pylist()]
        assert got == lines


def test_avro_probe_tells_whether_decoding_works(spark):
    df = spark.range(1).select(F.lit(b"x").alias("value"))
    try:
        messages.decode_avro(df)
        works = True
    except Exception:
        works = False
    assert messages.has_avro(spark) == works


def test_jdbc_merge_stages_the_newest_row(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    staged, said = [], []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode, properties: staged.extend(self._df.collect()))
    batch = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "only", 1)], "id int, v string, at int")
    sinks.jdbc_merge("url", "t", "staging", "id", ["v"], {}, said.append, order="at")(batch, 0)
    assert sorted(map(tuple, staged)) == [(1, "new"), (2, "only")] and "ON CONFLICT (id)" in said[0]


class FileConnection:
    """Stand-in for a database connection: committed rows go to a file."""

    def __init__(self, folder, fail_on=None):
        self.folder, self.fail_on, self.rows = folder, fail_on, []

    def cursor(self):
        return self

    def execute(self, statement, values):
        if self.fail_on is not None and values[0] == self.fail_on:
            raise ValueError("constraint")
        self.rows.append(values)

    def commit(self):
        import uuid

        Path(self.folder, f"{uuid.uuid4().hex}.txt").write_text("\n".join(map(repr, self.rows)))

    def rollback(self):
        self.rows = []

    def close(self):
        pass


def committed(folder):
    return sorted(line for f in Path(folder).glob("*.txt") for line in f.read_text().splitlines())


def test_transactional_writer(spark, tmp_path):
    src, good, bad = tmp_path / "src", tmp_path / "good", tmp_path / "bad"
    good.mkdir(), bad.mkdir()
    rows = spark.createDataFrame([("chevy", 130), ("bike", None)], "name string, hp int")
    rows.coalesce(1).write.parquet(str(src))

    def run(folder, fail_on, accept=None):
        writer = sinks.TransactionalWriter(lambda: FileConnection(str(folder), fail_on), "insert into cars values (?, ?)", ["name", "hp"], accept)
        q = spark.readStream.schema(rows.schema).parquet(str(src)).writeStream.foreach(writer).trigger(availableNow=True).start()
        q.awaitTermination()

    run(good, None)
    assert committed(good) == ["('bike', None)", "('chevy', 130)"]
    with pytest.raises(Exception, match="constraint"):
        run(bad, "bike")
    assert committed(bad) == []
    run(bad, None, accept=lambda partition, epoch: False)
    assert committed(bad) == []


def test_push_with_retry(spark, tmp_path):
    folder = str(tmp_path)

    def send(rows):
        marker = Path(folder, f"tried-{rows[0][0]}")
        if not marker.exists():
            marker.write_text("x")
            raise ConnectionError("down")
        Path(folder, f"ok-{rows[0][0]}.n").write_text(str(len(rows)))

    sinks.push_partitions(send, chunk=10, first_wait=0.01)(spark.range(0, 95, 1, 2), 0)
    sizes = [int(f.read_text()) for f in Path(folder).glob("*.n")]
    assert sum(sizes) == 95 and max(sizes) == 10

    def broken(rows):
        raise ConnectionError("still down")

    with pytest.raises(Exception, match="still down"):
        sinks.push_partitions(broken, attempts=2, first_wait=0.01)(spark.range(3), 0)


def test_paced_writer():
    time, slept, written = [0.0], [], []

    def sleep(s):
        slept.append(s)
        time[0] += s

    sinks.paced(written.append, 10, now=lambda: time[0], sleep=sleep)(iter(range(21)))
    assert written == list(range(21)) and time[0] == pytest.approx(2.0)


def test_rate_limited_upsert_keeps_newest(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "only", 1)], "id int, v string, at int")
    sinks.rate_limited_upsert(lambda r: Path(folder, f"{r['id']}.n").write_text(r["v"]), "id", "at", 1000)(df, 0)
    assert {f.name: f.read_text() for f in tmp_path.glob("*.n")} == {"1.n": "new", "2.n": "only"}


def test_chunked_ack(spark, tmp_path):
    folder = str(tmp_path)
    acks = sinks.chunked_ack(spark.range(0, 1037, 1, 3), FolderReceiver(folder, ["id"], "id").send, 100).collect()
    assert sorted(r["id"] for r in spark.read.json(folder).collect()) == list(range(1037))
    assert sum(r["size"] for r in acks) == 1037 and max(r["size"] for r in acks) == 100
    assert all(len({r["chunk"] for r in acks if r["part"] == p}) == sum(r["part"] == p for r in acks) for p in (0, 1, 2))


def test_keyed_table_compacts_and_repeats(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), ["k"], spark.createDataFrame([], "k int, v string, at int").schema, compact_every=2)
    write = table.upsert("at")
    batches = [[(1, "a", 1), (2, "b", 1)], [(1, "c", 1), (1, "d", 2)], [(3, "e", 1)], [(2, "f", 1)], [(1, "g", 1)]]
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, table.schema)
        write(df, n)
        if n == 3:
            write(df, n)
    assert {r["k"]: r["v"] for r in table.read().collect()} == {1: "g", 2: "f", 3: "e"}
    assert {r["k"]: r["v"] for r in table.read(1).collect()} == {1: "d", 2: "b"}
    assert sinks.child_numbers(spark, str(tmp_path / "t" / "snapshot"), "v") == [1, 3]


def test_schema_evolution(spark):
    schema = spark.createDataFrame([], "ID long, price double, note string, n int").schema
    assert sinks.alter_statements("t", ["id"], schema) == [
        "ALTER TABLE t ADD COLUMN price DOUBLE PRECISION", "ALTER TABLE t ADD COLUMN note TEXT", "ALTER TABLE t ADD COLUMN n TEXT"]


def test_slug(spark):
    df = spark.createDataFrame([("Ford-F 150!",)], "s string")
    assert df.select(sinks.slug("s").alias("x")).first()["x"] == "fordf150"


def test_threshold_file_changes_between_batches(spark, tmp_path):
    src, limit, seen = tmp_path / "src", tmp_path / "limit.txt", []
    src.mkdir()
    for i in range(3):
        spark.createDataFrame([(1,), (5,), (9,)], "value int").coalesce(1).write.mode("append").parquet(str(src))
    texts = [None, "4", "oops"]

    def load(session, n):
        if texts[n] is not None:
            limit.write_text(texts[n])
        return threshold_file(session, str(limit))

    build = lambda s: s.readStream.schema("value int").option("maxFilesPerTrigger", 1).parquet(str(src))
    for_each_batch(spark, build, dynamic_threshold(load, "value", collected(seen)))
    assert [rows for _, rows in seen] == [[(1,), (5,), (9,)], [(5,), (9,)], [(1,), (5,), (9,)]]


def test_keywords_change_between_batches(spark, tmp_path):
    seen = []
    for i in range(2):
        (tmp_path / f"{i}.txt").write_text("Spark rocks\nhello\n")
    lists = [["spark"], ["HELLO"]]
    for_each_batch(spark, lambda s: files.read_lines(s, str(tmp_path), 1), dynamic_keywords(lambda n: lists[n], "value", collected(seen)))
    assert [rows for _, rows in seen] == [[("Spark rocks",)], [("hello",)]]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cut_of_the_stream_gives_the_batch_result(spark, sf_dir, seed):
    """Random slice widths: complete mode equals the table form."""
    from tributary.operators import windows as W

    width = random.Random(seed).randint(2 * 86400, 12 * 86400)
    events = read_table(spark, sf_dir, "events")
    staged = stage(events, "ts", width, f"cut-{seed}")
    aggs = {"n": ("count", "*"), "hi": ("max", "value")}
    stream = replay(spark, lambda s: W.sliding(staged.stream(s), "ts", "12 hours", "4 hours", aggs, ["event_type"]), "complete")
    table = W.sliding(events, "ts", "12 hours", "4 hours", aggs, ["event_type"])
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, table.collect()))


def test_triggers_and_two_queries(spark, tmp_path):
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "src"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "src"))

    def start(name):
        writer = stream.writeStream.format("memory").queryName(name)
        return lambda: monitor.with_trigger(writer, "once").start()

    queries = monitor.run_all([start("first_copy"), start("second_copy")])
    assert spark.table("first_copy").count() == spark.table("second_copy").count() == 4
    assert monitor.progress_table(spark, *queries).where("input_rows = 4").count() == 2
    q = monitor.with_trigger(stream.writeStream.format("noop"), "every", "1 second").start()
    q.processAllAvailable()
    q.stop()
    # the continuous source holds one slot per partition, so it takes fewer than there are; stop after its first epoch
    spark.conf.set("spark.sql.streaming.stopTimeout", "60s")
    rate = spark.readStream.format("rate").option("numPartitions", 2).load()
    q = monitor.with_trigger(rate.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")), "continuous", "1 second").start()
    try:
        until = time.monotonic() + 30
        while not q.recentProgress and q.isActive and time.monotonic() < until:
            time.sleep(0.2)
    finally:
        q.stop()
        spark.conf.unset("spark.sql.streaming.stopTimeout")
    with pytest.raises(ValueError):
        monitor.with_trigger(stream.writeStream, "sometimes")


def test_output_mode_rules(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "src"))
    counts = spark.readStream.schema("id long").parquet(str(tmp_path / "src")).groupBy("id").count()
    with pytest.raises(Exception, match="(?i)append"):
        counts.writeStream.outputMode("append").format("noop").start()
    for mode in ("complete", "update"):
        q = counts.writeStream.outputMode(mode).format("noop").trigger(availableNow=True).start()
        q.awaitTermination()


