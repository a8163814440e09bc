import gzip
import hashlib
import io

import pytest

from tests.oracle import compare, connect
from tributary.llm import warc as W
from tributary.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def pages(spark):
    long = "<p>" + "é" * 200 + "</p>"
    rows = [(5, "http://a/5", long), (3, "http://a/3", long), (3, "http://a/3", long), (9, None, "short"), (8, "u\r\nX: y", "short"), (7, "http://a/7", None),
            (None, "http://a/n", long), (10, "http://a/10", "x" * 3_000_000), (11, "http://a/11", ""), (12, "http://a/12", "y" * 100), (13, "http://a/13", "y" * 100), (14, "z", "v" * 99), (15, "z", "v" * 99)]
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, record_type string")


def expected(rows):
    first = {}
    for r in rows:
        body = (r.html or "").encode()
        if len(body) >= 100 and r.page_id is not None:
            first[body] = min(first.get(body, r.page_id), r.page_id)
    out = []
    for r in rows:
        body = (r.html or "").encode()
        f = first.get(body)
        revisit = f is not None and f != r.page_id
        out.append((r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, pages):
    got = W.archived(pages)
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()], key=str) == expected(pages.collect())
    assert W.archived(pages.limit(0)).count() == 0


def test_files_are_plain_gzip_members(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    W.write_warc(W.page_records(pages.repartition(2)), path)
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "w").glob("*.warc.gz"))
    assert raw.count(b"WARC/1.1\r\n") == pages.count() and b"u%0D%0AX: y" in raw
    # what no manifest lists is not read
    (tmp_path / "w" / "part-99999-lost.warc.gz").write_bytes(next((tmp_path / "w").glob("*.warc.gz")).read_bytes())
    assert W.read_warc(spark, path).count() == pages.count()


def test_predicates_are_pushed_and_payloads_skipped(spark, pages, tmp_path):
    path = str(tmp_path / "p")
    W.write_warc(W.page_records(pages.coalesce(1)), path)
    reader = W.WarcReader({"path": path})
    f = W.EqualTo(("record_type",), "revisit")
    assert list(reader.pushFilters([f, W.EqualTo(("http_length",), 5)])) == [W.EqualTo(("http_length",), 5)] and reader.tests == [("warc-type", "EqualTo", "revisit")]
    plan = W.read_warc(spark, path).where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("Filters", "").replace("PushedFilter", "")
    counted = []
    real = W.Record._more
    W.Record._more = lambda self, n: counted.append(n) or real(self, n)
    try:
        rows = [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]
    finally:
        W.Record._more = real
    assert {r["record_type"] for r in rows} == {"revisit"} and max(counted) <= W.WINDOW
    # the 3 MB payload was skipped by its member's length, not inflated
    assert sum(counted) < 1_000_000
    for condition, n in (("record_id = '<urn:page:9>'", 1), ("record_id in ('<urn:page:9>', '<urn:page:8>')", 2), ("target_uri is null", 1), ("target_uri like 'http://a/1%'", 4), ("http_length > 1000000", 1), ("refers_to is not null", 3)):
        assert W.read_warc(spark, path).where(condition).count() == n, condition
    assert W.read_warc(spark, path, payload=False).where("payload is not null").count() == 0


def test_foreign_archives(spark, tmp_path):
    record = W.record_bytes({"record_type": "response", "record_id": "<urn:x>", "record_date": None, "target_uri": "t", "payload_digest": None, "refers_to": None, "payload": b"hello" * 9000, "http_length": None})
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n"
    (tmp_path / "one.warc").write_bytes(info + record)
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(record))
    rows = W.read_warc(spark, str(tmp_path)).collect()
    assert sorted(r.record_type for r in rows) == ["response", "response", "warcinfo", "warcinfo"]
    assert {bytes(r.payload) for r in rows} == {b"hello" * 9000, b"a: b"}


def test_members_name_their_length():
    raw = W.member(b"abc" * 1000)
    assert gzip.decompress(raw) == b"abc" * 1000 and raw[12:14] == b"sl" and int.from_bytes(raw[16:20], "little") == len(raw)
    assert gzip.GzipFile(fileobj=io.BytesIO(raw + raw)).read() == b"abc" * 2000


def test_query_equals_its_twin(spark, sf_dir):
    assert not compare(QUERIES["op8_warc"](spark, sf_dir), connect(sf_dir), SQL["op8_warc"])


def test_many_records_in_a_member_and_broken_records(tmp_path):
    rows = [{c: None for c in W.HEADER_OF} | {"record_type": "response", "record_id": f"r{i}", "http_length": None, "payload": bytes([65 + i % 26]) * n}
            for i, n in enumerate((5, 0, 3_000_000, 70, *range(400, 600)))]
    raw = [W.record_bytes(r) for r in rows]
    shapes = {
        "one": gzip.compress(b"".join(raw)), "each": b"".join(map(gzip.compress, raw)), "plain": b"".join(raw), "own": b"".join(map(W.member, raw)),
        "pairs": b"".join(gzip.compress(b"".join(raw[i : i + 2])) for i in range(0, len(raw), 2)),
    }
    for name, data in shapes.items():
        for touch in (True, False):  # with blocks read and with blocks passed over
            got = []
            for r in W.records(W.Source(pa_file(data))):
                got.append((r.headers["warc-record-id"], r.block().partition(b"\r\n\r\n")[2] if touch else None))
            assert got == [(r["record_id"], r["payload"] if touch else None) for r in rows], name
    for broken in (shapes["plain"] + b"\0" * 40, shapes["each"] + gzip.compress(b"no record")):
        with pytest.raises(ValueError, match="without headers"):
            list(W.records(W.Source(pa_file(broken))))


def pa_file(data):
    import pyarrow as pa

    return pa.BufferReader(data)


def record(ident, payload=b"p" * 50, kind="response"):
    return {c: None for c in W.HEADER_OF} | {"record_type": kind, "record_id": f"<urn:page:{ident}>", "http_length": None, "content_length": None, "payload": payload}


def rows_of(spark, *idents, **options):
    return spark.createDataFrame([record(i, **options) for i in idents], W.SCHEMA)


def idents(spark, path):
    return sorted(int(r.record_id[10:-1]) for r in W.read_warc(spark, path).collect())


def test_appends_overwrites_and_foreign_archives(spark, tmp_path):
    path = str(tmp_path / "a")
    W.write_warc(rows_of(spark, 1), path)
    W.write_warc(rows_of(spark, 2, 3), path)
    W.write_warc(rows_of(spark, 1), path)
    assert idents(spark, path) == [1, 1, 2, 3]
    W.write_warc(rows_of(spark, 7), path, "overwrite")
    assert idents(spark, path) == [7]
    W.write_warc(rows_of(spark, 8), path)
    assert idents(spark, path) == [7, 8]
    W.write_warc(rows_of(spark, 1).limit(0), path, "overwrite")
    assert idents(spark, path) == []
    foreign = tmp_path / "b"
    foreign.mkdir()
    (foreign / "old.warc.gz").write_bytes(gzip.compress(W.record_bytes(record(50))))
    (foreign / f"pages-{'0' * 32}-0-0.warc.gz").write_bytes(gzip.compress(W.record_bytes(record(60))))  # of a write that failed
    (foreign / "._manifest-0000000001-x.json.part").write_bytes(b'{"over')  # half a manifest
    assert idents(spark, str(foreign)) == [50]
    W.write_warc(rows_of(spark, 51), str(foreign))
    W.write_warc(rows_of(spark, 52), str(foreign))
    assert idents(spark, str(foreign)) == [50, 51, 52]


def test_long_files_are_read_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "START_BYTES", 2000)

    class Context:
        taskAttemptId = staticmethod(lambda: 0)

    monkeypatch.setattr(W.TaskContext, "get", staticmethod(Context))
    rng = __import__("random").Random(1)
    rows = [record(i, rng.randbytes(rng.randint(0, 900))) for i in range(200)]
    import pyarrow as pa

    kinds = pa.schema([(c, pa.string()) for c in W.HEADER_OF] + [("content_length", pa.int64()), ("http_length", pa.int64()), ("payload", pa.binary())])
    writer = W.WarcWriter(str(tmp_path), 1 << 30)
    writer.commit([writer.write(iter([pa.RecordBatch.from_pylist(rows, schema=kinds)]))])
    for most in (1, 5000, 1 << 30):
        reader = W.WarcReader({"path": str(tmp_path), "maxpartitionbytes": str(most)})
        parts = reader.partitions()
        got = [r for part in parts for b in reader.read(part) for r in b.to_pylist()]
        assert [(r["record_id"], r["payload"]) for r in got] == [(r["record_id"], r["payload"]) for r in rows]
        assert (len(parts) > 10) == (most < 1 << 30)


def test_only_http_records_have_an_http_head(spark, tmp_path):
    W.write_warc(rows_of(spark, 1, payload=b"GET / HTTP/1.1\r\n\r\nx", kind="metadata"), str(tmp_path / "m"))
    row = W.read_warc(spark, str(tmp_path / "m")).first()
    assert bytes(row.payload) == b"GET / HTTP/1.1\r\n\r\nx" and row.content_length == 19 and row.http_length is None
