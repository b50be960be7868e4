"""Archives: round trips, revisits against plain Python, pushed filters, skipped blocks, lost tasks."""

import gzip
import hashlib
import io
import os
import random

import pytest

from tributary.llm import warc
from tributary.llm.warc import PushedReader, Writer, page_archives, planned, read_archives, record_bytes, records, write_archives

KINDS = "record_id string, record_type string, target_uri string, date string, refers_to string, headers map<string,string>, payload binary"


def rows_of(n=40):
    rng = random.Random(3)
    out = []
    for k in range(n):
        payload = bytes(rng.randrange(256) for _ in range(rng.choice([0, 5, 300, 5000]))) + b"\r\n\r\nWARC/1.1\r\n" * (k % 3)
        out.append((f"<urn:x:{k}>", ["response", "resource", "metadata"][k % 3], f"http://h/{k}?é=\r\nWARC-Type: evil", "2024-01-01T00:00:00Z", None, {"X-Own": f"v{k}", "WARC-Type": "never", "bad name": "x"}, payload))
    return out


@pytest.mark.parametrize("compress", ["true", "false"])
def test_records_come_back_as_they_were(spark, tmp_path, compress):
    rows, path = rows_of(), str(tmp_path / "a")
    write_archives(spark.createDataFrame(rows, KINDS).repartition(3), path, compress=compress, max_file_bytes="20000", split_bytes="3000")
    got = {r.record_id: r for r in read_archives(spark, f"file://{path}", target_bytes="5000").collect()}
    assert len(got) == len(rows) and len(planned(path, 5000)) > len(os.listdir(path)) > 4
    for i, kind, uri, date, _, _, payload in rows:
        r = got[i]
        assert (r.record_type, r.date, r.payload, r.payload_bytes) == (kind, date, payload, len(payload))
        assert r.target_uri == uri.replace("\r", "%0D").replace("\n", "%0A") and r.payload_digest == f"sha256:{hashlib.sha256(payload).hexdigest()}"
        assert r.headers["x-own"] == f"v{i[7:-1]}" and "bad name" not in r.headers
    brief = read_archives(spark, path, payload="false").collect()
    assert {(r.record_id, r.payload_bytes) for r in brief} == {(r[0], len(r[6])) for r in rows} and not any(r.payload for r in brief)


@pytest.mark.parametrize("compress", [True, False])
def test_unwanted_blocks_are_not_read(tmp_path, compress):
    """A record that filters leave out has only its header read: its block is damaged here, and nobody notices."""
    writer = Writer({"path": str(tmp_path), "compress": str(compress).lower()})
    parts = [writer._record({"record_type": kind, "record_id": f"<{n}>", "payload": os.urandom(3 << 20)}) for n, kind in enumerate(["resource", "response", "resource"])]
    whole = bytearray(b"".join(parts))
    at = len(parts[0]) + len(parts[1])
    whole[len(parts[0]) // 2] ^= 255
    whole[at + len(parts[2]) // 2] ^= 255

    class Counting(io.BytesIO):
        count = 0

        def read(self, n=-1):
            got = super().read(n)
            self.count += len(got)
            return got

    file = Counting(bytes(whole))
    got = list(records(file, compress, 0, None, [("in", "warc-type", ("response",))], True))
    assert [r["record_id"] for r in got] == ["<1>"] and len(got[0]["payload"]) == 3 << 20 and file.count < len(whole) * 0.8
    file = Counting(bytes(whole))
    assert len(list(records(file, compress, 0, None, [], False))) == 3 and file.count < len(whole) * 0.5
    with pytest.raises(ValueError, match="byte 0"):
        list(records(io.BytesIO(bytes(whole)), compress, 0, None, [], True))


def test_filters_reach_the_reader(spark, tmp_path):
    path = str(tmp_path / "a")
    write_archives(spark.createDataFrame(rows_of(), KINDS), path)
    table = read_archives(spark, path)
    whole = spark.createDataFrame(table.collect(), table.schema)
    conditions = ["record_type = 'response'", "record_type in ('metadata', 'x')", "target_uri like 'http://h/1%'", "refers_to is null", "refers_to is not null", "record_type = 'response' and record_id = '<urn:x:3>'", "record_type = 'response' or record_id = '<urn:x:4>'", "payload_bytes > 300"]
    for condition in conditions:
        wanted = sorted(r.record_id for r in whole.where(condition).collect())
        assert sorted(r.record_id for r in read_archives(spark, path, condition).collect()) == wanted
        assert sorted(r.record_id for r in table.where(condition).collect()) == wanted and table.count() == 40
    both = read_archives(spark, path, conditions[0]).union(read_archives(spark, path, conditions[1], payload="false"))
    assert both.groupBy("record_type").count().count() == 2
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, StringStartsWith

    reader = PushedReader({"path": path})
    left = [EqualTo(("payload_bytes",), 3), GreaterThan(("date",), "2"), EqualTo(("headers", "x"), "y")]
    taken = [EqualTo(("record_type",), "response"), In(("record_id",), ("a", "b")), StringStartsWith(("target_uri",), "h"), IsNull(("refers_to",))]
    assert list(reader.pushFilters([*left, *taken])) == left and len(reader.tests) == 4


def test_archives_of_others(tmp_path):
    """Whole-file gzip members without lengths, folded and lower-case headers, more line ends than need be, no index."""
    one = b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <i>\r\nX: a\r\n b\r\ncontent-length: 3\r\n\r\nabc\r\n\r\n"
    two = record_bytes({"WARC-Type": "response", "Content-Type": "application/http;msgtype=response"}, b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>")
    for name, content in (("a.warc", one + b"\r\n\r\n" + two), ("b.warc.gz", gzip.compress(one) + gzip.compress(two))):
        (tmp_path / name).write_bytes(content)
        got = list(records(io.BytesIO(content), name.endswith("gz"), 0, None, [], True))
        assert [(r["record_type"], r["payload"]) for r in got] == [("warcinfo", b"abc"), ("response", b"<p>")] and dict(got[0]["headers"])["x"] == "a b"
        brief = list(records(io.BytesIO(content), name.endswith("gz"), 0, None, [], False))
        assert [r["payload_bytes"] for r in brief] == [3, 3]
        with pytest.raises(ValueError, match="byte"):
            list(records(io.BytesIO(content[:-12]), name.endswith("gz"), 0, None, [], True))
    assert len(planned(str(tmp_path), 1)) == 2
    with pytest.raises(FileNotFoundError):
        planned(str(tmp_path / "none"), 1)


def test_what_failed_tasks_leave_is_not_read(spark, tmp_path):
    import pyarrow as pa

    path = str(tmp_path / "a")
    write_archives(spark.createDataFrame(rows_of(9), KINDS), path)
    lost = Writer({"path": path})
    told = lost.write(iter([pa.RecordBatch.from_pylist([{"record_id": "<lost>", "payload": b"x"}])]))
    assert read_archives(spark, path).count() == 9 and len(told.files) == 1
    lost.abort([told, None])
    assert not os.path.exists(f"{path}/{told.files[0][0]}")

    def broken():
        yield pa.RecordBatch.from_pylist([{"record_id": "<half>", "payload": b"x"}])
        raise RuntimeError("lost")

    before = sorted(os.listdir(path))
    with pytest.raises(RuntimeError):
        lost.write(broken())
    assert sorted(os.listdir(path)) == before
    write_archives(spark.createDataFrame(rows_of(3), KINDS), path)
    assert read_archives(spark, path).count() == 12


def brute(pages):
    out, first = [], {}
    for i, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        raw = (html or "").encode()
        new = len(raw) < 100 or raw not in first
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if new else "revisit", None if new else first[raw]))
        first.setdefault(raw, i)
    return out


@pytest.mark.parametrize("few", [0, 1000])
def test_pages_against_plain_python(spark, few, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", few)
    rng = random.Random(8)
    bodies = ["<p>" + "".join(rng.choices("abé \r\n", k=k)) for k in (0, 50, 96, 97, 98, 500, 200_000)]
    pages = [(n, rng.choice([*bodies, None, ""])) for n in range(120)] + [(200 + n, bodies[5]) for n in range(100)]
    pages += [(3, bodies[5]), (3, bodies[5]), (None, bodies[4]), (None, "a" * 100), (-5, bodies[6])]
    table = spark.createDataFrame([(i, f"http://h/{i}\n", h, "x", b"y") for i, h in pages], "page_id long, url string, html string, record_type string, payload binary").repartition(4)
    got = sorted(map(tuple, page_archives(table).collect()), key=repr)
    assert got == sorted(brute(pages), key=repr)
    assert page_archives(table.limit(0)).count() == 0


def test_ids_of_text(spark):
    table = spark.createDataFrame([("a:1>\n", None, "x" * 200), ("", "u", "x" * 200), (None, "u", "x" * 200)], "page_id string, url string, html string")
    assert sorted((r.page_id or repr(r.page_id), r.record_type, r.refers_to) for r in page_archives(table, compress=False).collect()) == [("''", "response", None), ("None", "revisit", ""), ("a:1>\n", "revisit", "")]
