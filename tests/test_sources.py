import gzip
import io
import json
from dataclasses import replace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.operators.dedupe import unseen
from tributary.plans import checkpoint, config, ingest
from tributary.sources import catalogue, files, http, retry, tail, tasks
from tributary.sources.paged import Feed, Page, paged_source, slices, walk
from tributary.streaming.dedupe import within_ttl, within_watermark
from tributary.streaming.sinks import to_each, to_memory, to_parquet


class FakeApi:
    """A feed of one record a second, three a page."""

    def __init__(self, n=20, repeat_cursor=False):
        self.n, self.repeat_cursor = n, repeat_cursor

    def fetch(self, feed, since, until, cursor):
        found = [{"id": i, "t": i * 1000} for i in range(self.n) if since <= i * 1000 < until]
        at = cursor or 0
        more = at + 3 < len(found)
        return Page(found[at : at + 3], (at + 3 if not self.repeat_cursor else 1) if more else None)


FEED = Feed("f", lambda i: str(i["id"]), lambda i: i["t"], lag=0, lookback=60_000, slice=5_000)


def test_batch_read_walks_all_pages_and_takes_bounds(spark):
    spark.dataSource.register(paged_source("fake_batch", [FEED], FakeApi(), clock=lambda: 30_000))
    rows = spark.read.format("fake_batch").option("since", 0).load()
    assert sorted(int(r.id) for r in rows.collect()) == list(range(20))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = spark.read.format("fake_batch").option("since", 0).option("push_filters", "true").load()
    assert rows.where("event_time >= timestamp'1970-01-01 00:00:15'").count() == 5
    assert rows.where("event_time < timestamp'1970-01-01 00:00:03'").count() == 3


def test_stream_reads_each_record_once(spark, tmp_path):
    spark.dataSource.register(paged_source("fake_stream", [FEED], FakeApi(), clock=lambda: 12_000))
    query = to_parquet(spark.readStream.format("fake_stream").option("since", 0).load(), str(tmp_path / "out"), str(tmp_path / "c"))
    query.processAllAvailable()
    query.stop()
    assert sorted(int(r.id) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(12))


def test_cursor_that_comes_back_fails():
    with pytest.raises(RuntimeError):
        list(walk(FakeApi(repeat_cursor=True), FEED, 0, 20_000))
    assert [(s.since, s.until) for s in slices("f", 0, 25, 10)] == [(0, 10), (10, 20), (20, 25)]


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    table = pa.table({"a": ["x", None], "b": pa.array([2**53 + 1, None])})
    buffer = io.BytesIO()
    pq.write_table(table, buffer)
    (tmp_path / "in/rows.parquet.gz").write_bytes(gzip.compress(buffer.getvalue()))
    (tmp_path / "in/odd.bin").write_bytes(buffer.getvalue())
    (tmp_path / "in/lines.txt.gz").write_bytes(gzip.compress(b"one\n\ntwo"))
    (tmp_path / "in/plain.txt").write_bytes(b"three")
    (tmp_path / "in/bad.gz").write_bytes(b"no gzip")
    got = files.bundles(spark, str(tmp_path / "in")).collect()
    assert sorted(r.text for r in got if r.text and not r.text.startswith("{")) == ["one", "three", "two"]
    assert [json.loads(r.text) for r in got if r.text and r.text.startswith("{")] == [{"a": "x", "b": 2**53 + 1}, {"a": None, "b": None}] * 2
    assert [r.path.rsplit("/")[-1] for r in got if r.error] == ["bad.gz"]
    with pytest.raises(files.TooLarge):
        files.unpacked(gzip.compress(b"x" * 5000), most=100)
    assert sorted(r.text for r in files.lines(spark, str(tmp_path / "in"), "*.txt*").collect()) == ["one", "three", "two"]
    before = files.versions(spark, str(tmp_path / "in")).toPandas()
    (tmp_path / "in/plain.txt").write_bytes(b"three, again")
    changed = unseen(files.versions(spark, str(tmp_path / "in")), spark.createDataFrame(before), ["path", "length"]).collect()
    assert [r.path.rsplit("/")[-1] for r in changed] == ["plain.txt"]
    (tmp_path / "rows.parquet").write_bytes(buffer.getvalue())
    assert [r.text for r in files.parquet_rows(spark, str(tmp_path / "rows.parquet")).collect()][1] == '{"a":null,"b":null}'
    marks = spark.read.format("binaryFile").load(str(tmp_path / "in")).select("path", files.is_parquet(F.col("path"), F.col("content")).alias("p")).collect()
    assert [r.path.rsplit("/")[-1] for r in marks if r.p] == ["odd.bin"]


def test_pod_logs_and_stream(spark, tmp_path):
    import os

    for name, text, age in (("0.log", "old", 100), ("1.log", "new", 0)):
        folder = tmp_path / "pods/ns_web-1_u1/app"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)
        os.utime(folder / name, (1_700_000_000 - age,) * 2)
    assert [(r.pod_name, r.text) for r in files.pod_logs(spark, str(tmp_path / "pods")).collect()] == [("web-1", "new")]
    assert files.pod_logs(spark, str(tmp_path / "pods"), exclude="web").count() == 0
    (tmp_path / "s").mkdir()
    (tmp_path / "s/a.txt").write_text("x\ny\nx")
    got = []
    query = to_each(files.line_stream(spark, str(tmp_path / "s")), lambda df, _: got.extend(r.text for r in df.collect()), str(tmp_path / "c"), once=True)
    query.awaitTermination(60)
    assert sorted(got) == ["x", "x", "y"]


def test_mail_parts(spark):
    mail = "From: a\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary=B\n\n--B\nContent-Type: text/plain\n\nhello\n--B\nContent-Type: application/pdf\nContent-Disposition: attachment; filename=x.pdf\nContent-Transfer-Encoding: base64\n\nAAEC\n--B--\n"
    got = files.mail_parts(spark.createDataFrame([(1, mail), (2, None)], "i int, text string")).where("i = 1").orderBy("part_no").collect()
    odd = "Content-Type: text/plain; charset=x-unknown\nContent-Transfer-Encoding: 8bit\n\nhello"
    assert [r.body for r in files.mail_parts(spark.createDataFrame([(1, odd)], "i int, text string")).collect()] == ["hello"]
    assert got[0].body.strip() == "hello" and bytes(got[1].attachment) == b"\x00\x01\x02" and got[1].name == "x.pdf"


def test_streaming_dedupe(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:30"), (2, "2024-01-01 00:01:00")], "k int, t string").write.json(str(tmp_path / "in/a"))
    stream = spark.readStream.schema("k int, t timestamp").json(str(tmp_path / "in/*"))
    query = to_memory(within_watermark(stream, ["k"], "t", "1 hour"), "deduped")
    query.processAllAvailable()
    query.stop()
    assert sorted(r.k for r in spark.table("deduped").collect()) == [1, 2]


def test_time_to_live_outlasts_a_batch(spark, tmp_path):
    import time

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"k":1,"v":1}\n{"k":1,"v":2}\n{"k":2,"v":3}\n')
    stream = spark.readStream.schema("k int, v int").json(str(tmp_path / "in"))
    query = to_memory(within_ttl(stream, ["k"], 3600), "alive")

    def rows(n):
        end = time.time() + 60
        while time.time() < end and spark.table("alive").count() < n:
            time.sleep(0.5)
        return sorted((r.k, r.v) for r in spark.table("alive").collect())

    assert rows(2) == [(1, 1), (2, 3)]
    (tmp_path / "in/b.json").write_text('{"k":1,"v":5}\n{"k":3,"v":6}\n')
    assert rows(3) == [(1, 1), (2, 3), (3, 6)]
    query.stop()


def test_checkpoint_rule():
    w = checkpoint.Walk
    assert checkpoint.advanced(100, w(newest=150), 1000, 50) == 950
    assert checkpoint.advanced(100, w(newest=150, complete=False), 1000, 50) == 150
    assert checkpoint.advanced(100, w(newest=990, complete=False), 1000, 50) == 950
    assert checkpoint.advanced(100, w(newest=150, failed=True), 1000, 50) == 100
    assert checkpoint.advanced(980, w(), 1000, 50) == 980
    assert checkpoint.is_stuck(100, w(newest=100, complete=False)) and not checkpoint.is_stuck(100, w(newest=100))


@given(st.integers(0, 10**6), st.none() | st.integers(0, 10**6), st.booleans(), st.booleans(), st.integers(0, 10**6), st.integers(0, 10**4))
def test_checkpoints_never_go_back_nor_pass_what_was_read(start, newest, complete, failed, now, lag):
    walk = checkpoint.Walk(newest, complete, failed)
    after = checkpoint.advanced(start, walk, now, lag)
    assert after >= start and (after == start or after <= now - lag)
    if failed:
        assert after == start
    if not complete:
        assert after == start or after <= newest


def test_config():
    got = config.parse_pairs(["a.b[0].c=1", "a.b[2].c=x", "a.flag=true", "bare", "z=", "n=007", "v=a=b"], {"n": str})
    assert got == {"a": {"b": [{"c": 1}, None, {"c": "x"}], "flag": True}, "z": "", "n": "007", "v": "a=b"}
    with pytest.raises(ValueError):
        config.parse_pairs(["a=1", "a.b=2"])
    assert config.documents('{"file": {"client_options.platform": "text"}}') == [{"file": {"client_options.platform": "text"}}]
    assert config.dotted({"client_options.mapping.event_type_path": "x"}) == {"client_options": {"mapping": {"event_type_path": "x"}}}
    assert config.overlaid({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}


def test_ingest_plan(spark, tmp_path):
    (tmp_path / "one.txt").write_text('{"id":1,"kind":"a"}\n{"id":1,"kind":"a"}\n{"id":2,"kind":"b"}\n')
    (tmp_path / "two.txt").write_text('{"id":1,"kind":"c"}\nbare\nbare\n')
    own = {"client_options": {"mapping": {"event_type_path": "kind"}}}
    settings = [{"file": {"file_path": str(tmp_path / "one.txt"), **own}}, {"file": {"file_path": str(tmp_path / "two.txt"), **own}}]
    got = lambda **how: sorted((r.text if r.payload_kind == "text" else r.dedupe_key, r.event_type) for r in ingest.events(spark, settings, **how).select("payload_kind", "text", "dedupe_key", "event_type").collect())
    assert got() == [("1", "a"), ("1", "a"), ("1", "c"), ("2", "b"), ("bare", None), ("bare", None)]
    assert got(dedupe=True) == [("1", "a"), ("1", "c"), ("2", "b"), ("bare", None), ("bare", None)]
    settings[0]["file"]["dedupe"] = False
    assert got(dedupe=True) == got()


def test_parquet_cells_keep_all_they_have():
    import datetime
    import decimal

    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 678901)
    table = pa.table({
        "d": pa.array([0.1234567890123456, 1e-12, float("nan"), 1e300]), "n": pa.array([decimal.Decimal("12345678901234567.89"), None, decimal.Decimal("-0.01"), decimal.Decimal("0")], pa.decimal128(38, 2)),
        "t": pa.array([at] * 4, pa.timestamp("us", "America/New_York")), "z": pa.array([at] * 4, pa.timestamp("us")), "ns": pa.array([1_700_000_000_123_456_789] * 4, pa.timestamp("ns")), "b": [b"\x00\xff"] * 4,
        "day": [at.date()] * 4, "l": [[1, None]] * 4, "s": [{"x": "é\n"}] * 4, "m": pa.array([[("k", 2**63 - 1)]] * 4, pa.map_(pa.string(), pa.int64())), "u": pa.array([2**64 - 1] * 4, pa.uint64()),
    })
    buffer = io.BytesIO()
    pq.write_table(table, buffer)
    rows = list(files.records("x.parquet", buffer.getvalue()))
    assert '"d":0.1234567890123456,"n":12345678901234567.89,"t":"2024-01-02T03:04:05.678901Z","z":"2024-01-02T03:04:05.678901","ns":"2023-11-14T22:13:20.123456789","b":"AP8="' in rows[0]
    assert '"day":"2024-01-02","l":[1,null],"s":{"x":"é\\n"},"m":{"k":9223372036854775807},"u":18446744073709551615}' in rows[0]
    assert rows[1].startswith('{"d":1.0e-12,"n":null,') and rows[2].startswith('{"d":"NaN","n":-0.01') and json.loads(rows[3])["d"] == 1e300
    assert list(files.decoded("x.parquet", b"PAR1 broken PAR1"))[0][1] == [None]


def test_json_rows_keep_microseconds(spark):
    rows = spark.sql("select timestamp'2024-01-02 03:04:05.678901' t, timestamp_ntz'2024-01-02 03:04:05.000001' z, X'00FF' b, 1e-12D d, null n")
    assert files.json_rows(rows).first().text == '{"t":"2024-01-02T03:04:05.678901Z","z":"2024-01-02T03:04:05.000001","b":"AP8=","d":1.0E-12,"n":null}'


def test_http_reading(monkeypatch):
    client = http.HttpClient({"r": http.Request("https://x.test/a", "data", ("id",), ("t",), "from", "to", "s", "cursor", "c", "next", size=("n", 2))})
    asked = []
    monkeypatch.setattr(client, "_get", lambda url: (asked.append(url), ({"data": [{"id": 1, "t": 5}, {}], "next": "k"} if "c=" not in url else {"data": []}, None))[1])
    feed = http.feeds_of(client.requests)[0]
    assert list(walk(client, feed, 1000, 2000)) == [{"id": 1, "t": 5}] and asked[1] == "https://x.test/a?from=1&to=2&n=2&c=k"
    assert feed.id_of({"id": 1}) == "1" and feed.time_of({"t": "2024-01-01T00:00:00.1234567Z"}) == 1704067200123
    assert catalogue.requests("okta", host="h.test")["log"].url == "https://h.test/api/v1/logs"


class Ignorant:
    """A service that ignores bounds: five records, one of them without a time."""

    def __init__(self, forbidden=False):
        self.forbidden = forbidden

    def fetch(self, feed, since, until, cursor):
        if self.forbidden:
            raise retry.Refused(403)
        return Page([{"id": i, "t": i * 1000} for i in range(5)])


def test_records_outside_the_range_are_dropped(spark):
    whole = Feed("g", FEED.id_of, FEED.time_of, lag=0, slice=1_000, bounded=False)
    spark.dataSource.register(paged_source("ignorant", [Feed("f", FEED.id_of, FEED.time_of, lag=0, slice=1_000), whole], Ignorant(), clock=lambda: 30_000))
    got = spark.read.format("ignorant").option("since", 1000).option("until", 4000).load().collect()
    assert sorted((r.feed, r.id) for r in got) == [(f, str(i)) for f in "fg" for i in (1, 2, 3)]
    spark.dataSource.register(paged_source("forbidden", [whole], Ignorant(forbidden=True), clock=lambda: 30_000))
    assert spark.read.format("forbidden").option("skip_forbidden", "true").load().count() == 0
    with pytest.raises(Exception, match="refused with status 403"):
        spark.read.format("forbidden").load().count()


def test_pages_before_the_range_end_a_descending_walk():
    asked = []

    class Service:
        def fetch(self, feed, since, until, cursor):
            asked.append(cursor)
            at = cursor or 0
            return Page([{"id": i, "t": (100 - i) * 1000} for i in range(at, at + 10)], at + 10)

    feed = Feed("f", FEED.id_of, FEED.time_of, newest_first=True)
    assert len(list(walk(Service(), feed, 85_000, 95_000))) == 30 and asked == [None, 10, 20]


def test_requests_of_services():
    def client(service, **settings):
        requests = catalogue.requests(service, **settings)
        return http.HttpClient(requests), next(iter(requests))

    c, feed = client("servicenow", instance="i", table="sys_audit", query="x=1")
    url, body = c.asked(feed, 1_700_000_000_000, 1_700_000_060_000, 1000)
    assert body is None and "sysparm_query=x%3D1%5Esys_created_on%3E%3D2023-11-14+22%3A13%3A20%5Esys_created_on%3C2023-11-14+22%3A14%3A20%5EORDERBYsys_created_on%5EORDERBYsys_id" in url and "sysparm_offset=1000" in url
    assert http.feeds_of(c.requests)[0].bounded
    c, feed = client("defender")
    assert "%24filter=createdDateTime+ge+2023-11-14T22%3A13%3A20.000Z+and+createdDateTime+lt+" in c.asked(feed, 1_700_000_000_000, 1_700_000_060_000, None)[0]
    c, feed = client("mimecast")
    body = c.asked(feed, 0, 1000, "p2")[1]
    assert body == {"data": [{"startDateTime": "1970-01-01T00:00:00.000Z", "endDateTime": "1970-01-01T00:00:01.000Z"}], "meta": {"pagination": {"pageSize": 100, "pageToken": "p2"}}}
    c, feed = client("zendesk", host="h")
    assert c.asked(feed, 0, 1000, None)[0].count("filter%5Bcreated_at%5D%5B%5D=") == 2
    c, feed = client("threatlocker", instance="i", path="p")
    assert c.asked(feed, 0, 1000, None)[1]["isAscending"] is True
    assert not http.feeds_of(client("sophos", host="h")[0].requests)[0].bounded


def test_details_of_records(monkeypatch):
    answers = {"https://protectapi.cylance.com/detections/v2/a%2Fb/details": {"Id": "a/b", "more": 1}, "https://blob/1": [{"Id": "x"}, {"Id": "y"}]}
    c = http.HttpClient(catalogue.requests("cylance") | catalogue.requests("office365", tenant="t", content_type="c"))
    monkeypatch.setattr(c, "_get", lambda url, body=None: (answers.get(url) or ({"page_items": [{"Id": "a/b"}]} if "cylance" in url else [{"contentUri": "https://blob/1"}]), None))
    assert c.fetch("detections", 0, 1, None).items == [{"Id": "a/b", "more": 1}]
    assert c.fetch("content", 0, 1, None).items == [{"Id": "x"}, {"Id": "y"}]


def test_nothing_is_lost_silently(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/bad.gz").write_bytes(b"no gzip")
    (tmp_path / "in/large.txt").write_bytes(b"x" * 5000)
    (tmp_path / "in/log.txt").write_bytes(b"same\nother\nsame\n")
    assert sorted(r.path.rsplit("/")[-1] for r in files.bundles(spark, str(tmp_path / "in"), max_bytes=4000).where("error is not null").collect()) == ["bad.gz", "large.txt"]
    (tmp_path / "in/large.txt").unlink()
    got = ingest.events(spark, [{"bundles": {"path": str(tmp_path / "in")}}]).collect()
    assert sorted(r.text for r in got if r.payload_kind == "text") == ["other", "same", "same"]
    assert [r.text.startswith("bad gzip") for r in got if r.payload_kind == "error"] == [True]


def test_upper_bounds_of_whole_seconds_lose_nothing():
    assert http.written(20_500, "s") == "20" and http.written(20_500, "s", up=True) == "21" and http.written(21_000, "s", up=True) == "21"
    records = [{"id": n, "date_create": n} for n in range(15, 25)]

    class Seconds(http.HttpClient):
        def _get(self, url, body=None):
            low, high = (int(url.split(f"{name}=")[1].split("&")[0]) for name in ("oldest", "latest"))
            return {"entries": [r for r in records if low <= r["date_create"] < high]}, None

    client = Seconds(catalogue.requests("slack"))
    feed = http.feeds_of(client.requests)[0]
    got = [i["id"] for since, until in ((15_000, 20_500), (20_500, 25_000)) for i in walk(client, feed, since, until) if since <= feed.time_of(i) < until]
    assert got == [r["id"] for r in records]


@given(st.integers(0, 10**13), st.sampled_from(["iso", "ms", "s", "sql"]))
def test_written_bounds_enclose_the_range(ms, form):
    low, high = http.written(ms, form), http.written(ms, form, up=True)
    assert low == high if ms % http.UNITS[form] == 0 else low < high or len(low) < len(high)


def test_events_older_than_their_listing_are_kept(spark, served):
    base, answers = served
    answers["/content"] = [{"contentUri": f"{base}/blob/{n}", "contentCreated": at} for n, at in ((1, "1970-01-01T00:16:40Z"), (2, "1970-01-01T01:00:00Z"))]
    answers["/blob/1"] = [{"Id": "old", "CreationTime": "1970-01-01T00:00:05"}, {"Id": "new", "CreationTime": "1970-01-01T00:16:00"}]
    answers["/blob/2"] = [{"Id": "late", "CreationTime": "1970-01-01T00:16:45"}]
    request = replace(catalogue.requests("office365", tenant="t", content_type="c")["content"], url=f"{base}/content")
    feeds = http.feeds_of({"content": request})
    assert not feeds[0].checked
    spark.dataSource.register(paged_source("listed", feeds, http.HttpClient({"content": request}), clock=lambda: 0))
    got = spark.read.format("listed").option("since", 1_000_000).option("until", 1_060_000).load().collect()
    assert sorted(r.id for r in got) == ["new", "old"]


def test_mail_messages_are_listed_and_fetched(served):
    base, answers = served
    request = catalogue.requests("gmail", user="me")["messages"]
    request = replace(request, url=f"{base}/m", detail=f"{base}/m/{{id}}?format=full")
    answers["/m"] = lambda asked: {"messages": [{"id": "c"}]} if "pageToken=2" in asked else {"messages": [{"id": "a"}, {"id": "gone"}], "nextPageToken": "2"}
    answers |= {"/m/a": {"id": "a", "internalDate": "1700000000500"}, "/m/c": {"id": "c", "internalDate": "1700000003000"}}
    client = http.HttpClient({"messages": request})
    feed = http.feeds_of(client.requests)[0]
    got = list(walk(client, feed, 1_700_000_000_000, 1_700_000_009_500))
    assert [(i["id"], feed.time_of(i)) for i in got] == [("a", 1_700_000_000_500), ("gone", None), ("c", 1_700_000_003_000)]
    assert "q=after%3A1699999999+before%3A1700000010&" in client.asked("messages", 1_700_000_000_000, 1_700_000_009_500, None)[0]


def test_graphql_feeds(served, monkeypatch):
    base, answers = served
    records = [{"id": str(n), "createdAt": f"1970-01-01T00:00:{n:02d}Z"} for n in range(7)]

    def issues(sent):
        after = sent["variables"]["filterBy"]["createdAt"]["after"]
        found, at = [r for r in records if http.read_time(r["createdAt"]) > http.read_time(after)], int(sent["variables"].get("after", 0))
        return {"data": {"issues": {"nodes": found[at : at + 3], "pageInfo": {"endCursor": str(at + 3), "hasNextPage": True}}}}

    answers["/graphql"] = issues
    client = http.HttpClient(catalogue.requests("wiz", url=f"{base}/graphql", connection="data/issues", time_field="createdAt", query="query ($after: String) { issues { nodes { id } } }"))
    feed = http.feeds_of(client.requests)[0]
    assert "{ nodes { id } }" in client.requests["any"].body["query"]
    assert [i["id"] for i in walk(client, feed, 2_000, 60_000)] == ["2", "3", "4", "5", "6"] and not feed.bounded

    marks = {"": ("m1", records[:4]), "m1": ("m2", records[4:]), "m2": ("m2", [])}
    answers["/cato"] = lambda sent: {"data": {"eventsFeed": {"marker": marks[sent["variables"]["marker"]][0], "accounts": [{"id": sent["variables"]["account"], "records": [{"time": r["createdAt"], "fieldsMap": r} for r in marks[sent["variables"]["marker"]][1]]}]}}}
    request = catalogue.requests("cato", account="7")["events"]
    client = http.HttpClient({"events": replace(request, url=f"{base}/cato")})
    assert request.body["variables"]["account"] == "7"
    assert [http.feeds_of(client.requests)[0].time_of(i) for i in walk(client, http.feeds_of(client.requests)[0], 0, 60_000)] == [n * 1000 for n in range(7)]

    answers["/cato"] = {"errors": [{"message": "no such account"}]}
    with pytest.raises(RuntimeError, match="no such account"):
        client.fetch("events", 0, 1, None)
    told = iter([{"errors": [{"message": "rate limit for operation: eventsFeed"}]}, {"data": {}}])
    answers["/cato"] = lambda sent: next(told)
    monkeypatch.setattr("tributary.sources.tokens.persistently", lambda call: retry.persistently(call, sleep=lambda _: None))
    assert client.fetch("events", 0, 1, None).items == []


def test_log_queries_that_run_as_tasks(spark, served):
    base, answers = served
    asked, states = [], {"mail": ["Processing", "Ready"], "idle": ["Done"], "absent": ["Canceled"]}

    def submitted(sent):
        asked.append(sent)
        return {"data": {"taskId": sent["cloudService"]}}

    for name, told in states.items():
        left = list(told)
        answers[f"{tasks.QUERY_PATH}/{name}"] = lambda _, left=left: {"data": {"state": left.pop(0) if len(left) > 1 else left[0], "pageTokens": ["p0"], "errors": ["not set up"]}}
    answers[tasks.QUERY_PATH] = submitted
    pages = {"p0": ([{"id": 0, "t": 0}, {"id": 1, "t": 1000}], "p1"), "p1": ([{"id": 2, "t": 2000}], "NULL")}
    answers[tasks.RETRIEVE_PATH] = lambda sent: {"data": {"records": pages[sent["pageToken"]][0], "nextPageToken": pages[sent["pageToken"]][1]}}
    client = tasks.TaskClient(base, wait=0.0)
    feeds = [Feed(name, FEED.id_of, FEED.time_of, lag=0) for name in states]
    assert [i["id"] for i in walk(client, feeds[0], 0, 3000)] == [0, 1, 2] and list(walk(client, feeds[1], 0, 3000)) == []
    assert asked[0]["timeframe"] == {"startTime": "1970-01-01T00:00:00.000Z", "endTime": "1970-01-01T00:00:03.000Z"} and "filter" not in asked[0]
    with pytest.raises(retry.Refused, match="not set up"):
        list(walk(client, feeds[2], 0, 3000))
    with pytest.raises(RuntimeError, match="no more than 3"):
        list(walk(tasks.TaskClient(base, wait=0.0, most=3), feeds[0], 0, 3000))
    spark.dataSource.register(paged_source("tasks", feeds, client, clock=lambda: 3000))
    got = spark.read.format("tasks").option("since", 1000).option("skip_forbidden", "true").load().collect()
    assert sorted((r.feed, r.id) for r in got) == [("mail", "1"), ("mail", "2")]


def test_tail_follows_growth_rotation_and_truncation(spark, tmp_path):
    log, out = tmp_path / "logs/app.log", str(tmp_path / "out")
    log.parent.mkdir()
    spark.dataSource.register(tail.tail_source())

    def rows(**options):
        source = spark.readStream.format("tail").options(path=f"{log.parent}/app.log*", **options).load()
        query = to_parquet(source, out, str(tmp_path / "c"))  # starts anew at its checkpoint
        query.processAllAvailable()
        query.stop()
        return sorted(r.text for r in spark.read.parquet(out).collect())

    log.write_text("one\n\ntwo\nthr")
    assert rows(split=3) == ["one", "two"]
    with log.open("a") as f:
        f.write("ee\nfour\n")
    log.rename(tmp_path / "logs/app.log.1")
    log.write_text("five\n")
    assert rows(split=3) == sorted(["one", "two", "three", "four", "five"])
    log.write_text("6\n")
    assert rows() == sorted(["one", "two", "three", "four", "five", "6"])
    log.write_text("another file on the inode of the old one\nwhich it has outgrown\n")
    assert rows() == sorted(["one", "two", "three", "four", "five", "6", "another file on the inode of the old one", "which it has outgrown"])


@given(st.text(alphabet="ab\né", max_size=60), st.lists(st.integers(0, 80), max_size=5))
def test_parts_of_a_file_give_each_finished_line_once(text, cuts):
    import os
    import tempfile

    with tempfile.NamedTemporaryFile() as file:
        file.write(text.encode())
        file.flush()
        size, same = os.path.getsize(file.name), next(iter(tail.sizes(file.name)))
        edges = sorted({0, size, *(c for c in cuts if c < size)})
        got = [r for a, b in zip(edges, edges[1:]) for r in tail.lines_of(tail.Part(same, file.name, a, b), file.name)]
        assert [t for _, _, t in got] == [line for line in text.split("\n")[:-1] if line]
        assert all(text.encode()[at:].startswith(t.encode() + b"\n") for _, at, t in got)


def test_deleted_file_fails_a_tail_unless_told_otherwise(tmp_path):
    gone = tail.Part("0:0", str(tmp_path / "gone.log"), 0, 10)
    reader = lambda **options: tail.tail_source()({"path": str(tmp_path / "*.log"), **options}).streamReader(None)
    with pytest.raises(FileNotFoundError):
        list(reader().read(gone))
    assert list(reader(fail_on_loss="false").read(gone)) == []
    (tmp_path / "a.log").write_text("x\n")
    assert reader().initialOffset() == {} and [size for size, _ in reader(backfill="false").initialOffset().values()] == [2]


@given(st.binary(max_size=9000), st.integers(0, 9000), st.binary(min_size=1, max_size=40))
def test_a_file_is_known_by_its_beginning(content, cut, other):
    import tempfile

    def own(raw):
        with tempfile.NamedTemporaryFile() as file:
            file.write(raw)
            file.flush()
            return [len(raw), tail.head(file.name, len(raw))]

    cut = min(cut, len(content))
    assert tail.continues(own(content[:cut]), own(content)) and (cut == len(content) or not tail.continues(own(content), own(content[:cut])))
    changed = other + content[len(other) :]
    if len(changed) == len(content) and content[:1] != other[:1]:
        assert not tail.continues(own(content), own(changed + b"more"))


def test_inactive_files_are_not_opened(tmp_path, monkeypatch):
    import os

    (tmp_path / "a.log").write_text("x\n")
    (tmp_path / "b.log").write_text("y\n")
    os.utime(tmp_path / "a.log", (1_000_000, 1_000_000))
    reader = tail.tail_source()({"path": str(tmp_path / "*.log"), "inactive_seconds": "60"}).streamReader(None)
    first, opened = reader.latestOffset(), []
    plain = tail.head
    monkeypatch.setattr(tail, "head", lambda path, size: opened.append(path) or plain(path, size))
    assert reader.latestOffset() == first and [p.rsplit("/")[-1] for p in opened] == ["b.log"]
    with (tmp_path / "a.log").open("a") as file:
        file.write("z\n")
    after = reader.latestOffset()
    assert [(p.start, p.end) for p in reader.partitions(first, after)] == [(2, 4)]


def test_bundles_of_a_larger_table_are_more_files(spark, monkeypatch):
    """The query's files stay below the cap however many rows the table has."""
    import functools

    from tributary import queries as core

    monkeypatch.setattr(core, "_FILE_ROWS", 50)
    monkeypatch.setattr(core.files, "bundles", functools.partial(files.bundles, max_bytes=15_000))
    sf = "/root/testdata/sf0.001"
    wanted = 3 * core.table(spark, sf, "customer").count()
    assert core.bundle_routing(spark, sf).count() == wanted > 300
