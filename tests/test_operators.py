import datetime as dt

from pyspark.sql import functions as F

from tributary.functions.text import named_groups, pod_of, url_decoded, xml_value
from tributary.functions.timestamps import millis, parsed
from tributary.operators import dedupe, envelopes, events, feeds, framing, predicates
from tributary.operators.running import running_sum


def test_lines_keep_one_byte_and_drop_empty(spark):
    rows = spark.createDataFrame([(1, "a\n\nbb\nc"), (2, None), (3, "")], "i int, text string")
    assert [(r.i, r.place, r.line) for r in framing.lines(rows).orderBy("i", "place").collect()] == [(1, 0, "a"), (1, 2, "bb"), (1, 3, "c")]
    assert [(r.line, r.oversize) for r in framing.lines(rows, max_size=1).orderBy("i", "place").collect()] == [("a", None), (None, 2), ("c", None)]
    assert framing.lines(spark.createDataFrame([("a.b",)], "text string"), separator=".").count() == 2


def test_multi_line_json(spark):
    lines = ["{", '  "a": 1', "", "} ", '{"b":', "{}}", "{ unfinished"]
    rows = spark.createDataFrame([("f", n, t) for n, t in enumerate(lines)], "file string, place long, line string")
    assert [r.text for r in framing.multi_line_json(rows, ["file"]).orderBy("object_no").collect()] == ['{"a": 1}', '{"b":{}}']


def test_running_sum_over_stretches(spark):
    rows = spark.range(1000).selectExpr("id % 2 as k", "id as place")
    got = running_sum(rows, ["k"], "place", F.col("place"), "total", stretch=7).where("place = 999 or place = 998")
    assert sorted(r.total for r in got.collect()) == [sum(range(0, 1000, 2)), sum(range(1, 1000, 2))]


def test_envelopes(spark):
    bodies = [(1, '[{"a":1},{},3]'), (2, '{"value":[{"a":2}]}'), (3, '{"other":[{"a":3}]}'), (4, ""), (5, None), (6, "oops"), (7, '{"data":5,"items":[{"a":7}]}')]
    rows = spark.createDataFrame(bodies, "i int, body string")
    assert sorted(r.i for r in envelopes.items(rows).collect()) == [1, 2, 7]
    assert [r.i for r in envelopes.items(rows, path="other").collect()] == [3]
    assert sorted(r.i for r in envelopes.malformed(rows).collect()) == [3, 6]


def test_events(spark):
    rows = spark.createDataFrame([('{"id":5,"t":"2024-01-02 03:04:05","kind":"x","of":{"a":1}}',), ("plain line",), (None,), ('{"uuid":"u"}',)], "text string")
    m = events.Mapping("s", event_type_path="kind", event_type="other", event_time_path="t", sensor_key="k")
    got = {r.dedupe_key: r for r in events.to_events(rows, m).drop("payload").collect()}
    assert len(got) == 3 and got["5"].event_type == "x" and got["5"].event_time == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got["u"].event_type == "other" and got["u"].payload_kind == "json"
    text = next(r for k, r in got.items() if len(k) == 64)
    assert text.payload_kind == "text" and text.text == "plain line" and text.event_time == text.ingest_time
    m = events.Mapping("s", pattern=r"(?P<who>\w+) (?P<what>\w+)", fields={"who": "user"})
    row = events.to_events(rows.where("text like 'plain%'"), m).drop("payload").first()
    assert row.text == '{"user":"plain"}' and row.payload_kind == "json"


def test_named_groups_and_paths(spark):
    rows = spark.createDataFrame([("10.0.0.1 GET",), ("nothing",)], "t string")
    got = rows.select(named_groups(F.col("t"), r"(?P<ip>[\d.(]+) (GET|PUT)(?P<rest>.*)").alias("g")).collect()
    assert got[0].g.ip == "10.0.0.1" and got[0].g.rest == "" and got[1].g.ip is None
    paths = spark.createDataFrame([("/var/log/pods/ns_pod-1_uid-2/web/0.log",), ("/var/log/x.log",)], "p string")
    got = [r.p for r in paths.select(pod_of(F.col("p")).alias("p")).collect()]
    assert tuple(got[0]) == ("ns", "pod-1", "uid-2", "web") and got[1] is None
    assert spark.range(1).select(url_decoded(F.lit("a%20b")), url_decoded(F.lit("%zz"))).first()[:] == ("a b", None)


def test_times(spark):
    rows = spark.createDataFrame([("2024-01-01T00:00:00.123456789Z",), ("2024-01-01 00:00:00",), ("2024-01-01T01:00:00+01:00",), ("x",)], "t string")
    assert [r.m for r in rows.select(millis(parsed(F.col("t"))).alias("m")).collect()] == [1704067200123, 1704067200000, 1704067200000, None]


def test_ttl_against_a_loop(spark):
    import random

    rng = random.Random(3)
    data = [(i, rng.choice("abc"), rng.randrange(0, 40)) for i in range(300)]
    rows = spark.createDataFrame(data, "i int, k string, s int").select("i", "k", F.timestamp_seconds("s").alias("t"))
    got = {r.i for r in dedupe.first_within_ttl(rows, ["k"], "t", 3, 10, ["i"]).collect()}
    held, wanted = {}, set()
    for i, k, s in sorted(data, key=lambda x: (x[2], x[0])):
        if k not in held or s // 3 - held[k] >= 3:
            held[k] = s // 3
            wanted.add(i)
    assert got == wanted


def test_dedupe_handles_nulls_and_ties(spark):
    rows = spark.createDataFrame([(None, 1), (None, 1), ("a", 2), ("a", 1)], "k string, o int")
    assert sorted(map(str, dedupe.first_of(rows, ["k"], ["o"]).collect())) == ["Row(k='a', o=1)", "Row(k=None, o=1)"]
    assert dedupe.first_of(rows.limit(0), ["k"], ["o"]).count() == 0


def test_feeds(spark):
    a, b = spark.range(3).toDF("i"), spark.range(2, 5).toDF("i")
    assert feeds.union_tagged({"a": a, "b": b}).groupBy("event_type").count().count() == 2
    start, stop = feeds.reconcile(a, b, ["i"], static=spark.range(1).toDF("i"))
    assert sorted(r.i for r in start.collect()) == [3, 4] and sorted(r.i for r in stop.collect()) == [1]
    assert feeds.reconcile(a, b.limit(0), ["i"])[1].count() == 0
    assert [r.i for r in feeds.page(b, ["i"], 2, 2).collect()] == [4]


def test_predicates_on_nulls(spark):
    rows = spark.createDataFrame([("ab",), (None,), ("",)], "c string")
    count = lambda p, v=None: rows.where(predicates.all_of([("c", p, v)])).count()
    assert [count("is", "ab"), count("isNot", "ab"), count("contains", "a"), count("notContains", "a"), count("isEmpty"), count("isNotEmpty")] == [1, 2, 1, 2, 2, 1]
    assert predicates.included(rows, "c", None, "a").count() == 2


def test_members_of_records(spark):
    rows = spark.createDataFrame([(1, '{"a":1,"in":{"a":2,"b":3}}'), (2, '{"a":1}'), (3, "no")], "i int, t string")
    got = {r.i: (r.f, r.b) for r in rows.select("i", events.flattened(F.try_parse_json("t"), "in").alias("f"), events.root_or_below(F.col("t"), "b", "int").cast("int").alias("b")).collect()}
    assert got == {1: ('{"b":3,"a":1}', 3), 2: ('{"a":1}', None), 3: (None, None)}
    docs = spark.createDataFrame([("<a><b>x</b></a>",), ("<a/>",), ("broken <",), (None,)], "d string")
    assert [r.x for r in docs.select(xml_value(F.col("d"), "a/b").alias("x")).collect()] == ["x", None, None, None]
