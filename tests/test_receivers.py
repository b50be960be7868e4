"""Logs over the network, artifacts, typed records."""

import os
import socket
import time

import pytest

from tributary.functions import typed
from tributary.sources import artifacts, receiver
from tributary.sources.spool import Folder


def wait_for(spool, n):
    end = time.time() + 10
    while time.time() < end:
        spool.tick(now=True)
        got = [f for name in sorted(os.listdir(spool.folder)) if name.endswith(".frames") for f in receiver.frames(open(f"{spool.folder}/{name}", "rb").read())]
        if len(got) >= n:
            return sorted(text for *_, text in got)
        time.sleep(0.1)
    raise AssertionError(f"{len(got)} records")


def test_lines_and_datagrams_are_received(spark, tmp_path):
    lines = receiver.Listener(receiver.Spool(str(tmp_path / "tcp")), "127.0.0.1", 0)
    grams = receiver.Listener(receiver.Spool(str(tmp_path / "udp")), "127.0.0.1", 0, udp=True)
    with socket.create_connection(("127.0.0.1", lines.port)) as a, socket.create_connection(("127.0.0.1", lines.port)) as b:
        a.sendall(b"<34>one\n\ntw")
        b.sendall(b"three\nlast without end")
        time.sleep(0.1)
        a.sendall(b"o\n\xff\n")
    out = socket.socket(socket.AF_INET, socket.SOCK_DGRAM)
    for text in (b"one record\nof two lines\n", b"", b"another"):
        out.sendto(text, ("127.0.0.1", grams.port))
    assert wait_for(lines.spool, 5) == sorted([b"<34>one", b"two", b"three", b"last without end", b"\xff"])
    assert wait_for(grams.spool, 2) == [b"another", b"one record\nof two lines\n"]
    lines.close()
    grams.close()
    query = receiver.received_stream(spark, str(tmp_path / "udp")).writeStream.format("memory").queryName("received").start()
    query.processAllAvailable()
    query.stop()
    rows = spark.table("received").collect()
    assert sorted(r.text for r in rows) == ["another", "one record\nof two lines\n"] and {r.sender for r in rows} == {"127.0.0.1"} and abs(rows[0].received.timestamp() - time.time()) < 60
    with pytest.raises(ValueError):
        receiver.Listener(lines.spool, udp=True, context=object())


def test_what_a_lost_listener_had_is_kept(tmp_path):
    spool = receiver.Spool(str(tmp_path))
    for text in (b"a", b"bb", b"ccc"):
        spool.add(text, "h")
    spool.file.write(receiver.frame(b"half", "h", 1)[:-2])
    spool.file.close()
    assert [n for n in os.listdir(tmp_path) if n.endswith(".frames")] == []
    again = receiver.Spool(str(tmp_path))
    assert wait_for(again, 3) == [b"a", b"bb", b"ccc"] and not [n for n in os.listdir(tmp_path) if n.endswith(".part")]
    small = receiver.Spool(str(tmp_path / "small"), most=1)
    small.add(b"x", "h")
    small.add(b"y", "h")
    assert len(os.listdir(tmp_path / "small")) == 2


def test_a_line_without_end_ends_its_connection(tmp_path):
    listener = receiver.Listener(receiver.Spool(str(tmp_path)), "127.0.0.1", 0, most_line=100)
    with socket.create_connection(("127.0.0.1", listener.port)) as a:
        a.sendall(b"fine\n" + b"x" * 5000)
        a.settimeout(5)
        try:
            assert a.recv(1) == b""
        except ConnectionError:
            pass
    assert wait_for(listener.spool, 1) == [b"fine"]
    listener.close()


def test_one_file_for_each_content(spark, tmp_path):
    rows = spark.createDataFrame([(n, b"x%d" % (n % 3) if n % 5 else None) for n in range(40)], "n int, attachment binary").repartition(6)
    path = str(tmp_path / "files")
    first = {(r.n, r.artifact) for r in artifacts.store(rows, path).collect()}
    stamp = {p: os.stat(p).st_mtime_ns for _, p in first if p}
    assert len(stamp) == 3 and {(r.n, r.artifact) for r in artifacts.store(rows, path).collect()} == first and all(os.stat(p).st_mtime_ns == t for p, t in stamp.items())
    assert sorted(bytes(r.content) for r in artifacts.artifacts(spark, path).collect()) == [b"x0", b"x1", b"x2"]
    assert all(p is None for n, p in first if n % 5 == 0) and len([n for n in Folder(path).names() if n.startswith("_written")]) == 2
    artifacts.store(rows.limit(0), path)


def test_records_that_do_not_fit(spark):
    rows = spark.createDataFrame([('{"traceID":18446744073709551615,"threadID":1,"source":{"x":[1]},"more":2}',), ('{"threadID":"x","eventMessage":"m"}',), ("no JSON",), (None,), ("{}",)], "t string")
    got = [r.r for r in rows.select(typed.typed(rows.t, typed.UNIFIED_LOG).alias("r")).collect()]
    assert (int(got[0].traceID), got[0].threadID, got[0]._misfit) == (2**64 - 1, 1, None)
    assert (got[1].threadID, got[1].eventMessage, got[1]._misfit) == (None, "m", '{"threadID":"x","eventMessage":"m"}') and got[2]._misfit == "no JSON" and got[3] is None and got[4]._misfit is None


def test_xml_records(spark):
    documents = ["<E x='1'><D N='n'>a</D><D N='m'>b</D><F/><S><T>2.50</T></S></E>", "<broken", "plain", "", "  ", None, "<a><b></a>"]
    rows = spark.createDataFrame([(d,) for d in documents], "d string").select(typed.xml_record(__import__("pyspark").sql.functions.col("d")).cast("string").alias("v"))
    assert [r.v for r in rows.collect()] == ['{"D":[{"_N":"n","_VALUE":"a"},{"_N":"m","_VALUE":"b"}],"F":null,"S":{"T":2.5},"_x":1}'] + [None] * 6


def test_settings_of_spooled_and_exported_logs(spark, tmp_path):
    from tributary.plans import ingest
    from tributary.sources.event_hub import kafka_options

    spool = receiver.Spool(str(tmp_path / "syslog"))
    spool.add(b"<34>two\nlines", "h")
    spool.tick(now=True)
    (tmp_path / "unified.log").write_text('Filtering the log data\n{"eventMessage":"m","traceID":7}\n')
    (tmp_path / "wel.xml").write_text("<Event><Id>4</Id></Event>\n")
    got = ingest.events(spark, [{"syslog": {"path": str(tmp_path / "syslog")}}, {"mac_unified_logging": {"path": str(tmp_path / "unified.log")}}, {"wel": {"path": str(tmp_path / "wel.xml")}}])
    assert sorted((r.source, r.payload_kind, r.text) for r in got.select("source", "payload_kind", "text").collect()) == [("mac_unified_logging", "json", '{"eventMessage":"m","traceID":7}'), ("syslog", "text", "<34>two\nlines"), ("wel", "text", "<Event><Id>4</Id></Event>")]
    options = kafka_options('Endpoint=sb://ns.servicebus.windows.net/;SharedAccessKeyName=n;SharedAccessKey=a"b=;EntityPath=hub')
    assert options["kafka.bootstrap.servers"] == "ns.servicebus.windows.net:9093" and options["subscribe"] == "hub" and options["startingOffsets"] == "latest" and 'a\\"b=' in options["kafka.sasl.jaas.config"]
    with pytest.raises(ValueError):
        kafka_options("Endpoint=sb://ns.servicebus.windows.net/")
