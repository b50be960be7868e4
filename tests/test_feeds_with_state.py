"""Feeds by cursors, members that are discovered, queues that tasks receive, objects that notifications name."""

import base64
import datetime
import gzip
import json
from dataclasses import replace

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.sources import catalogue, cursors, objects, queue_clients, queues, spool


class Service:
    """Records 0, 1, 2, ... of each member, three a page; a cursor is the next one's number."""

    def __init__(self, size=7, kept_from=0, fails_at=None):
        self.size, self.kept_from, self.fails_at, self.asked = size, kept_from, fails_at, 0

    def baseline(self, member):
        return self.size

    def fetch(self, member, cursor):
        self.asked += 1
        at = cursor or 0
        if cursor is not None and at < self.kept_from:
            raise cursors.Expired(str(at))
        if (member, at) == self.fails_at:
            raise ConnectionError("down")
        return cursors.Reading([{"id": f"{member}{n}", "t": n} for n in range(at, min(at + 3, self.size))], min(at + 3, self.size), at + 3 < self.size)


def reader(service, state, members=("a", "b"), **options):
    source = cursors.cursor_source("s", service, list(members) if isinstance(members, tuple) else members, lambda i: i["id"], lambda i: i["t"])
    return source({"state": str(state), "backfill": "true", **options}).streamReader(None)


def batch(r, start, end):
    return sorted((row[2] or row[4]) for part in r.partitions({"poll": start}, {"poll": end}) for row in r.read(part))


def test_a_repeated_batch_gives_the_same_rows(tmp_path):
    service = Service()
    wanted = sorted(f"{m}{n}" for m in "ab" for n in range(7))
    assert batch(reader(service, tmp_path), 0, 5) == wanted
    service.size, asked = 9, service.asked
    assert batch(reader(service, tmp_path), 0, 5) == wanted and service.asked == asked
    r = reader(service, tmp_path)
    assert batch(r, 5, 8) == ["a7", "a8", "b7", "b8"] and r.latestOffset()["poll"] >= 8
    r.commit({"poll": 8})
    assert spool.Folder(str(tmp_path)).names() == ["8"] and batch(reader(service, tmp_path), 8, 9) == []
    with pytest.raises(FileNotFoundError, match="can't go on"):
        batch(r, 5, 10)


def test_a_new_member_starts_at_its_baseline_without_backfill(tmp_path):
    service = Service()
    assert batch(reader(service, tmp_path, backfill="false"), 0, 1) == []
    service.size = 8
    assert batch(reader(service, tmp_path, backfill="false"), 1, 2) == ["a7", "b7"]


def test_expired_cursors_start_anew_and_tell(tmp_path):
    service = Service()
    batch(reader(service, tmp_path), 0, 1)
    service.size, service.kept_from = 20, 10
    told = batch(reader(service, tmp_path), 1, 2)
    assert len(told) == 2 and all("has expired" in t for t in told)
    service.size = 21
    assert batch(reader(service, tmp_path), 2, 3) == ["a20", "b20"]


def test_a_failure_loses_and_repeats_nothing(tmp_path):
    service = Service(fails_at=("a", 3))
    got = batch(reader(service, tmp_path), 0, 1)
    assert got == sorted(["a0", "a1", "a2", "ConnectionError: down", *(f"b{n}" for n in range(7))])
    service.fails_at = None
    assert batch(reader(service, tmp_path), 1, 2) == ["a3", "a4", "a5", "a6"]
    with pytest.raises(ConnectionError):
        batch(reader(Service(fails_at=("a", 0)), tmp_path / "other", on_error="fail"), 0, 1)
    assert batch(reader(Service(), tmp_path / "other", on_error="fail"), 0, 1) == sorted(f"{m}{n}" for m in "ab" for n in range(7))


def test_pages_beyond_the_most_are_left_to_the_next_batch(tmp_path):
    r = reader(Service(), tmp_path, members=("a",), most_pages="1")
    assert batch(r, 0, 1) == ["a0", "a1", "a2"] and batch(r, 1, 2) == ["a3", "a4", "a5"] and batch(r, 2, 3) == ["a6"] and batch(r, 3, 4) == []


def test_members_come_and_go(tmp_path):
    listing = [["a", "b"], True]
    service = Service(2)
    step = lambda n: batch(reader(service, tmp_path, members=lambda: tuple(listing)), n, n + 1)
    assert step(0) == ["a0", "a1", "b0", "b1"]
    listing[:] = ["c"], False
    service.size = 3
    assert step(1) == ["a2", "b2", "c0", "c1", "c2"]
    listing[:] = [], True
    assert step(2) == []
    listing[:] = ["b"], True
    service.size = 4
    assert step(3) == ["b3"]
    listing[:] = ["z"], True
    assert step(3) == ["b3"]  # the plan of a repeated batch stays
    assert step(4) == ["z0", "z1", "z2", "z3"]


@given(st.sets(st.sampled_from("abcdef")), st.sets(st.sampled_from("abcdef")), st.booleans(), st.sets(st.sampled_from("xy")))
def test_listings_that_broke_off_stop_nothing(running, listed, complete, static):
    after = set(cursors.reconciled(running, listed, complete, static))
    assert listed | static <= after <= listed | static | running and (running <= after or (complete and listed))


@given(st.lists(st.binary(max_size=30).map(lambda b: b.replace(b"\n", b"")), max_size=6), st.binary(max_size=20))
def test_notes_follow_their_lines(lines, note):
    import tempfile

    with tempfile.TemporaryDirectory() as path:
        folder = spool.Folder(path)
        folder.write_noted("x/y", iter(lines), [note])
        folder.write_noted("x/y", iter([b"other"]), [b"later"])
        assert list(folder.noted_lines("x/y")) == lines and folder.note("x/y") == note and folder.names("x") == ["y"]


def test_a_file_appears_whole_or_not_at_all(tmp_path):
    folder = spool.Folder(f"file://{tmp_path}")

    def broken():
        yield b"half"
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        folder.write("a/b", broken())
    assert not folder.has("a/b") and folder.names("a") == [] and folder.read("a/b") is None
    folder.write("a/b", [b"1\n2\n\n3"])
    assert list(folder.lines("a/b")) == [b"1", b"2", b"", b"3"]
    folder.remove("a")
    assert folder.names() == []


def test_services_by_cursors(served, tmp_path):
    base, answers = served
    history = [{"id": str(n), "messages": [{"id": f"m{n}"}]} for n in range(100, 105)]
    state = {"profile": "100", "oldest": 0}

    def listed(asked):
        if int(asked.split("startHistoryId=")[1].split("&")[0]) < state["oldest"]:
            return 404
        assert asked.count("historyTypes=") == 3
        return {"history": history[3:], "historyId": "105"} if "pageToken=p2" in asked else {"history": history[:3], "historyId": "105", "nextPageToken": "p2"} if "startHistoryId=100" in asked else {"historyId": "105"}

    answers["/users/me%40x/history"] = listed
    answers["/users/me%40x/profile"] = lambda _: {"historyId": state["profile"]}
    request = catalogue.cursor_request("gmail_history")
    request = replace(request, url=f"{base}/users/{{member}}/history", profile=(f"{base}/users/{{member}}/profile", "historyId"))
    client = cursors.HttpCursors(request, lambda member: {"Authorization": f"Bearer of {member}"})
    source = lambda: cursors.cursor_source("h", client, ["me@x"], lambda i: i["id"], lambda i: None)({"state": str(tmp_path)}).streamReader(None)
    assert batch(source(), 0, 1) == [] and batch(source(), 1, 2) == ["100", "101", "102", "103", "104"] and batch(source(), 2, 3) == []
    state |= {"oldest": 200, "profile": "300"}
    assert "has expired" in batch(source(), 3, 4)[0]

    answers["/box"] = lambda asked: {"entries": [], "next_stream_position": 7} if "stream_position=now" in asked else {"entries": [{"event_id": "e"}] if "stream_position=7" in asked else [], "next_stream_position": 8}
    box = cursors.HttpCursors(replace(catalogue.cursor_request("box"), url=f"{base}/box"))
    at = box.baseline("")
    first = box.fetch("", at)
    assert at == [7, None, None]
    assert first.items == [{"event_id": "e"}] and first.more and not box.fetch("", first.cursor).more

    answers["/op"] = lambda sent: {"items": [{"uuid": "2"}], "cursor": "c2", "has_more": False} if sent.get("cursor") == "c1" else {"items": [{"uuid": "1"}], "cursor": "c1", "has_more": True}
    op = cursors.HttpCursors(replace(catalogue.cursor_request("onepassword_auditevents"), url=f"{base}/op"))
    one = op.fetch("", None)
    two = op.fetch("", one.cursor)
    assert (one.more, two.more, one.items + two.items) == (True, False, [{"uuid": "1"}, {"uuid": "2"}])
    with pytest.raises(RuntimeError, match="backfill"):
        op.baseline("")


def test_mailboxes_of_a_domain():
    pages = {None: {"users": [{"primaryEmail": " A@x "}, {"primaryEmail": "b@x", "suspended": True}], "nextPageToken": "2"}, "2": {"users": [{"primaryEmail": "a@X"}, {}]}}
    get = lambda url: pages["2" if "pageToken=2" in url else None]
    assert catalogue.mailboxes(get) == (["a@x"], True) and catalogue.mailboxes(get, suspended=True)[0] == ["a@x", "b@x"]
    assert catalogue.mailboxes(get, most_pages=1) == (["a@x"], False)
    assert len(catalogue.requests("gmail", user="me")) == 9


class Held:
    """A queue of some messages; those that were received and not acknowledged stay in ``out``."""

    def __init__(self, n):
        self.left, self.out, self.done = [queues.Message(f"m{k}", f"r{k}", f"body\n{k}") for k in range(n)], [], []

    def receive(self, most):
        got, self.left = self.left[:most], self.left[most:]
        self.out += got
        return got

    def acknowledge(self, receipts):
        assert len(receipts) <= 3
        self.done += receipts


def test_a_lost_driver_loses_no_message(tmp_path):
    queue = Held(17)
    new = lambda: queues.queue_source("q", queue)({"state": str(tmp_path), "receivers": "2", "messages": "5", "at_once": "3"}).streamReader(None)
    rows = lambda r, a, b: sorted(row for p in r.partitions({"batch": a}, {"batch": b}) for row in r.read(p))
    first = rows(new(), 0, 3)
    assert len(first) == 10 and queue.done == [] and first[0] == ("m0", "body\n0")
    assert rows(new(), 0, 3) == first and len(queue.left) == 7  # after the driver was lost: from the files
    r = new()
    r.commit({"batch": 3})
    assert sorted(queue.done) == sorted(f"r{m[1:]}" for m, _ in first)
    r.commit({"batch": 3})
    assert len(queue.done) == 10 and len(rows(r, 3, 4)) == 7 and r.latestOffset()["batch"] >= 4
    r.commit({"batch": 4})
    assert len(queue.done) == 17


def test_signatures():
    """The documented example of signature version 4."""
    at = datetime.datetime(2015, 8, 30, 12, 36, 0)
    got = queue_clients.signed("GET", "https://iam.amazonaws.com/?Action=ListUsers&Version=2010-05-08", {"content-type": "application/x-www-form-urlencoded; charset=utf-8"}, b"", "AKIDEXAMPLE", "wJalrXUtnFEMI/K7MDENG+bPxRfiCYEXAMPLEKEY", "us-east-1", "iam", at)
    assert got["Authorization"].endswith("SignedHeaders=content-type;host;x-amz-date, Signature=5d672d79c15b13162d9279b0855cfba6789a8edb4c82c400e06b5924a6f2b5d7")


def test_clients_of_queues(served):
    base, answers = served
    deleted = []

    def sqs(sent):
        if "Entries" in sent:
            deleted.extend(e["ReceiptHandle"] for e in sent["Entries"])
            return {"Failed": [{"Id": "0"}]} if "bad" in deleted else {}
        return {"Messages": [{"MessageId": "1", "ReceiptHandle": "r", "Body": "b"}]} if sent["MaxNumberOfMessages"] == 10 else {}

    answers["/"] = sqs
    q = queue_clients.SqsQueue(f"{base}/1/q", "us-east-1", "k", "s")
    assert q.receive(50) == [queues.Message("1", "r", "b")] and q.receive(3) == []
    q.acknowledge([str(n) for n in range(23)])
    assert len(deleted) == 23
    with pytest.raises(RuntimeError, match="not deleted"):
        q.acknowledge(["bad"])
    acked = []
    answers["/projects/p/subscriptions/s:pull"] = {"receivedMessages": [{"ackId": "a", "message": {"messageId": "9", "data": base64.b64encode("é".encode()).decode()}}]}
    answers["/projects/p/subscriptions/s:acknowledge"] = lambda sent: acked.extend(sent["ackIds"]) or {}
    p = queue_clients.PubSubQueue("projects/p/subscriptions/s", dict, base)
    assert p.receive(5) == [queues.Message("9", "a", "é")]
    p.acknowledge(["a"])
    assert acked == ["a"]


def test_objects_that_notices_name(spark, tmp_path):
    (tmp_path / "b/x y").mkdir(parents=True)
    (tmp_path / "b/x y/1.gz").write_bytes(gzip.compress(b"one\ntwo"))
    (tmp_path / "b/x y/2.gz").write_bytes(b"no gzip")
    (tmp_path / "b/large").write_bytes(b"x" * 5000)
    notices = [
        json.dumps({"bucket": "b", "files": [{"path": "x+y%2F1.gz"}, {"path": "/x+y/2.gz"}, {"path": "none"}, {"path": "large"}, {"path": "%zz"}]}),
        json.dumps({"body": json.dumps({"bucket": "b"})}), json.dumps({"files": {"path": "p"}}), "{", json.dumps({"bucket": "b", "files": []}),
    ]
    rows = spark.createDataFrame(list(enumerate(notices)), "n int, body string").repartition(3)
    named = objects.named_objects(rows, base=f"{tmp_path}/", decode=True)
    got = objects.object_records(named.drop("body"), error="notice_error", max_bytes=4000).collect()
    assert sorted((r.n, r.offset, r.text) for r in got if r.error is None) == [(0, 0, "one"), (0, 1, "two")]
    assert sorted((r.n, r.error.split(":")[0].split(" [")[0]) for r in got if r.error) == sorted([(0, "bad gzip"), (0, "5000 bytes, more than 4000"), (0, next(r.error for r in got if r.error and "none" in r.error).split(":")[0].split(" [")[0]), (0, "the path can't be decoded"), (2, "the notification names no bucket"), (3, "the notification isn't JSON")])


def test_tokens_are_renewed_in_time_and_once_when_refused(served):
    import pickle

    from tributary.sources import http, retry, tokens

    base, answers = served
    given, now = [], [1000.0]

    def fetch():
        given.append(len(given))
        return f"t{given[-1]}", 100.0

    held = tokens.Tokens(fetch, margin=10.0, clock=lambda: now[0])
    assert held() == held() == {"Authorization": "Bearer t0"}
    now[0] = 1091.0
    assert held() == {"Authorization": "Bearer t1"}
    told = tokens.Tokens(lambda: (tokens.signed_jwt({"exp": 5000}, "s"), None), clock=lambda: now[0])
    told()
    assert told._ends == 5000.0 and tokens.expiry("a.b.c") is None and tokens.expiry("plain") is None
    seen = []

    def call(headers):
        seen.append(headers["Authorization"])
        if len(seen) == 1:
            raise retry.Refused(401)
        return "read"

    assert tokens.authorised(held, call) == "read" and seen == ["Bearer t1", "Bearer t2"]
    with pytest.raises(retry.Refused):
        tokens.authorised(held, lambda headers: (_ for _ in ()).throw(retry.Refused(401)))
    with pytest.raises(retry.Refused):
        tokens.authorised(held, lambda headers: (_ for _ in ()).throw(retry.Refused(403)))
    answers["/token"] = lambda sent: {"data": {"token": f"for {json.loads(base64.urlsafe_b64decode(sent['auth_token'].split('.')[1] + '=='))['sub']}", "lasts": 50}}
    posted = tokens.Tokens(tokens.PostedToken(f"{base}/token", tokens.SignedClaims({"sub": "app"}, "secret"), "data/token", "data/lasts"))
    assert pickle.loads(pickle.dumps(posted))() == posted() == {"Authorization": "Bearer for app"}
    answers["/rows"] = {"data": [{"id": 1}]}
    client = http.HttpClient({"r": http.Request(f"{base}/rows", "data")}, posted)
    assert client.fetch("r", 0, 1, None).items == [{"id": 1}]


def test_conditions_in_the_languages_of_services(served):
    from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, IsNull, LessThan, Not, StringContains, StringEndsWith, StringStartsWith

    from tributary.sources import http, pushdown

    columns = {"s": ("of/s", "string"), "n": ("n", "long"), "t": ("t", "timestamp")}
    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 678901, datetime.timezone.utc)
    filters = [EqualTo(("s",), "it's"), In(("s",), ("a", "b,c")), StringContains(("s",), "x^y"), StringStartsWith(("s",), "p"), IsNull(("s",)), Not(EqualTo(("s",), "q")), Not(StringContains(("s",), "r")), GreaterThan(("n",), 3), GreaterThanOrEqual(("n",), 4), LessThan(("n",), 9), GreaterThan(("t",), at), LessThan(("t",), at)]
    unsure = [IsNotNull(("s",)), GreaterThan(("s",), "a"), StringEndsWith(("s",), "z"), EqualTo(("t",), at), EqualTo(("other",), 1), EqualTo(("s", "below"), 1), Not(In(("s",), ("a",)))]
    assert pushdown.tests_of(unsure, columns, exact=True) == []
    assert len(pushdown.tests_of(filters, columns)) == len(filters) - 2 and len(pushdown.tests_of(filters + unsure, columns, exact=True)) == len(filters)
    tests = pushdown.tests_of(filters, columns, exact=True)
    assert " and ".join(pushdown.written(tests, "odata")) == "of/s eq 'it''s' and (of/s eq 'a' or of/s eq 'b,c') and contains(of/s,'x^y') and startswith(of/s,'p') and of/s eq null and of/s ne 'q' and n gt 3 and n ge 4 and n lt 9 and t ge 2024-01-02T03:04:05.678Z and t le 2024-01-02T03:04:05.679Z"
    assert "^".join(pushdown.written(tests, "encoded")) == "of/s=it's^of/sLIKEx^^y^of/sSTARTSWITHp^of/sISEMPTY^of/s!=q^of/sNOT LIKEr^n>3^n>=4^n<9^t>=2024-01-02 03:04:05^t<=2024-01-02 03:04:06"
    extended = pushdown.written(tests, "extended")
    assert extended[0] == {"saasAttrName": "of/s", "saasAttrOp": "is", "saasAttrValue": "it's"} and extended[-1]["saasAttrValue"] == "2024-01-02T03:04:05.680Z" and [e["saasAttrOp"] for e in extended][1:6] == ["contains", "startsWith", "isEmpty", "isNot", "notContains"]
    assert pushdown.written(tests, "members") == [("of/s", "it's")]

    asked = lambda service, tests, feed=None, **own: (lambda c: c.where(tests).asked(feed or next(iter(c.requests)), 0, 1000, None))(http.HttpClient(catalogue.requests(service, **own)))
    assert "sysparm_query=a%3Db%5Ex%3D1%5Esys_created_on" in asked("servicenow", [("a", "is", "b")], instance="i", table="t", query="x=1")[0]
    assert "%24filter=a+eq+%27b%27+and+createdDateTime" in asked("defender", [("a", "is", "b")])[0]
    assert asked("threatlocker", [("computer", "is", "c"), ("x", "contains", "y")], instance="i", path="p")[1]["computer"] == "c"
    assert asked("harmony", [("a", "is", "b")], host="h", saas="s", entity="e")[1]["requestData"]["entityExtendedFilter"] == [{"saasAttrName": "a", "saasAttrOp": "is", "saasAttrValue": "b"}]


def test_mailboxes_by_number():
    from tributary.sources import mailbox

    class Held:
        validity, last = 1, 7

        def status(self):
            return self.validity, self.last + 1

        def since(self, day):
            return [4, 5] if day <= datetime.date(2024, 1, 7) else []

        def fetch(self, low, high):
            yield from ((n, [], b"m%d" % n) for n in range(low - 1, high + 2) if 0 < n <= self.last)

    held = Held()
    new = lambda **options: mailbox.mailbox_source("m", lambda: held, lambda: datetime.date(2024, 1, 10))({"span": "3", **options}).streamReader(None)
    r = new()
    assert r.initialOffset() == {"validity": 1, "uid": 5} and new(from_zero="true").initialOffset()["uid"] == 0
    rows = lambda a, b: [row[1] for p in r.partitions(a, b) for row in r.read(p)]
    end = r.latestOffset()
    assert rows(r.initialOffset(), end) == [6, 7] and rows({"validity": 1, "uid": 0}, end) == [1, 2, 3, 4, 5, 6, 7] and rows(end, end) == []
    held.validity, held.last = 2, 4
    assert rows(end, r.latestOffset()) == [1, 2, 3, 4]
    old = [row for p in r.partitions({"validity": 1, "uid": 0}, end) for row in r.read(p)]
    assert old == []
    held.since = lambda day: []
    assert mailbox.last_known(held, datetime.date(2024, 1, 1)) == 0


def test_what_imap_servers_say():
    from tributary.sources import mailbox

    class Server:
        def select(self, folder, readonly):
            assert readonly and folder == '"IN BOX"'
            return "OK", [b"9"]

        def status(self, folder, items):
            return "OK", [b'"IN BOX" (UIDVALIDITY 77 UIDNEXT 31)']

        def uid(self, what, *own):
            if what == "SEARCH":
                return "OK", [b"3 4" if own[1] == "05-Mar-2024" else b""]
            low, high = own[0].split(":")
            return ("OK", [(f"1 (UID {low} FLAGS (\\Seen) BODY[] {{3}}".encode(), b"abc"), b")"]) if int(high) < 40 else ("NO", [b"gone"])

    box = mailbox.ImapMailbox(Server(), "IN BOX")
    assert box.status() == (77, 31) and box.since(datetime.date(2024, 3, 5)) == [3, 4] and box.since(datetime.date(2024, 3, 6)) == []
    assert list(box.fetch(1, 30)) == [(1, ["\\Seen"], b"abc"), (21, ["\\Seen"], b"abc")]
    with pytest.raises(ConnectionError):
        list(box.fetch(30, 45))


def test_streams_that_push(tmp_path):
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    from tributary.sources import push

    events = [{"metadata": {"offset": n, "eventCreationTime": 1_700_000_000_000 + n}} for n in range(1, 8)]

    class Handler(BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"

        def do_GET(self):
            after = int(self.path.split("offset=")[1])
            if after > 100:
                self.send_response(404)
                self.send_header("Content-Length", "0")
                self.end_headers()
                return
            self.send_response(200)
            self.send_header("Transfer-Encoding", "chunked")
            self.end_headers()
            text = "".join(json.dumps(e) + "\n\n" for e in events if e["metadata"]["offset"] >= after).encode()
            for at in range(0, len(text), 50):
                piece = text[at : at + 50]
                self.wfile.write(b"%x\r\n%s\r\n" % (len(piece), piece))
            self.wfile.flush()
            stop.wait(5)  # the connection stays open

        def log_message(self, *_):
            pass

    stop = threading.Event()
    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    client = push.PushClient(f"http://127.0.0.1:{server.server_port}/{{member}}?offset={{offset}}", seconds=0.3, quiet=0.3, not_before=1_700_000_000_003)
    source = cursors.cursor_source("p", client, ["x"], lambda e: str(e["metadata"]["offset"]), lambda e: e["metadata"]["eventCreationTime"])
    new = lambda: source({"state": str(tmp_path), "backfill": "true"}).streamReader(None)
    try:
        assert batch(new(), 0, 1) == [str(n) for n in range(3, 8)]
        events.append({"metadata": {"offset": 8, "eventCreationTime": 1_700_000_000_008}})
        assert batch(new(), 0, 1) == [str(n) for n in range(3, 8)] and batch(new(), 1, 2) == ["8"] and batch(new(), 2, 3) == []
        with pytest.raises(cursors.Expired):
            client.fetch("x", 500)
    finally:
        stop.set()
        server.shutdown()


def test_fake_services_read_each_page_once(spark, tmp_path, monkeypatch):
    """All pages of a service together take one reading of its table, not one a page."""
    import pyarrow.parquet as pq

    from tributary import queries as core

    path, taken = str(tmp_path / "rows"), []
    core._stored(spark.range(6500).select(F.col("id").alias("n"), "id"), path)
    read = pq.ParquetFile.read_row_group
    monkeypatch.setattr(pq.ParquetFile, "read_row_group", lambda *a, **k: (got := read(*a, **k), taken.append(got.num_rows))[0])
    service, cursor, found = core._TableService(path, 6000), None, []
    while True:
        page = service.fetch("", 0, 10, cursor)
        found += [r["id"] for r in page.items]
        if (cursor := page.following) is None:
            break
    assert found == list(range(6000))[::-1]
    assert sum(taken) == 6500 and max(taken) <= core._PAGE
    taken.clear()
    assert [r["id"] for r in service._rows("", 2995, 3005)] == list(range(2995, 3005))
    assert sum(taken) <= 3 * core._PAGE
    taken.clear()
    reading, members = core._CursorService(path, 6000), []
    cursor, more = None, True
    while more:
        got = reading.fetch("", cursor)
        members, cursor, more = members + [r["id"] for r in got.items], got.cursor, got.more
    assert members == list(range(6000))
    assert sum(taken) <= 3 * 6500
