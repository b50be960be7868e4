"""Feeds that go on from an opaque cursor, known only once what is before it was read.

A batch of the stream is a poll: its offset is the number of a moment, and each
member of the feed (a mailbox, an account, or the one feed there is) is read from its
cursor on. Tasks write what they have read to a file of the batch, and the members' next cursors
into the same file; the next batch starts from the cursors of the one before. A batch
that is repeated gives the rows of that file: the service isn't asked again. Files of
earlier batches are deleted in ``commit``.

Members may be listed anew for each batch (``members`` is a function then): new ones
start, those that are gone stop, and each has its own cursor. Nothing stops because of a listing
that broke off or came out empty, and a batch's members stand in its plan, so that a repeated one
has the same.

A cursor that has expired makes its member start at a new baseline, and a row with an
``error`` says so. So does a member's failure, after which its cursor stays behind the
last page that was read: the next batch goes on from there.
"""

from __future__ import annotations

import datetime
import json
import time
import urllib.error
import urllib.parse
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions.json_path import matches, steps
from .http import filled, placed, send
from .spool import Folder
from .tokens import authorised

SCHEMA = "feed string, event_time timestamp, id string, text string, error string"


class Expired(Exception):
    """The service no longer knows a cursor."""


@dataclass(frozen=True)
class Reading:
    """Records from a cursor on, the cursor after them, and whether there is more to read at once."""

    items: list[dict[str, Any]]
    cursor: Any
    more: bool = False


class CursorClient(Protocol):
    """``baseline``: the cursor after all that a member has now. ``fetch``: what comes after a cursor (None: from the service's first record on)."""

    def baseline(self, member: str) -> Any: ...

    def fetch(self, member: str, cursor: Any) -> Reading: ...


def reconciled(running: Iterable[str], listed: Iterable[str], complete: bool, static: Iterable[str] = ()) -> list[str]:
    """The members after a listing: static and listed ones, and all running ones where the listing broke off or is empty."""
    listed = set(listed)
    stay = set() if complete and listed else set(running)
    return sorted(listed | stay | set(static))


@dataclass
class Share(InputPartition):
    """One task's members with their cursors: (member, cursor, whether it goes on from there)."""

    poll: int
    number: int
    members: list[tuple[str, Any, bool]]


def _row(member: str, at: int | None, own: str | None, text: str | None, error: str | None) -> bytes:
    return json.dumps([member, at, own, text, error]).encode()


def cursor_source(
    name: str,
    client: CursorClient,
    members: list[str] | Callable[[], tuple[list[str], bool]],
    id_of: Callable[[dict[str, Any]], str | None],
    time_of: Callable[[dict[str, Any]], int | None],
    static: tuple[str, ...] = (),
    clock: Callable[[], int] = lambda: int(time.time() * 1000),
) -> type[DataSource]:
    """A streaming data source to be registered by ``spark.dataSource.register``.

    ``members``: their names, or what lists them and says whether the list is complete. Options:
    ``state``, a folder that driver and tasks share, of this stream alone; ``poll_seconds=60``;
    ``backfill=true``: a new member is read from the service's first record on, not from its baseline; ``parallel=16``, most tasks;
    ``most_pages=1000`` of a member in a batch, the rest is left to the next one;
    ``on_error=fail``: a member's failure fails the batch.
    """

    class Reader(DataSourceStreamReader):
        def __init__(self, options):
            self.folder = Folder(options["state"])
            self.poll, self.parallel, self.most = int(options.get("poll_seconds", 60)) * 1000, int(options.get("parallel", 16)), int(options.get("most_pages", 1000))
            self.backfill, self.fail = options.get("backfill") == "true", options.get("on_error") == "fail"

        def initialOffset(self):
            return {"poll": 0}

        def latestOffset(self):
            return {"poll": max([1, clock() // self.poll, *self._polls()])}  # a clock that was set back repeats the last one

        def _polls(self) -> list[int]:
            return [int(n) for n in self.folder.names() if n.isdigit()]

        def partitions(self, start, end):
            plan = f"{end['poll']}/plan.json"
            if not self.folder.has(plan):
                self.folder.write(plan, [json.dumps(self._planned(start["poll"])).encode()])
            shares: dict[int, list] = {}
            for member, cursor, known in json.loads(self.folder.read(plan)):
                shares.setdefault(zlib.crc32(member.encode()) % self.parallel, []).append((member, cursor, known))
            return [Share(end["poll"], k, own) for k, own in sorted(shares.items())]

        def _planned(self, before: int) -> list[tuple[str, Any, bool]]:
            cursors: dict[str, Any] = {}
            if before:
                if not self.folder.has(f"{before}/plan.json"):
                    raise FileNotFoundError(f"{self.folder.path} lacks the cursors of poll {before}: the stream can't go on without loss")
                for file in self.folder.names(str(before)):
                    if file.startswith("rows-"):
                        cursors |= json.loads(self.folder.note(f"{before}/{file}"))
            listed, complete = members() if callable(members) else (members, True)
            return [(m, cursors.get(m), m in cursors) for m in reconciled(cursors, listed, complete, static)]

        def read(self, partition):
            file = f"{partition.poll}/rows-{partition.number}"
            if not self.folder.has(file):
                note = [b"{}"]
                self.folder.write_noted(file, self._fetched(partition.members, note), note)
            for line in self.folder.noted_lines(file):
                member, at, own, text, error = json.loads(line)
                yield member, None if at is None else datetime.datetime.fromtimestamp(at / 1000, datetime.timezone.utc), own, text, error

        def _fetched(self, own: list[tuple[str, Any, bool]], note: list[bytes]) -> Iterator[bytes]:
            cursors: dict[str, Any] = {}
            for member, cursor, known in own:
                held = [cursor, known]
                try:
                    yield from self._of(member, held)
                except Exception as error:  # noqa: BLE001  whatever it is, the other members go on
                    if self.fail:
                        raise
                    yield _row(member, None, None, None, f"{type(error).__name__}: {error}")
                if held[1]:
                    cursors[member] = held[0]
            note[0] = json.dumps(cursors).encode()

        def _of(self, member: str, held: list) -> Iterator[bytes]:
            """A member's rows; ``held`` is its cursor, and whether it has one, after each page."""
            if not held[1] and not self.backfill:
                held[:] = [client.baseline(member), True]
                return
            for _ in range(self.most):
                try:
                    found = client.fetch(member, held[0])
                except Expired as gone:
                    held[:] = [client.baseline(member), True]
                    yield _row(member, None, None, None, f"the cursor has expired, what came before its new baseline is lost: {gone}")
                    return
                if found.more and found.cursor == held[0]:
                    raise RuntimeError(f"{member}: the cursor {found.cursor} came twice")
                rows = [_row(member, time_of(i), id_of(i), json.dumps(i, ensure_ascii=False, separators=(",", ":")), None) for i in found.items if isinstance(i, dict) and i]
                yield from rows
                held[:] = [found.cursor, True]
                if not found.more:
                    return

        def commit(self, end):
            for poll in self._polls():
                if poll < end["poll"]:
                    self.folder.remove(str(poll))

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return SCHEMA

        def streamReader(self, schema):
            return Reader(self.options)

    return Source


@dataclass(frozen=True)
class CursorRequest:
    """How such a feed is asked for. ``{member}`` in addresses stands for the member's name.

    ``position``: the parameter that takes the cursor, and ``following`` the path of the next one. Where one cursor is read in
    pages, ``page`` has the parameter and the path of their tokens. ``first`` is the cursor of the earliest
    record (None: the parameter is left out), ``now`` that of a baseline; or ``profile`` has the address
    and the path where the baseline is told. ``more``: the path of what says whether there is more;
    without it and without pages, an empty answer or the same cursor ends a poll. With ``body`` the request is a POST.
    """

    url: str
    items: str
    position: str
    following: str
    first: str | None = None
    now: str | None = None
    profile: tuple[str, str] | None = None
    page: tuple[str, str] | None = None
    more: str | None = None
    fixed: dict[str, Any] = field(default_factory=dict)
    body: dict[str, Any] | None = None
    expired: tuple[int, ...] = (404, 410)


def _first(answer: Any, path: str) -> Any:
    return next((v for v in matches(answer, steps(path)) if v not in (None, "")), None)


class HttpCursors:
    """A ``CursorClient`` of one request; ``headers`` are by member, or ``tokens.Tokens`` for all. Its cursors are lists: position, page's token, and the newest position that was told."""

    def __init__(self, request: CursorRequest, headers: Callable[[str], dict[str, str]] = lambda member: {}, timeout: float = 60.0):
        self.request, self.headers, self.timeout = request, headers, timeout

    def _ask(self, member: str, url: str, body: dict[str, Any] | None = None) -> Any:
        return authorised(self.headers if hasattr(self.headers, "renew") else lambda: self.headers(member), lambda headers: send(url, body, headers, self.timeout))[0]

    def baseline(self, member: str) -> Any:
        r = self.request
        if r.profile:
            at = _first(self._ask(member, filled(r.profile[0], {"member": urllib.parse.quote(member, safe="")})), r.profile[1])
            if at is None:
                raise RuntimeError(f"{member}: no {r.profile[1]} is told")
            return [str(at), None, None]
        if r.now is None:
            raise RuntimeError("this service has no baseline: read it with backfill=true")
        return [_first(self._answer(member, r.now, None), r.following) or r.now, None, None]

    def _answer(self, member: str, position: str | None, token: str | None) -> Any:
        r = self.request
        own = [*r.fixed.items(), *([(r.position, position)] if position is not None else []), *([(r.page[0], token)] if r.page and token else [])]
        url = filled(r.url, {"member": urllib.parse.quote(member, safe="")})
        if r.body is None:
            return self._ask(member, url + ("?" + urllib.parse.urlencode(own, doseq=True) if own else ""))
        body = json.loads(json.dumps(r.body))
        for path, value in own:
            placed(body, path, value)
        return self._ask(member, url, body)

    def fetch(self, member: str, cursor: Any) -> Reading:
        r = self.request
        position, token, newest = cursor or [r.first, None, None]
        try:
            answer = self._answer(member, position, token)
        except urllib.error.HTTPError as error:
            if error.code in r.expired and cursor:
                raise Expired(f"status {error.code} at {position}") from error
            raise
        items = [i for group in matches(answer, steps(r.items)) for i in (group if isinstance(group, list) else [group]) if isinstance(i, dict) and i]
        newest = _first(answer, r.following) or newest
        token = _first(answer, r.page[1]) if r.page else None
        if token:
            return Reading(items, [position, str(token), newest], True)
        after = position if newest is None else str(newest)
        more = bool(_first(answer, r.more)) if r.more else not r.page and bool(items) and after != position
        return Reading(items, [after, None, None], more and after != position)
