"""Paged APIs as Spark data sources.

A feed is read by time: a read covers [since, until), cut to slices that tasks
walk apart, each through all its pages in ascending order. The stream's offset
is the end of the last range, kept in the query's checkpoint; ``until`` trails
the clock by the feed's lag, so that records that become visible late are not
passed over, and the range before it may be read again by ``overlap``, for a
de-duplicating query. A failed slice fails its task and is read anew: nothing is
skipped, and nothing is marked as read before its batch is written.

Services may ignore bounds: records outside the range that was asked for are
dropped here, so each stands in one slice only. A feed whose service takes only
one bound or none is read in one slice.
"""

from __future__ import annotations

import datetime
import json
import logging
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan

from ..functions.json_path import matches, steps
from .pushdown import tests_of
from .retry import Refused

SCHEMA = "feed string, event_time timestamp, id string, text string"


@dataclass(frozen=True)
class Page:
    """Records of one response, and where the next page begins (None: there is none)."""

    items: list[dict[str, Any]]
    following: Any = None


class Client(Protocol):
    """Fetches a page of the records of a feed with ``since <= time < until`` (milliseconds), ascending by (time, id)."""

    def fetch(self, feed: str, since: int, until: int, cursor: Any) -> Page: ...


@dataclass(frozen=True)
class Feed:
    """A feed's name and how its records are read. Times are milliseconds.

    ``bounded``: the service takes both bounds, so that slices of a range save
    work. ``newest_first``: it gives its records in descending order, so that a
    page before the range is the last one needed. ``checked``: records are held
    against the range by their own times; not so where the client has done it by
    another time, as that of a listing. ``exact``: the service's comparisons tell cases apart,
    so that negated conditions may be sent to it.
    """

    name: str
    id_of: Callable[[dict[str, Any]], str | None]
    time_of: Callable[[dict[str, Any]], int | None]
    lookback: int = 15 * 60_000
    lag: int = 5 * 60_000
    overlap: int = 0
    slice: int = 60 * 60_000
    bounded: bool = True
    newest_first: bool = False
    checked: bool = True
    exact: bool = False


@dataclass
class Slice(InputPartition):
    feed: str
    since: int
    until: int


def slices(feed: str, since: int, until: int, width: int) -> list[Slice]:
    """[since, until) in parts of ``width``."""
    return [Slice(feed, a, min(until, a + width)) for a in range(since, until, width)]


def walk(client: Client, feed: Feed, since: int, until: int) -> Iterator[dict[str, Any]]:
    """All records of a slice. A cursor that comes back is a service's error."""
    cursor, before = None, set()
    while True:
        page = client.fetch(feed.name, since, until, cursor)
        yield from page.items
        if page.following is None:
            return
        if feed.newest_first:
            times = [t for i in page.items if (t := feed.time_of(i)) is not None]
            if times and max(times) < since:
                return
        mark = json.dumps(page.following, sort_keys=True, default=str)
        if mark in before:
            raise RuntimeError(f"{feed.name}: the cursor {mark} came twice")
        before.add(mark)
        cursor = page.following


#: Kinds of columns that a source may take out of its records.
_KINDS: dict[str, Callable[[Any], Any]] = {
    "string": lambda v: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False),
    "long": lambda v: v if isinstance(v, int) and not isinstance(v, bool) else None,
    "double": lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None,
    "timestamp": lambda v: None if (t := _read_time(v)) is None else datetime.datetime.fromtimestamp(t / 1000, datetime.timezone.utc),
}


def _read_time(value: Any) -> int | None:
    from .http import read_time

    return read_time(value)


def _rows(client: Client, feed: Feed, part: Slice, skip_forbidden: bool = False, columns: dict[str, tuple[str, str]] = {}):  # noqa: B006
    own = [(steps(path), _KINDS[kind]) for path, kind in columns.values()]
    try:
        for item, *row in _records(client, feed, part):
            found = [next((v for v in matches(item, path) if v is not None), None) for path, _ in own]
            yield (*row, *(None if v is None else of(v) for v, (_, of) in zip(found, own)))
    except Refused as refused:
        if refused.stops_all or not skip_forbidden:
            raise
        logging.getLogger(__name__).error("%s: %s; the feed is left out", feed.name, refused)


def _records(client: Client, feed: Feed, part: Slice):
    for item in walk(client, feed, part.since, part.until):
        if not isinstance(item, dict) or not item:
            continue
        at = feed.time_of(item)
        if feed.checked and at is not None and not part.since <= at < part.until:
            continue
        moment = None if at is None else datetime.datetime.fromtimestamp(at / 1000, datetime.timezone.utc)
        yield item, feed.name, moment, feed.id_of(item), json.dumps(item, ensure_ascii=False, separators=(",", ":"))


def paged_source(name: str, feeds: list[Feed], client: Client, clock: Callable[[], int] = lambda: int(time.time() * 1000), columns: dict[str, tuple[str, str]] | None = None) -> type[DataSource]:
    """A data source to be registered by ``spark.dataSource.register``.

    ``columns``: more columns by name, each with the path of its value in the records, which is also the
    service's name for it, and its kind: string, long, double or timestamp.

    Options: ``feed`` (default: all), ``since`` and ``until`` in milliseconds
    (batch: default is the feed's lookback, until now less its lag);
    ``push_filters=true``: bounds on event_time narrow a batch's range, and conditions on
    ``columns`` go to a client that takes them (``where``), for which
    ``spark.sql.python.filterPushdown.enabled`` must be set. Spark keeps one set of
    pushed conditions for a loaded table, so load one for each query that has them;
    ``skip_forbidden=true``: a feed that the service forbids (403) is left out, with
    an error in the log, where it otherwise fails the read, as refused credentials
    (401) always do.
    """
    by_name, taken = {f.name: f for f in feeds}, columns or {}

    def cut(feed: Feed, since: int, until: int) -> list[Slice]:
        return slices(feed.name, since, until, feed.slice if feed.bounded else max(1, until - since))

    def chosen(options: dict[str, str]) -> list[Feed]:
        return [by_name[options["feed"]]] if "feed" in options else feeds

    class Batch(DataSourceReader):
        def __init__(self, options):
            self.options, self.since, self.until, self.client = options, None, None, client

        def partitions(self):
            out = []
            for feed in chosen(self.options):
                until = int(self.options.get("until", clock() - feed.lag))
                since = int(self.options.get("since", until - feed.lookback))
                since, until = max(since, self.since or since), min(until, self.until or until)
                out += cut(feed, since, until)
            return out or [Slice(feeds[0].name, 0, 0)]

        def read(self, partition):
            return _rows(self.client, by_name[partition.feed], partition, self.options.get("skip_forbidden") == "true", taken) if partition.until > partition.since else iter(())

    class Pushed(Batch):
        def pushFilters(self, filters):
            """Bounds on event_time narrow what is asked of the service, other conditions go to it; Spark checks all of them again."""
            tests = tests_of(filters, taken, all(f.exact for f in chosen(self.options)))
            if tests and hasattr(client, "where"):
                self.client = client.where(tests)
            for f in filters:
                bound = getattr(f, "value", None)
                if getattr(f, "attribute", None) == ("event_time",) and hasattr(bound, "timestamp"):
                    at = int(bound.timestamp() * 1000)
                    if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                        self.since = max(at, self.since or at)
                    elif isinstance(f, LessThan):
                        self.until = min(at + 1, self.until or at + 1)
                yield f

    class Stream(DataSourceStreamReader):
        def __init__(self, options):
            self.options = options

        def initialOffset(self):
            return {f.name: int(self.options.get("since", clock() - f.lag - f.lookback)) for f in chosen(self.options)}

        def latestOffset(self):
            return {f.name: clock() - f.lag for f in chosen(self.options)}

        def partitions(self, start, end):
            out = []
            for feed in chosen(self.options):
                if end[feed.name] > start[feed.name]:
                    out += cut(feed, start[feed.name] - feed.overlap, end[feed.name])
            return out

        def read(self, partition):
            return _rows(client, by_name[partition.feed], partition, self.options.get("skip_forbidden") == "true", taken)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return SCHEMA + "".join(f", `{n}` {kind}" for n, (_, kind) in taken.items())

        def reader(self, schema):
            return (Pushed if self.options.get("push_filters") == "true" else Batch)(self.options)

        def streamReader(self, schema):
            return Stream(self.options)

    return Source
