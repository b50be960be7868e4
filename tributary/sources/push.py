"""Services that push events over a connection that stays open.

Such a service is a ``cursors.CursorClient``: a batch listens to each of its streams for
some seconds from the stream's offset on, and the offset after the last event is the
cursor that the batch leaves. Streams are the members of ``cursor_source``, which may be
listed anew for each batch; each is one task's work at a time.
"""

from __future__ import annotations

import json
import socket
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from typing import Any

from .cursors import Expired, Reading
from .http import first_at, read_time
from .retry import Refused


def lines_of(response: Any, seconds: float, clock: Callable[[], float] = time.monotonic) -> Iterator[bytes]:
    """The whole lines that an open answer gives in so many seconds; it ends earlier if the answer does or nothing comes for the connection's time limit."""
    end = clock() + seconds
    rest = b""
    while clock() < end:
        try:
            piece = response.read1(1 << 16)
        except (TimeoutError, socket.timeout):
            return
        if not piece:
            if rest.strip():
                yield rest
            return
        *whole, rest = (rest + piece).split(b"\n")
        yield from whole


class PushClient:
    """Listens to ``url``, in which ``{member}`` and ``{offset}`` stand for the stream and the offset after which events are wanted.

    ``offset``, ``time``: where an event has its offset (a number) and its time. Events before ``not_before``
    (milliseconds) are passed over: what a service keeps of the past needn't be read. Without an offset a
    stream is listened to from 0. A line that isn't JSON is an error, for events after it would hide it;
    an empty one keeps the connection open.
    """

    def __init__(self, url: str, headers: Callable[[str], dict[str, str]] = lambda member: {}, offset: tuple[str, ...] = ("metadata/offset",), time_path: tuple[str, ...] = ("metadata/eventCreationTime",), not_before: int = 0, seconds: float = 20.0, quiet: float = 5.0):
        self.url, self.headers, self.offset, self.time_path = url, headers, offset, time_path
        self.not_before, self.seconds, self.quiet = not_before, seconds, quiet

    def baseline(self, member: str) -> Any:
        return 0

    def fetch(self, member: str, cursor: Any) -> Reading:
        url = self.url.replace("{member}", urllib.parse.quote(member, safe="")).replace("{offset}", str(cursor or 0))
        items, last = [], cursor or 0
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=self.headers(member)), timeout=self.quiet) as response:
                for line in lines_of(response, self.seconds):
                    if not line.strip():
                        continue
                    event = json.loads(line)
                    at, n = read_time(first_at(event, self.time_path)), first_at(event, self.offset)
                    if n is not None and int(n) <= last and cursor is not None:
                        continue  # it was read before
                    last = last if n is None else int(n)
                    if at is None or at >= self.not_before:
                        items.append(event)
        except urllib.error.HTTPError as error:
            if error.code in (401, 403):
                raise Refused(error.code) from error
            if error.code in (404, 410) and cursor:
                raise Expired(f"status {error.code} at {cursor}") from error
            raise
        return Reading(items, last)
