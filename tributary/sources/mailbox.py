"""Mailboxes by their messages' numbers (UIDs), as a streaming source.

The stream's offset is the mailbox's validity and the last UID. A batch's UIDs are
cut to ranges that tasks fetch apart, so a batch that is repeated fetches the same
ones. A mailbox whose validity has changed has numbered its messages anew and is
read from its first one. The first batch begins after the last message of the newest day that has mail, or
at the first message with ``from_zero``.
"""

from __future__ import annotations

import datetime
import imaplib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "validity bigint, uid bigint, flags array<string>, content binary"
#: Days that are searched for the newest mail.
DAYS = 365


class Mailbox(Protocol):
    """``status``: the validity and the next UID. ``since``: the UIDs of messages that came on a day or after it. ``fetch``: (uid, flags, message) of a range."""

    def status(self) -> tuple[int, int]: ...

    def since(self, day: datetime.date) -> list[int]: ...

    def fetch(self, low: int, high: int) -> Iterator[tuple[int, list[str], bytes]]: ...


@dataclass
class Range(InputPartition):
    validity: int
    low: int
    high: int


def last_known(mailbox: Mailbox, today: datetime.date) -> int:
    """The last UID of the newest day that has mail, 0 where no day of the last year has any."""
    for back in range(1, DAYS + 1):
        found = mailbox.since(today - datetime.timedelta(days=back))
        if found:
            return max(found)
    return 0


def mailbox_source(name: str, connect: Callable[[], Mailbox], today: Callable[[], datetime.date] = datetime.date.today) -> type[DataSource]:
    """A source to be registered by ``spark.dataSource.register``.

    ``connect`` opens the mailbox, on the driver and in each task. Options:
    ``from_zero=true``; ``span=500``, UIDs of a task's range. A message that was deleted before it
    was fetched is not there; UIDs outside the range that was asked for are dropped.
    """

    class Reader(DataSourceStreamReader):
        def __init__(self, options):
            self.from_zero, self.span = options.get("from_zero") == "true", int(options.get("span", 500))

        def initialOffset(self):
            mailbox = connect()
            validity, _ = mailbox.status()
            return {"validity": validity, "uid": 0 if self.from_zero else last_known(mailbox, today())}

        def latestOffset(self):
            validity, following = connect().status()
            return {"validity": validity, "uid": following - 1}

        def partitions(self, start, end):
            before = start["uid"] if start["validity"] == end["validity"] else 0
            return [Range(end["validity"], a, min(end["uid"], a + self.span - 1)) for a in range(before + 1, end["uid"] + 1, self.span)]

        def read(self, partition):
            mailbox = connect()
            if mailbox.status()[0] != partition.validity:
                return  # these numbers mean nothing any more: the next batch reads the mailbox anew
            for uid, flags, content in mailbox.fetch(partition.low, partition.high):
                if partition.low <= uid <= partition.high:
                    yield partition.validity, uid, flags, content

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
class Imap:
    """Opens a mailbox of an IMAP server: ``mailbox_source(name, Imap(...))``. Nothing is marked as read."""

    host: str
    user: str
    password: str
    folder: str = "INBOX"
    port: int = 993
    tls: bool = True

    def __call__(self) -> ImapMailbox:
        server = (imaplib.IMAP4_SSL if self.tls else imaplib.IMAP4)(self.host, self.port, timeout=60)
        server.login(self.user, self.password)
        return ImapMailbox(server, self.folder)


def _done(answer: tuple) -> list:
    kind, data = answer
    if kind != "OK":
        raise ConnectionError(f"the server says {kind}: {data}")
    return data


class ImapMailbox:
    #: Messages that are asked for at once.
    AT_ONCE = 20

    def __init__(self, server: imaplib.IMAP4, folder: str):
        self.server, self.folder = server, folder
        _done(server.select(f'"{folder}"', readonly=True))

    def status(self) -> tuple[int, int]:
        told = b" ".join(_done(self.server.status(f'"{self.folder}"', "(UIDVALIDITY UIDNEXT)"))).decode()
        return tuple(int(re.search(rf"{name} (\d+)", told)[1]) for name in ("UIDVALIDITY", "UIDNEXT"))

    def since(self, day: datetime.date) -> list[int]:
        months = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
        found = _done(self.server.uid("SEARCH", "SINCE", f"{day.day:02d}-{months[day.month - 1]}-{day.year}"))
        return [int(n) for part in found if part for n in part.split()]

    def fetch(self, low: int, high: int) -> Iterator[tuple[int, list[str], bytes]]:
        for at in range(low, high + 1, self.AT_ONCE):
            for piece in _done(self.server.uid("FETCH", f"{at}:{min(high, at + self.AT_ONCE - 1)}", "(UID FLAGS BODY.PEEK[])")):
                if isinstance(piece, tuple):
                    head = piece[0].decode("ascii", "replace")
                    flags = re.search(r"FLAGS \(([^)]*)\)", head)
                    yield int(re.search(r"\bUID (\d+)", head)[1]), flags[1].split() if flags else [], piece[1]
