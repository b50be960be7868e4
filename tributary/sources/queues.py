"""Message queues as a streaming data source whose tasks receive.

A batch's tasks take messages from the queue, write them with their receipts to
files of the batch, and hand on what they have written: no message passes the
driver. A batch that is repeated, as after the driver was lost, gives the rows of its
files, and the queue isn't asked again. ``commit``, after the batch is written,
acknowledges from the files' receipts. A message whose files were never
finished was never acknowledged and comes again; one that comes again
because its receipt ran out has the same ``message_id``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .spool import Folder

SCHEMA = "message_id string, body string"


@dataclass(frozen=True)
class Message:
    """``receipt`` acknowledges this delivery of the message."""

    id: str
    receipt: str
    body: str


class Queue(Protocol):
    """A queue's client. ``receive`` gives up to ``most`` messages, none if there are none just now; unacknowledged ones come again."""

    def receive(self, most: int) -> list[Message]: ...

    def acknowledge(self, receipts: list[str]) -> None: ...


@dataclass
class Receiver(InputPartition):
    batch: int
    number: int


def queue_source(name: str, queue: Queue, clock: Callable[[], float] = time.time) -> type[DataSource]:
    """A source to be registered by ``spark.dataSource.register``.

    Options: ``state``, a folder that driver and tasks share, of this stream alone;
    ``receivers=4``, tasks of a batch; ``messages=10000``, at most, of each; ``seconds=30`` that each
    may receive (both well within the time in which the queue wants its acknowledgements);
    ``poll_seconds=5`` between the beginnings of batches; ``at_once=10``.
    """

    class Reader(DataSourceStreamReader):
        def __init__(self, options):
            self.folder = Folder(options["state"])
            self.receivers, self.messages, self.at_once = (int(options.get(k, n)) for k, n in (("receivers", 4), ("messages", 10_000), ("at_once", 10)))
            self.seconds, self.poll = float(options.get("seconds", 30)), float(options.get("poll_seconds", 5))

        def initialOffset(self):
            return {"batch": 0}

        def latestOffset(self):
            return {"batch": max([1, int(clock() / self.poll), *self._batches()])}

        def _batches(self) -> list[int]:
            return [int(n) for n in self.folder.names() if n.isdigit()]

        def partitions(self, start, end):
            return [Receiver(end["batch"], k) for k in range(self.receivers)]

        def read(self, partition):
            file = f"{partition.batch}/messages-{partition.number}"
            if not self.folder.has(file):
                self.folder.write(file, self._received())
            for line in self.folder.lines(file):
                own, _, body = json.loads(line)
                yield own, body

        def _received(self) -> Iterator[bytes]:
            left, end = self.messages, time.monotonic() + self.seconds
            while left > 0 and time.monotonic() < end:
                got = queue.receive(min(left, self.at_once))
                if not got:
                    return
                left -= len(got)
                for m in got:
                    yield json.dumps([m.id, m.receipt, m.body]).encode() + b"\n"

        def commit(self, end):
            for batch in self._batches():
                if batch <= end["batch"]:
                    for file in self.folder.names(str(batch)):
                        self._acknowledged(f"{batch}/{file}")
                    self.folder.remove(str(batch))

        def _acknowledged(self, file: str) -> None:
            held: list[str] = []
            for line in self.folder.lines(file):
                held.append(json.loads(line)[1])
                if len(held) == self.at_once:
                    queue.acknowledge(held)
                    held = []
            if held:
                queue.acknowledge(held)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return SCHEMA

        def streamReader(self, schema):
            return Reader(self.options)

    return Source
