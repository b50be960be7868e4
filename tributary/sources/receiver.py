"""A listener for logs that are sent over the network, and the stream of what it has received.

The listener runs beside Spark, by itself: it takes TCP connections (lines, over TLS
if a context is given) or UDP datagrams (one record each, its line ends kept) and writes the records,
each with its length before it, to files in a folder that Spark can read. A file is forced to the disk and
gets its final name when it is large or old enough; Spark reads only such files, as a
stream of its own with its own checkpoint. Records of a file that was not finished are kept: at
the next start it is cut after its last whole record and finished. What is lost with the machine is what wasn't forced
to the disk yet, ``seconds`` of records at most.
"""

from __future__ import annotations

import os
import socket
import ssl
import struct
import threading
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "path string, offset bigint, received timestamp, sender string, text string"
_HEAD = struct.Struct(">IqH")  # lengths of text, microseconds, length of the sender


def frame(text: bytes, sender: str, at_micros: int) -> bytes:
    who = sender.encode()[:65535]
    return _HEAD.pack(len(text), at_micros, len(who)) + who + text


def frames(content: bytes) -> Iterator[tuple[int, int, str, bytes]]:
    """(place, microseconds, sender, text) of the whole records of a file."""
    at = 0
    while at + _HEAD.size <= len(content):
        size, micros, who = _HEAD.unpack_from(content, at)
        end = at + _HEAD.size + who + size
        if end > len(content):
            return
        begin = at + _HEAD.size
        yield at, micros, content[begin : begin + who].decode("utf-8", "replace"), content[begin + who : end]
        at = end


class Spool:
    """Appends records to files; ``most`` bytes or ``seconds`` finish one."""

    def __init__(self, folder: str, most: int = 64 << 20, seconds: float = 10.0):
        self.folder, self.most, self.seconds = folder, most, seconds
        self.lock, self.file, self.name, self.began = threading.Lock(), None, "", 0.0
        os.makedirs(folder, exist_ok=True)
        for name in os.listdir(folder):
            if name.startswith(".") and name.endswith(".part"):
                self._recover(f"{folder}/{name}")

    def _recover(self, path: str) -> None:
        with open(path, "r+b") as file:
            content = file.read()
            last = None
            for last in frames(content):
                pass
            file.truncate(0 if last is None else last[0] + _HEAD.size + len(last[2].encode()) + len(last[3]))
        self._finish(path)

    def _finish(self, path: str) -> None:
        if os.path.getsize(path):
            os.rename(path, f"{self.folder}/{os.path.basename(path)[1:].removesuffix('.part')}.frames")
        else:
            os.remove(path)

    def add(self, text: bytes, sender: str) -> None:
        """Adds a record; empty ones are passed over."""
        if not text:
            return
        with self.lock:
            if self.file is None:
                self.name, self.began = f"{self.folder}/.{uuid.uuid4().hex}.part", time.monotonic()
                self.file = open(self.name, "ab")  # noqa: SIM115
            self.file.write(frame(text, sender, time.time_ns() // 1000))
            if self.file.tell() >= self.most:
                self._close()

    def tick(self, now: bool = False) -> None:
        """Finishes a file that is old enough, or ``now``."""
        with self.lock:
            if self.file is not None and (now or time.monotonic() - self.began >= self.seconds):
                self._close()

    def _close(self) -> None:
        self.file.flush()
        os.fsync(self.file.fileno())
        self.file.close()
        self.file = None
        self._finish(self.name)


class Listener:
    """Listens until ``close``. ``port=0`` takes a free one; ``context``: TLS, mutual if it asks for certificates; a line of more than ``most_line`` bytes ends its connection."""

    def __init__(self, spool: Spool, host: str = "0.0.0.0", port: int = 514, udp: bool = False, context: ssl.SSLContext | None = None, most_line: int = 1 << 20):
        if udp and context:
            raise ValueError("there is no TLS over datagrams")
        self.spool, self.context, self.most_line, self.open = spool, context, most_line, True
        self.socket = socket.socket(socket.AF_INET, socket.SOCK_DGRAM if udp else socket.SOCK_STREAM)
        self.socket.setsockopt(socket.SOL_SOCKET, socket.SO_REUSEADDR, 1)
        self.socket.bind((host, port))
        self.socket.settimeout(0.2)
        self.port = self.socket.getsockname()[1]
        if not udp:
            self.socket.listen(128)
        self.threads = [threading.Thread(target=self._datagrams if udp else self._connections, daemon=True), threading.Thread(target=self._ticks, daemon=True)]
        for t in self.threads:
            t.start()

    def _ticks(self) -> None:
        while self.open:
            time.sleep(0.2)
            self.spool.tick()

    def _datagrams(self) -> None:
        while self.open:
            try:
                content, sender = self.socket.recvfrom(1 << 16)
            except TimeoutError:
                continue
            except OSError:
                return
            self.spool.add(content, sender[0])

    def _connections(self) -> None:
        while self.open:
            try:
                connection, sender = self.socket.accept()
            except TimeoutError:
                continue
            except OSError:
                return
            threading.Thread(target=self._lines, args=(connection, sender[0]), daemon=True).start()

    def _lines(self, connection: socket.socket, sender: str) -> None:
        rest = b""
        try:
            connection.settimeout(30.0)
            if self.context:
                connection = self.context.wrap_socket(connection, server_side=True)
            connection.settimeout(0.2)
            while self.open and len(rest) <= self.most_line:
                try:
                    piece = connection.recv(1 << 16)
                except TimeoutError:
                    continue
                if not piece:
                    break
                *whole, rest = (rest + piece).split(b"\n")
                for line in whole:
                    self.spool.add(line, sender)
        except OSError:  # the sender is gone, or it isn't trusted: its whole lines are kept
            pass
        finally:
            if len(rest) <= self.most_line:
                self.spool.add(rest, sender)  # a last line without its end
            connection.close()

    def close(self) -> None:
        """Stops, and finishes what was received."""
        self.open = False
        self.socket.close()
        for t in self.threads:
            t.join(5)
        self.spool.tick(now=True)


def received(rows: DataFrame) -> DataFrame:
    """Rows of SCHEMA of spooled files (path, content)."""

    def decoded(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = [(name, at, micros, sender, text.decode("utf-8", "replace")) for at, micros, sender, text in frames(content)]
                for k in range(0, len(held), 10_000):
                    columns = zip(*held[k : k + 10_000])
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.string(), pa.string()))], names=["path", "offset", "received", "sender", "text"])

    return rows.select("path", "content").mapInArrow(decoded, SCHEMA)


def received_stream(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """The records as they arrive; files are at most as large as the listener makes them."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    return received(files.option("pathGlobFilter", "*.frames").option("maxFilesPerTrigger", files_a_batch).load(folder))
