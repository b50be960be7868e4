"""Files that grow and rotate, as a streaming source of the lines that were added.

The stream's offset has, by device and inode, the size of each file that it has seen and
hashes of the file's beginning: of its first 1, 2, 4, ... bytes, up to HEAD. A file that is
renamed stays the same one, as long as the pattern matches its new name, and a
new file under the old name is read from its start. So is a file that is now smaller than it was, and
one that begins otherwise than it did: inodes are given to new files as soon as old ones are
deleted. (A new file on an old inode is taken for the old one only if it has outgrown it and begins with the
same bytes, as far as they were hashed.) A batch's ranges of bytes are cut to parts
that tasks read apart; a line belongs to the part in which it ends, so a line
that isn't finished waits until it is. A batch that is repeated gives the same lines.

Files must be mounted under one path on the driver and all executors. The driver lists them each batch, and
an offset has some 150 bytes for each: the pattern should match thousands of files, not
millions. Known files that weren't changed for ``inactive_seconds`` aren't opened: their places stay in the
offset, and they go on from there when they change. Lost are lines that are removed before a batch has seen them.
"""

from __future__ import annotations

import glob
import hashlib
import logging
import os
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "path string, offset bigint, text string"
#: Bytes that are read at once.
_PIECE = 1 << 16
#: Bytes of a file's beginning that tell it from another one.
HEAD = 4096


@dataclass
class Part(InputPartition):
    """The bytes [start, end) of a file."""

    file: str
    path: str
    start: int
    end: int


def _identity(status: os.stat_result) -> str:
    return f"{status.st_dev}:{status.st_ino}"


def head(path: str, size: int) -> list[str]:
    """Hashes of the first 1, 2, 4, ... bytes of a file, as far as it has them."""
    with open(path, "rb") as file:
        content = file.read(min(size, HEAD))
    return [hashlib.sha256(content[: 1 << k]).hexdigest()[:8] for k in range(len(content).bit_length()) if 1 << k <= len(content)]


def continues(before: list, now: list) -> bool:
    """Whether a file (size, head) is the one that it was: not smaller, and with the same beginning."""
    return before[0] <= now[0] and now[1][: len(before[1])] == before[1]


def sizes(pattern: str, known: dict[str, list] | None = None, inactive: float | None = None) -> dict[str, tuple[str, list]]:
    """The path of each file that a pattern matches, and its size and head, by its identity.

    A known file that wasn't changed for ``inactive`` seconds is as it is known.
    """
    found = {}
    for path in sorted(glob.glob(pattern, recursive=True)):
        try:
            status = os.stat(path)
            if not os.path.isfile(path):
                continue
            own = (known or {}).get(_identity(status))
            if inactive is not None and time.time() - status.st_mtime > inactive and own and own[0] == status.st_size:
                found[_identity(status)] = (path, own)
                continue
            found[_identity(status)] = (path, [status.st_size, head(path, status.st_size)])
        except FileNotFoundError:  # it was moved since it was listed, and is found under its new name
            continue
    return found


def _opened(part: Part, pattern: str):
    """The part's file, wherever it is now."""
    for path in (part.path, *glob.iglob(pattern, recursive=True)):
        try:
            file = open(path, "rb")  # noqa: SIM115
        except (FileNotFoundError, IsADirectoryError):
            continue
        if _identity(os.fstat(file.fileno())) == part.file:
            return file
        file.close()
    raise FileNotFoundError(f"{part.path or part.file} is neither there nor under another name that matches {pattern}")


def _line_start(file, at: int) -> int:
    """Where the line that holds the byte ``at`` begins."""
    while at > 0:
        low = max(0, at - _PIECE)
        file.seek(low)
        cut = file.read(at - low).rfind(b"\n")
        if cut >= 0:
            return low + cut + 1
        at = low
    return 0


def lines_of(part: Part, pattern: str) -> Iterator[tuple[str, int, str]]:
    """(path, offset, text): the lines that end in a part, without empty ones."""
    with _opened(part, pattern) as file:
        at = _line_start(file, part.start)
        file.seek(at)
        while at < part.end:
            line = file.readline(part.end - at)
            if not line.endswith(b"\n"):
                return
            text = line[:-1].decode("utf-8", "replace")
            if text:
                yield part.path, at, text
            at += len(line)


def tail_source(name: str = "tail") -> type[DataSource]:
    """A data source to be registered by ``spark.dataSource.register``.

    Options: ``path``, a pattern of paths that rotated names should match too;
    ``backfill=false``: only lines after the start are read; ``split``: bytes of a
    part, 64 MB unless given; ``inactive_seconds``: see above; ``fail_on_loss=false``: a file that is deleted before all
    of it was read is left out, with an error in the log, where it otherwise fails the query.
    """

    class Reader(DataSourceStreamReader):
        def __init__(self, options):
            self.pattern, self.split = options["path"], int(options.get("split", 64 << 20))
            self.backfill = options.get("backfill", "true") != "false"
            self.fail_on_loss = options.get("fail_on_loss", "true") != "false"
            self.inactive = float(options["inactive_seconds"]) if "inactive_seconds" in options else None
            self.known: dict[str, list] = {}

        def initialOffset(self):
            return {} if self.backfill else self.latestOffset()

        def latestOffset(self):
            self.known = {file: own for file, (_, own) in sizes(self.pattern, self.known, self.inactive).items()}
            return dict(self.known)

        def partitions(self, start, end):
            paths, parts = {}, []
            for path in glob.glob(self.pattern, recursive=True):
                try:
                    paths[_identity(os.stat(path))] = path
                except FileNotFoundError:
                    continue
            for file, (size, own) in sorted(end.items()):
                before = start.get(file)
                if isinstance(before, int):  # an offset of an earlier version, without heads
                    before = [before, []]
                low = before[0] if before and continues(before, [size, own]) else 0
                parts += [Part(file, paths.get(file, ""), a, min(size, a + self.split)) for a in range(low, size, self.split)]
            return parts

        def read(self, partition):
            try:
                yield from lines_of(partition, self.pattern)
            except FileNotFoundError as lost:
                if self.fail_on_loss:
                    raise
                logging.getLogger(__name__).error("%s; bytes %s to %s are left out", lost, partition.start, partition.end)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return SCHEMA

        def streamReader(self, schema):
            return Reader(self.options)

    return Source
