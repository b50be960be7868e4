"""Small durable files that driver and tasks share: what a batch has read, and where the next one begins."""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow.fs as pafs


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of an address and the path there; without a scheme, this machine's (or a mount's)."""
    if re.match(r"\w+:/", path):
        return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))
    return pafs.LocalFileSystem(), path


class Folder:
    """A folder of such files, which ``pyarrow.fs`` opens (``file``, ``hdfs``, ``s3`` and ``gs`` addresses).

    A file appears whole or not at all, and the first one of a name stays, so
    that all attempts of a task give what one of them wrote. (Object stores tell only
    before they write whether a name is taken; there two attempts at the same moment
    could differ, so speculation should be off.)
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _at(self, name: str) -> tuple[pafs.FileSystem, str]:
        system, root = opened(self.path)
        return system, f"{root}/{name}" if name else root

    def has(self, name: str) -> bool:
        system, path = self._at(name)
        return system.get_file_info(path).type != pafs.FileType.NotFound

    def write(self, name: str, chunks: Iterable[bytes]) -> None:
        """Writes a file, unless it is there."""
        system, path = self._at(name)
        system.create_dir(os.path.dirname(path), recursive=True)
        draft = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
        try:
            with system.open_output_stream(draft, compression=None) as out:
                for chunk in chunks:
                    out.write(chunk)
            if isinstance(system, pafs.LocalFileSystem):
                os.link(draft, path)
            elif not self.has(name):
                system.move(draft, path)
        except FileExistsError:
            pass
        finally:
            if system.get_file_info(draft).type != pafs.FileType.NotFound:
                system.delete_file(draft)

    def read(self, name: str) -> bytes | None:
        system, path = self._at(name)
        try:
            with system.open_input_stream(path, compression=None) as file:
                return file.read()
        except FileNotFoundError:
            return None

    def lines(self, name: str) -> Iterator[bytes]:
        """The lines of a file, read piece by piece."""
        system, path = self._at(name)
        with system.open_input_stream(path, compression=None, buffer_size=1 << 20) as file:
            rest = b""
            while piece := file.read(1 << 20):
                *whole, rest = (rest + piece).split(b"\n")
                yield from whole
            if rest:
                yield rest

    def names(self, below: str = "") -> list[str]:
        """The names of files and folders in a folder."""
        system, path = self._at(below)
        found = system.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        return sorted(i.base_name for i in found if not i.base_name.startswith("."))

    def remove(self, name: str) -> None:
        """Deletes a file, or a folder with all it holds."""
        system, path = self._at(name)
        kind = system.get_file_info(path).type
        if kind == pafs.FileType.Directory:
            system.delete_dir(path)
        elif kind == pafs.FileType.File:
            system.delete_file(path)

    # rows with a note after them: one file, so that they are never of different attempts

    def write_noted(self, name: str, lines: Iterable[bytes], note: list[bytes]) -> None:
        """Lines and, after the last of them was taken, the note that then stands in ``note``."""

        def chunks():
            for line in lines:
                yield line + b"\n"
            yield note[0] + struct.pack("<Q", len(note[0]))

        self.write(name, chunks())

    def note(self, name: str) -> bytes:
        """The note of a file; its lines aren't read."""
        system, path = self._at(name)
        with system.open_input_file(path) as file:
            size = file.size()
            file.seek(size - 8)
            length = struct.unpack("<Q", file.read(8))[0]
            file.seek(size - 8 - length)
            return file.read(length)

    def noted_lines(self, name: str) -> Iterator[bytes]:
        """The lines of a file with a note."""
        system, path = self._at(name)
        left = system.get_file_info(path).size - 8 - len(self.note(name))
        with system.open_input_stream(path, compression=None) as file:
            rest = b""
            while left > 0 and (piece := file.read(min(left, 1 << 20))):
                left -= len(piece)
                *whole, rest = (rest + piece).split(b"\n")
                yield from whole
