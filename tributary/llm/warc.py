"""WARC archives (ISO 28500, version 1.1) as a Spark data source.

Writing: each task writes archives of its own, of up to ``max_file_bytes``, and
names them to ``commit``, which lists those of all successful tasks in one small
index file. What lost, failed or repeated tasks have left is in no index and is
never read. The index also has places at which records begin, every
``split_bytes``, so that large archives are read by many tasks.

Reading: the driver plans ranges of files from the index, or, for archives of other
writers, whole files. A task parses a record's header first. With ``push_filters=true``
(and ``spark.sql.python.filterPushdown.enabled`` set) filters on the record's type and
on header columns are pushed down: of a record that they leave out, and with
``payload=false`` of every record, the block is passed over by its length, neither read
nor decoded. In compressed archives (``.gz``) each record is a
member of its own, whose packed length this writer puts into the gzip header, so
that a reader needs to unpack the header's bytes only; members without that
length are unpacked to find where they end.

Files are opened by ``pyarrow.fs``: ``file``, ``hdfs``, ``s3`` and ``gs`` addresses
work in driver and tasks alike.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, IsNull, StringStartsWith, WriterCommitMessage

from .common import by_small_batches, materialise, shared_dir, without_nulls

SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, payload_bytes long, headers map<string,string>, payload binary"
#: Columns that filters are pushed down on, by the header that has them.
PUSHED = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
INDEX = "_archives-"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of an Arrow batch, of a record's header at most, and that are read ahead.
_BATCH, _HEADER, _AHEAD = 8 << 20, 1 << 20, 1 << 20
#: The extra field of a gzip member that has its whole packed length.
_LENGTH_FIELD = b"TL"


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if re.match(r"\w+:/", path) else (pafs.LocalFileSystem(), path)


def _header_text(value: str) -> str:
    """A header's value: control characters, which would end it, are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value.encode("utf-8", "replace").decode())


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    """One record: version, named fields, block, and the two line ends after it."""
    lines = ["WARC/1.1", *(f"{k}: {_header_text(v)}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def http_block(payload: bytes, kept: bool) -> bytes:
    """A response's block: its HTTP header, which tells the whole payload's length, and the payload if it is kept."""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + (payload if kept else b"")


def packed(record: bytes, level: int = 6) -> bytes:
    """A gzip member whose header has the member's length."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    length = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", 12) + _LENGTH_FIELD + struct.pack("<HQ", 8, length)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    """The archives of a task: name, bytes, and places at which records begin."""

    files: list[tuple[str, int, list[int]]]


class Writer(DataSourceArrowWriter):
    """Options: ``path``; ``compress=true``; ``max_file_bytes`` and ``split_bytes``.

    Rows of SCHEMA: of null ids each gets a new one, a null type is ``response``,
    a null payload is empty. ``payload_digest`` and ``payload_bytes`` are reckoned
    from the payload; a revisit's payload is not stored. ``headers`` are written as
    they are, but for those of other columns.
    """

    def __init__(self, options: dict[str, str], overwrite: bool = False):
        if overwrite:
            raise ValueError("archives are only added to: write by mode('append'), to a new path for a new set")
        self.path, self.compress = options["path"].rstrip("/"), options.get("compress", "false") == "true"
        self.most, self.split = int(options.get("max_file_bytes", 1 << 30)), int(options.get("split_bytes", 128 << 20))

    def write(self, iterator):
        system, root = _opened(self.path)
        system.create_dir(root, recursive=True)
        done, out, at, places = [], None, 0, []
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    record = self._record(row)
                    if out is None or at >= self.most:
                        if out:
                            out.close()
                            done.append((name, at, places))
                        name, at, places = f"{uuid.uuid4().hex}.warc{'.gz' * self.compress}", 0, []
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    if not places or at - places[-1] >= self.split:
                        places.append(at)
                    out.write(record)
                    at += len(record)
            if out:
                out.close()
                done.append((name, at, places))
        except BaseException:
            if out:
                out.close()
                system.delete_file(f"{root}/{name}")
            raise
        return Written(done)

    def _record(self, row: dict) -> bytes:
        payload = row.get("payload") or b""
        kind = row.get("record_type") or "response"
        own = {"WARC-Type": kind, "WARC-Record-ID": row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": row.get("date") or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")}
        if row.get("target_uri") is not None:
            own["WARC-Target-URI"] = row["target_uri"]
        http = kind in ("response", "revisit")
        own["WARC-Payload-Digest"] = f"sha256:{hashlib.sha256(payload).hexdigest()}"
        if row.get("refers_to") is not None:
            own["WARC-Refers-To"] = row["refers_to"]
        if kind == "revisit":
            own["WARC-Profile"] = _PROFILE
        if http:
            own["Content-Type"] = "application/http; msgtype=response"
        taken = {k.lower() for k in own} | {"content-length"}
        own |= {k: v for k, v in row.get("headers") or [] if k.lower() not in taken and v is not None and re.fullmatch(r"[!#-'*+.^-z|~\w-]+", k)}
        record = record_bytes(own, http_block(payload, kind == "response") if http else payload)
        return packed(record) if self.compress else record

    def commit(self, messages):
        system, root = _opened(self.path)
        system.create_dir(root, recursive=True)
        files = [f for m in messages if m for f in m.files]
        name = uuid.uuid4().hex
        with system.open_output_stream(f"{root}/.{name}", compression=None) as out:
            out.write(json.dumps(files).encode())
        system.move(f"{root}/.{name}", f"{root}/{INDEX}{name}.json")

    def abort(self, messages):
        system, root = _opened(self.path)
        for m in messages:
            for name, *_ in m.files if m else []:
                system.delete_file(f"{root}/{name}")


@dataclass
class Range(InputPartition):
    """Ranges of files that one task reads: (path, first record's place, end or None for the file's end)."""

    ranges: list[tuple[str, int, int | None]]


def planned(path: str, target: int) -> list[Range]:
    """The archives below a path, cut at known places, in ranges of about ``target`` bytes for each task."""
    system, root = _opened(path)
    scheme = re.match(r"\w+:(//[^/]*)?", path)
    full = lambda p: p if not scheme else f"{scheme[0]}{'' if p.startswith('/') else '/'}{p}" if scheme[0].startswith(("file", "hdfs")) else f"{scheme[0].split(':')[0]}://{p}"
    told = system.get_file_info(root)
    if told.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    infos = [told] if told.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(root, recursive=True))
    indexes = [i for i in infos if i.base_name.startswith(INDEX)]
    pieces = []
    if indexes:
        for i in indexes:
            with system.open_input_stream(i.path, compression=None) as file:
                for name, size, places in json.loads(file.read()):
                    pieces += [(full(f"{i.path.rpartition('/')[0]}/{name}"), a, b, b - a) for a, b in zip(places, [*places[1:], size])]
    else:
        pieces = [(full(i.path), 0, None, i.size) for i in infos if i.type == pafs.FileType.File and re.search(r"\.warc(\.gz)?$", i.base_name)]
    out, held = [], 0
    for name, a, b, size in sorted(pieces, key=lambda p: (p[0], p[1])):
        if not out or held + size > target and held:
            out.append(Range([]))
            held = 0
        out[-1].ranges.append((name, a, b))
        held += size
    return out


class _Window:
    """Reads a file at any place, some way ahead: archives are read forwards, with gaps."""

    def __init__(self, file):
        self.file, self.at, self.held = file, 0, b""

    def read(self, at: int, n: int) -> bytes:
        """So many bytes from a place; fewer at the file's end."""
        low = at - self.at
        if low < 0 or low + n > len(self.held):
            self.file.seek(at)
            self.at, self.held, low = at, self.file.read(max(n, _AHEAD)), 0
        return self.held[low : low + n]


class _Plain:
    """Records of an archive that isn't compressed."""

    def __init__(self, window: _Window, at: int):
        self.window, self.at = window, at

    def header(self) -> bytes | None:
        """The next record's header, or None at the end of the file."""
        size = 1 << 12
        while size <= _HEADER:
            got = self.window.read(self.at, size)
            blank = len(got) - len(got.lstrip(b"\r\n"))
            if blank:  # more line ends than there must be
                self.at += blank
                continue
            cut = got.find(b"\r\n\r\n")
            if cut >= 0:
                self.at += cut + 4
                return got[: cut + 4]
            if len(got) < size:
                if not got:
                    return None
                break
            size *= 2
        raise ValueError("a record's header does not end")

    def block(self, length: int) -> bytes:
        got = self.window.read(self.at, length)
        if len(got) < length:
            raise ValueError("a record's block is cut off")
        self.at += length
        return got

    def ended(self, left: int) -> None:
        """Passes over what is left of the block, and the line ends after it."""
        self.at += left + 4


class _Packed:
    """Records of an archive of gzip members."""

    def __init__(self, window: _Window, at: int):
        self.window, self.at = window, at

    def header(self) -> bytes | None:
        head = self.window.read(self.at, 24)
        if not head:
            return None
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError("no gzip member")
        own = len(head) == 24 and head[3] & 4 and head[10:14] == struct.pack("<H", 12) + _LENGTH_FIELD
        self.length = struct.unpack("<Q", head[16:24])[0] if own else None
        self.inflate, self.out, self.pending, self.place = zlib.decompressobj(31), b"", b"", self.at
        while (cut := self.out.find(b"\r\n\r\n")) < 0:
            if not self._step(1 << 12) or len(self.out) > _HEADER:
                raise ValueError("a record's header does not end")
        taken, self.out = self.out[: cut + 4], self.out[cut + 4 :]
        return taken

    def _step(self, most: int) -> bool:
        """Unpacks some more bytes; False at the member's end."""
        if self.inflate.eof:
            return False
        if not self.pending:
            self.pending = self.window.read(self.place, 1 << 14)
            self.place += len(self.pending)
            if not self.pending:
                raise ValueError("a record's gzip member is cut off")
        self.out += self.inflate.decompress(self.pending, most)
        self.pending = self.inflate.unconsumed_tail
        return True

    def block(self, length: int) -> bytes:
        pieces, have = [self.out], len(self.out)
        while have < length:
            self.out = b""
            if not self._step(1 << 20):
                raise ValueError("a record's block is cut off")
            pieces.append(self.out)
            have += len(self.out)
        whole = b"".join(pieces)
        self.out = whole[length:]
        return whole[:length]

    def ended(self, left: int) -> None:
        """Passes over what is left of the record; a member without its length is unpacked to its end."""
        if self.length is None:
            while not self.inflate.eof:
                self.out = b""
                self._step(1 << 20)
            self.length = self.place - len(self.inflate.unused_data) - self.at
        self.at += self.length


def _fields(header: bytes) -> dict[str, str]:
    """Named fields by lower-case name; a line that begins with white space goes on with the one before it."""
    version, *lines = header.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no record begins here: {version[:40]!r}")
    out, name = {}, None
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _passes(tests: list[tuple[str, str, object]], fields: dict[str, str]) -> bool:
    for kind, name, wanted in tests:
        have = fields.get(name)
        if kind == "null":
            if (have is None) != wanted:
                return False
        elif have is None or (kind == "in" and have not in wanted) or (kind == "starts" and not have.startswith(wanted)):
            return False
    return True


def records(file, packed_: bool, at: int, end: int | None, tests: list, with_payload: bool) -> Iterator[dict]:
    """The records that begin in a range of an archive and pass the tests."""
    source = (_Packed if packed_ else _Plain)(_Window(file), at)
    while end is None or source.at < end:
        began = source.at
        try:
            header = source.header()
            if header is None:
                return
            fields = _fields(header)
            length = int(fields.get("content-length", "0"))
            if not _passes(tests, fields):
                source.ended(length)
                continue
            http = fields.get("content-type", "").replace(" ", "").lower().startswith("application/http")
            kind, payload, size, left = fields.get("warc-type"), None, None, length
            if with_payload:
                block, left = source.block(length), 0
                payload = block
            elif http:
                block = source.block(min(length, 1 << 13))
                left -= len(block)
            if http:
                head, mark, body = block.partition(b"\r\n\r\n")
                told = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head)
                inside = len(body) + left if mark else 0
                size = int(told[1]) if told and kind == "revisit" else inside
                payload = None if payload is None or kind == "revisit" else body
            else:
                size = length
            if payload is not None and (digest := fields.get("warc-payload-digest", "")).startswith("sha256:") and hashlib.sha256(payload).hexdigest() != digest[7:].lower():
                raise ValueError(f"the payload isn't that of its digest {digest}")
            source.ended(left)
        except (ValueError, zlib.error) as error:
            raise ValueError(f"byte {began}: {error}") from error
        yield {column: fields.get(name) for column, name in PUSHED.items()} | {"payload_bytes": size, "headers": list(fields.items()), "payload": payload}


class Reader(DataSourceReader):
    """Options: ``path``, a file or folder; ``payload=false``: payloads are neither read nor returned; ``target_bytes`` of a task."""

    def __init__(self, options: dict[str, str]):
        self.path, self.payload, self.target = options["path"], options.get("payload", "true") != "false", int(options.get("target_bytes", 128 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def partitions(self):
        return planned(self.path, self.target) or [Range([])]

    def read(self, partition):
        kinds = pa.schema([*((n, pa.string()) for n in PUSHED), ("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
        kinds = pa.schema([kinds.field(n.split()[0]) for n in SCHEMA.split(", ")])
        held, size = [], 0
        for path, at, end in partition.ranges:
            system, name = _opened(path)
            with system.open_input_file(name) as file:
                try:
                    for row in records(file, name.endswith(".gz"), at, end, self.tests, self.payload):
                        held.append(row)
                        size += len(row["payload"] or b"") + 500
                        if size >= _BATCH:
                            yield pa.RecordBatch.from_pylist(held, kinds)
                            held, size = [], 0
                except ValueError as error:
                    raise ValueError(f"{path}: {error}") from error
        if held:
            yield pa.RecordBatch.from_pylist(held, kinds)


class PushedReader(Reader):
    """Spark keeps one set of pushed filters for a table that is loaded, whichever query it came from: load a table for each condition."""

    def pushFilters(self, filters):
        """Takes equality, membership, beginnings and null checks of header columns; others go back to Spark."""
        for f in filters:
            name = PUSHED.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if name and isinstance(f, EqualTo) and isinstance(f.value, str):
                self.tests.append(("in", name, (f.value,)))
            elif name and isinstance(f, In) and all(isinstance(v, str) for v in f.value):
                self.tests.append(("in", name, tuple(f.value)))
            elif name and isinstance(f, StringStartsWith):
                self.tests.append(("starts", name, f.value))
            elif name and isinstance(f, (IsNull, IsNotNull)):
                self.tests.append(("null", name, isinstance(f, IsNull)))
            else:
                yield f


class WarcSource(DataSource):
    """``spark.dataSource.register(WarcSource)``, then ``spark.read.format("warc")`` and ``df.write.format("warc").mode("append")``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return (PushedReader if self.options.get("push_filters") == "true" else Reader)(self.options)

    def writer(self, schema, overwrite):
        return Writer(self.options, overwrite)


#: Payloads of fewer bytes are stored as often as they occur.
LEAST_BYTES = 100
#: Most repeated payloads whose digests are sent to all tasks; more are joined by a shuffle.
BROADCAST_DIGESTS = 500_000


def archived(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """Rows of SCHEMA for ``Writer``: one record for each page, repeated payloads as revisits.

    Of the rows with equal payloads of LEAST_BYTES or more, that with the
    smallest id is the response (of rows that share it, one), and the others revisit it;
    all others are responses. Rows without an id come after those with one. A
    null payload is an empty one. A record's id is ``<urn:row:=id:n>``, where n tells
    apart rows that share an id (of a null id, ``<urn:row::n>``). Other columns are ignored.
    """
    payload = without_nulls(F.col(payload_column)).cast("binary")
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), payload.alias("payload"), F.monotonically_increasing_id().alias("n"))
    rows = materialise(rows.withColumn("digest", F.unhex(F.sha2("payload", 256))), "payloads")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "n")
    long = rows.where(F.octet_length("payload") >= LEAST_BYTES)
    repeated = materialise(long.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies"), "digests")
    if repeated.count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    named = lambda i, n: F.concat(F.lit("<urn:row:"), F.coalesce(F.concat(F.lit("="), F.url_encode(i.cast("string"))), F.lit("")), F.lit(":"), n.cast("string"), F.lit(">"))
    again = F.col("first").isNotNull() & (F.octet_length("payload") >= LEAST_BYTES) & (F.col("first.n") != F.col("n"))
    return rows.join(repeated, "digest", "left").select(
        named(F.col("id"), F.col("n")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(None).cast("string").alias("date"),
        F.when(again, named(F.col("first.id"), F.col("first.n"))).alias("refers_to"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.lit(None).cast("long").alias("payload_bytes"),
        F.lit(None).cast("map<string,string>").alias("headers"),
        "payload",
    )


def write_archives(records_: DataFrame, path: str, **options: str) -> None:
    """Adds records to the archives at a path."""
    records_.sparkSession.dataSource.register(WarcSource)
    records_.write.format("warc").options(**options).mode("append").save(path)


def read_archives(spark: SparkSession, path: str, condition: str | None = None, **options: str) -> DataFrame:
    """The records of the archives at a path, those that fulfil a condition if there is one; what it says of header columns reaches the reader.

    Two queries that add other conditions of their own to a table that was read with one must not be parts of one plan.
    """
    spark.dataSource.register(WarcSource)
    if condition is None:
        return spark.read.format("warc").options(**options).load(path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(push_filters="true", **options).load(path).where(condition)


def page_archives(pages: DataFrame, compress: bool = True) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of pages that were written to archives and read back.

    Responses are read whole, and their length and digest are those of the payload that was
    read; of revisits only the headers are, which tell those of the payload that they stand for.
    Ids are those of the pages (a null stays one); see ``archived`` for repeats and nulls. An
    empty table gives no rows.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    kind = pages.schema["page_id"].dataType.simpleString()
    write_archives(by_small_batches(archived(pages)), path, compress=str(compress).lower())
    id_of = lambda c: F.when(c.startswith("<urn:row:="), F.url_decode(F.regexp_extract(c, r"^<urn:row:=(.*):\d+>$", 1))).cast(kind)
    whole = read_archives(spark, path, "record_type = 'response'").select("record_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    brief = read_archives(spark, path, "record_type = 'revisit'", payload="false").select("record_id", "record_type", "refers_to", "payload_bytes", F.substring_index("payload_digest", ":", -1).alias("payload_digest"))
    return whole.unionByName(brief).select(id_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", id_of(F.col("refers_to")).alias("refers_to"))
