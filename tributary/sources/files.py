"""Files, object stores and bundles."""

from __future__ import annotations

import base64
import datetime
import decimal
import gzip
import io
import json
import math
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import pod_of
from ..operators.feeds import newest
from ..operators.predicates import included

#: Most bytes of a file that is decoded whole, and of what one unpacks to.
MAX_FILE_BYTES, MAX_UNPACKED_BYTES = 100 << 20, 1 << 30
_PARQUET_MARK = b"PAR1"


def lines(spark: SparkSession, path: str, glob: str | None = None, modified_after: str | None = None, max_bytes: int | None = None) -> DataFrame:
    """(path, text): the lines of text files, gzipped ones too, without empty ones. The cap on sizes is off by default."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    rows = reader.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("_size"), F.col("value").alias("text"))
    rows = rows if max_bytes is None else rows.where(F.col("_size") <= max_bytes)
    return rows.where(F.length("text") > 0).drop("_size")


def line_stream(spark: SparkSession, path: str, glob: str | None = None, files_a_batch: int = 1000, backfill: bool = True, archive: str | None = None) -> DataFrame:
    """The lines of files as they arrive in a folder or bucket.

    The query's checkpoint knows which files were read. ``archive``: where they
    are moved once they are, in place of deletion. Without ``backfill`` the
    newest files come first.
    """
    options = {"maxFilesPerTrigger": files_a_batch, "latestFirst": not backfill}
    if glob:
        options["pathGlobFilter"] = glob
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    rows = spark.readStream.options(**options).text(path)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).where(F.length("text") > 0)


def is_parquet(name: Column, content: Column) -> Column:
    """By the name's end, in any case, or by the mark at both ends of the content."""
    mark = F.lit(_PARQUET_MARK)
    marked = (F.octet_length(content) >= 8) & (F.substring(content, 1, 4) == mark) & (F.substring(content, -4, 4) == mark)
    return F.lower(name).endswith(".parquet") | F.coalesce(marked, F.lit(False))


def versions(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, modificationTime, length) of files; their contents aren't read.

    A file that is written anew is another version: ``dedupe.unseen`` by all
    three columns against those that were read gives what is to be read again.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", "modificationTime", "length")


def json_rows(rows: DataFrame, out: str = "text") -> DataFrame:
    """Each row of a table as JSON text; nulls stay, as nulls, and times keep their microseconds."""
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return rows.select(F.to_json(F.struct(*rows.columns), options).alias(out))


def parquet_rows(spark: SparkSession, path: str) -> DataFrame:
    """(text): the rows of Parquet files as JSON, by Spark's own reader."""
    return json_rows(spark.read.parquet(path))


class TooLarge(ValueError):
    """A packed file grows beyond its cap."""


def unpacked(content: bytes, most: int = MAX_UNPACKED_BYTES) -> bytes:
    """Gzip content, read in pieces so that a small file can't fill the memory."""
    out, size = [], 0
    try:
        with gzip.GzipFile(fileobj=io.BytesIO(content)) as packed:
            while piece := packed.read(1 << 20):
                size += len(piece)
                if size > most:
                    raise TooLarge(f"more than {most} bytes")
                out.append(piece)
    except (OSError, EOFError, zlib.error) as error:
        raise ValueError(f"bad gzip: {error}") from error
    return b"".join(out)


def as_json(value: Any) -> str:
    """A value of a Parquet cell as JSON, without loss.

    Doubles and decimals keep all digits (a double always has a dot), times their
    fractions of a second, in UTC if they have a zone; bytes become base64. What isn't a number
    or is infinite is spelled as a text.
    """
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, float):
        text = repr(value)
        if not math.isfinite(value):
            return json.dumps({"nan": "NaN", "inf": "Infinity", "-inf": "-Infinity"}[text])
        return text if "." in text else text.replace("e", ".0e")
    if isinstance(value, decimal.Decimal):
        return format(value, "f") if value.is_finite() else json.dumps(str(value))
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(str(k), ensure_ascii=False)}:{as_json(v)}" for k, v in value.items()) + "}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(as_json, value)) + "]"
    if isinstance(value, (bytes, bytearray)):
        return json.dumps(base64.b64encode(value).decode())
    if isinstance(value, datetime.datetime):
        fine = "nanoseconds" if getattr(value, "nanosecond", 0) else "microseconds"
        if value.tzinfo is None:
            return json.dumps(value.isoformat(timespec=fine))
        return json.dumps(value.astimezone(datetime.timezone.utc).replace(tzinfo=None).isoformat(timespec=fine) + "Z")
    return json.dumps(value.isoformat() if hasattr(value, "isoformat") else str(value))


def records(name: str, content: bytes, most: int = MAX_UNPACKED_BYTES) -> Iterator[str]:
    """The records of one bundle: rows of Parquet as JSON, packed or not, else lines of text."""
    low = name.lower()
    if low.endswith(".gz"):
        content = unpacked(content, most)
        low = low.removesuffix(".gz")
    if low.endswith(".parquet") or len(content) >= 8 and content[:4] == content[-4:] == _PARQUET_MARK:
        import pyarrow.parquet as pq

        for batch in pq.ParquetFile(io.BytesIO(content)).iter_batches(1024):
            yield from map(as_json, batch.to_pylist(maps_as_pydicts="strict"))
    else:
        yield from (line for line in content.decode("utf-8", "replace").split("\n") if line.strip("\r"))


def decoded(name: str, content: bytes, size: int = 10_000) -> Iterator[tuple[int, list[str | None], str | None]]:
    """(place of the first, texts, error) for the records of a bundle; what can't be decoded ends it by one row with the error."""
    held: list[str | None] = []
    at = 0
    try:
        for text in records(name, content):
            held.append(text)
            if len(held) == size:
                yield at, held, None
                at, held = at + size, []
    except (ValueError, pa.ArrowException) as error:
        if held:
            yield at, held, None
        yield at + len(held), [None], str(error)
        return
    if held:
        yield at, held, None


def bundles(spark: SparkSession, path: str, glob: str | None = None, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """(path, offset, text, error): the records of small mixed files; a bad file gives one row with its error.

    Files over ``max_bytes`` aren't read: each gives one row with that for its
    error. Large Parquet and text files belong in ``parquet_rows`` and ``lines``.
    """
    reader = spark.read.format("binaryFile")
    found = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    files = found.where(F.col("length") <= max_bytes).select("path", "content")
    beyond = found.where(F.col("length") > max_bytes).select("path", F.lit(0).cast("long").alias("offset"), F.lit(None).cast("string").alias("text"), F.concat("length", F.lit(f" bytes, more than {max_bytes}")).alias("error"))

    def rows(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for at, part, error in decoded(name, content):
                    yield pa.record_batch([pa.array([name] * len(part)), pa.array(range(at, at + len(part)), pa.int64()), pa.array(part, pa.string()), pa.array([error] * len(part), pa.string())], names=["path", "offset", "text", "error"])

    return files.mapInArrow(rows, "path string, offset long, text string, error string").unionByName(beyond)


def pod_logs(spark: SparkSession, root: str, include: str | None = None, exclude: str | None = None, newest_only: bool = True) -> DataFrame:
    """(namespace, pod_name, pod_id, container_name, path, text): container logs under ``root/namespace_pod_id/container/n.log``."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.log").text(root)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("_changed"), F.col("value").alias("text"))
    rows = rows.withColumn("_pod", pod_of(F.col("path"))).where("_pod is not null and length(text) > 0").select("_pod.*", "path", "_changed", "text")
    rows = included(rows, "pod_name", include, exclude)
    if newest_only:
        container = ["namespace", "pod_name", "pod_id", "container_name"]
        last = newest(rows.select(*container, "path", "_changed").distinct(), container, ["_changed", "path"])
        rows = rows.join(last.select("path"), "path", "left_semi")
    return rows.drop("_changed")


def _text(content: bytes, charset: str | None) -> str:
    """A mail's text; in a charset that isn't known it is read as UTF-8."""
    try:
        return content.decode(charset or "utf-8", "replace")
    except LookupError:
        return content.decode("utf-8", "replace")


def mail_parts(mails: DataFrame, raw: str = "text") -> DataFrame:
    """(columns, part_no, content_type, name, sha256, body, attachment): the parts of RFC 822 messages, texts or bytes.

    ``attachment``: parts other than text/plain and text/html, as bytes with
    their SHA-256; the others have a text body.
    """
    kept = [c for c in mails.columns if c != raw]

    def split(batches):
        import email
        import email.policy
        import hashlib

        for batch in batches:
            rows, at = [], []
            for i, text in enumerate(batch.column(batch.schema.get_field_index(raw)).to_pylist()):
                message = (email.message_from_bytes if isinstance(text, bytes) else email.message_from_string)(text or "", policy=email.policy.default)
                for n, part in enumerate(p for p in message.walk() if not p.is_multipart()):
                    content = part.get_payload(decode=True) or b""
                    plain = part.get_content_type() in ("text/plain", "text/html")
                    rows.append((n, part.get_content_type(), part.get_filename(), hashlib.sha256(content).hexdigest(), _text(content, part.get_content_charset()) if plain else None, None if plain else content))
                    at.append(i)
            columns = list(zip(*rows)) if rows else [()] * 6
            types = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
            own = [batch.column(batch.schema.get_field_index(c)).take(pa.array(at, pa.int64())) for c in kept]
            yield pa.record_batch([*own, *(pa.array(c, t) for c, t in zip(columns, types))], names=[*kept, "part_no", "content_type", "name", "sha256", "body", "attachment"])

    kinds = "".join(f"`{c}` {mails.schema[c].dataType.simpleString()}, " for c in kept)
    return mails.mapInArrow(split, f"{kinds}part_no int, content_type string, name string, sha256 string, body string, attachment binary")


def query(spark: SparkSession, sql: str, **jdbc: str) -> DataFrame:
    """A query's rows with its own schema: of Spark's catalog, or of a database by JDBC options."""
    return spark.read.format("jdbc").options(query=sql, **jdbc).load() if jdbc else spark.sql(sql)

