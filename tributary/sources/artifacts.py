"""Files by the SHA-256 of their contents, as a Spark data source to write to.

A content has one file, however many rows have it and however often a task runs: a
file appears whole or not at all, and one that is there is not written again. So
nothing is undone where a job fails, and a repeated one writes only what was missing.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .spool import Folder

SCHEMA = "content binary, name string"


def place_of(digest: str) -> str:
    """Where a content's file stands: in one of 256 folders."""
    return f"{digest[:2]}/{digest}"


@dataclass
class Stored(WriterCommitMessage):
    #: Contents that this task has put there, of all that it had.
    new: int
    seen: int


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def write(self, iterator):
        folder, known, new = Folder(self.path), set(), 0
        for batch in iterator:
            for content in batch.column(batch.schema.get_field_index("content")):
                raw = content.as_py()
                if raw is None:
                    continue
                digest = hashlib.sha256(raw).hexdigest()
                if digest not in known and not folder.has(place_of(digest)):
                    folder.write(place_of(digest), [raw])
                    new += 1
                known.add(digest)
        return Stored(new, len(known))

    def commit(self, messages):
        told = [m for m in messages if m]
        Folder(self.path).write(f"_written-{uuid.uuid4().hex}", [f'{{"new":{sum(m.new for m in told)},"contents":{sum(m.seen for m in told)}}}\n'.encode()])

    def abort(self, messages):
        pass


class ArtifactSource(DataSource):
    @classmethod
    def name(cls):
        return "artifacts"

    def schema(self):
        return SCHEMA

    def writer(self, schema, overwrite):
        return Writer(self.options)


def store(rows: DataFrame, path: str, content: str = "attachment") -> DataFrame:
    """``rows`` with ``artifact``, the path of each content's file (of a null one: null), after all contents have been written.

    Equal contents within a task are written once; among tasks, whoever comes first. For a
    stream call it for each batch (``sinks.to_each``).
    """
    rows.sparkSession.dataSource.register(ArtifactSource)
    rows.where(F.col(content).isNotNull()).select(F.col(content).cast("binary").alias("content"), F.lit(None).cast("string").alias("name")).write.format("artifacts").mode("append").save(path)
    return rows.withColumn("artifact", artifact_path(F.col(content).cast("binary"), path))


def artifact_path(content: Column, path: str) -> Column:
    digest = F.sha2(content, 256)
    return F.concat(F.lit(path.rstrip("/") + "/"), F.substring(digest, 1, 2), F.lit("/"), digest)


def artifacts(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, path, length, content) of all files that were stored."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[0-9a-f]*").load(path)
    return files.select(F.regexp_extract("path", "([0-9a-f]{64})$", 1).alias("sha256"), "path", "length", "content")
