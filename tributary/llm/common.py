"""Helpers that several text operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import weakref
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(table: DataFrame) -> DataFrame:
    """A plain table, dealt to all cores where its few files would keep only some of them busy."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    if len(table.inputFiles()) < cores and table.rdd.getNumPartitions() <= cores:
        return table.repartition(cores)
    return table


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share for intermediate tables.

    It is the session's ``spark.checkpoint.dir``. A local session without that
    setting (a test) gets a temporary folder; on a cluster it must be set, for
    executors don't see each other's folders.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tributary-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage.

    The rows are computed once, and a lost executor costs a re-read of the
    written files instead of the work before them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


#: Where the tables of ``materialise`` stand.
_PATHS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``materialise`` that nothing reads any more; others are left alone."""
    for table in tables:
        path = _PATHS.pop(table, None)
        if path:
            target = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def if_small(table: DataFrame, rows: int) -> DataFrame:
    """The table, to be sent to all tasks if it has at most so many rows."""
    return F.broadcast(table) if table.count() <= rows else table


#: Most keys that are sent to all tasks as an array, of 8 bytes each.
LISTED_KEYS = 8_000_000


def flagged(rows: DataFrame, key: str, keys: DataFrame, name: str, few: int) -> DataFrame:
    """``rows`` with the boolean ``name``: whether their long ``key`` is among ``keys``, a written table of only that column, without nulls.

    A few keys are sent to all tasks as a table, up to LISTED_KEYS as a sorted
    array, for a shuffle moves whole rows with their texts. More are joined by one.
    """
    many = keys.count()
    if few < many <= LISTED_KEYS:
        sent = rows.sparkSession.sparkContext.broadcast(np.sort(keys.toArrow().column(0).to_numpy()))

        @F.pandas_udf("boolean")
        def listed(column: pd.Series) -> pd.Series:
            at = np.searchsorted(sent.value, column.to_numpy())
            at[at == len(sent.value)] = 0
            return pd.Series(sent.value[at] == column.to_numpy())

        return rows.withColumn(name, listed(F.coalesce(key, F.lit(0))) & F.col(key).isNotNull())
    marks = keys.distinct().withColumn(name, F.lit(True))
    return rows.join(F.broadcast(marks) if many <= few else marks, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def returning_memory(batches_to_batches: Callable) -> Callable:
    """The function for ``mapInArrow``, which gives freed memory back to the system when a task ends.

    Python workers outlive their tasks, and what the allocators keep counts
    against the executor while the next stage runs.
    """

    def run(batches):
        yield from batches_to_batches(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run


#: Rows of an Arrow batch: of Spark's 10,000, whole texts can take more memory than a task has.
BATCH_ROWS = 1000


#: Bytes of an Arrow batch, but for a single longer row.
BATCH_BYTES = 8 << 20
#: Longer words and runs aren't kept in memos, so that a memo's entries bound its bytes.
MEMO_CHARS = 64


def by_small_batches(rows: DataFrame) -> DataFrame:
    """``rows``, after lowering the session's Arrow batches to BATCH_ROWS and BATCH_BYTES, where they are larger.

    The session keeps these settings: they act when the rows are read, which is
    after this call. They change no result.
    """
    conf = rows.sparkSession.conf
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(conf.get(size).rstrip("b")) <= BATCH_BYTES:
        conf.set(size, BATCH_BYTES)
    if not 0 < int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return rows


def fold_of(doc_id) -> F.Column:
    """crc32 of the id's decimal text, modulo 4; 2 marks the held-out rows."""
    return F.crc32(doc_id.cast("string")) % 4


def without_nulls(text) -> F.Column:
    """A null text counts as an empty one."""
    return F.coalesce(text, F.lit(""))
