"""Where streams go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def to_parquet(rows: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, once: bool = False) -> StreamingQuery:
    """Appends to Parquet files; the checkpoint holds how far the sources are read. ``once``: what there is now, then stop."""
    out = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        out = out.partitionBy(*partition_by)
    return (out.trigger(availableNow=True) if once else out).start()


def to_each(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Hands each batch with its number to ``write``, which must give one result however often it gets a batch."""
    out = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()


def to_memory(rows: DataFrame, name: str) -> StreamingQuery:
    """A table in the driver's memory, for tests."""
    return rows.writeStream.format("memory").queryName(name).outputMode("append").start()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder's name under ``spark.checkpoint.dir``, which driver and executors share; unset, a local session gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tributary-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def run_once(rows: DataFrame) -> DataFrame:
    """What a stream gives for the input there is now, as a table in the session's shared folder."""
    spark = rows.sparkSession
    path = shared_folder(spark, "stream")
    to_parquet(rows, f"{path}/rows", f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/rows")
