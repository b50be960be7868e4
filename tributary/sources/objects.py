"""Objects that notifications name: rows of paths to rows of records.

The tasks open the objects, each where its row is: no listing, and no path
passes the driver. With a queue's stream as input the notifications are acknowledged
after their batch, when the objects' records are written.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_path import find, find_one
from ..functions.text import url_decoded
from .files import MAX_FILE_BYTES, decoded
from .spool import opened


def named_objects(notices: DataFrame, body: str = "body", bucket: Column | None = None, bucket_path: str = "bucket", file_path: str = "files/path", base: str = "s3://", decode: bool = False) -> DataFrame:
    """(columns, path, notice_error): the objects that notifications name, a row for each.

    Bucket and paths are found in the notification's JSON, also where it is JSON in strings; ``decode``: paths are
    URL-encoded. A notification without a bucket, that isn't JSON, or with a path that can't
    be decoded has a row with the reason and a null path; one without paths has none.
    """
    own = F.coalesce(bucket if bucket is not None else F.lit(None).cast("string"), find_one(body, bucket_path, "string", expand=True))
    rows = notices.withColumn("_bucket", own).withColumn("_paths", find(body, file_path, "string", expand=True))
    whole = F.try_parse_json(F.col(body)).isNotNull()
    problem = F.when(~whole, "the notification isn't JSON").when(F.col("_bucket").isNull() & (F.size("_paths") > 0), "the notification names no bucket")
    rows = rows.withColumn("_problem", problem)
    paths = F.when(F.col("_problem").isNotNull(), F.array(F.lit(None).cast("string"))).otherwise(F.col("_paths"))
    rows = rows.withColumn("_path", F.explode(paths))
    key = url_decoded(F.col("_path")) if decode else F.col("_path")
    undone = F.when(F.col("_path").isNotNull() & key.isNull(), F.concat(F.lit("the path can't be decoded: "), "_path"))
    return rows.select(*notices.columns, F.concat(F.lit(base), "_bucket", F.lit("/"), F.ltrim(key, F.lit("/"))).alias("path"), F.coalesce("_problem", undone).alias("notice_error"))


def object_records(rows: DataFrame, path: str = "path", error: str | None = None, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """(columns, offset, text, error): the records of the objects that rows name, decoded as bundles are.

    An object that isn't there, can't be opened, is larger than ``max_bytes`` or can't be decoded gives one
    row with the reason. A row with a null path gives one with the text of its column ``error``. Objects
    are opened by ``pyarrow.fs``; refused credentials fail the task, which Spark repeats.
    """
    kept = [c for c in rows.columns if c != error]
    sent = rows.select(*kept, (F.col(error) if error else F.lit(None).cast("string")).alias("_given"))

    def content(name: str) -> bytes:
        system, place = opened(name)
        with system.open_input_file(place) as file:
            if file.size() > max_bytes:
                raise ValueError(f"{file.size()} bytes, more than {max_bytes}")
            return file.read()

    def pieces(name: str | None, given: str | None):
        if name is None:
            yield 0, [None], given or "no path"
            return
        try:
            yield from decoded(name, content(name))
        except (FileNotFoundError, IsADirectoryError, ValueError, pa.ArrowException) as bad:
            yield 0, [None], str(bad)

    def read(batches):
        for batch in batches:
            names, given = batch.column(batch.schema.get_field_index(path)).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            for n, (name, told) in enumerate(zip(names, given)):
                for at, texts, bad in pieces(name, told):
                    own = [batch.column(i).take(pa.array([n] * len(texts), pa.int64())) for i in range(len(kept))]
                    yield pa.record_batch([*own, pa.array(range(at, at + len(texts)), pa.int64()), pa.array(texts, pa.string()), pa.array([bad] * len(texts), pa.string())], names=[*kept, "offset", "text", "error"])

    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in kept)
    return sent.mapInArrow(read, f"{kinds}offset long, text string, error string")
