"""From settings to one DataFrame of canonical events."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content_hash
from ..operators.events import ID_FIELDS, Mapping, to_events
from ..sources import files, receiver


def mapping_of(source: str, settings: dict[str, Any]) -> Mapping:
    own = settings.get("client_options", {})
    of = own.get("mapping", {})
    return Mapping(
        source=source,
        pattern=of.get("parsing_re"),
        sensor_key_path=of.get("sensor_key_path"),
        sensor_key=own.get("sensor_seed_key"),
        sensor_hostname_path=of.get("sensor_hostname_path"),
        event_type_path=of.get("event_type_path"),
        event_type=settings.get("event_type"),
        event_time_path=of.get("event_time_path"),
        id_paths=tuple(settings.get("id_paths", ID_FIELDS)),
        fields={m["src_field"]: m["dst_field"] for m in of.get("mappings", [])},
        rename_only=bool(of.get("rename_only", False)),
    )


def raw(spark: SparkSession, source: str, settings: dict[str, Any]) -> DataFrame:
    """(path, text): a source's raw records; bundles have an ``error`` too, in place of the text."""
    path = settings.get("file_path") or settings.get("path") or settings.get("root")
    if source in ("file", "s3", "gcs", "simulator", "stdin"):
        return files.parquet_rows(spark, path).withColumn("path", F.lit(path)) if path.lower().endswith(".parquet") else files.lines(spark, path, settings.get("glob"))
    if source == "bundles":
        return files.bundles(spark, path, settings.get("glob")).select("path", "text", "error")
    if source == "syslog":  # what a receiver has spooled
        spooled = spark.read.format("binaryFile").option("pathGlobFilter", "*.frames").load(path)
        return receiver.received(spooled).select("path", "text")
    if source in ("wel", "mac_unified_logging"):  # exported as a record a line; the latter begins with a line that is none
        rows = files.lines(spark, path, settings.get("glob"))
        return rows if source == "wel" else rows.where(F.col("text").startswith("{"))
    if source == "k8s_pods":
        return files.pod_logs(spark, path, settings.get("include_pods_re"), settings.get("exclude_pods_re"))
    if source == "bigquery":
        return files.json_rows(files.query(spark, settings["sql_query"])).withColumn("path", F.lit(None).cast("string"))
    raise ValueError(f"{source!r} isn't a source of files; read it by spark.read.format() with paged_source(), cursor_source(), queue_source() or mailbox_source()")


def events(spark: SparkSession, settings: list[dict[str, dict[str, Any]]], dedupe: bool = False) -> DataFrame:
    """All sources of all settings, united.

    A bundle that can't be decoded gives an event of kind ``error`` with the
    reason for its text. Every record is an event, for files are read once; a
    setting with ``dedupe: true`` (``dedupe`` sets it for those that don't say) is of a feed that is read
    again in part: of its records that share an id the first by time stays, and
    records without an id of their own are all kept. Settings are never held
    against each other, whatever ids their records have.
    """
    tables = []
    for document in settings:
        for source, own in document.items():
            rows = raw(spark, source, own)
            failed = F.col("error") if "error" in rows.columns else F.lit(None).cast("string")
            rows = rows.select("path", F.coalesce("text", failed).alias("text"), failed.isNotNull().alias("_failed"), content_hash(F.coalesce("text", failed)).alias("_hash"))
            table = to_events(rows, mapping_of(source, own), path="path", keep=("_failed", "_hash"))
            table = table.withColumn("payload_kind", F.when(F.col("_failed"), "error").otherwise(F.col("payload_kind")))
            named = F.col("dedupe_key") != F.col("_hash")
            table = _once(table, named) if own.get("dedupe", dedupe) else table
            tables.append(table.drop("_failed", "_hash"))
    return reduce(lambda a, b: a.unionByName(b), tables)


def _once(table: DataFrame, named: Column) -> DataFrame:
    """Of rows that share a key of their own the first by time; the others are not grouped."""
    plain = table.withColumn("payload", F.to_json("payload"))  # a variant can't be compared
    first = plain.where(named).groupBy("dedupe_key").agg(F.min_by(F.struct(*plain.columns), F.struct("event_time", "text")).alias("row"))
    return first.select("row.*").unionByName(plain.where(~named)).withColumn("payload", F.try_parse_json("payload"))
