"""Event hubs through Spark's Kafka source, which they serve; its package must be on Spark's class path."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(connection: str, hub: str | None = None, starting: str = "latest", most: int | None = None) -> dict[str, str]:
    """Options of the Kafka source for a hub's connection string; the hub is its ``EntityPath`` unless given.

    A new stream starts at the newest events, as ``starting`` says; one with a checkpoint goes on from there.
    """
    told = dict(p.split("=", 1) for p in connection.strip().strip(";").split(";") if "=" in p)
    host = re.fullmatch(r"sb://([^/]+)/?", told.get("Endpoint", ""))
    name = hub or told.get("EntityPath")
    if not host or not name:
        raise ValueError("the connection string lacks its endpoint, or no hub is named")
    secret = connection.replace("\\", "\\\\").replace('"', '\\"')
    options = {
        "kafka.bootstrap.servers": f"{host[1]}:9093",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f'org.apache.kafka.common.security.plain.PlainLoginModule required username="$ConnectionString" password="{secret}";',
        "subscribe": name,
        "startingOffsets": starting,
    }
    return options if most is None else options | {"maxOffsetsPerTrigger": str(most)}


def event_hub(spark: SparkSession, connection: str, hub: str | None = None, **how) -> DataFrame:
    """(path, offset, text, sent): a hub's events as a stream; ``path`` is the partition."""
    rows = spark.readStream.format("kafka").options(**kafka_options(connection, hub, **how)).load()
    return rows.select(F.concat_ws("/", "topic", F.col("partition").cast("string")).alias("path"), "offset", F.col("value").cast("string").alias("text"), F.col("timestamp").alias("sent"))
