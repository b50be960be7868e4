"""De-duplication of streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def within_watermark(rows: DataFrame, keys: list[str], time: str, lateness: str) -> DataFrame:
    """The first row of each key; a key is forgotten once the watermark has passed it by ``lateness``. By event time."""
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def within_ttl(rows: DataFrame, keys: list[str], ttl_seconds: int, schema: str | None = None) -> DataFrame:
    """The first row of each key; a key is forgotten ``ttl_seconds`` of processing time after that row.

    State stands in the checkpoint, so a restart doesn't let rows in again.
    Needs the RocksDB state store. Repeats don't prolong a key's time.
    """
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class FirstOnly(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("seen", "seen boolean", ttl_seconds * 1000)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            first = None
            for part in rows:
                if first is None and len(part):
                    first = part.iloc[:1]
            if first is not None and not self.seen.exists():
                self.seen.update((True,))
                yield first

        def close(self) -> None:
            pass

    own = schema or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.groupBy(*keys).transformWithStateInPandas(FirstOnly(), outputStructType=own, outputMode="append", timeMode="ProcessingTime")
