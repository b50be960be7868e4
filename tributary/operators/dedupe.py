"""De-duplication of bounded feeds.

All forms reduce a key's rows to the earliest of each time window by an
aggregate, which combines before the shuffle: a key that holds a third of all
rows costs one row for each task and window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_of(time: Column, seconds: int, start: int = 0) -> Column:
    """The number of the time window, from ``start`` (seconds since 1970)."""
    return F.floor((F.unix_micros(time.cast("timestamp")) - start * 1_000_000) / (seconds * 1_000_000))


def first_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``, with all columns. Nulls come first; equal rows collapse to one."""
    packed = F.min_by(F.struct(*rows.columns), F.struct(*order))
    return rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(packed.alias("_row")).select("_row.*")


def first_in_window(rows: DataFrame, keys: list[str], time: str, seconds: int, order: list[str] | None = None) -> DataFrame:
    """The first row of each key in each window of ``seconds``."""
    cut = rows.withColumn("_window", window_of(F.col(time), seconds))
    return first_of(cut, [*keys, "_window"], [time, *(order or [])]).drop("_window")


def first_within_ttl(rows: DataFrame, keys: list[str], time: str, seconds: int, ttl: int, order: list[str] | None = None) -> DataFrame:
    """Rows that a set of ``ttl // seconds`` rotating buckets admits.

    A key that is admitted in one window is refused for the rest of it and
    until its bucket is reused, ``ttl // seconds`` windows later; a refused row
    doesn't prolong that. The admitted windows follow from the windows in which
    the key occurs, of which a key has as many as the feed's span has windows
    at most; they are folded in the JVM.
    """
    if seconds > ttl:
        raise ValueError("the window is longer than the time to live")
    life = max(1, ttl // seconds)
    cut = first_of(rows.withColumn("_window", window_of(F.col(time), seconds)), [*keys, "_window"], [time, *(order or [])])
    kept = F.aggregate(
        F.sort_array(F.collect_set("_window")),
        F.array().cast("array<bigint>"),
        lambda held, w: F.when((F.size(held) == 0) | (w - F.element_at(held, -1) >= life), F.concat(held, F.array(w))).otherwise(held),
    )
    admitted = cut.groupBy(*keys).agg(kept.alias("_kept")).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.explode("_kept").alias("_admitted"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return cut.join(admitted, [*same, F.col("_window") == F.col("_admitted")], "left_semi").drop("_window")


def first_contents(rows: DataFrame, keys: list[str], content_hash: Column, order: list[str]) -> DataFrame:
    """Rows that show a content for the first time: a return to an earlier one isn't new."""
    return first_of(rows.withColumn("_hash", content_hash), [*keys, "_hash"], order).drop("_hash")


def unseen(rows: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't among those seen."""
    return rows.join(seen.select(*keys).distinct(), keys, "left_anti")
