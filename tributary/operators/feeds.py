"""Feeds together: union, lookup, reconciliation, newest, pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_tagged(feeds: dict[str, DataFrame], tag: str = "event_type") -> DataFrame:
    """All rows of all feeds, each tagged with its feed's name (an earlier column of that name is overwritten)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(tag, F.lit(name)) for name, df in feeds.items()])


def with_details(rows: DataFrame, details: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their details; a row without any is dropped, and the others go on."""
    return rows.join(details, keys, "inner")


def reconcile(active: DataFrame, desired: DataFrame, keys: list[str], static: DataFrame | None = None, complete: bool = True) -> tuple[DataFrame, DataFrame]:
    """(to start, to stop): the keys that are desired and not active, and the other way round.

    Nothing is stopped where ``desired`` is empty, for an empty listing is more
    likely a failed one, nor where the listing isn't ``complete``; what is
    ``static`` is always desired.
    """
    listed = complete and not desired.isEmpty()
    wanted = desired.select(*keys)
    wanted = (wanted if static is None else wanted.unionByName(static.select(*keys))).distinct()
    running = active.select(*keys).distinct()
    stale = running.join(wanted, keys, "left_anti").where(F.lit(listed))
    return wanted.join(running, keys, "left_anti"), stale


def newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``, with all columns."""
    packed = F.max_by(F.struct(*rows.columns), F.struct(*order))
    return rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(packed.alias("_row")).select("_row.*")


def page(rows: DataFrame, order: list[str], size: int, number: int = 1) -> DataFrame:
    """A page of ``size`` rows by ``order``, which should end in a unique column; pages count from 1."""
    return rows.orderBy(*order).offset(size * (number - 1)).limit(size)
