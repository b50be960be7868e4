"""Running sums that no single task has to carry.

A window over one long file would put the file in one task. Here the rows of a
key are summed in stretches of ``stretch`` places, the stretches' totals are
summed along the key, and each row adds the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Places of a stretch.
STRETCH = 100_000


def in_stretches(rows: DataFrame, place: str, stretch: int = STRETCH) -> DataFrame:
    """``rows`` with ``_stretch``, by which several running sums share one shuffle."""
    return rows.withColumn("_stretch", F.floor(F.col(place) / stretch))


def running_sum(rows: DataFrame, keys: list[str], place: str, value: Column, name: str, stretch: int = STRETCH, total: str | None = None) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the key's rows up to this one, by the integer column ``place``.

    ``total``: a column for the sum over all the key's rows, if it is wanted. Rows that come ``in_stretches`` stay so.
    """
    given = "_stretch" in rows.columns
    cut = (rows if given else in_stretches(rows, place, stretch)).withColumn("_value", value)
    totals = cut.groupBy(*keys, "_stretch").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = [F.sum("_total").over(Window.partitionBy(*keys)).alias(total)] if total else []
    starts = totals.select(*keys, "_stretch", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"), *whole)
    within = Window.partitionBy(*keys, "_stretch").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    joined = cut.withColumn("_within", F.sum("_value").over(within)).join(starts, [*keys, "_stretch"])
    return joined.withColumn(name, F.col("_within") + F.col("_before")).drop("_value", "_within", "_before", *([] if given else ["_stretch"]))
