"""Records from raw text: lines, and JSON objects that stretch over lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import brace_balance
from .running import in_stretches, running_sum


def lines(rows: DataFrame, text: str = "text", separator: str = "\n", out: str = "line", max_size: int | None = None) -> DataFrame:
    """One row for each piece between separators, but empty ones; ``place`` counts all pieces from 0.

    Other columns are kept. A null text gives no row. A last piece without a
    separator counts, and so do pieces of one byte. With ``max_size``, a piece of
    more characters has a null in place of its text and its length in the column
    ``oversize``, which is null for the others.
    """
    cut = rows.select(*[c for c in rows.columns if c != text], F.posexplode(F.split(F.col(text), f"\\Q{separator}\\E")).alias("place", out))
    kept = cut.where(F.length(out) > 0)
    if max_size is None:
        return kept
    size = F.length(out)
    return kept.withColumn("oversize", F.when(size > max_size, size)).withColumn(out, F.when(F.col("oversize").isNull(), F.col(out)))


def multi_line_json(rows: DataFrame, keys: list[str], place: str = "place", line: str = "line") -> DataFrame:
    """(keys, object_no, text): lines are trimmed and joined, without blanks, until their braces balance.

    Blank lines are dropped; braces inside strings count. Lines after the last
    balanced one are no object, and are left out before lines are gathered: a brace that
    never closes doesn't put the rest of its file in one task. ``place`` is the line's
    integer place in its file.
    """
    trimmed = rows.select(*keys, place, F.trim(F.col(line)).alias("_line")).where(F.length("_line") > 0)
    trimmed = in_stretches(trimmed, place).repartition(*keys, "_stretch")  # once for both sums
    balanced = running_sum(trimmed, keys, place, brace_balance(F.col("_line")), "_open")
    numbered = running_sum(balanced, keys, place, (F.col("_open") == 0).cast("long"), "_ended", total="_objects")
    # a closing line has already counted itself
    numbered = numbered.withColumn("object_no", F.col("_ended") - (F.col("_open") == 0).cast("long"))
    whole = numbered.where("object_no < _objects").groupBy(*keys, "object_no").agg(
        F.sort_array(F.collect_list(F.struct(F.col(place).alias("place"), F.col("_line").alias("line")))).alias("_lines"),  # the lines of one object
    )
    return whole.select(*keys, "object_no", F.array_join("_lines.line", "").alias("text"))
