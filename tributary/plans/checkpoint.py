"""How far a feed has been read.

A feed is walked in ascending order of (time, id) from its checkpoint. Records
may become visible late, up to ``lag`` after their time, so a complete walk
moves the checkpoint to now less that lag and later walks read the overlap
again, where de-duplication absorbs it. A walk that was cut off moves it to the
newest time seen, a failed one leaves it, and it never goes back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Walk:
    """What one walk came to. Times are milliseconds since 1970."""

    newest: int | None = None
    complete: bool = True
    failed: bool = False


def advanced(checkpoint: int, walk: Walk, now: int, lag: int) -> int:
    """The checkpoint after a walk."""
    if walk.failed:
        return checkpoint
    upto = now - lag
    if not walk.complete:
        upto = min(upto, checkpoint if walk.newest is None else walk.newest)
    return max(checkpoint, upto)


def is_stuck(checkpoint: int, walk: Walk) -> bool:
    """Whether a walk was cut off without having passed its checkpoint: its cap is too small for the records of one time."""
    return not walk.complete and not walk.failed and (walk.newest is None or walk.newest <= checkpoint)


def watermark(rows: DataFrame, keys: list[str], time: str, now: Column, lag_seconds: int) -> DataFrame:
    """(keys, seen, checkpoint): rows and the checkpoint that a complete walk over them leads to at most, for each feed."""
    lagged = now - F.make_dt_interval(secs=F.lit(lag_seconds).cast("decimal(18,6)"))
    return rows.groupBy(*keys).agg(F.count("*").alias("seen"), F.least(F.max(time), lagged).alias("checkpoint"))
