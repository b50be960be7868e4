"""Event times from texts and numbers. Times without a zone are UTC: set the session's time zone to that."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Layouts that are tried in turn.
LAYOUTS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd",
)


def parsed(text: Column, layouts: tuple[str, ...] = LAYOUTS) -> Column:
    """The time by the first layout that fits; null if none does. Digits beyond microseconds are dropped."""
    short = F.regexp_replace(text, r"(\.\d{6})\d+", "$1")
    return F.coalesce(*[F.try_to_timestamp(short, F.lit(layout)) for layout in layouts])


def first_known(*times: Column) -> Column:
    """The first time that isn't null, else the time of ingestion."""
    return F.coalesce(*times, F.current_timestamp())


def millis(time: Column) -> Column:
    return F.unix_millis(time)
