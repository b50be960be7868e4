"""Named predicates of feed specifications; Catalyst pushes them to the scan where it can."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A null is empty, and neither contains nor is anything.
PREDICATES: dict[str, Callable[[Column, object], Column]] = {
    "is": lambda c, v: c == F.lit(v),
    "isNot": lambda c, v: ~c.eqNullSafe(F.lit(v)),
    "contains": lambda c, v: F.contains(c, F.lit(v)),
    "notContains": lambda c, v: ~F.coalesce(F.contains(c, F.lit(v)), F.lit(False)),
    "startsWith": lambda c, v: F.startswith(c, F.lit(v)),
    "isEmpty": lambda c, _: c.isNull() | (c.cast("string") == ""),
    "isNotEmpty": lambda c, _: c.isNotNull() & (c.cast("string") != ""),
    "greaterThan": lambda c, v: c > F.lit(v),
    "lessThan": lambda c, v: c < F.lit(v),
}


def all_of(conditions: list[tuple[str, str, object]]) -> Column:
    """(column, predicate, value) conditions, all of which must hold."""
    return reduce(lambda a, b: a & b, [PREDICATES[p](F.col(c), v) for c, p, v in conditions], F.lit(True))


def included(rows: DataFrame, column: str, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Rows that match ``include``, if given, and then don't match ``exclude``, if given."""
    if include:
        rows = rows.where(F.col(column).rlike(include))
    if exclude:
        rows = rows.where(~F.coalesce(F.col(column).rlike(exclude), F.lit(False)))
    return rows
