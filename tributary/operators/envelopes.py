"""Records out of API responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean_json
from ..functions.json_path import field

#: Names under which responses hold their records, in order of precedence.
ITEM_KEYS = ("data", "pageItems", "items", "value", "result", "results", "records")


def items(rows: DataFrame, body: str = "body", path: str | None = None, out: str = "item") -> DataFrame:
    """One row for each record of a response, as VARIANT; the other columns are kept.

    The body is a bare array, or an object that holds the array at ``path`` or
    else under the first of ITEM_KEYS that it has. Bodies that are blank,
    malformed or without an array give no row. Records that aren't objects,
    and empty objects, are skipped.
    """
    parsed = clean_json.parse(F.col(body))
    inner = field(parsed, path, "list") if path is not None else F.coalesce(field(parsed, "", "list"), *[field(parsed, k, "list") for k in ITEM_KEYS])
    kept = [c for c in rows.columns if c != body]
    exploded = rows.select(*kept, F.explode(inner).alias(out))
    return exploded.where(F.size(F.coalesce(F.map_keys(field(F.col(out), "", "object")), F.array().cast("array<string>"))) > 0)


def malformed(rows: DataFrame, body: str = "body", path: str | None = None) -> DataFrame:
    """The rows whose body isn't blank and holds no array of records, for a feed to fail on."""
    parsed = clean_json.parse(F.col(body))
    inner = field(parsed, path, "list") if path is not None else F.coalesce(field(parsed, "", "list"), *[field(parsed, k, "list") for k in ITEM_KEYS])
    return rows.where((F.length(F.trim(F.coalesce(F.col(body), F.lit("")))) > 0) & inner.isNull())
