"""The canonical events table, and how records become its rows."""

from __future__ import annotations

from dataclasses import dataclass
from dataclasses import field as member

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_json
from ..functions.json_path import field, find_first, steps
from ..functions.text import content_hash, named_groups
from ..functions.timestamps import first_known, parsed

SCHEMA = "source string, sensor_key string, hostname string, event_type string, event_time timestamp, ingest_time timestamp, payload_kind string, text string, payload variant, dedupe_key string, provenance struct<path:string,offset:bigint>"
#: Members that often hold a record's id, and its time.
ID_FIELDS = ("id", "uuid", "eventId", "event_id")
TIME_FIELDS = ("time", "eventTime", "timestamp")


@dataclass(frozen=True)
class Mapping:
    """How a source's records are read, in this order: pattern, extractors, field mappings."""

    source: str
    pattern: str | None = None  # named groups turn a line into JSON
    sensor_key_path: str | None = None
    sensor_key: str | None = None
    sensor_hostname_path: str | None = None
    event_type_path: str | None = None
    event_type: str | None = None
    event_time_path: str | None = None
    id_paths: tuple[str, ...] = ID_FIELDS
    fields: dict[str, str] = member(default_factory=dict)  # source path to new name
    rename_only: bool = False  # keep the other fields too


def _is_name(path: str) -> bool:
    """Whether a path is one name, for which an object needs no more than a look inside the JVM."""
    own = steps(path)
    return len(own) == 1 and own[0] not in ("*", "?")


def _either(record: Column, text: Column, path: str) -> tuple[Column, Column]:
    """The first string and the first integer at a path of a record, an object: by its VARIANT for one name, else by its text, read once."""
    if _is_name(path):
        return field(record, path, "string"), field(record, path, "int")
    found = find_first(text, {"s": (path, "string"), "i": (path, "int")})
    return found["s"], found["i"]


def _scalar(record: Column, text: Column, path: str) -> Column:
    """The first string or integer at a path, as a string."""
    string, number = _either(record, text, path)
    return F.coalesce(string, number.cast("string"))


def identity(record: Column, text: Column, paths: tuple[str, ...] = ID_FIELDS) -> Column:
    """A record's id by the first path that has one, strings or integers, else its content's hash."""
    return F.coalesce(*[_scalar(record, text, p) for p in paths], content_hash(text))


def event_time(record: Column, text: Column, paths: tuple[str, ...] = TIME_FIELDS) -> Column:
    """A record's time by the first path that has a readable one: a text, or milliseconds since 1970. Null if none has."""
    tries = []
    for p in paths:
        string, number = _either(record, text, p)
        tries += [parsed(string), F.timestamp_millis(number.cast("long"))]
    return F.coalesce(*tries)


def mapped(variant: Column, fields: dict[str, str], rename_only: bool = False) -> Column:
    """The record with members moved to new names, as JSON text.

    Paths are of names and ``[n]``. With ``rename_only`` the members that aren't
    moved stay; else only the moved ones are left. A member that is absent is left out.
    """
    whole = field(variant, "", "object")
    moved = F.map_from_arrays(F.array(*[F.lit(n) for n in fields.values()]), F.array(*[field(variant, p, "any") for p in fields]))
    moved = F.map_filter(moved, lambda _, v: v.isNotNull())
    gone = [steps(p)[0] for p in fields if len(steps(p)) == 1]
    if not rename_only:
        return F.to_json(moved)
    rest = F.map_filter(whole, lambda k, _: ~k.isin(*gone, *fields.values()))
    return F.to_json(F.map_concat(rest, moved))


def root_or_below(text: Column, name: str, kind: str = "string") -> Column:
    """A member of the record, or else of one of its members."""
    found = find_first(text, {"root": (name, kind), "below": (f"?/{name}", kind)})
    return F.coalesce(found["root"], found["below"])


def flattened(variant: Column, member_name: str) -> Column:
    """The record as JSON text with an object's members beside its own, which count where names clash."""
    whole = field(variant, "", "object")
    inner = F.coalesce(field(variant, member_name, "object"), F.map_filter(whole, lambda k, _: F.lit(False)))
    own = F.map_filter(whole, lambda k, _: k != member_name)
    return F.to_json(F.map_concat(F.map_filter(inner, lambda k, _: ~F.map_contains_key(own, k)), own))


def to_events(rows: DataFrame, mapping: Mapping, text: str = "text", path: str | None = None, offset: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical events of raw records in the column ``text``, and the columns ``keep`` of the raw records.

    A record that is a clean JSON object is of kind ``json``; any other text is
    of kind ``text`` with a null payload. Null texts are left out. Times that
    can't be read become the time of ingestion.
    """
    raw = F.col(text)
    own = rows.where(raw.isNotNull())
    if mapping.pattern:
        own = own.withColumn(text, F.coalesce(F.when(F.regexp_like(raw, F.lit(mapping.pattern.replace("(?P<", "(?<"))), F.to_json(named_groups(raw, mapping.pattern))), raw))
    payload = clean_json.parse(raw)
    own = own.withColumn("_payload", F.when(F.schema_of_variant(payload).startswith("OBJECT"), payload))
    record, is_json = F.col("_payload"), F.col("_payload").isNotNull()
    time = event_time(record, raw, (mapping.event_time_path,) if mapping.event_time_path else TIME_FIELDS)
    shaped = mapped(record, mapping.fields, mapping.rename_only) if mapping.fields else raw
    final = F.when(is_json, shaped).otherwise(raw)
    return own.select(
        F.lit(mapping.source).alias("source"),
        (_scalar(record, raw, mapping.sensor_key_path) if mapping.sensor_key_path else F.lit(mapping.sensor_key).cast("string")).alias("sensor_key"),
        (_scalar(record, raw, mapping.sensor_hostname_path) if mapping.sensor_hostname_path else F.lit(None).cast("string")).alias("hostname"),
        (F.coalesce(_scalar(record, raw, mapping.event_type_path), F.lit(mapping.event_type)) if mapping.event_type_path else F.lit(mapping.event_type).cast("string")).alias("event_type"),
        first_known(time).alias("event_time"),
        F.current_timestamp().alias("ingest_time"),
        F.when(is_json, "json").otherwise("text").alias("payload_kind"),
        final.alias("text"),
        F.when(is_json, F.try_parse_json(final)).alias("payload"),
        identity(record, raw, mapping.id_paths).alias("dedupe_key"),
        F.struct((F.col(path) if path else F.lit(None)).cast("string").alias("path"), (F.col(offset) if offset else F.lit(None)).cast("bigint").alias("offset")).alias("provenance"),
        *keep,
    )


def filled(rows: DataFrame, **defaults: Column) -> DataFrame:
    """``rows`` with each of these columns where it is missing or null."""
    return rows.withColumns({n: F.coalesce(F.col(n), c) if n in rows.columns else c for n, c in defaults.items()})
