"""The registered queries of the ingestion operators, each with its SQL where SQL can express it."""

from __future__ import annotations

import bisect
import functools
from collections.abc import Callable, Iterator
from itertools import islice
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from .functions import clean_json, typed
from .functions.json_path import field, find, find_first, find_one, has, keys, values
from .functions.text import address, composite_key, content_hash, jwt_expiry, named_groups, pod_of, url_decoded, xml_value
from .functions.timestamps import millis, parsed
from .operators import dedupe, envelopes, events, feeds, framing, predicates
from .plans import ingest
from .plans.checkpoint import watermark
from .sources import artifacts, cursors, files, mailbox, objects, paged, queues, spool
from .sources.spool import opened
from .streaming.dedupe import within_watermark
from .streaming.sinks import run_once, shared_folder, to_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
WITH typed AS (SELECT event_id, ts, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type <> 'error'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY ts, event_id) AS n FROM typed)
SELECT event_id, 'events' AS source, CAST(user_id AS VARCHAR) AS sensor_key, event_type, epoch_us(ts) // 1000 AS event_ms, k FROM ranked WHERE n = 1
""")
def ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: scan, typed path, event time, filter, first per key and hour, canonical columns."""
    rows = table(spark, sf_dir, "events").where("event_type <> 'error'").withColumn("ts", F.col("ts").cast("timestamp"))
    first = dedupe.first_in_window(rows, ["user_id", "event_type"], "ts", 3600, ["event_id"])
    k = field(clean_json.parse(F.col("props")), "k", "int").cast("long")
    return first.select("event_id", F.lit("events").alias("source"), F.col("user_id").cast("string").alias("sensor_key"), "event_type", millis(F.col("ts")).alias("event_ms"), k.alias("k"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def path_get_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", field(clean_json.parse(F.col("props")), "k", "int").cast("long").alias("k"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def path_find_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", find_one("props", "k", "int").cast("long").alias("k"))


def _wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"a":{"b":['), "props", F.lit(","), "props", F.lit(']},"k":"text"}')).alias("doc"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) * 2 AS total, 2 AS found FROM events")
def path_deep_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``*/k`` reaches every k at any depth; the typed form drops the text at the top."""
    rows = _wrapped(spark, sf_dir).select("event_id", find("doc", "*/k", "int").alias("ks"))
    return rows.select("event_id", F.aggregate("ks", F.lit(0).cast("long"), lambda a, x: a + x.cast("long")).alias("total"), F.size("ks").alias("found"))


@query("SELECT conv_id, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations WHERE text IS NOT NULL GROUP BY conv_id")
def path_list_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name after a list is taken from every element."""
    rows = table(spark, sf_dir, "conversations").where("text is not null")
    packed = rows.groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct("turn", "text")).alias("turns"))).alias("doc"))  # the turns of one conversation
    found = packed.select("conv_id", find("doc", "turns/text", "string").alias("texts"))
    return found.select("conv_id", F.size("texts").cast("long").alias("turns"), F.aggregate("texts", F.lit(0).cast("long"), lambda a, t: a + F.length(t)).alias("chars"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def path_auto_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON inside a string of JSON."""
    rows = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(F.col("props").alias("body"))).alias("doc"))
    return rows.select("event_id", find_one("doc", "body/k", "int", expand=True).cast("long").alias("k"))


@query("SELECT event_id, json_exists(props, '$.k') AS has_k, json_exists(props, '$.none') AS has_none FROM events")
def path_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", has("props", "k").alias("has_k"), has("props", "none").alias("has_none"))


@query("SELECT event_id, array_to_string(list_sort(json_keys(props)), ',') AS names FROM events")
def path_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.array_join(F.sort_array(keys(clean_json.parse(F.col("props")))), ",").alias("names"))


@query("""
SELECT event_id, n, CASE n WHEN 0 THEN event_id % 2 = 0 WHEN 3 THEN FALSE WHEN 4 THEN event_id % 10 < 6 ELSE TRUE END AS clean FROM events, (SELECT unnest([0, 1, 2, 3, 4]) AS n)
""")
def clean_json_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole 64-bit integers and doubles with a dot are clean; an exponent without a dot and wider integers are not."""
    spelled = F.concat("event_id", F.when(F.col("event_id") % 2 == 0, ".5").otherwise("e5"))
    numbers = F.array(spelled, F.concat(F.lit("-"), "event_id"), F.concat("event_id", F.lit(".0")), F.concat("event_id", F.lit("E-7")), F.concat(F.lit("1844674407370955161"), F.col("event_id") % 10))
    rows = table(spark, sf_dir, "events").select("event_id", F.posexplode(numbers).alias("n", "number"))
    doc = F.concat(F.lit('{"1e5": "2e9", "x": '), "number", F.lit("}"))
    return rows.select("event_id", "n", clean_json.parse(doc).isNotNull().alias("clean"))


@query("SELECT doc_id, place - 1 AS place, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents) WHERE line <> ''")
def frame_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return framing.lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.col("place").cast("long").alias("place"), "line")


@query("SELECT user_id, event_id, '{\"id\":' || event_id || ',\"props\":' || replace(props, ' ', '') || '}' AS text FROM events")
def multi_line_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects that were written over four lines each, one file for each user, come back whole."""
    rows = table(spark, sf_dir, "events")
    parts = F.array(F.lit("{"), F.concat(F.lit('  "id":'), "event_id", F.lit(",")), F.concat(F.lit('  "props":'), F.regexp_replace("props", " ", "")), F.lit("} "))
    lines = rows.select("user_id", F.posexplode(parts).alias("n", "line"), "event_id").withColumn("place", F.col("event_id") * 4 + F.col("n"))
    whole = framing.multi_line_json(lines, ["user_id"])
    return whole.select("user_id", F.get_json_object("text", "$.id").cast("long").alias("event_id"), "text")


@query("SELECT conv_id, turn, role FROM conversations")
def envelope_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in an envelope; the empty object beside them is skipped."""
    rows = table(spark, sf_dir, "conversations")
    bodies = rows.groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct("turn", "role")).alias("results"))).alias("body"))
    bodies = bodies.withColumn("body", F.regexp_replace("body", r"\]\}$", ",{}]}"))
    found = envelopes.items(bodies)
    return found.select("conv_id", field(F.col("item"), "turn", "int").cast("long").alias("turn"), field(F.col("item"), "role").alias("role"))


@query("SELECT p_partkey, p_name, p_size, p_retailprice, TRUE AS spelled FROM part")
def parquet_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet rows as JSON text and back: integers stay whole, doubles doubles."""
    text = files.parquet_rows(spark, f"{sf_dir}/part.parquet")
    v = F.try_parse_json("text")
    size = field(v, "p_size", "int").cast("int")
    return text.select(field(v, "p_partkey", "int").cast("long").alias("p_partkey"), field(v, "p_name").alias("p_name"), size.alias("p_size"), find_one("text", "p_retailprice", "double").alias("p_retailprice"), F.contains("text", F.concat(F.lit('"p_size":'), size)).alias("spelled"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN -1 ELSE epoch_us(o_orderdate) // 1000 END AS ms FROM orders")
def event_time_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in several layouts, and one that fits none."""
    at = F.col("o_orderdate").cast("timestamp")
    form = F.col("o_orderkey") % 4
    text = F.when(form == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(form == 1, F.date_format(at, "yyyy-MM-dd HH:mm:ss")).when(form == 2, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS+00:00")).otherwise("yesterday")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(millis(parsed(text)), F.lit(-1)).alias("ms"))


@query("""
SELECT event_id, user_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY ts, event_id) AS n FROM events
) WHERE n = 1
""")
def dedupe_first_in_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return dedupe.first_in_window(rows, ["user_id", "event_type"], "ts", 3600, ["event_id"]).select("event_id", "user_id", "event_type")


@query("""
WITH RECURSIVE firsts AS (
  SELECT event_type, user_id, w, event_id FROM (
    SELECT event_type, user_id, epoch_us(ts) // 3600000000 AS w, event_id, row_number() OVER (PARTITION BY event_type, user_id, epoch_us(ts) // 3600000000 ORDER BY ts, event_id) AS n FROM events
  ) WHERE n = 1
), kept AS (
  SELECT event_type, user_id, min(w) AS w FROM firsts GROUP BY ALL
  UNION ALL
  SELECT k.event_type, k.user_id, (SELECT min(f.w) FROM firsts f WHERE f.event_type = k.event_type AND f.user_id = k.user_id AND f.w >= k.w + 6) AS w
  FROM kept k WHERE k.w IS NOT NULL
)
SELECT event_id, event_type, user_id FROM firsts JOIN (SELECT DISTINCT * FROM kept WHERE w IS NOT NULL) USING (event_type, user_id, w)
""")
def dedupe_ttl_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six rotating buckets of an hour each."""
    rows = table(spark, sf_dir, "events")
    return dedupe.first_within_ttl(rows, ["event_type", "user_id"], "ts", 3600, 6 * 3600, ["event_id"]).select("event_id", "event_type", "user_id")


@query("""
SELECT c_custkey, c_nationkey, c_mktsegment FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey, sha256(c_mktsegment) ORDER BY c_custkey) AS n FROM customer
) WHERE n = 1
""")
def change_detect_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    return dedupe.first_contents(rows, ["c_nationkey"], content_hash(F.col("c_mktsegment")), ["c_custkey"]).select("c_custkey", "c_nationkey", "c_mktsegment")


@query("SELECT event_type, count(*) AS seen, epoch_us(least(max(ts), TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 5 MINUTE)) // 1000 AS checkpoint_ms FROM events GROUP BY event_type")
def checkpoint_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    now = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return watermark(rows, ["event_type"], "ts", now, 300).select("event_type", "seen", millis(F.col("checkpoint")).alias("checkpoint_ms"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100 OFFSET 200")
def page_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page of a hundred rows."""
    return feeds.page(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 100, 3).select("o_orderkey", "o_custkey")


@query("SELECT p_partkey, p_name FROM part WHERE p_brand <> 'Brand#11' AND p_type LIKE '%A%' AND p_name NOT LIKE '%zz%' AND p_size > 5 AND p_size < 45 AND p_name <> '' AND p_brand LIKE 'Brand%'")
def predicate_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = [
        ("p_brand", "isNot", "Brand#11"),
        ("p_type", "contains", "A"),
        ("p_name", "notContains", "zz"),
        ("p_size", "greaterThan", 5),
        ("p_size", "lessThan", 45),
        ("p_name", "isNotEmpty", None),
        ("p_brand", "startsWith", "Brand"),
    ]
    return table(spark, sf_dir, "part").where(predicates.all_of(conditions)).select("p_partkey", "p_name")


@query("SELECT s_suppkey, s_name FROM supplier WHERE regexp_matches(s_name, '[0-4]$') AND NOT regexp_matches(s_name, '1$')")
def regex_include_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.included(table(spark, sf_dir, "supplier"), "s_name", "[0-4]$", "1$").select("s_suppkey", "s_name")


@query(r"SELECT page_id, regexp_extract(url, '^(https?)://([^/]+)(/.*)?$', 1) AS scheme, regexp_extract(url, '^(https?)://([^/]+)(/.*)?$', 2) AS host FROM pages WHERE regexp_matches(url, '^(https?)://([^/]+)(/.*)?$')")
def regex_named_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", named_groups(F.col("url"), r"^(?P<scheme>https?)://(?P<host>[^/]+)(/.*)?$").alias("of"))
    return rows.where("of.scheme is not null").select("page_id", "of.scheme", "of.host")


@query("SELECT o_orderkey, o_custkey, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey")
def lookup_detail_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return feeds.with_details(table(spark, sf_dir, "orders"), details, ["o_custkey"]).select("o_orderkey", "o_custkey", "c_name", "c_nationkey")


@query("SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')")
def seen_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return dedupe.unseen(table(spark, sf_dir, "orders"), seen, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("SELECT event_id, user_id, 'click' AS event_type FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, user_id, 'buy' AS event_type FROM events WHERE event_type = 'purchase'")
def feed_union_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return feeds.union_tagged({"click": rows.where("event_type = 'click'"), "buy": rows.where("event_type = 'purchase'")}).select("event_id", "user_id", "event_type")


@query("""
SELECT c_custkey, 'start' AS action FROM (SELECT c_custkey FROM customer WHERE c_acctbal > 0 EXCEPT SELECT o_custkey FROM orders)
UNION ALL
SELECT c_custkey, 'stop' AS action FROM (SELECT o_custkey AS c_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def reconcile_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    desired = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    active = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    start, stop = feeds.reconcile(active, desired, ["c_custkey"])
    return start.withColumn("action", F.lit("start")).unionByName(stop.withColumn("action", F.lit("stop")))


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id, event_type")
def newest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.newest(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN sha256(text) ELSE CAST(doc_id AS VARCHAR) END AS key FROM documents")
def id_probe_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id where there is one, else the content's hash."""
    rows = table(spark, sf_dir, "documents")
    return rows.select("doc_id", F.coalesce(F.when(F.col("doc_id") % 3 != 0, F.col("doc_id").cast("string")), content_hash(F.col("text"))).alias("key"))


@query("SELECT p_partkey, CAST(p_name AS VARCHAR) AS title, p_size AS size FROM part")
def fixed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("title"), F.col("p_size").alias("size"))


@query("SELECT p_partkey, p_name AS title, p_size AS size, p_brand AS kept FROM part")
def rename_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of a record under new names, the others kept."""
    rows = table(spark, sf_dir, "part")
    record = F.to_json(F.struct("p_partkey", F.struct("p_name").alias("of"), "p_size", "p_brand"))
    out = rows.select("p_partkey", F.try_parse_json(events.mapped(F.parse_json(record), {"of/p_name": "title", "p_size": "size"}, rename_only=True)).alias("v"))
    return out.select("p_partkey", field(F.col("v"), "title").alias("title"), field(F.col("v"), "size", "int").cast("int").alias("size"), field(F.col("v"), "p_brand").alias("kept"))


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'a b/' || page_id || '&é' WHEN 1 THEN url END AS key FROM pages")
def url_decode_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escapes of one and two bytes, a plus sign, escaped addresses, and broken escapes."""
    form = F.col("page_id") % 3
    escaped = F.when(form == 0, F.concat(F.lit("a+b%2F"), "page_id", F.lit("%26%C3%A9"))).when(form == 1, F.url_encode("url")).otherwise(F.concat("page_id", F.lit("%zz")))
    return table(spark, sf_dir, "pages").select("page_id", url_decoded(escaped).alias("key"))


@query("""
SELECT c_custkey, sensor_key, event_type, event_ms, payload_kind, dedupe_key FROM (
  SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS sensor_key, c_mktsegment AS event_type, 1700000000000 + c_custkey AS event_ms, 'json' AS payload_kind, CAST(c_custkey AS VARCHAR) AS dedupe_key FROM customer
)
""")
def canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by paths: sensor, type, time and id."""
    rows = table(spark, sf_dir, "customer")
    record = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.struct(F.col("c_nationkey").alias("nation")).alias("of"), F.col("c_mktsegment").alias("kind"), (F.lit(1_700_000_000_000) + F.col("c_custkey")).alias("at")))
    mapping = events.Mapping("customers", sensor_key_path="of/nation", event_type_path="kind", event_time_path="at")
    out = events.to_events(rows.select(record.alias("text")), mapping)
    return out.select(field(F.col("payload"), "id", "int").cast("long").alias("c_custkey"), "sensor_key", "event_type", millis(F.col("event_time")).alias("event_ms"), "payload_kind", "dedupe_key")


@query("SELECT s_suppkey, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier")
def xml_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of XML records."""
    record = F.concat(F.lit("<Event><Data Name='n'>"), "s_name", F.lit("</Data><Nation>"), "s_nationkey", F.lit("</Nation></Event>"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", xml_value(record, "Event/Data[@Name='n']").alias("name"), xml_value(record, "Event/Nation").alias("nation"))


@query("SELECT c_custkey, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation FROM customer")
def flatten_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested object's members move beside the record's own, which count where names clash."""
    inner = F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), F.lit("other").alias("name"))
    record = F.to_json(F.struct(F.col("c_name").alias("name"), inner.alias("fields")))
    out = table(spark, sf_dir, "customer").select("c_custkey", F.try_parse_json(events.flattened(F.parse_json(record), "fields")).alias("v"))
    return out.select("c_custkey", field(F.col("v"), "name").alias("name"), field(F.col("v"), "segment").alias("segment"), field(F.col("v"), "nation", "int").cast("int").alias("nation"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def member_root_or_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member at the root of even events and one level down in the others."""
    record = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit('{"inner":'), "props", F.lit("}")))
    return table(spark, sf_dir, "events").select("event_id", events.root_or_below(record, "k", "int").cast("long").alias("k"))


@query("SELECT l_orderkey || '|' || l_linenumber AS key, count(*) AS n FROM lineitem GROUP BY ALL")
def composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(composite_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("key")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey AS c_custkey, NULL AS c_name FROM supplier")
def feed_union_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds with different columns."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return feeds.union_tagged({"c": customers, "s": table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"))}).select("c_custkey", "c_name")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream without repeats of its keys, run over what there is now."""
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    return run_once(within_watermark(stream.select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "1000 days").select("user_id", "event_type"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) + 1 AS k FROM events")
def path_list_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``[n]`` takes one element of a list, and nothing beyond its end."""
    rows = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"a":[{"k":-1},'), "props", F.lit("]}")).alias("doc"))
    found = find_one("doc", "a/[1]/k", "int").cast("long")
    return rows.select("event_id", (found + F.when(find_one("doc", "a/[2]/k", "int").isNull(), 1)).alias("k"))


@query("SELECT o_orderkey, o_orderkey + o_custkey AS total FROM orders")
def path_list_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``*`` on a list takes every element, once."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(F.array("o_orderkey", "o_custkey").alias("l"))).alias("doc"))
    return rows.select("o_orderkey", F.aggregate(find("doc", "l/*", "int"), F.lit(0).cast("long"), lambda a, x: a + x.cast("long")).alias("total"))


@query("""
SELECT c_custkey, c_acctbal > 0 AS positive, c_acctbal AS balance, '[' || c_custkey || ',"' || c_mktsegment || '"]' AS parts, c_mktsegment AS first_text, CAST(c_nationkey AS BIGINT) AS first_int FROM customer
""")
def path_typed_finds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Booleans, doubles and lists by their kind, and several finds of one reading."""
    record = F.struct((F.col("c_acctbal") > 0).alias("b"), F.col("c_acctbal").alias("d"), F.struct(F.col("c_nationkey").alias("n")).alias("o"))
    doc = F.concat(F.regexp_replace(F.to_json(record), r"\}$", ',"l":['), "c_custkey", F.lit(',"'), "c_mktsegment", F.lit('"]}'))
    rows = table(spark, sf_dir, "customer").select("c_custkey", doc.alias("doc"))
    several = find_first("doc", {"s": ("?/*", "string"), "i": ("?/n", "int")})
    return rows.select("c_custkey", find_one("doc", "b", "bool").alias("positive"), find_one("doc", "d", "double").alias("balance"), find_one("doc", "l", "list").alias("parts"), several["s"].alias("first_text"), several["i"].cast("long").alias("first_int"))


@query("SELECT c_custkey, CAST(c_custkey AS VARCHAR) || ',' || c_nationkey AS members FROM customer")
def path_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.parse_json(F.to_json(F.struct(F.col("c_custkey").alias("a"), F.col("c_nationkey").alias("b"))))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(F.transform(values(record), lambda v: v.cast("string")), ",").alias("members"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN p_size > 10 ELSE FALSE END AS parquet FROM part")
def parquet_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the name in any case, or by the mark at both ends; one end is not enough."""
    form = F.col("p_partkey") % 4
    name = F.concat("p_name", F.when(form == 0, ".PARQUET").otherwise(".bin"))
    marked = F.concat(F.lit("PAR1"), "p_brand", F.when(F.col("p_size") > 10, "PAR1").otherwise("PAR2"))
    content = F.when(form == 1, marked).when(form == 2, F.concat(F.lit("PAR1"), "p_brand")).when(form == 3, F.lit("PAR1")).otherwise(F.lit(""))
    return table(spark, sf_dir, "part").select("p_partkey", files.is_parquet(name, content.cast("binary")).alias("parquet"))


#: Most rows of a file that is to be decoded whole, so that a larger table gives more files, and none beyond the cap.
_FILE_ROWS = 50_000


def _small_files(rows: DataFrame) -> DataFrameWriter:
    return rows.write.option("maxRecordsPerFile", _FILE_ROWS)


@query("""
SELECT kind, c_custkey, c_name, c_acctbal / 3e14 AS small, CAST(c_custkey + 1 AS VARCHAR) || '12345678901234.0625' AS exact, c_custkey * 1000003 AS micros, c_name AS raw
FROM customer, (SELECT unnest(['packed', 'rows', 'plain']) AS kind)
""")
def bundle_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small files of three kinds, each read as its kind is: doubles, decimals, times and bytes keep all their digits."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", (F.col("c_acctbal").cast("double") / 3e14).alias("small"), F.concat(F.col("c_custkey") + 1, F.lit("12345678901234.0625")).cast("decimal(38,4)").alias("exact"), F.timestamp_micros(F.col("c_custkey") * 1000003).alias("at"), F.col("c_name").cast("binary").alias("raw")
    )
    path = shared_folder(spark, "bundles")
    _small_files(rows).parquet(f"{path}/rows")
    _small_files(files.json_rows(rows)).option("compression", "gzip").text(f"{path}/packed")
    _small_files(files.json_rows(rows)).text(f"{path}/plain")
    found = files.bundles(spark, f"{path}/*", "part-*").where("error is null").withColumn("v", F.try_parse_json("text"))
    return found.select(
        F.regexp_extract("path", "/(rows|packed|plain)/", 1).alias("kind"), field(F.col("v"), "c_custkey", "int").cast("long").alias("c_custkey"), field(F.col("v"), "c_name").alias("c_name"),
        F.regexp_extract("text", '"small":([^,]*)', 1).cast("double").alias("small"), F.regexp_extract("text", '"exact":([^,]*)', 1).alias("exact"), F.unix_micros(field(F.col("v"), "at").cast("timestamp")).alias("micros"), F.unbase64(field(F.col("v"), "raw")).cast("string").alias("raw"),
    )


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS namespace, CASE WHEN c_custkey % 5 > 0 THEN 'pod-' || c_custkey END AS pod_name, CASE WHEN c_custkey % 5 > 0 THEN 'n' || c_nationkey END AS container_name FROM customer")
def pod_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pod logs' paths, and paths that aren't."""
    path = F.concat(F.lit("/var/log/pods/"), "c_mktsegment", F.lit("_pod-"), "c_custkey", F.lit("_u1/n"), "c_nationkey", F.when(F.col("c_custkey") % 5 > 0, "/0.log").otherwise("/0.txt"))
    return table(spark, sf_dir, "customer").select("c_custkey", pod_of(path).alias("p")).select("c_custkey", "p.namespace", "p.pod_name", "p.container_name")


@query("""
SELECT conv_id, turn, part_no, CASE part_no WHEN 0 THEN 'text/plain' ELSE 'application/octet-stream' END AS content_type,
  CASE part_no WHEN 0 THEN sha256('turn ' || turn) ELSE sha256(text) END AS sha256, CASE part_no WHEN 0 THEN 'turn ' || turn END AS body, CASE part_no WHEN 1 THEN CAST(strlen(text) AS BIGINT) ELSE -1 END AS size
FROM conversations, (SELECT unnest([0, 1]) AS part_no) WHERE text IS NOT NULL
""")
def mail_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of two parts, the second one an attachment with its hash."""
    rows = table(spark, sf_dir, "conversations").where("text is not null")
    mark = "--part\n"
    body = F.concat(F.lit(f"MIME-Version: 1.0\nContent-Type: multipart/mixed; boundary=part\n\n{mark}Content-Type: text/plain\n\nturn "), "turn", F.lit(f"\n{mark}Content-Type: application/octet-stream\nContent-Transfer-Encoding: base64\n\n"), F.base64(F.col("text").cast("binary")), F.lit("\n--part--\n"))
    parts = files.mail_parts(rows.select("conv_id", "turn", body.alias("text")))
    return parts.select("conv_id", "turn", "part_no", "content_type", "sha256", "body", F.coalesce(F.octet_length("attachment"), F.lit(-1)).cast("long").alias("size"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus ELSE 'none' END AS status, 'orders' AS source FROM orders")
def filled_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"))
    return events.filled(rows, status=F.lit("none"), source=F.lit("orders")).select("o_orderkey", "status", "source")


@query("SELECT doc_id, place - 1 AS place, 'doc-' || doc_id AS path, sha256(line) AS dedupe_key, 'text' AS payload_kind FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents) WHERE line <> ''")
def provenance_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each event's record stood, with a content hash for its id."""
    lines = framing.lines(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("path", F.concat(F.lit("doc-"), "doc_id"))
    out = events.to_events(lines, events.Mapping("documents"), text="line", path="path", offset="place")
    return out.select(F.substring("provenance.path", 5, 20).cast("long").alias("doc_id"), F.col("provenance.offset").alias("place"), "provenance.path", "dedupe_key", "payload_kind")


@query("""
SELECT 'json' AS kind, CAST(c_custkey AS VARCHAR) AS name, CAST(1 AS BIGINT) AS n, 'host-' || c_nationkey AS hostname FROM customer
UNION ALL SELECT 'json' AS kind, CAST(s_suppkey AS VARCHAR) AS name, CAST(2 AS BIGINT) AS n, 'supplier-' || s_nationkey AS hostname FROM supplier
UNION ALL SELECT 'text' AS kind, 'line ' || c_nationkey AS name, 2 * count(*) AS n, NULL AS hostname FROM customer GROUP BY c_nationkey
""")
def ingest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings to events: two of one kind whose records share ids, one of them read again; equal lines of a log each."""
    rows, path = table(spark, sf_dir, "customer"), shared_folder(spark, "plan")
    record = lambda i, host: F.to_json(F.struct(F.col(i).alias("id"), F.struct(host.alias("name")).alias("host"))).alias("value")
    twice = F.explode(F.array(F.lit(1), F.lit(2))).alias("c")
    rows.select(record("c_custkey", F.concat(F.lit("host-"), "c_nationkey"))).select("value", twice).select("value").write.text(f"{path}/records")
    suppliers = table(spark, sf_dir, "supplier")
    suppliers.select(record("s_suppkey", F.concat(F.lit("supplier-"), "s_nationkey"))).select("value", twice).select("value").write.text(f"{path}/suppliers")
    rows.select(F.concat(F.lit("line "), "c_nationkey").alias("value"), twice).select("value").write.text(f"{path}/lines")
    mapping = {"client_options": {"mapping": {"sensor_hostname_path": "host/name"}}}
    settings = [{"file": {"file_path": f"{path}/records", "dedupe": True, **mapping}}, {"file": {"file_path": f"{path}/suppliers", **mapping}}, {"file": {"file_path": f"{path}/lines"}}]
    found = ingest.events(spark, settings)
    name = F.when(F.col("payload_kind") == "json", F.col("dedupe_key")).otherwise(F.col("text"))
    return found.groupBy(F.col("payload_kind").alias("kind"), name.alias("name"), "hostname").agg(F.count("*").alias("n"))


#: Records of a page of the fake services, and of a row group of the tables they read.
_PAGE = 1000


def _stored(rows: DataFrame, path: str, by: list[str] = []) -> None:  # noqa: B006
    """Writes a fake service's records in order of ``n``, in row groups of a page, so that it reads no more than the page that is asked for."""
    rows.repartitionByRange(*by, "n").sortWithinPartitions(*by, "n").write.option("parquet.block.row.count.limit", _PAGE).partitionBy(*by).parquet(path)


class _Group(NamedTuple):
    """A row group: the least and the largest ``n``, and where it stands."""

    low: int
    high: int
    name: str
    place: int
    metadata: Any


@functools.lru_cache(maxsize=32)
def _groups(path: str) -> list[_Group]:
    """The row groups of a table of ``_stored``, in order; the table doesn't change any more."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    (system, root), out = opened(path), []
    for info in system.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        if not info.base_name.endswith(".parquet"):
            continue
        with system.open_input_file(info.path) as file:
            metadata = pq.read_metadata(file)
        column = metadata.schema.names.index("n")
        for place in range(metadata.num_row_groups):
            told = metadata.row_group(place).column(column).statistics
            if told is not None and told.has_min_max:
                out.append(_Group(told.min, told.max, info.path, place, metadata))
    return sorted(out, key=lambda g: g[:4])


class _TableService:
    """A fake service whose records are rows (feed, n, text) of a table of ``_stored`` in the shared folder, which tasks read; ``n`` is time and place."""

    def __init__(self, path: str, upto: int, lost: tuple[str, ...] = (), page: int = _PAGE, tests: tuple = ()):
        self.path, self.upto, self.lost, self.page, self.tests = path, upto, lost, page, tests

    def where(self, tests: list) -> _TableService:
        return type(self)(self.path, self.upto, self.lost, self.page, tuple(tests))

    def _read(self, group: _Group, since: int, until: int) -> list[dict]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        wanted = (pc.field("n") >= since) & (pc.field("n") < min(until, self.upto))
        of = {"is": lambda c, v: c == v, "in": lambda c, v: c.isin(v), "startsWith": lambda c, v: pc.starts_with(c, v), "contains": lambda c, v: pc.match_substring(c, v), "greaterThan": lambda c, v: c > v, "lessThan": lambda c, v: c < v, "atLeast": lambda c, v: c >= v}
        for name, op, value in self.tests:
            wanted = wanted & of[op](pc.field(name), value)
        with opened(self.path)[0].open_input_file(group.name) as file:
            return pq.ParquetFile(file, metadata=group.metadata).read_row_group(group.place).filter(wanted).to_pylist()

    def _rows(self, feed: str, since: int, until: int) -> Iterator[dict]:
        """In order; what stands outside the range isn't read, nor what stands after the last row that is taken."""
        groups = _groups(self.path if not feed else f"{self.path}/feed={feed}")
        for group in groups[bisect.bisect_left(groups, since, key=lambda g: g.high) :]:
            if group.low >= min(until, self.upto):
                return
            yield from self._read(group, since, until)

    # paged.Client: the bounds that are asked for are ignored, all there is comes newest first

    def fetch(self, feed: str, since: int, until: int, cursor) -> paged.Page:
        groups, at = _groups(self.path), cursor or 0
        if not groups:
            return paged.Page([])
        return paged.Page(self._read(groups[-1 - at], 0, self.upto)[::-1], at + 1 if at + 1 < len(groups) else None)


class _CursorService(_TableService):
    """The same, by cursors; those of the feeds in ``lost`` have expired."""

    def baseline(self, member: str) -> int:
        return self.upto

    def fetch(self, member: str, cursor) -> cursors.Reading:
        if cursor is not None and member in self.lost:
            raise cursors.Expired(f"{cursor}")
        rows = list(islice(self._rows(member, cursor or 0, self.upto), self.page + 1))
        more = len(rows) > self.page
        return cursors.Reading(rows[: self.page], rows[self.page - 1]["n"] + 1 if more else self.upto, more)


class _FolderQueue:
    """A fake queue: a message is a text file in the shared folder, taken by renaming it and acknowledged by moving it away."""

    def __init__(self, path: str):
        self.path = path

    def receive(self, most: int) -> list[queues.Message]:
        system, root = opened(self.path)
        out = []
        for name in spool.Folder(f"{self.path}/ready").names():
            if len(out) == most:
                break
            if not name.startswith("part-"):
                continue
            try:
                system.move(f"{root}/ready/{name}", f"{root}/taken-{name}")
            except OSError:  # another task has it
                continue
            out.append(queues.Message(name, name, (spool.Folder(self.path).read(f"taken-{name}") or b"").decode()))
        return out

    def acknowledge(self, receipts: list[str]) -> None:
        for name in receipts:
            spool.Folder(self.path).remove(f"taken-{name}")


#: A moment after which the services' records are, and what parts their batches.
_START, _BATCH = 1_700_000_000_000, 1_000_000_000


def _served(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Customers as a service's records: by nation, those of each batch after those of the one before."""
    path = shared_folder(spark, label)
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("feed"), (F.col("c_custkey") % 3 * _BATCH + F.col("c_custkey")).alias("n"), F.col("c_custkey").alias("id"))
    _stored(rows, f"{path}/service", ["feed"])
    return path


def _polled(spark: SparkSession, path: str, sources: list) -> DataFrame:
    """What a stream gives over several batches, one for each source; each goes on from the checkpoint of the one before."""
    for source in sources:
        spark.dataSource.register(source)
        rows = spark.readStream.format(source.name()).option("state", f"{path}/state").option("backfill", "true").load()
        to_parquet(rows, f"{path}/rows", f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/rows")


def _cursor_batch(path: str, n: int, members, lost: tuple[str, ...] = ()):
    service = _CursorService(f"{path}/service", (n + 1) * _BATCH, lost)
    return cursors.cursor_source("cursor_service", service, members, lambda r: str(r["id"]), lambda r: _START + r["n"] // _BATCH, clock=lambda: (n + 1) * 60_000)


@query("""
SELECT c_nationkey AS feed, c_custkey, 1700000000000 + c_custkey % 3 AS ms, FALSE AS gap FROM customer WHERE c_nationkey <> 7 OR c_custkey % 3 < 2
UNION ALL SELECT 7 AS feed, -1 AS c_custkey, -1 AS ms, TRUE AS gap
""")
def cursor_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three polls of feeds that go on from their own cursors; before the third one feed's has expired, which a row tells."""
    path = _served(spark, sf_dir, "cursors")
    members = [str(k) for k in range(25)]
    rows = _polled(spark, path, [_cursor_batch(path, n, members, ("7",) if n == 2 else ()) for n in range(3)])
    return rows.select(F.col("feed").cast("int").alias("feed"), F.coalesce(F.col("id").cast("long"), F.lit(-1)).alias("c_custkey"), F.coalesce(millis(F.col("event_time")), F.lit(-1)).alias("ms"), F.col("error").isNotNull().alias("gap"))


@query("""
SELECT c_nationkey AS feed, c_custkey FROM customer
WHERE c_nationkey BETWEEN 5 AND 14 OR c_nationkey = 20 OR c_nationkey < 5 AND c_custkey % 3 < 2
""")
def discovered_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members that a listing finds: a broken one starts 12 and stops nothing; then 0 to 4 are gone, and 10 to 14 there. 20 is always read."""
    path = _served(spark, sf_dir, "members")
    listings = [([str(k) for k in range(10)], True), (["12"], False), ([str(k) for k in range(5, 15)], True)]
    rows = _polled(spark, path, [_cursor_batch(path, n, lambda told=told: (["20", *told[0]], told[1])) for n, told in enumerate(listings)])
    return rows.where("error is null").select(F.col("feed").cast("int").alias("feed"), F.col("id").cast("long").alias("c_custkey"))


@query("SELECT c_custkey, c_name, 0 AS left_over FROM customer")
def queue_by_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that tasks receive, each of many records; all are acknowledged in the end."""
    path, parts = shared_folder(spark, "queue"), 4 * spark.sparkContext.defaultParallelism
    files.json_rows(table(spark, sf_dir, "customer").select("c_custkey", "c_name")).repartition(parts).write.text(f"{path}/queue/ready")
    held = _FolderQueue(f"{path}/queue")
    rows = _polled(spark, path, [queues.queue_source("folder_queue", held, clock=lambda n=n: 5.0 * n) for n in (1, 2)])
    lines = framing.lines(rows, text="body").withColumn("v", F.try_parse_json("line"))
    left = len([n for n in spool.Folder(f"{path}/queue").names() if n.startswith("taken-")])
    # what the second batch received, nothing, is not acknowledged before a third one
    return lines.select(field(F.col("v"), "c_custkey", "int").cast("long").alias("c_custkey"), field(F.col("v"), "c_name").alias("c_name"), F.lit(left).alias("left_over"))


@query("""
SELECT c_custkey, c_name, FALSE AS missing FROM customer
UNION ALL SELECT -1 AS c_custkey, 'no such object' AS c_name, TRUE AS missing FROM nation
UNION ALL SELECT -1 AS c_custkey, 'no JSON' AS c_name, TRUE AS missing FROM region
""")
def notified_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects that a queue's notifications name, in JSON within JSON with encoded paths; some aren't there, some name nothing."""
    path, rows = shared_folder(spark, "objects"), table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    of = lambda k: rows.where(F.col("c_nationkey") % 3 == k).repartition(2).drop("c_nationkey")
    _small_files(of(0)).parquet(f"{path}/bucket/a b/rows")
    _small_files(files.json_rows(of(1))).option("compression", "gzip").text(f"{path}/bucket/a b/packed")
    _small_files(files.json_rows(of(2))).text(f"{path}/bucket/a b/plain")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(f"{path}/bucket").select("path")
    keys = found.select(F.url_encode(F.concat(F.lit("a b/"), F.regexp_extract("path", "([^/]+/[^/]+)$", 1))).alias("key"))
    keys = keys.unionByName(table(spark, sf_dir, "nation").select(F.concat(F.lit("gone/"), "n_nationkey").alias("key")))
    inner = F.to_json(F.struct(F.lit("bucket").alias("bucket"), F.array(F.struct(F.col("key").alias("path"))).alias("files")))
    notices = keys.select(F.to_json(F.struct(inner.alias("Message"))).alias("value"))
    notices = notices.unionByName(table(spark, sf_dir, "region").select(F.concat(F.lit("no JSON "), "r_regionkey").alias("value")))
    notices.repartition(8).write.text(f"{path}/queue/ready")
    spark.dataSource.register(queues.queue_source("notices", _FolderQueue(f"{path}/queue")))
    stream = spark.readStream.format("notices").option("state", f"{path}/state").load()
    named = objects.named_objects(framing.lines(stream, text="body", out="notice"), "notice", bucket_path="Message/bucket", file_path="Message/files/path", base=f"{path}/", decode=True)
    got = run_once(objects.object_records(named.select("message_id", "path", "notice_error"), error="notice_error"))
    v, missing = F.try_parse_json("text"), F.col("error").isNotNull()
    name = F.when(F.col("path").contains("/gone/"), "no such object").when(missing, "no JSON").otherwise(field(v, "c_name"))
    return got.select(F.coalesce(field(v, "c_custkey", "int").cast("long"), F.lit(-1)).alias("c_custkey"), name.alias("c_name"), missing.alias("missing"))


@query("""
SELECT c_custkey, 1700000000000 + 60000 * c_custkey AS ms, slice FROM customer, (SELECT unnest(['bounded', 'whole']) AS slice)
WHERE c_custkey >= 20 AND c_custkey < 140
""")
def feed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of two feeds of a service that ignores bounds: each record once, sliced or whole."""
    path = shared_folder(spark, "service")
    _stored(table(spark, sf_dir, "customer").select((F.lit(_START) + 60_000 * F.col("c_custkey")).alias("n"), F.col("c_custkey").alias("id")), f"{path}/rows")
    of = lambda name, **own: paged.Feed(name, lambda r: str(r["id"]), lambda r: r["n"], **own)
    source = paged.paged_source("table_service", [of("bounded", slice=1_000_000), of("whole", bounded=False, newest_first=True)], _TableService(f"{path}/rows", 1 << 62))
    spark.dataSource.register(source)
    rows = spark.read.format("table_service").option("since", _START + 60_000 * 20).option("until", _START + 60_000 * 140).load()
    return rows.select(F.col("id").cast("long").alias("c_custkey"), millis(F.col("event_time")).alias("ms"), F.col("feed").alias("slice"))


@query("""
SELECT c_custkey, c_mktsegment AS segment, 4 AS sent FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') AND c_mktsegment LIKE '%U%' AND c_nationkey >= 3 AND c_acctbal < 5000
""")
def pushed_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four conditions that reach a service's requests, and one (a length) that doesn't: each record that the service gives tells how many it was held against."""
    path = shared_folder(spark, "service")
    rows = table(spark, sf_dir, "customer").select((F.lit(_START) + 60_000 * F.col("c_custkey")).alias("n"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("long").alias("nation"), F.col("c_acctbal").cast("double").alias("balance"))
    _stored(rows, f"{path}/rows")
    columns = {"segment": ("segment", "string"), "nation": ("nation", "long"), "balance": ("balance", "double"), "held": ("held", "long")}
    spark.dataSource.register(paged.paged_source("conditional", [paged.Feed("rows", lambda r: str(r["id"]), lambda r: r["n"], bounded=False)], _ConditionService(f"{path}/rows", 1 << 62), columns=columns))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    found = spark.read.format("conditional").option("push_filters", "true").option("since", 0).option("until", 1 << 62).load()
    found = found.where("segment in ('BUILDING', 'MACHINERY', 'FURNITURE') and segment like '%U%' and nation >= 3 and balance < 5000 and length(segment) > 1")
    return found.select(F.col("id").cast("long").alias("c_custkey"), "segment", F.col("held").cast("int").alias("sent"))


class _ConditionService(_TableService):
    def fetch(self, feed: str, since: int, until: int, cursor) -> paged.Page:
        page = super().fetch(feed, since, until, cursor)
        return paged.Page([i | {"held": len(self.tests)} for i in page.items], page.following)


class _TableMailbox:
    """A fake mailbox: message n is the n-th customer, as long as it is among the first ``upto`` ones."""

    def __init__(self, path: str, validity: int, upto: int):
        self.path, self.validity, self.upto = path, validity, upto

    def status(self) -> tuple[int, int]:
        return self.validity, self.upto + 1

    def fetch(self, low: int, high: int):
        rows = _TableService(self.path, self.upto + 1)._rows("", low - 3, high + 2)  # some servers give neighbours too
        for r in rows:
            yield r["n"], ["\\Seen"], f"Subject: {r['id']}\n\nto {r['n']}".encode()


@query("SELECT CAST(v AS BIGINT) AS validity, c_custkey, 'to ' || (c_custkey + 1) AS body FROM customer, (SELECT unnest([1, 2]) AS v)")
def mailbox_uids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mailbox read by ranges of UIDs in two batches, and from its first message again when its validity has changed."""
    path, rows = shared_folder(spark, "mailbox"), table(spark, sf_dir, "customer")
    _stored(rows.select((F.col("c_custkey") + 1).alias("n"), F.col("c_custkey").alias("id")), f"{path}/rows")
    last = rows.agg(F.max("c_custkey")).first()[0] + 1
    for validity, upto in ((1, last // 2), (1, last), (2, last)):
        held = _TableMailbox(f"{path}/rows", validity, upto)
        spark.dataSource.register(mailbox.mailbox_source("table_mailbox", lambda held=held: held))
        mails = spark.readStream.format("table_mailbox").options(from_zero="true", span=max(10, last // 8)).load()
        to_parquet(mails, f"{path}/mails", f"{path}/checkpoint", once=True).awaitTermination()
    parts = files.mail_parts(spark.read.schema(mails.schema).parquet(f"{path}/mails"), raw="content")
    return parts.select("validity", (F.col("uid") - 1).alias("c_custkey"), F.trim("body").alias("body"))


@query("SELECT sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size, count(*) AS mails FROM conversations WHERE text IS NOT NULL GROUP BY text")
def artifact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attachments stored by their contents, the second time nothing more; each file's rows by its path."""
    path = f"{shared_folder(spark, 'artifacts')}/files"
    rows = table(spark, sf_dir, "conversations").where("text is not null").select("conv_id", F.col("text").cast("binary").alias("attachment"))
    artifacts.store(rows, path)
    named = artifacts.store(rows, path).groupBy(F.regexp_extract("artifact", "([^/]+)$", 1).alias("sha256")).agg(F.count("*").alias("mails"))
    held = artifacts.artifacts(spark, path).where(F.sha2("content", 256) == F.col("sha256")).select("sha256", F.col("length").alias("size"))
    return held.join(named, "sha256")


@query("""
SELECT c_custkey, c_name AS message, CASE WHEN c_custkey % 4 < 2 THEN CAST(c_nationkey AS BIGINT) ELSE -1 END AS thread, c_custkey % 4 > 1 AS misfit,
  CASE WHEN c_custkey % 4 < 2 THEN CAST(c_custkey + 1 AS BIGINT) ELSE -1 END AS frame FROM customer
""")
def typed_log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a log's known shape; in every other pair of them a thread has a text for its number and a frame a fraction, which makes them misfits."""
    of = F.col("c_custkey") % 4
    frames = F.struct(F.array(F.struct(F.when(of < 2, (F.col("c_custkey") + 1).cast("string")).otherwise("1.5").alias("imageOffset"), F.lit("u").alias("imageUUID"))).alias("frames"))
    record = F.to_json(F.struct(F.col("c_name").alias("eventMessage"), F.when(of < 2, F.col("c_nationkey").cast("string")).otherwise("none").alias("threadID"), frames.alias("backtrace"), F.lit(1).alias("unknown")))
    plain = F.regexp_replace(F.regexp_replace(record, '"threadID":"(\\d+)"', '"threadID":$1'), '"imageOffset":"([\\d.]+)"', '"imageOffset":$1')
    rows = table(spark, sf_dir, "customer").select("c_custkey", typed.typed(plain, typed.UNIFIED_LOG).alias("r"))
    offset = F.col("r.backtrace.frames")[0]["imageOffset"]
    return rows.select("c_custkey", F.col("r.eventMessage").alias("message"), F.coalesce("r.threadID", F.lit(-1)).alias("thread"), F.col("r._misfit").isNotNull().alias("misfit"), F.coalesce(offset, F.lit(-1)).alias("frame"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 > 0 THEN s_name END AS name, CASE WHEN s_suppkey % 5 > 0 THEN '[' || s_nationkey || ',' || (s_nationkey + 1) || ']' END AS items, CASE WHEN s_suppkey % 5 > 0 THEN 4 ELSE -1 END AS members FROM supplier")
def xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole XML records: attributes, repeated and empty elements; broken ones are null."""
    record = F.concat(F.lit("<Event Kind='k'><Data Name='n'>"), "s_name", F.lit("</Data><Item>"), "s_nationkey", F.lit("</Item><Item>"), F.col("s_nationkey") + 1, F.lit("</Item><Empty/>"), F.when(F.col("s_suppkey") % 5 > 0, "</Event>").otherwise("</Even>"))
    v = typed.xml_record(record)
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", v.alias("v"))
    return rows.select("s_suppkey", field(F.col("v"), "Data/_VALUE").alias("name"), F.try_variant_get(F.col("v"), "$.Item", "variant").cast("string").alias("items"), F.when(F.col("v").isNotNull(), F.size(keys(F.col("v")))).otherwise(-1).cast("int").alias("members"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 > 0 THEN 1700000000 + c_custkey ELSE -1 END AS expires FROM customer")
def token_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When JSON web tokens end; broken ones don't say."""
    part = lambda c: F.translate(F.regexp_replace(F.base64(c.cast("binary")), r"[=\r\n]", ""), "+/", "-_")
    payload = F.concat(F.lit('{"sub":"'), "c_name", F.lit('","exp":'), F.col("c_custkey") + 1_700_000_000, F.lit("}"))
    token = F.concat(part(F.lit('{"alg":"none"}')), F.lit("."), part(payload), F.when(F.col("c_custkey") % 7 > 0, ".").otherwise(""))
    return table(spark, sf_dir, "customer").select("c_custkey", F.coalesce(F.unix_seconds(jwt_expiry(token)), F.lit(-1)).alias("expires"))


@query("SELECT c_custkey, lower(c_name) AS mailbox FROM customer")
def mailbox_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", address(F.concat(F.lit("  "), F.upper("c_name"), F.lit(" "))).alias("mailbox"))


@query("SELECT c_custkey, 'start' AS action FROM (SELECT c_custkey FROM customer WHERE c_acctbal > 0 EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def reconcile_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing that broke off starts what is new and stops nothing."""
    desired = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    active = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    start, stop = feeds.reconcile(active, desired, ["c_custkey"], complete=False)
    return start.withColumn("action", F.lit("start")).unionByName(stop.withColumn("action", F.lit("stop")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
