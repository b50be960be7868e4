"""Text functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def brace_balance(line: Column) -> Column:
    """Opening less closing braces, those inside strings counted too."""
    return (F.length(F.regexp_replace(line, r"[^{]", "")) - F.length(F.regexp_replace(line, r"[^}]", ""))).cast("long")


def address(mailbox: Column) -> Column:
    """A mailbox's one spelling: trimmed and in lower case."""
    return F.lower(F.trim(mailbox))


def url_decoded(key: Column) -> Column:
    """An object key without its URL escapes; null where they are broken."""
    return F.try_url_decode(key)


def composite_key(*parts: Column, separator: str = "|") -> Column:
    """One key of several parts; nulls are skipped."""
    return F.concat_ws(separator, *[p.cast("string") for p in parts])


def content_hash(text: Column) -> Column:
    """SHA-256 of a text's UTF-8 bytes, in hexadecimal. The raw text is hashed: VARIANT changes how numbers are spelt."""
    return F.sha2(text.cast("binary"), 256)


def named_groups(line: Column, pattern: str) -> Column:
    """A struct of the named groups of the first match, each null without a match.

    Both ``(?P<name>...)`` and ``(?<name>...)`` are taken.
    """
    java = pattern.replace("(?P<", "(?<")
    plain = re.sub(r"\\.|\[(?:\\.|[^\]\\])*\]", lambda m: "x" * len(m.group()), java)  # escapes and classes hold no groups
    names, groups = [], 0
    for m in re.finditer(r"\((?!\?)|\(\?<([A-Za-z]\w*)>", plain):
        groups += 1
        if m.group(1):
            names.append((m.group(1), groups))
    if not names:
        raise ValueError(f"{pattern!r} has no named group")
    matched = F.regexp_like(line, F.lit(java))
    return F.struct(*[F.when(matched, F.regexp_extract(line, java, n)).alias(name) for name, n in names])


def jwt_expiry(token: Column) -> Column:
    """The time at which a JSON web token ends, by its payload; null for what isn't one. The signature isn't checked."""
    part = F.regexp_extract(token, r"^[\w-]+\.([\w-]+)\.[\w-]*$", 1)
    padded = F.rpad(F.translate(part, "-_", "+/"), (F.ceil(F.length(part) / 4) * 4).cast("int"), F.lit("="))
    payload = F.try_to_binary(padded, F.lit("base64")).cast("string")
    return F.timestamp_seconds(F.get_json_object(payload, "$.exp").try_cast("long"))


def pod_of(path: Column) -> Column:
    """(namespace, pod_name, pod_id, container_name) of a pod log's path; null if it isn't one."""
    parts = [F.regexp_extract(path, r".*/([^/]+)_([^/]+)_([^/]+)/([^/]+)/[^/]+\.log$", n) for n in (1, 2, 3, 4)]
    names = ("namespace", "pod_name", "pod_id", "container_name")
    return F.when(F.length(parts[0]) > 0, F.struct(*[p.alias(n) for p, n in zip(parts, names)]))


def xml_value(document: Column, xpath: str) -> Column:
    """The text at an XPath of an XML document; null where the document is broken or has none."""
    return F.nullif(F.xpath_string(F.when(F.regexp_like(F.trim(document), F.lit("(?s)^<.*>$")), document), F.lit(xpath)), F.lit(""))
