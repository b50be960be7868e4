"""Reading of JSON that keeps integers whole and refuses doubtful numbers.

A number without a dot is an integer and must fit 64 bits, unsigned unless it
has a minus; so ``1e5`` and 2^64 spoil their whole text. A number with a dot is a
double. Text after the first value is ignored, and of repeated names the last
counts.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST, MOST = -(2**63), 2**64 - 1
_STRINGS = r'"(?:[^"\\]|\\.)*"'


def _integer(digits: str) -> int:
    n = int(digits)
    if not LEAST <= n <= MOST:
        raise ValueError(f"{digits} has more than 64 bits")
    return n


def _double(digits: str) -> float:
    if "." not in digits:
        raise ValueError(f"{digits} has an exponent and no dot")
    return float(digits)


def _refuse(name: str) -> Any:
    raise ValueError(f"{name} is no JSON")


_DECODER = json.JSONDecoder(parse_int=_integer, parse_float=_double, parse_constant=_refuse)


def loads(text: str) -> Any | None:
    """The first value of a text; None where it can't be read."""
    try:
        return _DECODER.raw_decode(text.lstrip())[0]
    except (ValueError, RecursionError):
        return None


def is_clean(text: Column) -> Column:
    """Whether all numbers of a JSON text keep the rules; inside the JVM."""
    bare = F.regexp_replace(text, _STRINGS, '""')
    exponents = F.regexp_like(bare, F.lit(r"(?:^|[^\w.])-?\d+[eE]"))
    long = F.regexp_extract_all(bare, F.lit(r"(?:^|[^\w.])(-?\d{19,})(?![\d.eE])"), F.lit(1))
    most, least = F.lit(str(MOST)).cast("decimal(38,0)"), F.lit(str(LEAST)).cast("decimal(38,0)")
    wide = F.exists(long, lambda d: F.coalesce(~F.try_to_number(d, F.lit("S" + "9" * 38)).between(least, most), F.lit(True)))
    return ~exponents & ~wide


def parse(text: Column) -> Column:
    """A VARIANT of the text; null where it is malformed or not clean."""
    return F.when(is_clean(text), F.try_parse_json(text))
