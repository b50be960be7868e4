"""Conditions of a query in the languages of services.

Spark offers a source the conditions on its columns. Those that a service's
language has are sent with the requests, and Spark holds all conditions against the
records again: what is sent only has to leave out nothing that Spark would keep. So
a condition is sent only if that is sure: negations not where the service may
ignore case, orders only of numbers and times, and null checks only for what
is missing.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql.datasource import EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringStartsWith

#: (attribute, predicate, value): by the names of ``operators.predicates``; ``in`` with a list; ``atLeast`` and ``atMost`` of numbers, ``from`` and ``upto`` of times.
Test = tuple[str, str, Any]


def _written(value: Any, up: bool = False) -> str:
    """A value as services take it; a time by milliseconds, rounded down, or ``up``."""
    if isinstance(value, datetime.datetime):
        at = value if value.tzinfo else value.replace(tzinfo=datetime.timezone.utc)
        micros = (at - datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)) // datetime.timedelta(microseconds=1)
        ms = -(-micros // 1000) if up else micros // 1000
        return (datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=ms)).isoformat(timespec="milliseconds") + "Z"
    return str(value)


def tests_of(filters: Iterable[Filter], columns: dict[str, tuple[str, str]], exact: bool = False) -> list[Test]:
    """The conditions that may be sent. ``columns``: name to (the service's attribute, kind). ``exact``: the service tells cases apart."""
    out: list[Test] = []
    for f in filters:
        inner, no = (f.child, True) if isinstance(f, Not) else (f, False)
        if len(getattr(inner, "attribute", ())) != 1 or inner.attribute[0] not in columns:
            continue
        attribute, kind = columns[inner.attribute[0]]
        ordered = kind in ("long", "double", "timestamp")
        value = getattr(inner, "value", None)
        if no:
            if exact and kind == "string" and isinstance(inner, (EqualTo, StringContains)):
                out.append((attribute, "isNot" if isinstance(inner, EqualTo) else "notContains", value))
        elif isinstance(inner, EqualTo) and kind != "timestamp":
            out.append((attribute, "is", value))
        elif isinstance(inner, In) and kind == "string" and all(v is not None for v in inner.value):
            out.append((attribute, "in", list(inner.value)))
        elif isinstance(inner, StringContains):
            out.append((attribute, "contains", value))
        elif isinstance(inner, StringStartsWith):
            out.append((attribute, "startsWith", value))
        elif isinstance(inner, IsNull):
            out.append((attribute, "isEmpty", None))
        elif ordered and isinstance(inner, GreaterThan) and kind != "timestamp":
            out.append((attribute, "greaterThan", value))
        elif ordered and isinstance(inner, GreaterThanOrEqual) and kind != "timestamp":
            out.append((attribute, "atLeast", value))
        elif ordered and isinstance(inner, (GreaterThan, GreaterThanOrEqual)):
            out.append((attribute, "from", _written(value)))
        elif ordered and isinstance(inner, LessThan) and kind != "timestamp":
            out.append((attribute, "lessThan", value))
        elif ordered and isinstance(inner, LessThanOrEqual) and kind != "timestamp":
            out.append((attribute, "atMost", value))
        elif ordered and isinstance(inner, (LessThan, LessThanOrEqual)):
            out.append((attribute, "upto", _written(value, up=True)))
    return out


def _odata(test: Test) -> str | None:
    name, op, value = test
    spelled = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) and op not in ("from", "upto") else json.dumps(v) if isinstance(v, bool) else str(v)
    if op == "in":
        return "(" + " or ".join(f"{name} eq {spelled(v)}" for v in value) + ")" if value else None
    if op in ("contains", "startsWith"):
        return f"{op.lower()}({name},{spelled(value)})"
    sign = {"is": "eq", "isNot": "ne", "greaterThan": "gt", "lessThan": "lt", "atLeast": "ge", "atMost": "le", "from": "ge", "upto": "le"}.get(op)
    return f"{name} eq null" if op == "isEmpty" else f"{name} {sign} {spelled(value)}" if sign else None


def _encoded(test: Test) -> str | None:
    name, op, value = test
    spelled = lambda v: str(v).replace("^", "^^")
    if op == "in":
        return None if not value or any("," in v for v in value) else f"{name}IN{','.join(map(spelled, value))}"
    if op == "isEmpty":
        return f"{name}ISEMPTY"
    if op in ("from", "upto"):  # times without a zone, in whole seconds; a second more at the upper end
        at = datetime.datetime.fromisoformat(value[:-1])
        at = at.replace(microsecond=0) + datetime.timedelta(seconds=bool(at.microsecond) if op == "upto" else 0)
        return f"{name}{'>=' if op == 'from' else '<='}{at}"
    sign = {"is": "=", "isNot": "!=", "contains": "LIKE", "notContains": "NOT LIKE", "startsWith": "STARTSWITH", "greaterThan": ">", "lessThan": "<", "atLeast": ">=", "atMost": "<="}[op]
    return f"{name}{sign}{spelled(value)}" if value != "" else None


def _extended(test: Test) -> dict[str, Any] | None:
    name, op, value = test
    if op in ("in", "atLeast", "atMost"):
        return None
    # this service has no "or equal": the bound before it, by the millisecond
    if op in ("from", "upto"):
        at = datetime.datetime.fromisoformat(value[:-1]) + datetime.timedelta(milliseconds=-1 if op == "from" else 1)
        op, value = "greaterThan" if op == "from" else "lessThan", at.isoformat(timespec="milliseconds") + "Z"
    return {"saasAttrName": name, "saasAttrOp": op, "saasAttrValue": "" if value is None else str(value)}


def _member(test: Test) -> tuple[str, Any] | None:
    return (test[0], test[2]) if test[1] == "is" else None


#: How a condition is written in each language (None: it can't be).
LANGUAGES: dict[str, Callable[[Test], Any]] = {"odata": _odata, "encoded": _encoded, "extended": _extended, "members": _member}


def written(tests: Iterable[Test], language: str) -> list[Any]:
    """The conditions in a service's language; those that it lacks are left to Spark."""
    return [w for t in tests if (w := LANGUAGES[language](t)) is not None]
