"""A path language over JSON text.

A path is a list of steps parted by ``/``; empty steps are dropped.

* a name takes that member of an object; on a list it applies to every element;
* ``[n]`` takes the n-th element of a list, from 0; on an object it is a name;
* ``?`` takes every member of an object or element of a list;
* ``*`` on an object matches the rest of the path there and at any depth below;
  at the end of a path it gives everything below, containers included; on a
  list it takes every element, once.

With ``expand``, a string that steps remain for is read as JSON.

``field`` is for paths of names and ``[n]`` alone, where no list is to be mapped
over: it stays inside the JVM. ``find`` takes the whole language, in Arrow batches.
"""

from __future__ import annotations

import json
from collections import deque
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean_json import loads

#: Kinds of results by name: Spark's type.
KINDS = {"string": "string", "int": "decimal(20,0)", "bool": "boolean", "double": "double", "object": "string", "list": "string", "any": "string"}


def steps(path: str) -> list[str]:
    return [s for s in path.split("/") if s]


def _index(step: str) -> int | None:
    inner = step[1:-1]
    return int(inner) if step[:1] == "[" and step[-1:] == "]" and inner.isdigit() else None


def _everything(value: Any) -> list[Any]:
    """The value, if it is a container, and all below it."""
    out, todo = [], [value]
    while todo:
        v = todo.pop()
        out.append(v)
        todo += reversed(list(v.values()) if isinstance(v, dict) else v if isinstance(v, list) else [])
    return out


def matches(value: Any, path: list[str], expand: bool = False, lists_take_wildcards: bool = True) -> list[Any]:
    """All values that the path reaches; in no particular order."""
    front = [(value, False)]
    for step in path:
        reached: list[tuple[Any, bool]] = []
        todo = deque(front)
        while todo:
            v, deep = todo.popleft()
            if expand and isinstance(v, str):
                try:
                    v = json.loads(v)
                except ValueError:
                    continue
            if isinstance(v, dict):
                if step == "*":
                    reached.append((v, True))
                elif step == "?":
                    reached += [(child, False) for child in v.values()]
                elif step in v:
                    reached.append((v[step], False))
                if deep:
                    todo += [(child, True) for child in v.values()]
            elif isinstance(v, list):
                if step[:1] == "[" and step[-1:] == "]":
                    n = _index(step)
                    if n is not None and n < len(v):
                        reached.append((v[n], deep))
                elif step in ("*", "?") and lists_take_wildcards:
                    reached += [(child, deep) for child in v]
                else:
                    todo += [(child, deep) for child in v]
        front = reached
    return [x for v, deep in front for x in (_everything(v) if deep else [v])]


def _as_kind(value: Any, kind: str) -> tuple[bool, Any]:
    """Whether the value is of that kind, and its form in a result. Nothing is cast."""
    if kind == "any":
        return True, json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    if kind in ("object", "list"):
        return isinstance(value, dict if kind == "object" else list), json.dumps(value, ensure_ascii=False, separators=(",", ":")) if isinstance(value, (dict, list)) else None
    if kind == "bool":
        return isinstance(value, bool), value
    if kind == "int":
        return isinstance(value, int) and not isinstance(value, bool), value
    if kind == "double":
        return isinstance(value, float), value
    return isinstance(value, str), value


def find(text: Column | str, path: str, kind: str = "string", expand: bool = False) -> Column:
    """An array of the values of ``kind`` that the path reaches in a JSON text.

    ``any``, ``object`` and ``list`` give JSON text. Null and malformed texts
    give null; a path that reaches nothing gives an empty array.
    """
    wanted = steps(path)

    def evaluate(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            root = loads(t) if t is not None else None
            if root is None:
                out.append(None)
                continue
            held = [_as_kind(v, kind) for v in matches(root, wanted, expand)]
            out.append([v if kind != "int" else _decimal(v) for ok, v in held if ok])
        return pd.Series(out, dtype=object)

    return F.pandas_udf(evaluate, f"array<{KINDS[kind]}>")(text)


def _decimal(value: int):
    from decimal import Decimal

    return Decimal(value)


def find_one(text: Column | str, path: str, kind: str = "string", expand: bool = False) -> Column:
    """The first value of ``find``; null if there is none, so that absent differs from zero."""
    return F.try_element_at(find(text, path, kind, expand), F.lit(1))


def find_first(text: Column | str, wanted: dict[str, tuple[str, str]]) -> Column:
    """A struct of first values: ``wanted`` names a path and a kind each. A text is read once for all of them."""
    own = {name: (steps(path), kind) for name, (path, kind) in wanted.items()}

    def first(root: Any, path: list[str], kind: str):
        for v in matches(root, path):
            ok, held = _as_kind(v, kind)
            if ok:
                return _decimal(held) if kind == "int" else held
        return None

    def evaluate(texts: pd.Series) -> pd.DataFrame:
        roots = [None if t is None else loads(t) for t in texts]
        return pd.DataFrame({name: pd.Series([None if r is None else first(r, *of) for r in roots], dtype=object) for name, of in own.items()})

    return F.pandas_udf(evaluate, ", ".join(f"`{name}` {KINDS[kind]}" for name, (_, kind) in own.items()))(text)


def has(text: Column | str, path: str) -> Column:
    """Whether the path reaches anything. An empty path always does; lists don't take up ``*`` and ``?`` here."""
    wanted = steps(path)

    def present(texts: pd.Series) -> pd.Series:
        return pd.Series([t is not None and (root := loads(t)) is not None and (not wanted or bool(matches(root, wanted, lists_take_wildcards=False))) for t in texts], dtype=bool)

    return F.pandas_udf(present, "boolean")(text)


def _variant_path(path: str) -> str:
    out = "$"
    for step in steps(path):
        n = _index(step)
        if step in ("*", "?"):
            raise ValueError(f"{path!r}: wildcards need find()")
        out += f"[{n}]" if n is not None else "['" + step.replace("\\", "\\\\").replace("'", "\\'") + "']"
    return out


def field(variant: Column, path: str, kind: str = "string") -> Column:
    """The value at a plain path of a VARIANT column if it has that kind, else null; inside the JVM.

    Nothing is cast: a text of digits is no int. ``any`` gives a VARIANT.
    """
    value = F.try_variant_get(variant, _variant_path(path), "variant")
    if kind == "any":
        return value
    shape = F.schema_of_variant(value)
    of = {
        "string": (shape == "STRING", "string"),
        "int": (shape.isin("BIGINT") | shape.rlike(r"^DECIMAL\(\d+,0\)$"), "decimal(20,0)"),
        "bool": (shape == "BOOLEAN", "boolean"),
        "double": (shape.isin("DOUBLE", "FLOAT") | shape.rlike(r"^DECIMAL\(\d+,[1-9]\d*\)$"), "double"),
        "object": (shape.startswith("OBJECT"), "map<string,variant>"),
        "list": (shape.startswith("ARRAY"), "array<variant>"),
    }[kind]
    return F.when(of[0], F.try_variant_get(value, "$", of[1]))


def keys(variant: Column) -> Column:
    """The member names of an object."""
    return F.map_keys(field(variant, "", "object"))


def values(variant: Column) -> Column:
    """The members of an object, as VARIANT."""
    return F.map_values(field(variant, "", "object"))
