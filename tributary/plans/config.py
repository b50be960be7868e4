"""Settings: from documents, from ``a.b[0].c=value`` pairs, and from the environment over both."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from typing import Any

_PART = re.compile(r"([^.\[\]]+)((?:\[\d+\])*)")


def converted(text: str, kind: type | None = None) -> Any:
    """A setting's value: of the known kind, else a boolean or an integer if it reads as one, else the text.

    ``0`` and ``1`` are integers.
    """
    if kind is str:
        return text
    if kind is bool:
        return text.strip().lower() in ("1", "t", "true", "yes")
    if kind in (int, float):
        return kind(text)
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    return int(text) if re.fullmatch(r"-?\d{1,18}", text) else text


def _path(name: str) -> list[str | int]:
    out: list[str | int] = []
    for part in name.split("."):
        found = _PART.fullmatch(part)
        if not found:
            raise ValueError(f"{name!r} is no setting's name")
        out.append(found[1])
        out += [int(n) for n in re.findall(r"\d+", found[2])]
    return out


def _plain(node: Any) -> Any:
    """Dicts by number become lists, in order; gaps hold None."""
    if not isinstance(node, dict):
        return node
    if node and all(isinstance(k, int) for k in node):
        return [_plain(node.get(i)) for i in range(max(node) + 1)]
    return {k: _plain(v) for k, v in node.items()}


def parse_pairs(pairs: Iterable[str], kinds: Mapping[str, type] | None = None, prefix: str = "") -> dict[str, Any]:
    """Nested settings from ``name=value`` pairs; those without ``=`` or without the prefix are ignored.

    ``kinds``: types by name without numbers (``a.list.b``).
    """
    root: dict[Any, Any] = {}
    for pair in pairs:
        name, eq, value = pair.partition("=")
        if not eq or not name.startswith(prefix):
            continue
        *way, last = _path(name.removeprefix(prefix))
        node = root
        for step in way:
            node = node.setdefault(step, {})
            if not isinstance(node, dict):
                raise ValueError(f"{name}: {step} already has a value")
        if isinstance(node.get(last), dict):
            raise ValueError(f"{name}: {last} already has members")
        node[last] = converted(value, (kinds or {}).get(re.sub(r"\[\d+\]", "", name.removeprefix(prefix))))
    return _plain(root)


def documents(text: str) -> list[dict[str, Any]]:
    """All documents of a YAML or JSON text, each once. JSON alone is read where YAML isn't installed."""
    try:
        import yaml
    except ImportError:
        decoder, at, out = json.JSONDecoder(), 0, []
        while text[at:].strip():
            at += len(text[at:]) - len(text[at:].lstrip())
            value, at = decoder.raw_decode(text, at)
            out.append(value)
        return out
    return [d for d in yaml.safe_load_all(text) if d]


def dotted(settings: Mapping[str, Any]) -> dict[str, Any]:
    """Names with dots in documents become nested settings."""
    out: dict[str, Any] = {}
    for name, value in settings.items():
        *way, last = name.split(".")
        node = out
        for step in way:
            node = node.setdefault(step, {})
        node[last] = dotted(value) if isinstance(value, Mapping) else value
    return out


def overlaid(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """``base`` with the settings of ``over``, member by member."""
    out = dict(base)
    for name, value in over.items():
        out[name] = overlaid(out[name], value) if isinstance(value, Mapping) and isinstance(out.get(name), Mapping) else value
    return out
