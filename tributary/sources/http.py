"""Paged HTTP APIs by description: one client for feeds that differ in names alone."""

from __future__ import annotations

import datetime
import json
import re
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from ..functions.json_path import matches, steps
from .paged import Feed, Page
from .pushdown import Test
from .pushdown import written as conditions
from .retry import Busy


@dataclass(frozen=True)
class Request:
    """How a feed is asked for and how its responses are read.

    ``paging``: ``none``; ``offset`` and ``page`` count by themselves until a
    page is short; ``cursor`` takes the next cursor from ``following``, a path
    in the response; ``url`` takes the next page's address from there; ``link``
    from the response's Link header.

    ``filter``: a parameter and its text, in which ``{since}`` and ``{until}``
    stand for the bounds. ``since`` and ``until`` may name one parameter, which
    is then given twice. With ``body`` the request is a POST of JSON: the fixed
    members there and all parameters, each at its path of names parted by ``/``.
    ``detail``: an address with ``{member}`` of a record; the record is replaced by
    what is found there, an object or each object of a list; where nothing is found
    any more (404) the record stays as it was listed. ``listed``: where a listed record
    has the time that the bounds are of, for services that list by another time than
    the records' own; only that one is held against the range then.

    ``open_below``: the service leaves out records at the lower bound itself, so it is
    asked from a unit before. ``ends_empty``: a page without records is the last,
    although it has a cursor. The answer of a body with a ``query`` must have no ``errors``.
    ``conditions``: the language of a query's conditions (``pushdown.LANGUAGES``) and the parameter
    that takes them: before the bounds of ``filter`` if that has the same one.
    """

    url: str
    items: str = ""
    id: tuple[str, ...] = ("id",)
    time: tuple[str, ...] = ()
    since: str | None = None
    until: str | None = None
    bound: str = "iso"  # how times are written: iso, ms, s, sql
    paging: str = "none"
    position: str | None = None
    following: str | None = None
    size: tuple[str, int] | None = None
    fixed: dict[str, str] = field(default_factory=dict)
    filter: tuple[str, str] | None = None
    body: dict[str, Any] | None = None
    detail: str | None = None
    newest_first: bool = False
    listed: tuple[str, ...] = ()
    open_below: bool = False
    ends_empty: bool = False
    conditions: tuple[str, str] | None = None

    @property
    def bounded(self) -> bool:
        """Whether both bounds are sent."""
        return bool(self.since and self.until) or bool(self.filter and "{since}" in self.filter[1] and "{until}" in self.filter[1])


#: Milliseconds of the least time that a form of writing tells apart.
UNITS = {"iso": 1, "ms": 1, "s": 1000, "sql": 1000}


def written(ms: int, form: str, up: bool = False) -> str:
    """A time as services take it. Whole seconds are rounded down, or ``up``, as an upper bound must be that loses nothing."""
    if up:
        ms += -ms % UNITS[form]
    if form == "ms":
        return str(ms)
    if form == "s":
        return str(ms // 1000)
    if form == "sql":
        return datetime.datetime.fromtimestamp(ms // 1000, datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return datetime.datetime.fromtimestamp(ms / 1000, datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.") + f"{ms % 1000:03d}Z"


def read_time(value: Any) -> int | None:
    """Milliseconds of a record's time: ISO text (without a zone: UTC), or seconds or milliseconds as a number or its digits."""
    if isinstance(value, str) and not value.isdigit():
        try:
            at = datetime.datetime.fromisoformat(re.sub(r"(\.\d{6})\d+", r"\1", value.strip()))
        except ValueError:
            return None
        at = at if at.tzinfo else at.replace(tzinfo=datetime.timezone.utc)
        return round(at.timestamp() * 1000)
    if isinstance(value, (int, float, str)) and not isinstance(value, bool) and value != "":
        n = float(value)
        return int(n if n >= 1e11 else n * 1000)
    return None


def first_at(item: Any, paths: tuple[str, ...]) -> Any:
    for p in paths:
        for v in matches(item, steps(p)):
            if v is not None and not isinstance(v, (dict, list)):
                return v
    return None


def filled(text: str, values: dict[str, str]) -> str:
    """A text with the values of the names in braces; braces around other names stay."""
    return re.sub(r"\{(\w+)\}", lambda m: values.get(m[1], m[0]), text)


def placed(body: dict[str, Any], path: str, value: Any) -> None:
    """Sets the member at a path of names and ``[n]``; missing objects and lists are made."""
    names = steps(path)
    for name, after in zip(names, [*names[1:], None]):
        key: Any = int(name[1:-1]) if name[:1] == "[" else name
        if isinstance(key, int):
            body.extend({} for _ in range(key + 1 - len(body)))
        if after is None:
            body[key] = value
        else:
            empty: Any = [] if after[:1] == "[" else {}
            if isinstance(key, str) and key not in body:
                body[key] = empty
            body = body[key]


def send(url: str, body: dict[str, Any] | None, headers: dict[str, str], timeout: float) -> tuple[Any, str | None]:
    """The JSON that an address answers (to a POST of a body, if there is one), and its link to the next page."""
    data = None if body is None else json.dumps(body).encode()
    headers = headers | ({} if body is None else {"Content-Type": "application/json"})
    with urllib.request.urlopen(urllib.request.Request(url, data, headers), timeout=timeout) as response:
        content, link = response.read(), response.headers.get("Link", "")
    found = re.search(r"<([^>]*)>\s*;[^,]*\brel=\"?next\"?", link or "")
    return (json.loads(content) if content.strip() else []), found and found[1]


def without_errors(answer: Any) -> Any:
    """A GraphQL answer, which tells of failures within a response of status 200."""
    if isinstance(answer, dict) and answer.get("errors"):
        told = "; ".join(str(e.get("message", e)) if isinstance(e, dict) else str(e) for e in answer["errors"])
        raise (Busy if "rate limit" in told.lower() else RuntimeError)(told)
    return answer


class HttpClient:
    """A ``paged.Client``. ``headers`` gives a request's headers; ``tokens.Tokens`` among them are renewed once when refused."""

    def __init__(self, requests: dict[str, Request], headers: Callable[[], dict[str, str]] = dict, timeout: float = 60.0, tests: tuple[Test, ...] = ()):
        self.requests, self.headers, self.timeout, self.tests = requests, headers, timeout, tests

    def where(self, tests: list[Test]) -> HttpClient:
        """The same client with conditions that its services are asked to hold records against."""
        return HttpClient(self.requests, self.headers, self.timeout, (*self.tests, *tests))

    def _get(self, url: str, body: dict[str, Any] | None = None) -> tuple[Any, str | None]:
        from .tokens import authorised

        def call(headers):
            answer, link = send(url, body, headers, self.timeout)
            return without_errors(answer) if body and "query" in body else answer, link

        return authorised(self.headers, call)

    def _conditions(self, r: Request, own: list[tuple[str, Any]]) -> list[tuple[str, Any]]:
        """The parameters with the conditions among them."""
        if not r.conditions or not (told := conditions(self.tests, r.conditions[0])):
            return own
        language, place = r.conditions
        if language == "members":
            return [*told, *own]
        value = told if language == "extended" else {"odata": " and ", "encoded": "^"}[language].join(told)
        if isinstance(value, str) and any(name == place for name, _ in own):
            return [(name, {"odata": " and ", "encoded": "^"}[language].join((value, v)) if name == place else v) for name, v in own]
        return [*own, (place, value)]

    def _detailed(self, r: Request, item: dict[str, Any]) -> list[dict[str, Any]]:
        names = re.findall(r"\{(\w+)\}", r.detail or "")
        if any(not isinstance(item.get(n), (str, int)) for n in names):
            return [item]
        # a member that is an address of its own stands alone in ``detail``
        url = str(item[names[0]]) if r.detail == "{" + names[0] + "}" else filled(r.detail, {n: urllib.parse.quote(str(item[n]), safe="") for n in names})
        try:
            found, _ = self._get(url)
        except urllib.error.HTTPError as error:
            if error.code != 404:
                raise
            return [item]
        return [i for i in (found if isinstance(found, list) else [found]) if isinstance(i, dict) and i]

    def asked(self, feed: str, since: int, until: int, cursor: Any) -> tuple[str, dict[str, Any] | None]:
        """The address and the JSON body, if any, of the request for a page."""
        r = self.requests[feed]
        bounds = {"since": written(since - UNITS[r.bound] * r.open_below, r.bound), "until": written(until, r.bound, up=True)}
        own: list[tuple[str, Any]] = list(r.fixed.items())
        own += [(name, bounds[which]) for which, name in (("since", r.since), ("until", r.until)) if name]
        if r.filter:
            own.append((r.filter[0], filled(r.filter[1], bounds)))
        own = self._conditions(r, own)
        if r.size:
            own.append((r.size[0], r.size[1]))
        if r.position and cursor is not None:
            own.append((r.position, cursor))
        if r.paging in ("url", "link") and cursor:
            return str(cursor), None
        if r.body is None:
            return r.url + ("?" + urllib.parse.urlencode(own) if own else ""), None
        body = json.loads(json.dumps(r.body))
        for path, value in own:
            placed(body, path, value)
        return r.url, body

    def fetch(self, feed: str, since: int, until: int, cursor: Any) -> Page:
        r = self.requests[feed]
        url, sent = self.asked(feed, since, until, cursor)
        body, link = self._get(url) if sent is None else self._get(url, sent)
        found = matches(body, steps(r.items)) if r.items else [body]
        given = [i for group in found for i in (group if isinstance(group, list) else [group])]
        items = [i for i in given if isinstance(i, dict) and i]
        following = None
        if r.paging == "link":
            following = link
        elif r.paging in ("cursor", "url"):
            following = next((v for v in matches(body, steps(r.following or "")) if isinstance(v, (str, int)) and v), None)
        elif r.paging in ("offset", "page") and r.size and len(given) >= r.size[1]:
            following = (cursor or 0) + len(given) if r.paging == "offset" else (cursor or 1) + 1
        if r.ends_empty and not given:
            following = None
        if r.listed:
            at = [(i, read_time(first_at(i, r.listed))) for i in items]
            items = [i for i, t in at if t is None or since <= t < until]
        if r.detail:
            items = [d for i in items for d in self._detailed(r, i)]
        return Page(items, following)


def feeds_of(requests: dict[str, Request], **settings: int) -> list[Feed]:
    """Feeds for ``paged_source``, ids and times read as the requests say."""

    def feed(name: str, r: Request) -> Feed:
        return Feed(name, lambda i: None if (v := first_at(i, r.id)) is None else str(v), lambda i: read_time(first_at(i, r.time)), **{"bounded": r.bounded, "newest_first": r.newest_first, "checked": not r.listed, **settings})

    return [feed(name, r) for name, r in requests.items()]
