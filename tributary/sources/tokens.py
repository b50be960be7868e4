"""Access tokens: fetched where they are needed, kept until shortly before they end, and renewed once when they are refused."""

from __future__ import annotations

import base64
import hashlib
import hmac
import json
import time
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any, TypeVar

from .http import first_at, send
from .retry import Refused, persistently

T = TypeVar("T")


def _part(value: Any) -> str:
    return base64.urlsafe_b64encode(value if isinstance(value, bytes) else json.dumps(value, separators=(",", ":")).encode()).rstrip(b"=").decode()


def signed_jwt(claims: dict[str, Any], secret: str) -> str:
    """A JSON web token, signed by HMAC-SHA256."""
    head = f"{_part({'alg': 'HS256', 'typ': 'JWT'})}.{_part(claims)}"
    return f"{head}.{_part(hmac.digest(secret.encode(), head.encode(), hashlib.sha256))}"


def expiry(token: str) -> float | None:
    """When a JSON web token ends, in seconds since 1970; None for what isn't one or doesn't say."""
    parts = token.split(".")
    if len(parts) != 3:
        return None
    try:
        claims = json.loads(base64.urlsafe_b64decode(parts[1] + "=" * (-len(parts[1]) % 4)))
        return float(claims["exp"])
    except (ValueError, KeyError, TypeError):
        return None


@dataclass(frozen=True)
class ClientCredentials:
    """The OAuth grant of that name: (token, seconds it lasts, if that is told)."""

    url: str
    client: str
    secret: str
    scope: str | None = None

    def __call__(self) -> tuple[str, float | None]:
        own = {"grant_type": "client_credentials", "client_id": self.client, "client_secret": self.secret, **({"scope": self.scope} if self.scope else {})}

        def call():
            request = urllib.request.Request(self.url, urllib.parse.urlencode(own).encode(), {"Content-Type": "application/x-www-form-urlencoded"})
            with urllib.request.urlopen(request, timeout=30) as response:
                return json.loads(response.read())

        told = persistently(call)
        return told["access_token"], told.get("expires_in")


@dataclass(frozen=True)
class PostedToken:
    """A token that a POST of JSON gives: ``body`` may be a function, and the token and its lifetime stand at paths of the answer."""

    url: str
    body: dict[str, Any] | Callable[[], dict[str, Any]]
    token: str = "access_token"
    lasts: str | None = None

    def __call__(self) -> tuple[str, float | None]:
        told = persistently(lambda: send(self.url, self.body() if callable(self.body) else self.body, {}, 30.0))[0]
        token, lasts = first_at(told, (self.token,)), first_at(told, (self.lasts,)) if self.lasts else None
        if not token:
            raise Refused(401, "no token was given")
        return str(token), None if lasts is None else float(lasts)


@dataclass(frozen=True)
class SignedClaims:
    """The body {``member``: a signed token} of a service that trades one for an access token."""

    claims: dict[str, Any]
    secret: str
    member: str = "auth_token"
    lasts: int = 1800

    def __call__(self) -> dict[str, Any]:
        now = int(time.time())
        return {self.member: signed_jwt(self.claims | {"exp": now + self.lasts, "iat": now, "jti": str(uuid.uuid4())}, self.secret)}


class Tokens:
    """Headers with a token, for the clients of this package: each process that asks keeps its own token.

    A token is fetched anew ``margin`` seconds before it ends: by what the service told, else by what the token
    itself says; one that says nothing is kept. ``renew`` drops it, which ``authorised`` does once after a 401.
    """

    def __init__(self, fetch: Callable[[], tuple[str, float | None]], margin: float = 60.0, form: str = "Bearer {token}", header: str = "Authorization", clock: Callable[[], float] = time.time):
        self.fetch, self.margin, self.form, self.header, self.clock = fetch, margin, form, header, clock
        self._token: str | None = None
        self._ends: float | None = None

    def __getstate__(self):
        return self.__dict__ | {"_token": None, "_ends": None}

    def __call__(self) -> dict[str, str]:
        if self._token is None or self._ends is not None and self.clock() >= self._ends - self.margin:
            self._token, lasts = self.fetch()
            self._ends = expiry(self._token) if lasts is None else self.clock() + lasts
        return {self.header: self.form.replace("{token}", self._token)}

    def renew(self) -> None:
        self._token = None


def authorised(headers: Callable[[], dict[str, str]], call: Callable[[dict[str, str]], T]) -> T:
    """The call's result with the headers; if they are refused (401) and can be renewed, it is tried once more."""
    try:
        return persistently(lambda: call(headers()))
    except Refused as refused:
        if refused.status != 401 or not hasattr(headers, "renew"):
            raise
        headers.renew()
        return persistently(lambda: call(headers()))
