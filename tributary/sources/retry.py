"""Which failures of a request pass by themselves, and how long to wait for that."""

from __future__ import annotations

import random
import time
import urllib.error
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")


class Refused(Exception):
    """The service refuses the credentials (401) or this feed (403)."""

    def __init__(self, status: int, reason: str = ""):
        super().__init__(f"refused with status {status}" + (f": {reason}" if reason else ""))
        self.status = status
        self.stops_all = status == 401


class Busy(Exception):
    """A service's answer says that it should be asked again later."""


def passes_by(status: int | None) -> bool:
    """Of a status, or None for a failed connection."""
    return status is None or status == 429 or status >= 500


def delay(attempt: int, base: float = 1.0, most: float = 60.0, retry_after: float | None = None, spread: float = 0.2) -> float:
    """Seconds before the next attempt: what the service asks for, else doubled each time, with some chance to part clients."""
    wait = min(most, base * 2**attempt) if retry_after is None else retry_after
    return wait * (1 + random.uniform(-spread, spread)) if retry_after is None else wait


def persistently(call: Callable[[], T], attempts: int = 5, base: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """The call's result, after failures that pass by; others are raised at once."""
    for attempt in range(attempts):
        try:
            return call()
        except urllib.error.HTTPError as error:
            if error.code in (401, 403):
                raise Refused(error.code) from error
            if not passes_by(error.code) or attempt + 1 == attempts:
                raise
            after = error.headers.get("Retry-After") if error.headers else None
            sleep(delay(attempt, base, retry_after=float(after) if after and after.isdigit() else None))
        except (Busy, urllib.error.URLError, TimeoutError, ConnectionError):
            if attempt + 1 == attempts:
                raise
            sleep(delay(attempt, base))
    raise ValueError("attempts must be 1 or more")
