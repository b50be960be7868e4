"""Services that answer a query by a task: it is submitted, waited for, and its result read in pages."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

from .http import send, written
from .paged import Page
from .retry import Refused
from .tokens import authorised

# The service's paths.
QUERY_PATH, RETRIEVE_PATH = "/app/laas-logs-api/api/logs_query", "/app/laas-logs-api/api/logs_query/retrieve"


class TaskClient:
    """A ``paged.Client`` of log queries that run as tasks; each feed is one of the service's products.

    A page's cursor is its task and token, and how many records came before it.
    A result of ``most`` records may have been cut, which is an error: shorter
    slices are wanted then. A task that the service cancels, as it does for a product that isn't
    set up, is a refusal of that feed alone (``skip_forbidden`` leaves it out); one
    that isn't ready in ``patience`` seconds fails the slice, which Spark tries again.
    """

    def __init__(self, base: str, headers: Callable[[], dict[str, str]] = dict, condition: str | None = None, size: int = 1000, most: int = 1_000_000, patience: float = 600.0, wait: float = 2.0):
        self.base, self.headers, self.condition, self.size, self.most = base, headers, condition, size, most
        self.patience, self.wait = patience, wait

    def _ask(self, path: str, body: dict[str, Any] | None = None) -> dict[str, Any]:
        answer, _ = authorised(self.headers, lambda headers: send(self.base + path, body, headers, 60.0))
        return answer.get("data") or {}

    def _submitted(self, feed: str, since: int, until: int) -> str:
        frame = {"startTime": written(since, "iso"), "endTime": written(until, "iso")}
        own = {} if self.condition is None else {"filter": self.condition}
        return self._ask(QUERY_PATH, {"cloudService": feed, "timeframe": frame, "pageLimit": self.size, "limit": self.most, **own})["taskId"]

    def _first_page(self, task: str) -> str | None:
        """The token of the first page of a task's result, None for an empty one; waits until the task has ended."""
        end = time.monotonic() + self.patience
        while True:
            told = self._ask(f"{QUERY_PATH}/{task}")
            state = told.get("state")
            if state == "Canceled":
                raise Refused(403, f"task {task} was cancelled: {told.get('errors') or 'no reason given'}")
            if state in ("Ready", "Done"):
                return next((t for t in told.get("pageTokens") or [] if t), None) if state == "Ready" else None
            if time.monotonic() > end:
                raise TimeoutError(f"task {task} is in state {state!r} after {self.patience} s")
            time.sleep(self.wait)

    def fetch(self, feed: str, since: int, until: int, cursor: Any) -> Page:
        if cursor is None:
            task = self._submitted(feed, since, until)
            cursor = [task, self._first_page(task), 0]
        task, token, before = cursor
        if token is None:
            return Page([])
        told = self._ask(RETRIEVE_PATH, {"taskId": task, "pageToken": token})
        records, after = told.get("records") or [], told.get("nextPageToken")
        read = before + len(records)
        if after not in (None, "", "NULL"):
            return Page(records, [task, after, read])
        if read >= self.most:
            raise RuntimeError(f"{feed}: {read} records from {since} to {until}, where no more than {self.most} are given")
        return Page(records)
