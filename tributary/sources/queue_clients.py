"""Queues of two public services, by their HTTP interfaces."""

from __future__ import annotations

import base64
import datetime
import hashlib
import hmac
import json
import urllib.parse
import urllib.request
from collections.abc import Callable
from typing import Any

from .http import send
from .queues import Message
from .retry import persistently
from .tokens import authorised


def signed(method: str, url: str, headers: dict[str, str], content: bytes, key: str, secret: str, region: str, service: str, at: datetime.datetime) -> dict[str, str]:
    """The headers with those of signature version 4: time and authorization."""
    place, day = urllib.parse.urlsplit(url), at.strftime("%Y%m%d")
    headers = headers | {"host": place.netloc, "x-amz-date": at.strftime("%Y%m%dT%H%M%SZ")}
    own = sorted((k.lower(), " ".join(v.split())) for k, v in headers.items())
    names = ";".join(k for k, _ in own)
    asked = "&".join(f"{urllib.parse.quote(k, safe='-_.~')}={urllib.parse.quote(v, safe='-_.~')}" for k, v in sorted(urllib.parse.parse_qsl(place.query, keep_blank_values=True)))
    request = "\n".join([method, place.path or "/", asked, *(f"{k}:{v}" for k, v in own), "", names, hashlib.sha256(content).hexdigest()])
    scope = f"{day}/{region}/{service}/aws4_request"
    text = "\n".join(["AWS4-HMAC-SHA256", headers["x-amz-date"], scope, hashlib.sha256(request.encode()).hexdigest()])
    step = f"AWS4{secret}".encode()
    for part in (day, region, service, "aws4_request"):
        step = hmac.digest(step, part.encode(), "sha256")
    proof = hmac.digest(step, text.encode(), "sha256").hex()
    return headers | {"Authorization": f"AWS4-HMAC-SHA256 Credential={key}/{scope}, SignedHeaders={names}, Signature={proof}"}


class SqsQueue:
    """A queue by its address. ``visible_after``: seconds in which a message must be acknowledged."""

    def __init__(self, url: str, region: str, key: str, secret: str, visible_after: int = 600, wait: int = 5):
        self.url, self.region, self.key, self.secret, self.visible_after, self.wait = url, region, key, secret, visible_after, wait

    def _ask(self, action: str, body: dict[str, Any]) -> dict[str, Any]:
        place = urllib.parse.urlsplit(self.url)
        url, content = f"{place.scheme}://{place.netloc}/", json.dumps(body | {"QueueUrl": self.url}).encode()

        def call():
            headers = {"content-type": "application/x-amz-json-1.0", "x-amz-target": f"AmazonSQS.{action}"}
            headers = signed("POST", url, headers, content, self.key, self.secret, self.region, "sqs", datetime.datetime.now(datetime.timezone.utc))
            with urllib.request.urlopen(urllib.request.Request(url, content, headers), timeout=60) as response:
                return json.loads(response.read() or b"{}")

        return persistently(call)

    def receive(self, most: int) -> list[Message]:
        told = self._ask("ReceiveMessage", {"MaxNumberOfMessages": min(10, most), "VisibilityTimeout": self.visible_after, "WaitTimeSeconds": self.wait})
        return [Message(m["MessageId"], m["ReceiptHandle"], m["Body"]) for m in told.get("Messages") or []]

    def acknowledge(self, receipts: list[str]) -> None:
        for at in range(0, len(receipts), 10):
            told = self._ask("DeleteMessageBatch", {"Entries": [{"Id": str(n), "ReceiptHandle": r} for n, r in enumerate(receipts[at : at + 10])]})
            if told.get("Failed"):
                raise RuntimeError(f"{len(told['Failed'])} messages were not deleted: {told['Failed'][0]}")


class PubSubQueue:
    """A subscription (``projects/p/subscriptions/s``); ``headers`` has its token."""

    def __init__(self, subscription: str, headers: Callable[[], dict[str, str]], base: str = "https://pubsub.googleapis.com/v1"):
        self.url, self.headers = f"{base}/{subscription}", headers

    def _ask(self, action: str, body: dict[str, Any]) -> dict[str, Any]:
        return authorised(self.headers, lambda headers: send(f"{self.url}:{action}", body, headers, 60.0))[0] or {}

    def receive(self, most: int) -> list[Message]:
        found = self._ask("pull", {"maxMessages": most}).get("receivedMessages") or []
        return [Message(m["message"]["messageId"], m["ackId"], base64.b64decode(m["message"].get("data", "")).decode("utf-8", "replace")) for m in found]

    def acknowledge(self, receipts: list[str]) -> None:
        self._ask("acknowledge", {"ackIds": receipts})
