"""A polite client for the fetch step, which runs on the driver before any data is read."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable


class FetchError(RuntimeError):
    pass


class PoliteClient:
    """At most one request in `pause` seconds; 429 and 5xx are tried again after a growing wait."""

    def __init__(self, transport: Callable[[str], tuple[int, bytes]] | None = None, pause: float = 1.0, retries: int = 5, longest: float = 60.0, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.transport, self.pause, self.retries, self.longest, self.sleep, self.clock = transport or self._get, pause, retries, longest, sleep, clock
        self.last: float | None = None

    @staticmethod
    def _get(url: str) -> tuple[int, bytes]:
        try:
            with urllib.request.urlopen(url, timeout=30) as answer:
                return answer.status, answer.read()
        except urllib.error.HTTPError as wrong:
            return wrong.code, b""

    def get(self, url: str) -> bytes:
        for attempt in range(self.retries + 1):
            if self.last is not None and (wait := self.pause - (self.clock() - self.last)) > 0:
                self.sleep(wait)
            self.last = self.clock()
            status, body = self.transport(url)
            if status == 200:
                return body
            if status != 429 and status < 500:
                raise FetchError(f"{url}: status {status}")
            if attempt < self.retries:
                self.sleep(min(self.longest, 2.0**attempt))
        raise FetchError(f"{url}: no answer after {self.retries + 1} tries")
