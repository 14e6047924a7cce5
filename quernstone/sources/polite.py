"""A polite HTTP client for the driver: waits between requests, backs off, gives up with a reason.

The transport and the clock are passed in, so it runs without a network in tests.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import urlsplit

Transport = Callable[[str], tuple[int, dict[str, str], bytes]]


class GaveUp(Exception):
    def __init__(self, url: str, status: int, wait: float):
        super().__init__(f"{url}: status {status}, {wait:.0f} s asked for")
        self.url, self.status, self.wait = url, status, wait


@dataclass
class PoliteClient:
    """429 honours Retry-After up to `longest`, else waits double; a host that asked for patience is slower from then on."""

    transport: Transport
    delay: float = 1.0
    tries: int = 4
    longest: float = 120.0
    slower: float = 1.5
    slowest: float = 45.0
    sleep: Callable[[float], None] = time.sleep
    delays: dict[str, float] = field(default_factory=dict)

    def get(self, url: str) -> bytes:
        host = urlsplit(url).netloc
        wait = self.delays.setdefault(host, self.delay)
        back = wait
        for attempt in range(self.tries):
            self.sleep(back if attempt else wait)
            status, headers, body = self.transport(url)
            if status < 400:
                return body
            if status == 429:
                self.delays[host] = min(self.delays[host] * self.slower, self.slowest)
                asked = headers.get("Retry-After", "")
                back = float(asked) if asked.isdigit() else back * 2
                if back > self.longest:
                    raise GaveUp(url, status, back)
            elif status >= 500:
                back *= 2
            else:
                raise GaveUp(url, status, 0)
        raise GaveUp(url, status, back)


def fetch_shards(urls: list[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    """host, urls: one list a host, fetched in order within it; the longest first."""
    shards: dict[str, list[str]] = {}
    for host, url in urls:
        shards.setdefault(host, []).append(url)
    return sorted(shards.items(), key=lambda kv: (-len(kv[1]), kv[0]))
