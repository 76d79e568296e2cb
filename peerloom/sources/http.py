"""Fetching with retries. The opener is passed in, so that nothing here needs a network to be tested."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

#: opener(url) -> (status, headers, body).
Opener = Callable[[str], tuple[int, dict[str, str], bytes]]


@dataclass
class Fetcher:
    """fetch(url) gives the body, null for 404 where that is tolerated, and raises what stays wrong.

    Too many requests wait as long as the answer says, else 2^n seconds up to longest; other client errors fail at once
    unless retry_client; everything else is tried again after 1+n seconds. requests counts by host."""

    opener: Opener
    tries: int = 5
    longest: float = 30
    delay: float = 0
    retry_client: bool = False
    sleep: Callable[[float], None] = time.sleep
    requests: dict[str, int] = field(default_factory=dict)

    def fetch(self, url: str, missing_ok: bool = True) -> bytes | None:
        host = url.split("/")[2] if "//" in url else ""
        problem: Exception = RuntimeError("no try was made")
        for n in range(self.tries):
            self.requests[host] = self.requests.get(host, 0) + 1
            wait = 1.0 + n
            try:
                status, headers, body = self.opener(url)
            except OSError as e:
                problem = e
            else:
                if status < 400:
                    if self.delay:
                        self.sleep(self.delay)
                    return body
                problem = RuntimeError(f"{url}: status {status}")
                if status == 404 and missing_ok:
                    return None
                if status == 429:
                    told = headers.get("Retry-After", "")
                    wait = float(told) if told.isdigit() else min(self.longest, 2.0**n)
                elif status < 500 and not self.retry_client:
                    raise problem
            if n + 1 < self.tries:
                self.sleep(wait)
        raise problem
