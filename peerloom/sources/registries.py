"""Lookups in registries: an address for each namespace, asked through the retrying fetcher, for cache.fetch_missing."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

from .http import Fetcher, Opener


def asker(opener: Opener, addresses: dict[str, str], tries: int = 3, delay: float = 0.05, **options) -> Callable[[str, str], str | None]:
    """fetch(namespace, key): the text at the namespace's address, in which {key} stands for the encoded key.

    Null for what is not there; what stays wrong is raised, and fetch_missing makes a row of it. Each worker has its own
    fetcher, so waits hold back one partition only."""
    fetcher = Fetcher(opener, tries=tries, delay=delay, **options)

    def fetch(namespace: str, key: str) -> str | None:
        body = fetcher.fetch(addresses[namespace].replace("{key}", quote(key, safe="")))
        return None if body is None else body.decode("utf-8")

    return fetch
