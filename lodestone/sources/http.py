"""Records over HTTP, cache first. Runs on the driver: what is fetched are small curated records, then read with Spark."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from pathlib import Path

from .sinks import canonical_json, write_if_changed

TRIES, TIMEOUT = 4, 30.0


def batched(items: Iterable, size: int = 50) -> Iterator[list]:
    it = iter(items)
    while part := list(islice(it, size)):
        yield part


def get_json(url: str, opener: Callable = urllib.request.urlopen, tries: int = TRIES, pause: Callable[[float], None] = time.sleep) -> dict:
    """GET with retries on 429, 5xx and network errors: as long as Retry-After says, else twice as long each time."""
    for k in range(tries):
        try:
            with opener(url, timeout=TIMEOUT) as answer:
                return json.load(answer)
        except urllib.error.HTTPError as e:
            if k + 1 == tries or not (e.code == 429 or e.code >= 500):
                raise
            wait = e.headers.get("Retry-After") if e.headers else None
            pause(float(wait) if wait and wait.isdigit() else 2.0**k)
        except (urllib.error.URLError, TimeoutError):
            if k + 1 == tries:
                raise
            pause(2.0**k)
    raise AssertionError


def harvest(urls: dict[str, str], cache: Path, get: Callable[[str], dict] = get_json, drop: tuple[str, ...] = ("stats",)) -> tuple[list[str], list[str]]:
    """Fetch what isn't cached, one file a record without its volatile fields; returns (records that are gone, records to try again).

    An answer of 4xx is remembered, so it isn't asked for again; a network error never is.
    """
    gone, again = [], []
    for name, url in sorted(urls.items()):
        path, missing = Path(cache) / f"{name}.json", Path(cache) / f"{name}.missing"
        if path.is_file():
            continue
        if missing.is_file():
            gone.append(name)
            continue
        try:
            record = {k: v for k, v in get(url).items() if k not in drop}
            write_if_changed(path, canonical_json(record).encode())
        except urllib.error.HTTPError as e:
            if 400 <= e.code < 500 and e.code != 429:
                write_if_changed(missing, str(e.code).encode())
                gone.append(name)
            else:
                again.append(name)
        except OSError:
            again.append(name)
    return gone, again


def answers(path: Path, terms: list[str]) -> dict | None:
    """A cached search answer, if it was asked with the same terms."""
    held = json.loads(Path(path).read_text()) if Path(path).is_file() else None
    return held["answers"] if held and held.get("terms") == terms else None
