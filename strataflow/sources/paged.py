"""Paged sources that count and fetch (SRC-05..07): an offline snapshot, and the remote API behind one interface."""

from __future__ import annotations

import copy
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date
from typing import Protocol

from pyspark.sql import DataFrame, functions as F

RETRY_CODES = (429, 500, 502, 503, 504)


@dataclass(frozen=True)
class Window:
    """What is asked for: a journal's title and a closed range of days."""

    title: str
    start: date
    end: date

    def query(self) -> str:
        name = self.title.replace('"', '\\"')
        return f'"{name}"[jour] AND ("{self.start}"[Date - Publication] : "{self.end}"[Date - Publication])'


class Source(Protocol):
    """What counts and fetches. ``handle`` is what ``opened`` gave, if the source keeps results between requests.

    A source whose requests are limited has ``lane(n)`` too: a client with an n-th of the rate, for one of n tasks.
    """

    def opened(self, window: Window) -> tuple[int, str | None]: ...

    def page(self, window: Window, at: int, size: int, handle: str | None = None) -> bytes: ...


class Snapshot:
    """A table of records as the source; counts and ranges are pushed into its scan."""

    def __init__(self, records: DataFrame, title: str = "journal", day: str = "day", key: str = "pmid") -> None:
        self.records, self.title, self.day, self.key = records, title, day, key

    def select(self, window: Window) -> DataFrame:
        return self.records.filter((F.col(self.title) == window.title) & F.col(self.day).between(F.lit(window.start), F.lit(window.end)))

    def count(self, window: Window) -> int:
        return self.select(window).count()

    def counts(self, windows: DataFrame) -> DataFrame:
        """``windows`` (title, slice_start, slice_end) with ``records``, the members of each, all in one plan.

        A day's records are counted once and a window sums its days: no record is joined.
        """
        daily = self.records.groupBy(F.col(self.title).alias("title"), F.col(self.day).alias("__day")).agg(F.count("*").alias("__n"))
        days = windows.withColumn("__day", F.explode(F.sequence("slice_start", "slice_end")))
        return days.join(daily, ["title", "__day"], "left").groupBy(*windows.columns).agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("records"))

    def numbered(self, windows: DataFrame) -> DataFrame:
        """Members of all windows (title, slice_start, slice_end, run_id) at once, for planned backfills."""
        days = windows.select("run_id", F.col("title").alias(self.title), F.explode(F.sequence("slice_start", "slice_end")).alias(self.day))
        return self.records.join(days, [self.title, self.day])


class Remote:
    """The public e-utilities API: history queries, rate limit, retries.

    The limit on requests is per client; ``lane`` gives each of several tasks its share. Live calls need a
    network; the transport is a parameter, and tests put a fake in its place.
    """

    BASE = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils"

    def __init__(self, email: str, api_key: str | None = None, timeout: float = 60, retries: int = 5, send: Callable[[str, bytes, float], bytes] | None = None, sleep: Callable[[float], None] = time.sleep) -> None:
        if "@" not in email:
            raise ValueError("the API asks for a contact address")
        self.params = {"email": email, "tool": "strataflow"} | ({"api_key": api_key} if api_key else {})
        self.gap, self.timeout, self.retries, self.sleep = (0.11 if api_key else 0.34), timeout, retries, sleep
        self.send, self.last = send or self._post, 0.0

    @staticmethod
    def _post(url: str, body: bytes, timeout: float) -> bytes:
        with urllib.request.urlopen(urllib.request.Request(url, data=body), timeout=timeout) as got:  # noqa: S310
            return got.read()

    def call(self, endpoint: str, **params: object) -> bytes:
        body = urllib.parse.urlencode(self.params | params).encode()
        for attempt in range(self.retries + 1):
            wait = self.last + self.gap - time.monotonic()
            if wait > 0:
                self.sleep(wait)
            self.last = time.monotonic()
            try:
                return self.send(f"{self.BASE}/{endpoint}", body, self.timeout)
            except urllib.error.URLError as exc:
                if attempt == self.retries or getattr(exc, "code", None) not in (None, *RETRY_CODES):
                    raise
                self.sleep(min(2**attempt, 30))
        raise AssertionError

    def lane(self, lanes: int) -> Remote:
        """A client for one of ``lanes`` tasks that ask at the same time: together they keep to the limit."""
        one = copy.copy(self)
        one.gap = self.gap * lanes
        return one

    def opened(self, window: Window) -> tuple[int, str | None]:
        got = json.loads(self.call("esearch.fcgi", db="pubmed", term=window.query(), usehistory="y", retmax=0, retmode="json"))["esearchresult"]
        return int(got["count"]), f"{got['querykey']} {got['webenv']}"

    def count(self, window: Window) -> int:
        return self.opened(window)[0]

    def page(self, window: Window, at: int, size: int, handle: str | None = None) -> bytes:
        if not 1 <= size <= 1000:
            raise ValueError("a page holds 1 to 1000 records")
        key, env = (handle or self.opened(window)[1]).split(" ", 1)
        return self.call("efetch.fcgi", db="pubmed", query_key=key, WebEnv=env, retstart=at, retmax=size, retmode="xml")

    def pages(self, window: Window, size: int = 200) -> Iterator[tuple[int, bytes]]:
        if not 1 <= size <= 1000:
            raise ValueError("a page holds 1 to 1000 records")
        total, handle = self.opened(window)
        for at in range(0, total, size):
            yield at, self.page(window, at, size, handle)
