"""A Python data source for a paged ticket search API, partitioned by date range.

    spark.dataSource.register(TicketSearch)
    spark.read.format("ticket_search").options(base_url=…, start="2024-01-01", end="2024-07-01", channel="web").load()

The options are the search's predicates. Filters of a query aren't pushed further: Spark keeps a Python reader between
queries of one DataFrame, and one query's filter would narrow the next one's rows. A range that holds as many rows as the
API returns for one search is halved, to days and then to seconds, with half-open halves, so no ticket is missed or comes
twice; a second that holds that many raises. Each partition has its own retries.
"""

from __future__ import annotations

import base64
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "id bigint, subject string, status string, created_at string, updated_at string, requester_id bigint, submitter_id bigint, assignee_id bigint, group_id bigint, tags array<string>, channel string"
FIELDS = tuple(part.split()[0] for part in SCHEMA.split(", "))
RETRY = (429, 500, 502, 503, 504)


def midpoint(start: date, end: date | None, today: date | None = None) -> date | None:
    """The day that halves [start, end), or None if that is a day or less. An open end is tomorrow."""
    end = end or (today or datetime.now(timezone.utc).date()) + timedelta(days=1)
    days = (end - start).days
    return start + timedelta(days=days // 2) if days >= 2 else None


def instant(start: datetime, end: datetime) -> datetime | None:
    """The second that halves [start, end), or None if that is a second or less."""
    seconds = int((end - start).total_seconds())
    return start + timedelta(seconds=seconds // 2) if seconds >= 2 else None


def _as_time(day: date) -> datetime:
    return day if isinstance(day, datetime) else datetime(day.year, day.month, day.day)


def _said(when: date) -> str:
    """A day as such, another time in UTC."""
    return f"{when.isoformat()}Z" if isinstance(when, datetime) else when.isoformat()


def get_json(url: str, user: str | None, token: str | None, retries: int = 5, backoff: float = 2.0) -> dict:
    request = urllib.request.Request(url, headers={"Accept": "application/json"})
    if user:
        request.add_header("Authorization", "Basic " + base64.b64encode(f"{user}:{token or ''}".encode()).decode())
    for attempt in range(retries + 1):
        try:
            with urllib.request.urlopen(request, timeout=60) as answer:
                return json.loads(answer.read())
        except urllib.error.HTTPError as e:
            if e.code not in RETRY or attempt == retries:
                raise
        except urllib.error.URLError:
            if attempt == retries:
                raise
        time.sleep(backoff**attempt * 0.1)
    raise AssertionError


@dataclass
class Search:
    base_url: str
    user: str | None
    token: str | None
    channel: str | None
    page_size: int
    most_rows: int
    retries: int
    backoff: float

    def url(self, start: date, end: date | None) -> str:
        terms = ["type:ticket", f"created>={_said(start)}"]
        if end:
            terms.append(f"created<{_said(end)}")
        if self.channel:
            terms.append(f"via:{self.channel}")
        query = {"query": " ".join(terms), "sort_by": "created_at", "sort_order": "asc", "per_page": self.page_size}
        return f"{self.base_url}/search.json?{urllib.parse.urlencode(query)}"

    def get(self, url: str) -> dict:
        return get_json(url, self.user, self.token, self.retries, self.backoff)

    def ranges(self, start: date, end: date | None) -> Iterator[tuple[date, date | None]]:
        """Half-open ranges of fewer than ``most_rows`` tickets each."""
        if self.get(self.url(start, end)).get("count", 0) < self.most_rows:
            yield start, end
            return
        middle = None if isinstance(start, datetime) else midpoint(start, end)
        if not middle:
            start, end = _as_time(start), _as_time(end or datetime.now(timezone.utc).date() + timedelta(days=1))
            middle = instant(start, end)
        if not middle:
            raise ValueError(f"{self.most_rows} tickets or more were created in the second {_said(start)}")
        yield from self.ranges(start, middle)
        yield from self.ranges(middle, end)

    def rows(self, start: date, end: date | None) -> Iterator[dict]:
        """The tickets of a range that ``ranges`` gave; a refused page raises, as no such range has one too many."""
        url: str | None = self.url(start, end)
        while url:
            page = self.get(url)
            yield from page.get("results") or []
            url = page.get("next_page")


class Range(InputPartition):
    def __init__(self, start: date, end: date | None) -> None:
        self.start, self.end = start, end


class TicketReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        o = options
        if not o.get("base_url"):
            raise ValueError("base_url is missing")
        if not o.get("start"):
            raise ValueError("start is missing")
        self.search = Search(o["base_url"].rstrip("/"), o.get("user"), o.get("token"), o.get("channel"), int(o.get("page_size", 100)), int(o.get("most_rows", 1000)), int(o.get("retries", 5)), float(o.get("backoff", 2.0)))
        self.start = date.fromisoformat(o["start"][:10])
        self.end = date.fromisoformat(o["end"][:10]) if o.get("end") else None

    def partitions(self) -> list[InputPartition]:
        return [Range(a, b) for a, b in self.search.ranges(self.start, self.end)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for row in self.search.rows(partition.start, partition.end):
            via = row.get("via")
            channel = row.get("channel") or (via.get("channel") if isinstance(via, dict) else None) or self.search.channel
            yield tuple(channel if f == "channel" else (row.get(f) or []) if f == "tags" else row.get(f) for f in FIELDS)


class TicketSearch(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ticket_search"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TicketReader:  # noqa: ANN001
        return TicketReader(dict(self.options))


def fetch_comments(tickets, base_url: str, user: str | None = None, token: str | None = None, retries: int = 5, backoff: float = 2.0):  # noqa: ANN001, ANN201
    """(ticket_id, id, author_id, created_at, public, body, attachments, failed) of every ticket's comments.

    A ticket that the API doesn't know (404) gives one row with failed set. Pages are followed within the task.
    """
    import pandas as pd

    schema = "ticket_id bigint, id bigint, author_id bigint, created_at string, public boolean, body string, attachments array<struct<file_name:string,content_url:string>>, failed boolean"

    def pages(ticket: int) -> Iterator[dict]:
        url: str | None = f"{base_url.rstrip('/')}/tickets/{ticket}/comments.json?per_page=100"
        while url:
            page = get_json(url, user, token, retries, backoff)
            yield from page.get("comments") or []
            url = page.get("next_page")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in schema.split(", ")]
        for batch in batches:
            rows = []
            for ticket in batch["id"].tolist():
                try:
                    for c in pages(int(ticket)):
                        files = [{"file_name": a.get("file_name"), "content_url": a.get("content_url")} for a in c.get("attachments") or []]
                        rows.append((ticket, c.get("id"), c.get("author_id"), c.get("created_at"), c.get("public", True), c.get("body") or "", files, False))
                except urllib.error.HTTPError as e:
                    if e.code != 404:
                        raise
                    rows.append((ticket, None, None, None, None, None, [], True))
            yield pd.DataFrame(rows, columns=names).astype({"ticket_id": "Int64", "id": "Int64", "author_id": "Int64"})

    return tickets.select("id").mapInPandas(run, schema)
