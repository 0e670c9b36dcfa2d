"""A paged interface as a Spark source, and the manners of asking it: pace, retries, budget, robots rules, cache.

``spark.read.format("paged")`` has one partition per prefix, so readers work side by side
without meeting; each asks page after page until its prefix is exhausted. The transport is
a function (method, url, body, headers) -> Response, named as "module:function", so that tests and other
networks bring their own.
"""

from __future__ import annotations

import base64
import hashlib
import importlib
import json
import os
import random
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from foliant.operators.responses import API, NOT_CHECKED, OK, Expectation, evaluate

RETRIED = frozenset({429, 500, 502, 503, 504})
THROTTLED = frozenset({429, 503})
PREFIXES = tuple("123456789")


class RunStopped(RuntimeError):
    """The run ends here; what wasn't asked stays "not counted", never "absent"."""


class Throttled(RunStopped):
    pass


class BudgetSpent(RunStopped):
    pass


class Refused(RunStopped):
    pass


@dataclass(frozen=True)
class Response:
    status: int
    body: bytes
    headers: dict[str, str] = field(default_factory=dict)
    attempts: int = 1


Transport = Callable[[str, str, "dict | None", dict[str, str]], Response]


def canonical(body: dict | None) -> str:
    return json.dumps(body or {}, sort_keys=True, ensure_ascii=False, separators=(",", ":"))


class DiskCache:
    """Responses by hash of method, address and canonical body; with ``ttl`` 0 they never expire."""

    def __init__(self, root: str, ttl: float = 0):
        self.root, self.ttl = Path(root), ttl

    def _file(self, method: str, url: str, body: dict | None) -> Path:
        key = hashlib.sha256("\n".join((method.upper(), url, canonical(body))).encode()).hexdigest()
        return self.root / key[:2] / f"{key}.json"

    def get(self, method: str, url: str, body: dict | None) -> Response | None:
        try:
            kept = json.loads(self._file(method, url, body).read_text())
        except (FileNotFoundError, json.JSONDecodeError):
            return None
        if self.ttl and time.time() - kept["at"] > self.ttl:
            return None
        return Response(kept["status"], base64.b64decode(kept["body"]), kept["headers"], attempts=0)

    def put(self, method: str, url: str, body: dict | None, r: Response) -> None:
        path = self._file(method, url, body)
        path.parent.mkdir(parents=True, exist_ok=True)
        # the stored body is decoded already
        headers = {k: v for k, v in r.headers.items() if k.lower() not in ("content-encoding", "content-length", "transfer-encoding")}
        part = path.with_suffix(f".{uuid.uuid4().hex}")
        part.write_text(json.dumps({"at": time.time(), "status": r.status, "headers": headers, "body": base64.b64encode(r.body).decode()}))
        os.replace(part, path)


def robots_directives(text: str, agent: str) -> tuple[float | None, str | None]:
    """(crawl delay, content signal) for an agent; a group that names it wins over the group for all."""
    named: dict[str, dict[str, str]] = {}
    group: list[str] = []
    opening = False
    for line in text.splitlines():
        key, colon, value = line.split("#", 1)[0].partition(":")
        key, value = key.strip().lower(), value.strip()
        if not colon:
            continue
        if key == "user-agent":
            group = [*group, value.lower()] if opening else [value.lower()]
            opening = True
            named.setdefault(value.lower(), {})
        else:
            opening = False
            for g in group:
                named[g].setdefault(key, value)
    mine = next((d for a, d in named.items() if a not in ("*", "") and a in agent.lower()), named.get("*", {}))
    try:
        delay = float(mine["crawl-delay"])
    except (KeyError, ValueError):
        delay = None
    return delay, mine.get("content-signal")


@dataclass
class Robots:
    """One host's rules. A missing file allows everything; one that can't be had allows nothing."""

    agent: str
    status: int | None
    text: str = ""

    @property
    def sha256(self) -> str:
        return hashlib.sha256(self.text.encode()).hexdigest()

    @property
    def delay(self) -> float | None:
        return robots_directives(self.text, self.agent)[0] if self.status == 200 else None

    def allows(self, url: str) -> bool:
        if self.status == 404:
            return True
        if self.status != 200:
            return False
        parser = RobotFileParser()
        parser.parse(self.text.splitlines())
        return parser.can_fetch(self.agent, url)


class Client:
    """Asks with pace, retries and a budget. Two throttled answers in a row stop the run."""

    def __init__(self, transport: Transport, agent: str = "foliant", per_second: float = 0.5, jitter: float = 0.25, retries: int = 3, backoff: float = 2.0, budget: int = 1000, cache: DiskCache | None = None, robots: bool = True, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.transport, self.agent, self.per_second, self.jitter = transport, agent, per_second, jitter
        self.retries, self.backoff, self.budget, self.cache = retries, backoff, budget, cache
        self.check_robots, self.clock, self.sleep = robots, clock, sleep
        self.asked, self._last, self._throttled, self._robots = 0, None, 0, {}

    def _send(self, method: str, url: str, body: dict | None, delay: float | None = None) -> Response:
        if self.asked >= self.budget:
            raise BudgetSpent(f"{self.asked} requests made")
        gap = max(1 / self.per_second, delay or 0) + random.uniform(0, self.jitter)
        if self._last is not None and (wait := self._last + gap - self.clock()) > 0:
            self.sleep(wait)
        self._last, self.asked = self.clock(), self.asked + 1
        return self.transport(method, url, body, {"User-Agent": self.agent})

    def robots_of(self, url: str) -> Robots:
        host = "{0.scheme}://{0.netloc}".format(urlsplit(url))
        if host not in self._robots:
            try:
                r = self._send("GET", f"{host}/robots.txt", None)
                self._robots[host] = Robots(self.agent, r.status, r.body.decode("utf-8", "replace"))
            except OSError:
                self._robots[host] = Robots(self.agent, None)
        return self._robots[host]

    def ask(self, method: str, url: str, body: dict | None = None, expect: Expectation | None = None) -> Response:
        """One response. What the cache holds counts only if it is (still) what is expected; it has made no attempts."""
        if self.cache and (kept := self.cache.get(method, url, body)):
            kind = kept.headers.get("Content-Type", kept.headers.get("content-type", ""))
            if expect is None or evaluate(kept.status, kept.body, kind, expect)[0] == OK:
                return kept
        delay = None
        if self.check_robots:
            rules = self.robots_of(url)
            if not rules.allows(url):
                raise Refused(url)
            delay = rules.delay
        for attempt in range(1, self.retries + 2):
            try:
                r = self._send(method, url, body, delay)
            except OSError:
                if attempt > self.retries:
                    raise
                self.sleep(self.backoff**attempt)
                continue
            self._throttled = self._throttled + 1 if r.status in THROTTLED else 0
            if self._throttled >= 2:
                raise Throttled(f"status {r.status} twice in a row: {url}")
            if r.status not in RETRIED or attempt > self.retries:
                break
            said = r.headers.get("Retry-After", "")
            self.sleep(float(said) if said.isdigit() else self.backoff**attempt)
        r = Response(r.status, r.body, r.headers, attempt)
        if self.cache and 200 <= r.status < 300:
            self.cache.put(method, url, body, r)
        return r


# The columns that the two interfaces of such a source declare, in their order, and those that can't be sorted.
COLUMNS = {
    "expediente": ("concordancia", "expedientes", "tipoExpediente", "fechaSentencia", "intro", "id", "pdf"),
    "texto_libre": ("concordancia", "expedientes", "fechaSentencia", "intro", "id", "pdf"),
}
UNSORTED = ("expedientes", "id", "pdf")


def request_body(search: str, start: int = 0, length: int = 25, draw: int = 1, columns: tuple[str, ...] = COLUMNS["expediente"]) -> dict:
    """The body that a server-side table sends: its columns, the order, the window and the search."""
    nothing = {"value": "", "regex": False}
    described = [{"data": c, "name": "", "searchable": True, "orderable": c not in UNSORTED, "search": nothing} for c in columns]
    return {"draw": draw, "columns": described, "order": [{"column": 0, "dir": "desc"}], "start": start, "length": length, "search": nothing, "mainSearch": search}


def page(client: Client, url: str, search: str, start: int, length: int, columns: tuple[str, ...] = COLUMNS["texto_libre"], rows: str = "documentos", total: str = "recordsFiltered") -> tuple[list[dict], int, tuple[str, str | None], Response | None]:
    """(rows, how many there are in all, (outcome, note), response) of one page; -1 in all where that wasn't checked.

    ``recordsTotal`` only echoes the length that was asked for.
    """
    try:
        r = client.ask("POST", url, request_body(search, start, length, columns=columns))
    except OSError as e:
        return [], -1, (NOT_CHECKED, f"consulta fallida: {type(e).__name__}: {e}"), None
    verdict = evaluate(r.status, r.body, r.headers.get("Content-Type", r.headers.get("content-type", "")), API)
    if verdict[0] != OK:
        return [], -1, verdict, r
    answer = json.loads(r.body)
    known = answer.get(total)
    return list(answer.get(rows) or []), -1 if known is None else int(known), verdict, r


def pages(client: Client, url: str, prefix: str, size: int, rows: str = "documentos", total: str = "recordsFiltered", interface: str = "expediente") -> Iterator[dict]:
    """All rows of a prefix. A failed page is an error, never taken for the end."""
    start = 0
    while True:
        r = client.ask("POST", url, request_body(prefix, start, size, columns=COLUMNS[interface]))
        if not 200 <= r.status < 300:
            raise RunStopped(f"status {r.status} at {prefix}:{start}")
        answer = json.loads(r.body)
        found = answer[rows]
        yield from found
        start += len(found)
        known = answer.get(total, -1)  # -1: not checked
        if not found or (known >= 0 and start >= known):
            return


@dataclass
class Prefix(InputPartition):
    value: str


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str], fields: list[str]):
        self.options, self.fields = dict(options), fields

    def partitions(self) -> list[Prefix]:
        return [Prefix(p) for p in self.options.get("prefixes", ",".join(PREFIXES)).split(",")]

    def read(self, partition: Prefix) -> Iterator[tuple]:
        o = self.options
        # the pace and budget are of the whole run, so each of the readers has its share
        client = _client(o, len(self.partitions()))
        for row in pages(client, o["url"], partition.value, int(o.get("pagesize", 1000)), interface=o.get("interface", "expediente")):
            yield _fields(partition.value, row, self.fields)


@dataclass
class PageRanges(InputPartition):
    ranges: list[tuple[str, int, int]]


class PagedStream(DataSourceStreamReader):
    """A stream whose offset is a position in every prefix.

    A batch takes ``pagesPerBatch`` pages of each prefix at most, one partition per prefix or, with the option ``readers``, its pages in equal
    shares for that many, who share pace and budget; the source is asked for its totals once per batch. What has been planned is noted in the folder ``state`` (beside the query's checkpoint), as Spark doesn't
    tell a source where a restarted query stands. A page that is refused, or has fewer rows
    than its totals promised, fails the batch: the query stops, and its next start reads the same range
    again. Rows that come later belong at a prefix's end.
    """

    def __init__(self, options: dict[str, str], fields: list[str]):
        self.options, self.fields = dict(options), fields
        self.prefixes = self.options.get("prefixes", ",".join(PREFIXES)).split(",")
        self.size, self.readers = int(self.options.get("pagesize", 1000)), int(self.options.get("readers", 0))
        self.fs, self.state = pafs.FileSystem.from_uri(self.options["state"])
        self.planned: dict[str, int] | None = None

    def _client(self) -> Client:
        return _client(self.options, self.readers or len(self.prefixes))

    def initialOffset(self) -> dict:  # noqa: N802
        return dict.fromkeys(self.prefixes, 0)

    def _plan(self) -> dict[str, int]:
        if self.planned is None:
            found = self.fs.get_file_info(f"{self.state}/planned.json").type != pafs.FileType.NotFound
            self.planned = self.initialOffset() | (json.loads(self.fs.open_input_stream(f"{self.state}/planned.json").read()) if found else {})
        return self.planned

    def latestOffset(self) -> dict:  # noqa: N802
        client, step = self._client(), self.size * int(self.options.get("pagesperbatch", 10))
        end = {}
        for p, at in self._plan().items():
            r = client.ask("POST", self.options["url"], request_body(p, 0, 1, columns=COLUMNS[self.options.get("interface", "expediente")]))
            known = json.loads(r.body).get("recordsFiltered") if 200 <= r.status < 300 else None
            if known is None:
                raise RunStopped(f"no total of {p}: status {r.status}")
            end[p] = max(at, min(int(known), at + step))
        return end

    def partitions(self, start: dict, end: dict) -> list[PageRanges]:
        self.planned = {p: max(n, end.get(p, 0)) for p, n in self._plan().items()}
        self.fs.create_dir(self.state, recursive=True)
        side = f"{self.state}/planned.json.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(side) as out:
            out.write(json.dumps(self.planned).encode())
        self.fs.move(side, f"{self.state}/planned.json")
        ranges = [(p, start.get(p, 0), n) for p, n in end.items() if n > start.get(p, 0)]
        if not self.readers:
            return [PageRanges([r]) for r in ranges]
        pages = [(p, at, min(at + self.size, n)) for p, first, n in ranges for at in range(first, n, self.size)]
        readers = min(self.readers, len(pages))
        return [PageRanges(pages[k * len(pages) // readers : (k + 1) * len(pages) // readers]) for k in range(readers)]

    def read(self, partition: PageRanges) -> Iterator[pa.RecordBatch]:
        """A batch of rows for each answer."""
        client, o = self._client(), self.options
        for prefix, at, end in partition.ranges:
            while at < end:
                r = client.ask("POST", o["url"], request_body(prefix, at, min(self.size, end - at), columns=COLUMNS[o.get("interface", "expediente")]))
                if not 200 <= r.status < 300:
                    raise RunStopped(f"status {r.status} at {prefix}:{at}")
                rows = json.loads(r.body)["documentos"][: end - at]
                if not rows:
                    raise RunStopped(f"nothing at {prefix}:{at}, before its end at {end}")
                at += len(rows)
                columns = [[prefix] * len(rows), *[[_text(row.get(f)) for row in rows] for f in self.fields]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["prefix", *self.fields])

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "fs"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.fs = pafs.FileSystem.from_uri(self.options["state"])[0]


def _client(o: dict[str, str], readers: int) -> Client:
    """A client with its share of the run's pace and budget."""
    module, name = o["transport"].split(":")
    send = getattr(importlib.import_module(module), name)
    return Client(send, per_second=float(o.get("persecond", 0.5)) / readers, budget=max(1, int(o.get("budget", 1000)) // readers), robots=o.get("robots", "true") == "true", jitter=float(o.get("jitter", 0.25)), retries=int(o.get("retries", 3)), cache=DiskCache(o["cache"]) if "cache" in o else None)


_encode = json.JSONEncoder(ensure_ascii=False).encode  # made once: json.dumps makes one for every value


def _text(v) -> str | None:
    return v if v is None or isinstance(v, str) else str(v) if type(v) is int else _encode(v)


def _fields(prefix: str, row: dict, fields: list[str]) -> tuple:
    return (prefix, *[_text(row.get(f)) for f in fields])


class PagedSource(DataSource):
    """Options: url, transport, fields (comma-separated), prefixes, pageSize, interface (a key of ``COLUMNS``), perSecond, jitter, retries, budget, robots, cache; for a stream also state, pagesPerBatch and readers. All fields are strings."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def _fields(self) -> list[str]:
        return self.options["fields"].split(",")

    def schema(self) -> str:
        return ", ".join(["prefix string", *[f"`{f}` string" for f in self._fields()]])

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options, self._fields())

    def streamReader(self, schema) -> PagedStream:  # noqa: N802
        return PagedStream(self.options, self._fields())
