"""A poller as a streaming source: `format("polled")`, and its posts, each once.

Each source has a folder of captured pages, numbered in the order in which a fetcher got them. The offset holds the last
page of every source, so the driver lists names and reads nothing; a micro-batch parses the pages in between, a task a
source. Offsets are logged before a batch runs and committed after it: a query that was stopped goes on where it was,
and a batch that is run again reads the same pages. commit() tells the fetcher, in a file beside the pages, how far a
source was read, so that it may remove them.

Pages overlap: a poller looks back, and a page begins with what the one before ended with. `posts` leaves repeated posts
out by keyed state within a horizon of event time, as a poller's lookback does; the archive's own index of keys has no
horizon and catches what comes later.

Options: path (a folder of folders `<source>.<platform>` with files `<number>` or `<number>.<suffix>`; a path that driver
and workers share, or an address that pyarrow's file systems know), since (posts dated before are left out), most_pages
(of a source a batch; 50). Defined cases: an empty folder is an empty stream; a page that can't be parsed gives a row
with its error; folders of other names are left alone; a source may come later than others.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import UTC, datetime

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from corvane.sources.connectors import PARSERS

SCHEMA = "source string, platform string, page long, fetched timestamp, post_id string, url string, published timestamp, title string, text string, media array<string>, author string, more string, error string"
#: File beside the pages of a source that tells how far they were read.
READ = "_read"


class Pages(InputPartition):
    """Pages of one source: their numbers, files and times."""

    def __init__(self, source: str, platform: str, pages: list[tuple[int, str, float]]):
        self.source, self.platform, self.pages = source, platform, pages


def store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+://", path) else (fs.LocalFileSystem(), path)


def listed(path: str) -> dict[str, list[tuple[int, str, float]]]:
    """Pages by `source.platform`, in order of their numbers."""
    files, root = store(path)
    found: dict[str, list[tuple[int, str, float]]] = {}
    for folder in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if folder.type != fs.FileType.Directory or folder.base_name.rpartition(".")[2] not in PARSERS or not folder.base_name.rpartition(".")[0]:
            continue
        for f in files.get_file_info(fs.FileSelector(folder.path)):
            m = re.fullmatch(r"(\d+)(\..*)?", f.base_name)
            if m and f.type == fs.FileType.File:
                found.setdefault(folder.base_name, []).append((int(m[1]), f.path, f.mtime_ns / 1e9 if f.mtime_ns else 0.0))
    return {k: sorted(v) for k, v in found.items()}


def stamp(text: str | None) -> datetime | None:
    try:
        t = datetime.fromisoformat(text) if text else None
    except ValueError:
        return None
    return t if t is None or t.tzinfo else t.replace(tzinfo=UTC)


def parsed(platform: str, payload: str) -> list[dict]:
    try:
        return list(PARSERS[platform](payload))
    except (SyntaxError, ValueError, KeyError, TypeError, AttributeError) as e:  # broken XML is a SyntaxError
        return [{"error": f"{type(e).__name__}: invalid_payload"}]


class PolledReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.since, self.most = options["path"], stamp(options.get("since")), int(options.get("most_pages") or 50)
        self.now: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        for name, pages in listed(self.path).items():
            ahead = [n for n, *_ in pages if n > self.now.get(name, -1)][: self.most]
            if ahead:
                self.now = self.now | {name: ahead[-1]}
        return self.now

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.now = end | {k: v for k, v in self.now.items() if v > end.get(k, -1)}  # after a restart the next offset follows the logged one
        pages = listed(self.path)
        todo = {name: [p for p in pages.get(name, []) if start.get(name, -1) < p[0] <= last] for name, last in sorted(end.items())}
        return [Pages(*name.rsplit(".", 1), ps) for name, ps in todo.items() if ps]

    def read(self, partition: Pages) -> Iterator[tuple]:
        files, _ = store(self.path)
        for page, path, at in partition.pages:
            with files.open_input_stream(path) as f:
                found = parsed(partition.platform, f.read().decode("utf-8", "replace"))
            for p in found:
                when = stamp(p.get("published"))
                if self.since is None or when is None or when >= self.since:
                    yield partition.source, partition.platform, page, datetime.fromtimestamp(at, UTC), p.get("post_id"), p.get("url"), when, p.get("title"), p.get("text"), p.get("media", []), p.get("author"), p.get("more"), p.get("error")

    def commit(self, end: dict) -> None:
        files, root = store(self.path)
        for name, last in end.items():
            with files.open_output_stream(f"{root.rstrip('/')}/{name}/{READ}") as f:
                f.write(json.dumps({"page": last}).encode())


class PolledSource(DataSource):
    """format("polled"): posts of captured pages, as a stream."""

    @classmethod
    def name(cls) -> str:
        return "polled"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PolledReader(dict(self.options))


def posts(stream: DataFrame, horizon: str = "168 hours") -> DataFrame:
    """Posts without those that came before within the horizon: by source and number, or address where there is none.

    Time is the post's own, or its page's where it has none; a post that lies further back than the horizon, seen from
    the newest, is left out. Rows of pages that couldn't be parsed are kept apart by page.
    """
    identity = F.coalesce(F.when(F.col("error").isNotNull(), F.concat(F.lit("page "), F.col("page").cast("string"))), F.nullif(F.col("post_id"), F.lit("")), F.col("url"), F.lit(""))
    timed = stream.withColumns({"at": F.coalesce("published", "fetched"), "identity": identity})
    return timed.withWatermark("at", horizon).dropDuplicatesWithinWatermark(["source", "identity"]).drop("at", "identity")
