"""Connectors over captured payloads: feeds, message pages, paged API answers and web indexes become items.

There is no network here, and none in a query: payloads (source, platform, seq, payload) are read by Spark from wherever
a fetcher put them, and parsed by one Arrow pass with the platform's parser.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from email.utils import parsedate_to_datetime

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corvane.functions import text as T
from corvane.sources import pages

ITEM = "source string, platform string, seq long, post_id string, url string, published string, title string, text string, media array<string>, author string, more string, error string"


def _stamp(value: str | None) -> str | None:
    if not value:
        return None
    if pages.STAMP.match(value.strip()):
        return value.strip()
    try:
        return parsedate_to_datetime(value).isoformat()
    except (TypeError, ValueError):
        return None


def rss(payload: str) -> Iterator[dict]:
    """RSS items and Atom entries; the longer of summary and content is the text. Documents with entities of their own are refused."""
    if "<!DOCTYPE" in payload[:4096] or "<!ENTITY" in payload:
        raise ValueError("a feed with a document type")
    root = ET.fromstring(payload)
    name = lambda e: e.tag.rsplit("}", 1)[-1]
    for entry in (e for e in root.iter() if name(e) in ("item", "entry")):
        got: dict[str, list] = {}
        for e in entry:
            got.setdefault(name(e), []).append(e)
        text = lambda *ks: next((("".join(got[k][0].itertext())).strip() for k in ks if k in got), "")  # noqa: E731, B023
        link = got.get("link", [None])[0]
        bodies = [text(k) for k in ("description", "summary", "content", "encoded")]
        body = max(bodies, key=len)
        yield {"post_id": text("guid", "id"), "url": ((link.get("href") or link.text or "") if link is not None else "").strip(), "published": _stamp(text("pubDate", "published", "updated", "date")), "title": text("title"), "text": " ".join("".join(pages.read(body).text).split()), "author": text("creator", "author")}


def messages(payload: str) -> Iterator[dict]:
    """A public message page: data-post blocks with a text and a time; empty posts are left out."""
    for m in re.finditer(r'data-post="([^"]+)"(.*?)(?=data-post="|\Z)', payload, re.S):
        r = pages.read(m[2])
        text = " ".join("".join(r.text).replace("<", " ").split()).lstrip("> ")
        media = re.findall(r"url\('([^']+)'\)", m[2]) + r.media
        if text or media:
            yield {"post_id": m[1].rsplit("/", 1)[-1], "url": f"https://t.me/{m[1]}", "published": _stamp(r.times[-1] if r.times else None), "text": text, "media": list(dict.fromkeys(media))}


def api(payload: str) -> Iterator[dict]:
    """One page of posts with its users and media; the token of the next page goes along."""
    page = json.loads(payload)
    inc = page.get("includes") or {}
    users = {u["id"]: u for u in inc.get("users", [])}
    media = {m["media_key"]: m.get("url") or m.get("preview_image_url") for m in inc.get("media", [])}
    for p in page.get("data") or []:
        user = users.get(p.get("author_id"), {})
        keys = (p.get("attachments") or {}).get("media_keys", [])
        yield {"post_id": p["id"], "url": f"https://x.com/{user.get('username', 'i')}/status/{p['id']}", "published": _stamp(p.get("created_at")), "text": p.get("text", ""), "media": [media[k] for k in keys if media.get(k)], "author": user.get("name", ""), "more": (page.get("meta") or {}).get("next_token")}


def web(payload: str) -> Iterator[dict]:
    """A page as one item."""
    r = pages.read(payload)
    yield {"title": " ".join("".join(r.title).split()), "text": " ".join("".join(r.text).split()), "published": pages.published(r), "media": r.media}


PARSERS: dict[str, Callable[[str], Iterator[dict]]] = {"rss": rss, "telegram": messages, "x": api, "web": web}


def parse(payloads: DataFrame) -> DataFrame:
    """Items of payloads (source, platform, seq, payload). A payload that its parser can't read gives one row with an
    error and no item; an unknown platform fails the query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["source", "platform", "seq", "post_id", "url", "published", "title", "text", "media", "author", "more", "error"]
        kinds = [pa.string(), pa.string(), pa.int64()] + [pa.string()] * 5 + [pa.list_(pa.string()), pa.string(), pa.string(), pa.string()]
        for b in batches:
            rows = []
            for source, platform, seq, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if platform not in PARSERS:
                    raise ValueError(f"no connector for platform {platform!r}")
                try:
                    found = list(PARSERS[platform](payload or ""))
                except (ET.ParseError, ValueError, KeyError, TypeError, AttributeError) as e:
                    found = [{"error": f"{type(e).__name__}: invalid_payload"}]
                for item in found:
                    rows.append((source, platform, seq, *(item.get(n, [] if n == "media" else None) for n in names[3:])))
            cols = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    return payloads.select("source", "platform", "seq", "payload").mapInArrow(run, ITEM)


def until_known(items: DataFrame, since: str, most_pages: int) -> DataFrame:
    """Posts of paged sources, as far as a poller would have read them: page after page, up to the cap, until one reaches
    ``since``, brings no post that earlier pages lacked, or has no number below those before it. Numbers are compared as
    numbers and times as times. Of a repeated post the first page's copy stays; dated posts before ``since`` go."""
    when = T.parse_stamp(F.col("published"))
    limit = T.parse_stamp(F.lit(since))
    number = F.col("post_id").try_cast("long")
    known = items.withColumn("first_seq", F.min("seq").over(Window.partitionBy("source", "post_id")))
    own = F.when(F.col("first_seq") == F.col("seq"), number)
    per_page = known.groupBy("source", "seq").agg(F.min(when).alias("oldest"), F.min(own).alias("least"))
    w = Window.partitionBy("source").orderBy("seq")  # a row per page
    last = F.coalesce(F.col("oldest") < limit, F.lit(False)) | F.col("least").isNull() | F.coalesce(F.col("least") >= F.lag("least").over(w), F.lit(False))
    pages_ = per_page.withColumn("last", last.cast("int")).withColumn("stopped", F.coalesce(F.sum("last").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("page", F.row_number().over(w))
    read = pages_.where((F.col("stopped") == 0) & (F.col("page") <= most_pages)).select("source", "seq")
    out = known.where(F.col("first_seq") == F.col("seq")).drop("first_seq").join(read, ["source", "seq"], "left_semi").where(when.isNull() | (when >= limit))
    return out.dropDuplicates(["source", "post_id"])


def by_token(items: DataFrame, most_pages: int) -> DataFrame:
    """Posts of an API whose pages follow each other by token: up to the first page without one, and to the cap."""
    pages_ = items.groupBy("source", "seq").agg(F.max("more").alias("more"))
    w = Window.partitionBy("source").orderBy("seq")  # a row per page
    ended = F.sum(F.when(F.coalesce(F.col("more"), F.lit("")) == "", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    read = pages_.withColumn("ended", F.coalesce(ended, F.lit(0))).withColumn("page", F.row_number().over(w)).where((F.col("ended") == 0) & (F.col("page") <= most_pages)).select("source", "seq")
    return items.join(read, ["source", "seq"], "left_semi").dropDuplicates(["source", "post_id"])


class CapturedSource(DataSource):
    """format("captured"): payload files as (source, platform, seq, payload), a partition per file.

    Options: paths (comma-separated files named source.platform.seq on a file system that workers share).
    """

    @classmethod
    def name(cls) -> str:
        return "captured"

    def schema(self) -> str:
        return "source string, platform string, seq long, payload string"

    def reader(self, schema) -> DataSourceReader:
        return _CapturedReader(self.options["paths"].split(","))


class _CapturedReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.value, encoding="utf-8") as f:
            source, platform, seq = partition.value.rsplit("/", 1)[-1].split(".")[:3]
            yield source, platform, int(seq), f.read()
