"""HTML captures: links and their scores, article fields, publication times."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# What is dropped with its content, and metadata keys in order of preference.
DROPPED = {"script", "style", "noscript", "svg", "form", "nav", "footer"}
TIME_META = ("article:published_time", "og:published_time", "publish-date", "publication_date", "date", "dc.date")
TIME_JSON = ("datePublished", "dateCreated", "uploadDate")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
STAMP = re.compile(r"\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?\Z")


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[tuple[str, str, bool, bool]] = []  # address, label, in a heading or an article, in main
        self.media: list[str] = []
        self.metas: list[tuple[str, str]] = []
        self.times: list[str] = []
        self.ld: list[str] = []
        self.text: list[str] = []
        self.title: list[str] = []
        self.hidden = 0
        self.open: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag not in VOID:
            self.open.append(tag)
            self.hidden += tag in DROPPED
        if tag == "a" and a.get("href"):
            self.links.append((a["href"], "", not {"article", "h2", "h3"}.isdisjoint(self.open), "main" in self.open))
        elif tag == "img" and a.get("src") and not self.hidden:
            self.media.append(a["src"])
        elif tag == "meta":
            self.metas.append(((a.get("property") or a.get("name") or a.get("itemprop") or "").lower(), a.get("content") or ""))
        elif tag == "time" and a.get("datetime"):
            self.times.append(a["datetime"])
        elif tag == "script" and a.get("type") == "application/ld+json":
            self.ld.append("")
            self.open[-1] = "ld"
        if tag in ("p", "div", "h1", "h2", "li", "br", "article"):
            self.text.append(" ")

    def handle_endtag(self, tag: str) -> None:
        names = [t if t != "ld" else "script" for t in self.open]
        if tag in names:
            while self.open:
                last = self.open.pop()
                last = "script" if last == "ld" else last
                self.hidden -= last in DROPPED
                if last == tag:
                    break

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1] == "ld":
            self.ld[-1] += data
        elif "title" in self.open:
            self.title.append(data)
        elif not self.hidden:
            self.text.append(data)
        if "a" in self.open and self.links:
            href, t, *where = self.links[-1]
            self.links[-1] = (href, t + data, *where)


def read(html: str | None) -> _Reader:
    r = _Reader()
    r.feed(html or "")
    r.close()
    return r


def published(r: _Reader) -> str | None:
    """The first valid stamp of metadata, then JSON-LD (last object first), then time elements."""
    for key in TIME_META:
        for name, value in r.metas:
            if name == key and STAMP.match(value.strip()):
                return value.strip()
    for text in r.ld:
        try:
            stack = [json.loads(text)]
        except ValueError:
            continue
        while stack:
            x = stack.pop()
            if isinstance(x, list):
                stack += x
            elif isinstance(x, dict):
                for key in TIME_JSON:
                    if isinstance(x.get(key), str) and STAMP.match(x[key].strip()):
                        return x[key].strip()
                stack += [v for v in x.values() if isinstance(v, (dict, list))]
    return next((t.strip() for t in r.times if STAMP.match(t.strip())), None)


def article_fields(pages: DataFrame) -> DataFrame:
    """page_id, title, text, media, published of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for url, html in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                r = read(html.as_py())
                rows.append((" ".join("".join(r.title).split()), " ".join("".join(r.text).split()), [urljoin(url or "", m) for m in dict.fromkeys(r.media)], published(r)))
            title, text, media, when = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(title, pa.string()), pa.array(text, pa.string()), pa.array(media, pa.list_(pa.string())), pa.array(when, pa.string())], ["page_id", "title", "text", "media", "published"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, title string, text string, media array<string>, published string")


def links(pages: DataFrame) -> DataFrame:
    """page_id, base, link (absolute, without fragment), label, framed (in an article or a heading) of every link; of a
    page with a main element, of those in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for page, url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                found = read(html.as_py()).links
                in_main = [x for x in found if x[3]]
                for href, label, framed, _ in in_main or found:
                    if href.strip().startswith(("#", "mailto:", "javascript:")):
                        continue
                    try:
                        link = urlsplit(urljoin(url or "", href.strip()))._replace(fragment="").geturl()
                    except ValueError:
                        continue
                    out.append((page, url, link, " ".join(label.split()), framed))
            cols = zip(*out, strict=True) if out else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()), strict=True)], ["page_id", "base", "link", "label", "framed"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, base string, link string, label string, framed boolean")


# Paths that speak for an article, and those that speak against it.
DATE_PATH = r"/(?:19|20)\d{2}/(?:0?[1-9]|1[0-2])(?:/|-)"
HINT_PATH = r"(?i)/(news|novyny|article|analysis|posts?|press|blog|events?|content)/"
BLOCKED_PATH = r"(?i)/(search|login|signin|tags?|topics?|authors?|categories?)(?:/|$)"
BINARY_PATH = r"(?i)\.(?:jpg|jpeg|png|gif|webp|svg|pdf|zip)$"


def discover(pages: DataFrame, limit: int = 12, least: int = 2) -> DataFrame:
    """Likely articles on the same host, the best ``limit`` of each page by score, then address.

    A path with a hint counts 3, one with a date 3, a link in an article or a heading 2, a label of 24 characters 1.
    """
    part = lambda c, what: F.coalesce(F.try_parse_url(F.col(c), F.lit(what)), F.lit(""))
    bare = lambda c: F.regexp_replace(part(c, "PATH"), "/+$", "")
    path = part("link", "PATH")
    found = links(pages).where(part("link", "PROTOCOL").isin("http", "https") & (F.lower(part("link", "HOST")) == F.lower(part("base", "HOST"))) & (bare("link") != bare("base")))
    found = found.where(~path.rlike(BLOCKED_PATH) & ~path.rlike(BINARY_PATH))
    score = F.when(path.rlike(HINT_PATH), 3).otherwise(0) + F.when(path.rlike(DATE_PATH), 3).otherwise(0) + F.when(F.col("framed"), 2).otherwise(0) + F.when(F.char_length("label") >= 24, 1).otherwise(0)
    best = found.groupBy("page_id", "link").agg(F.max(score).alias("score")).where(F.col("score") >= least)
    place = F.row_number().over(Window.partitionBy("page_id").orderBy(F.col("score").desc(), "link"))
    return best.withColumn("place", place).where(F.col("place") <= max(1, limit))
