"""Sequential canonicalisation, and an allowlist for report HTML."""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from corvane.functions.text import by_slices

RESULT = StructType([StructField("text", StringType()), StructField("anchors", ArrayType(StringType()))])


def canonicaliser(concepts: list[tuple[str, list[str]]]):
    """An Arrow UDF: text -> struct(text, anchors). Each pattern is replaced by its concept before the next is tried, so
    later patterns see what earlier ones left; plans.clusters.anchors is the native form for patterns that don't interact."""
    compiled = [(name, [re.compile(p, re.I) for p in ps]) for name, ps in concepts]

    def one(text: str | None) -> tuple[str, list[str]]:
        value, found = " ".join((text or "").split()).lower(), set()
        for name, patterns in compiled:
            for p in patterns:
                value, n = p.subn(f" {name} ", value)
                if n:
                    found.add(name)
        return " ".join(value.split()), sorted(found)

    def some(texts: list[str | None]) -> pa.Array:
        found = [one(t) for t in texts]
        return pa.StructArray.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([a for _, a in found], pa.list_(pa.string()))], ["text", "anchors"])

    @F.arrow_udf(RESULT)
    def canonical(text: pa.Array) -> pa.Array:
        return by_slices(some, text)

    return canonical


# Elements that reports may contain, and those dropped with their content.
ALLOWED = frozenset("a blockquote br code del div em h1 h2 h3 h4 h5 h6 hr li ol p pre span strong table tbody td th thead tr ul".split())
DROPPED = frozenset("script style iframe object embed form input button select textarea svg math template noscript link meta".split())


class _Cleaner(HTMLParser):
    def __init__(self, safe_link) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.hidden = 0
        self.safe_link = safe_link

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in DROPPED:
            self.hidden += tag not in ("input", "embed", "link", "meta")
        elif not self.hidden and tag in ALLOWED:
            href = next((v for k, v in attrs if k == "href" and tag == "a" and v and self.safe_link(v)), None)
            self.out.append(f'<a href="{escape(href)}" rel="noopener noreferrer">' if href else f"<{tag}>")

    def handle_endtag(self, tag: str) -> None:
        if tag in DROPPED:
            self.hidden = max(0, self.hidden - 1)
        elif not self.hidden and tag in ALLOWED and tag not in ("br", "hr"):
            self.out.append(f"</{tag}>")

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.out.append(escape(data, quote=False))


def sanitise(html: str, safe_link=lambda href: re.match(r"https?://[^/@\s]+(/|\Z|[?#])", href) is not None) -> str:
    c = _Cleaner(safe_link)
    c.feed(html)
    c.close()
    return "".join(c.out)
