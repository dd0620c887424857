"""The web connector over captured responses: redirects under a publisher's allowlist, articles of an index, snapshots.

There is no network in a query: a fetcher has put responses (url, status, location, html) into a table, the last of an
address counts. A request follows redirects as the fetcher would, through a recursive query that joins each hop with the
responses, and every hop's address must be the publisher's: https, without user information, on one of its domains. Six
responses may be read on the way. An index page gives the articles that it links to; where none can be read, or the
source is a map, the index itself is the item.

Defined cases: a request whose address wasn't captured ends there; redirects in a circle run into the limit; an address
that several requests ask for is read for each; a source without captured index gives an error row and no item; null
addresses are not allowed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.operators import filters as S
from corvane.session import settled
from corvane.sources import pages as W

HOPS = 6
#: A recursive query may have more rows than Spark's default allows.
UNLIMITED = {"spark.sql.cteRecursionRowLimit": "-1"}
#: Tags of sources whose index is the item.
SNAPSHOT_TAGS = ("map", "maps")


def responses(captured: DataFrame) -> DataFrame:
    """url, status, target (the absolute address of a redirect), html: the last response of each address."""
    order = F.struct("fetched", "status") if "fetched" in captured.columns else F.struct("status", F.coalesce("location", F.lit("")))
    last = captured.where("url IS NOT NULL").groupBy("url").agg(F.max_by(F.struct("status", "location", "html"), order).alias("r")).select("url", "r.*")
    redirect = F.col("status").isin(301, 302, 303, 307, 308) & (F.coalesce("location", F.lit("")) != "")
    return last.select("url", "status", F.when(redirect, T.joined_url(F.col("url"), F.col("location"))).alias("target"), "html")


def followed(requests: DataFrame, captured: DataFrame, hops: int = HOPS) -> DataFrame:
    """request, source, final, hops, status, error, html of every request (request, source, url, domains)."""
    spark = requests.sparkSession
    name = uuid.uuid4().hex
    asked, found = settled(requests.select("request", "source", "url", "domains"), "requests"), settled(responses(captured), "responses")
    asked.withColumn("allowed", S.publisher_allowed(F.col("url"), F.col("domains"))).createOrReplaceTempView(f"asked_{name}")
    found.where("target IS NOT NULL").select("url", "target").createOrReplaceTempView(f"redirects_{name}")
    allowed = "startswith(target, 'https://') AND NOT target RLIKE '^https://[^/?#]*@' AND exists(domains, d -> lower(try_parse_url(target, 'HOST')) = d OR endswith(lower(try_parse_url(target, 'HOST')), concat('.', d)))"
    before = {k: spark.conf.get(k, None) for k in UNLIMITED}
    for k, v in UNLIMITED.items():
        spark.conf.set(k, v)
    try:
        chain = spark.sql(f"""
            WITH RECURSIVE hop AS (
              SELECT request, source, url AS current, domains, 0 AS n, coalesce(allowed, false) AS allowed FROM asked_{name}
              UNION ALL
              SELECT h.request, h.source, r.target, h.domains, h.n + 1, coalesce({allowed}, false)
              FROM hop h JOIN redirects_{name} r ON r.url = h.current WHERE h.allowed AND h.n < {hops}
            ) SELECT request, source, current, n, allowed FROM hop""")
        last = chain.groupBy("request", "source").agg(F.max_by(F.struct("current", "allowed", "n"), "n").alias("l")).select("request", "source", "l.*")
        last = settled(last, "hops")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        for view in ("asked", "redirects"):
            spark.catalog.dropTempView(f"{view}_{name}")
    j = last.join(found, last["current"] == found["url"], "left")
    error = F.when(F.col("n") >= hops, "redirect_error").when(~F.col("allowed"), "unsafe_destination").when(F.col("status").isNull(), "not_captured").when(F.col("status") >= 400, F.concat(F.lit("http_"), F.col("status").cast("string")))
    return j.select("request", "source", F.col("current").alias("final"), F.col("n").alias("hops"), "status", error.alias("error"), F.when(error.isNull(), F.col("html")).alias("html"))


def _domains() -> Column:
    """Domains of a source: of its address, and configured ones (article_hosts)."""
    return S.publisher_domains(T.host(F.col("url")), F.col("article_hosts"))


def collected(sources: DataFrame, captured: DataFrame, since: Column, limit: int = 12, least: int = 2) -> DataFrame:
    """source, kind (web_article, web_snapshot), url, title, text, media, published, discovered_from, error: the items
    of sources (source, url, article_hosts, tags, web_mode); sources that can't be read have a row with their error."""
    s = sources.select("source", "url", _domains().alias("domains"), ((F.coalesce("web_mode", F.lit("")) == "snapshot") | F.coalesce(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in SNAPSHOT_TAGS])), F.lit(False))).alias("snapshot"))
    index = settled(followed(s.select(F.col("source").alias("request"), "source", "url", "domains"), captured), "index")
    numbered = index.where("error IS NULL").select(F.monotonically_increasing_id().alias("page_id"), "source", F.col("final").alias("url"), "html")
    numbered = settled(numbered, "indexes")
    ask = numbered.join(s.where("NOT snapshot").select("source", "domains"), "source")
    found = W.discover(ask.select("page_id", "url", "html"), limit, least).join(ask.select("page_id", "source", "domains", F.col("url").alias("from")), "page_id")
    wanted = settled(found.select(F.concat_ws(" ", F.col("page_id").cast("string"), "link").alias("request"), "source", F.col("link").alias("url"), "domains", "from", "place"), "articles")
    got = followed(wanted, captured).where("error IS NULL").join(wanted.select("request", "from", "place"), "request")
    read = _read(got.select(F.col("final").alias("url"), "html", "source", "from", "place"))
    when = T.parse_stamp(F.col("published"))
    articles = read.where((when.isNull() | (when >= since)) & (F.col("text") != "")).withColumn("kind", F.lit("web_article"))
    once = F.row_number().over(Window.partitionBy("source", "url").orderBy("place"))  # two links may end in one page
    articles = settled(articles.withColumn("_n", once).where("_n = 1").select("source", "kind", "url", "title", "text", "media", "published", F.col("from").alias("discovered_from")), "collected")
    rest = numbered.join(articles.select("source").distinct(), "source", "left_anti")
    whole = _read(rest.select("url", "html", "source")).where("text <> ''").select("source", F.lit("web_snapshot").alias("kind"), "url", "title", "text", "media", "published", F.lit(None).cast("string").alias("discovered_from"))
    bad = index.where("error IS NOT NULL").select("source", "error")
    return articles.unionByName(whole).withColumn("error", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


def _read(rows: DataFrame) -> DataFrame:
    """rows (url, html, ...) with the fields of their pages."""
    numbered = settled(rows.withColumn("page_id", F.monotonically_increasing_id()), "pages")
    return numbered.drop("html").join(W.article_fields(numbered), "page_id").drop("page_id")


def feed_items(entries: DataFrame, sources: DataFrame, captured: DataFrame, since: Column) -> DataFrame:
    """source, post_id, url, title, text, media, published, author: the entries of feeds (rows of connectors.parse) from
    since on, undated ones too, each with its article where the publisher's allowlist lets it be read.

    The longer text counts; the feed's own title and time come first. An entry whose address isn't the publisher's keeps
    its text and points to the feed; one whose article can't be read stays as it is.
    """
    s = sources.select("source", F.col("url").alias("feed"), _domains().alias("domains"))
    e = entries.where("error IS NULL").join(s, "source").withColumn("when", T.parse_stamp(F.col("published"))).where(F.col("when").isNull() | (F.col("when") >= since))
    e = e.withColumn("link", F.coalesce(F.nullif(F.trim("url"), F.lit("")), F.col("feed")))
    e = settled(e.withColumn("own", F.coalesce(S.publisher_allowed(F.col("link"), F.col("domains")), F.lit(False))).select("source", "post_id", "link", "feed", "domains", "own", "title", "text", "media", "published", "author"), "entries")
    ask = e.where("own").select(F.concat_ws(" ", "source", "link").alias("request"), "source", F.col("link").alias("url"), "domains").dropDuplicates(["request"])
    got = followed(ask, captured).where("error IS NULL").join(ask.select("request", F.col("url").alias("link")), "request")
    read = _read(got.select(F.col("final").alias("url"), "html", "source", "link")).select("source", "link", F.col("url").alias("a_url"), F.col("title").alias("a_title"), F.col("text").alias("a_text"), F.col("media").alias("a_media"), F.col("published").alias("a_published"))
    j = e.join(read, ["source", "link"], "left")
    text, article = T.clean(F.coalesce("text", F.lit(""))), T.clean(F.coalesce("a_text", F.lit("")))
    blank = lambda c: F.nullif(T.clean(F.coalesce(c, F.lit(""))), F.lit(""))
    return j.select(
        "source", "post_id", F.coalesce("a_url", F.when(F.col("own"), F.col("link")).otherwise(F.col("feed"))).alias("url"), F.coalesce(blank("title"), blank("a_title"), F.lit("")).alias("title"), F.when(F.char_length(article) > F.char_length(text), article).otherwise(text).alias("text"),
        F.coalesce("a_media", "media").alias("media"), F.coalesce("published", "a_published").alias("published"), "author")
