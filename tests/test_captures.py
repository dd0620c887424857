"""The web connector: redirects under the allowlist, articles, snapshots, errors."""

from datetime import datetime

from pyspark.sql import functions as F

from corvane.sources import captures as K

CAPTURE = "url string, status int, location string, html string"


def follow(spark, rows, ask, domains=("a.b",)):
    req = spark.createDataFrame([(str(k), "s", u, list(domains)) for k, u in enumerate(ask)], "request string, source string, url string, domains array<string>")
    got = {int(r.request): (r.final, r.hops, r.error) for r in K.followed(req, spark.createDataFrame(rows, CAPTURE)).collect()}
    return [got[k] for k in range(len(ask))]


def test_redirects(spark):
    chain = [(f"https://a.b/{k}", 302, f"/{k - 1}", None) for k in range(1, 9)] + [("https://a.b/0", 200, None, "<p>x</p>")]
    rows = [*chain, ("https://a.b/out", 301, "https://evil.c/", None), ("https://evil.c/", 200, None, "x"), ("https://a.b/up", 301, "https://w.a.b/x#f", None), ("https://w.a.b/x", 404, None, None), ("https://a.b/no", 302, None, "<p>y</p>"), ("https://a.b/me", 302, "me", None), ("https://a.b/http", 302, "http://a.b/0", None), ("https://a.b/user", 302, "https://u:p@a.b/0", None)]
    got = follow(spark, rows, ["https://a.b/0", "https://a.b/5", "https://a.b/6", "https://a.b/out", "https://a.b/up", "https://a.b/no", "https://a.b/me", "https://a.b/http", "https://a.b/user", "https://a.b/none", "https://xa.b/", None])
    assert got == [
        ("https://a.b/0", 0, None), ("https://a.b/0", 5, None), ("https://a.b/0", 6, "redirect_error"), ("https://evil.c/", 1, "unsafe_destination"), ("https://w.a.b/x", 1, "http_404"), ("https://a.b/no", 0, None), ("https://a.b/me", 6, "redirect_error"),
        ("http://a.b/0", 1, "unsafe_destination"), ("https://u:p@a.b/0", 1, "unsafe_destination"), ("https://a.b/none", 0, "not_captured"), ("https://xa.b/", 0, "unsafe_destination"), (None, 0, "unsafe_destination"),
    ]


def test_the_last_response_counts(spark):
    df = spark.createDataFrame([("https://a.b/", 200, None, "old", datetime(2026, 1, 1)), ("https://a.b/", 500, None, "new", datetime(2026, 1, 2)), (None, 200, None, "x", None)], CAPTURE + ", fetched timestamp")
    assert [(r.url, r.status, r.html) for r in K.responses(df).collect()] == [("https://a.b/", 500, "new")]


def test_articles_or_snapshot(spark):
    page = lambda body, time="": f"<title>T</title>{time and f'<time datetime={time!r}></time>'}<main>{body}</main>"
    link = lambda *paths: "".join(f"<article><a href='{p}'>a label of more than 24 characters</a></article>" for p in paths)
    rows = [
        ("https://a.b/news", 302, "/news/", None), ("https://a.b/news/", 200, None, page("index " + link("/news/one", "/news/two", "/news/old", "/news/away", "/news/empty", "/news/gone", "/news/same"))),
        ("https://a.b/news/one", 200, None, page("<p>one</p>", "2026-01-05T00:00:00Z")), ("https://a.b/news/two", 301, "/news/one", None), ("https://a.b/news/old", 200, None, page("<p>old</p>", "2025-01-05T00:00:00Z")), ("https://a.b/news/away", 302, "https://evil.c/", None), ("https://a.b/news/empty", 200, None, ""), ("https://a.b/news/gone", 410, None, ""), ("https://a.b/news/same", 200, None, page("<p>undated</p>")),
        ("https://m.b/", 200, None, page("map " + link("/news/x"))), ("https://m.b/news/x", 200, None, page("<p>x</p>")), ("https://n.b/", 200, None, page("only an index")), ("https://e.b/", 200, None, ""), ("https://d.b/", 503, None, "x"),
    ]
    sources = [("a", "https://a.b/news", None, [], None), ("m", "https://m.b/", None, ["maps"], None), ("n", "https://n.b/", None, None, None), ("e", "https://e.b/", None, [], None), ("d", "https://d.b/", None, [], None), ("q", "https://q.b/", None, [], None)]
    s = spark.createDataFrame(sources, "source string, url string, article_hosts array<string>, tags array<string>, web_mode string")
    got = sorted((r.source, r.kind, r.url, r.text and r.text.split()[-1], r.discovered_from, r.error) for r in K.collected(s, spark.createDataFrame(rows, CAPTURE), F.lit("2026-01-01").cast("timestamp")).collect() if r.source not in "m")
    assert got == [
        ("a", "web_article", "https://a.b/news/one", "one", "https://a.b/news/", None), ("a", "web_article", "https://a.b/news/same", "undated", "https://a.b/news/", None),
        ("d", None, None, None, None, "http_503"), ("n", "web_snapshot", "https://n.b/", "index", None, None), ("q", None, None, None, None, "not_captured"),
    ]
    maps = K.collected(s.where("source = 'm'"), spark.createDataFrame(rows, CAPTURE), F.lit("2026-01-01").cast("timestamp")).collect()
    assert [(r.kind, r.url) for r in maps] == [("web_snapshot", "https://m.b/")]


def test_feeds_with_their_articles(spark):
    entry = lambda k, **kw: {"source": "f", "post_id": str(k), "url": f"https://a.b/{k}", "published": "2026-01-05T00:00:00Z", "title": f"t{k}", "text": "short", "media": [], "author": "me", "error": None} | kw
    rows = [entry(1), entry(2, published="2025-01-01T00:00:00Z"), entry(3, url="https://evil.c/3"), entry(4, text="a text that is longer than its article"), entry(5, title="", published=None), entry(6), entry(7, error="ParseError: invalid_payload"), entry(8, url=None)]
    entries = spark.createDataFrame([tuple(r.values()) for r in rows], "source string, post_id string, url string, published string, title string, text string, media array<string>, author string, error string")
    sources = spark.createDataFrame([("f", "https://feed.a.b/rss", None)], "source string, url string, article_hosts array<string>")
    article = "<title>from the page</title><time datetime='2026-01-06T00:00:00Z'></time><main><p>the article, which says more</p><img src='/i.png'></main>"
    captured = [("https://a.b/1", 301, "/one", None), ("https://a.b/one", 200, None, article), ("https://a.b/4", 200, None, "<p>less</p>"), ("https://a.b/5", 200, None, article), ("https://evil.c/3", 200, None, article)]
    got = {r.post_id: r for r in K.feed_items(entries, sources, spark.createDataFrame(captured, CAPTURE), F.lit("2026-01-01").cast("timestamp")).collect()}
    assert sorted(got) == ["1", "3", "4", "5", "6", "8"]
    assert (got["1"].url, got["1"].title, got["1"].media) == ("https://a.b/one", "t1", ["https://a.b/i.png"]) and "says more" in got["1"].text
    assert (got["3"].url, got["3"].text) == ("https://feed.a.b/rss", "short") and got["4"].text.startswith("a text") and (got["5"].title, got["5"].published) == ("from the page", "2026-01-06T00:00:00Z")
    assert (got["6"].url, got["6"].text) == ("https://a.b/6", "short") and got["8"].url == "https://feed.a.b/rss"
