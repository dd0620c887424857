"""Typed views of the driver's tables: items, registry, source state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.plans import policy as P
from corvane.session import table


def pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n + 1).cast("int"))


def number(source: Column) -> Column:
    return F.substring(source, 4, 9).cast("int")


def registry_columns(n: Column) -> dict[str, Column]:
    return {"grp": pick(P.GROUPS, n % 7), "perspective": pick(P.PERSPECTIVES, n % 3)}


def items(spark: SparkSession, sf: str) -> DataFrame:
    """Publications: documents with a publication time (events), labels as trust, and derived attributes."""
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    lab = table(spark, sf, "labels").withColumnRenamed("doc_id", "l_id")
    i = F.col("doc_id")
    n = number(F.col("source"))
    tags = F.array_compact(F.array(*[F.when(i % k == 0, F.lit(t)) for k, t in ((5, "map"), (7, "precise-location"), (9, "operational-position"), (4, "drones"), (6, "logistics"))]))
    scheme = F.when(i % 13 == 0, "ftp://").when(i % 11 == 0, "https://user:pw@").otherwise("https://")
    media = F.array_compact(F.array(F.concat(F.lit("https://img.example.net/"), i.cast("string")), F.when(i % 3 == 0, F.concat(F.lit("https://img.example.net/"), i.cast("string"))), F.when(i % 4 == 0, F.lit("/relative.png")), F.when(i % 2 == 0, F.concat(F.lit("http://cdn.example.org/v/"), i.cast("string"))), F.when(i % 5 == 0, F.lit("https://img.example.net/last"))))
    trust = F.when(F.col("toxic").isNull(), "unknown").when(F.col("toxic") == 1, "low").when(F.col("quality") == 1, "high").otherwise("medium")
    published = F.when(i % 17 != 0, F.col("ts"))
    collected = F.col("ts") + F.make_dt_interval(hours=(i % 48).cast("int"))
    out = d.join(e, e.event_id == i * 5).join(lab, F.col("l_id") == i, "left").select(
        i.alias("item_id"), "source", F.concat(F.lit("Feed "), "source").alias("source_name"), pick(P.PLATFORMS, i % 4).alias("platform"), *[c.alias(k) for k, c in registry_columns(n).items()],
        trust.alias("trust"), published.alias("published"), collected.alias("collected"), F.substring("text", 1, 60).alias("title"), "text", F.col("lang").alias("language"),
        F.concat(scheme, F.lit("www."), "source", F.lit(".example.com/"), "lang", F.lit("/"), i.cast("string"), F.when(i % 2 == 0, F.lit("?page=2#top")).otherwise("")).alias("url"), tags.alias("tags"), media.alias("media"))
    stamp = F.coalesce("published", "collected")
    return out.withColumns({"event_ts": stamp, "stamp": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'"), "utc_day": F.to_date(stamp), "local_day": F.to_date(F.from_utc_timestamp(stamp, P.ZONE))})


def captures(spark: SparkSession, sf: str) -> DataFrame:
    """Items as they were captured: with HTML, author and the payload that their platform sent (keys in no order)."""
    i, quoted = F.col("item_id"), lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    n = i.cast("string")
    payload = (F.when(F.col("platform") == "telegram", F.concat(F.lit('{"views": '), n, F.lit(', "post": '), quoted(F.concat("source", F.lit("/"), n)), F.lit("}")))
               .when(F.col("platform") == "x", F.concat(F.lit('{"tweet": {"text": null, "id": '), quoted(n), F.lit('}, "collected_via": '), F.when(i % 3 == 0, F.lit("null")).otherwise(F.lit('"search"')), F.lit("}")))
               .when(F.col("platform") == "rss", F.concat(F.lit('{"link": "https://feed/'), n, F.lit('", "id": '), F.when(i % 4 == 2, F.lit('""')).otherwise(quoted(n)), F.lit(', "guid": '), quoted(F.concat(F.lit("g"), n)), F.lit("}"))))
    web = F.when(i % 8 == 3, F.lit('{"content_type": "text/html", "Étag": [1, {"b": true, "a": null}]}'))
    return items(spark, sf).withColumns({"raw": F.coalesce(payload, web), "html": F.concat(F.lit("<p>"), F.substring("text", 1, 20), F.lit("</p>")), "author": F.concat(F.lit("Author "), (i % 7).cast("string"))})


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """The source dimension: one row per source of documents."""
    n = number(F.col("source"))
    return table(spark, sf, "documents").select("source").distinct().select(
        "source", n.alias("n"), pick(P.PLATFORMS, n % 4).alias("platform"), *[c.alias(k) for k, c in registry_columns(n).items()], (n * 5 % 101).alias("priority"), (n % 10 != 0).alias("enabled"),
        F.when(n % 5 != 0, n % 5 * 10).alias("cadence"), F.concat(F.lit("https://www."), "source", F.lit(".example.com/@user"), n.cast("string"), F.lit("/?x=1#y")).alias("url"))


def source_state(spark: SparkSession, sf: str) -> DataFrame:
    """Per-source state: the latest event's status and the last success; two sources have none and two ids are unknown."""
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    k = F.col("user_id") % 20
    sid = F.when(k == 3, "src93").when(k == 5, "src95").otherwise(F.concat(F.lit("src"), k.cast("string")))
    last = F.max_by("event_type", F.struct("ts", "event_id"))
    s = e.groupBy(sid.alias("source")).agg(last.alias("kind"), F.max("ts").alias("checked"), F.max(F.when(F.col("event_type") != "error", F.col("ts"))).alias("last_success"), F.count(F.lit(1)).alias("fetched"), F.count_if(F.col("event_type") == "purchase").alias("added"))
    status = F.when(F.col("kind") == "error", "error").when(F.col("kind") == "signup", "skipped_config").when(F.col("kind") == "view", "skipped_cadence").otherwise("ok")
    return s.select("source", status.alias("status"), "checked", "last_success", "fetched", "added")


# --- the same views for the SQL oracle ---


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


ITEMS = f"""items AS (
 SELECT *, coalesce(published, collected) AS event_ts, strftime(coalesce(published, collected), '%Y-%m-%dT%H:%M:%SZ') AS stamp, CAST(coalesce(published, collected) AS DATE) AS utc_day,
  CAST((coalesce(published, collected) AT TIME ZONE 'UTC') AT TIME ZONE '{P.ZONE}' AS DATE) AS local_day
 FROM (SELECT d.doc_id AS item_id, d.source, 'Feed ' || d.source AS source_name, {_list(P.PLATFORMS)}[1 + d.doc_id % 4] AS platform,
  {_list(P.GROUPS)}[1 + CAST(substr(d.source, 4) AS INT) % 7] AS grp, {_list(P.PERSPECTIVES)}[1 + CAST(substr(d.source, 4) AS INT) % 3] AS perspective,
  CASE WHEN l.toxic IS NULL THEN 'unknown' WHEN l.toxic = 1 THEN 'low' WHEN l.quality = 1 THEN 'high' ELSE 'medium' END AS trust,
  CASE WHEN d.doc_id % 17 <> 0 THEN e.ts END AS published, e.ts + to_hours(CAST(d.doc_id % 48 AS INT)) AS collected, substr(d.text, 1, 60) AS title, d.text, d.lang AS language,
  CASE WHEN d.doc_id % 13 = 0 THEN 'ftp://' WHEN d.doc_id % 11 = 0 THEN 'https://user:pw@' ELSE 'https://' END || 'www.' || d.source || '.example.com/' || d.lang || '/' || d.doc_id || CASE WHEN d.doc_id % 2 = 0 THEN '?page=2#top' ELSE '' END AS url,
  list_filter([CASE WHEN d.doc_id % 5 = 0 THEN 'map' END, CASE WHEN d.doc_id % 7 = 0 THEN 'precise-location' END, CASE WHEN d.doc_id % 9 = 0 THEN 'operational-position' END, CASE WHEN d.doc_id % 4 = 0 THEN 'drones' END, CASE WHEN d.doc_id % 6 = 0 THEN 'logistics' END], lambda t: t IS NOT NULL) AS tags,
  list_filter(['https://img.example.net/' || d.doc_id, CASE WHEN d.doc_id % 3 = 0 THEN 'https://img.example.net/' || d.doc_id END, CASE WHEN d.doc_id % 4 = 0 THEN '/relative.png' END, CASE WHEN d.doc_id % 2 = 0 THEN 'http://cdn.example.org/v/' || d.doc_id END, CASE WHEN d.doc_id % 5 = 0 THEN 'https://img.example.net/last' END], lambda t: t IS NOT NULL) AS media
  FROM documents d JOIN events e ON e.event_id = d.doc_id * 5 LEFT JOIN labels l ON l.doc_id = d.doc_id))"""

#: The payload's canonical JSON, and what of it is public.
CAPTURES = """captures AS (SELECT *, '<p>' || substr(text, 1, 20) || '</p>' AS html, 'Author ' || (item_id % 7) AS author,
 CASE platform WHEN 'telegram' THEN '{"post":"' || source || '/' || item_id || '","views":' || item_id || '}'
  WHEN 'x' THEN '{"collected_via":' || CASE WHEN item_id % 3 = 0 THEN 'null' ELSE '"search"' END || ',"tweet":{"id":"' || item_id || '","text":null}}'
  WHEN 'rss' THEN '{"guid":"g' || item_id || '","id":"' || CASE WHEN item_id % 4 = 2 THEN '' ELSE CAST(item_id AS VARCHAR) END || '","link":"https://feed/' || item_id || '"}'
  ELSE CASE WHEN item_id % 8 = 3 THEN '{"content_type":"text/html","Étag":[1,{"a":null,"b":true}]}' ELSE 'null' END END AS canon,
 CASE platform WHEN 'telegram' THEN '{"post":"' || source || '/' || item_id || '"}'
  WHEN 'x' THEN CASE WHEN item_id % 3 = 0 THEN '{' ELSE '{"collected_via":"search",' END || '"tweet_id":"' || item_id || '"}'
  WHEN 'rss' THEN '{"entry_id":"' || CASE WHEN item_id % 4 = 2 THEN 'g' ELSE '' END || item_id || '","entry_link":"https://feed/' || item_id || '"}'
  ELSE CASE WHEN item_id % 8 = 3 THEN '{"content_type":"text/html"}' ELSE '{}' END END AS identity FROM items)"""

REGISTRY = f"""registry AS (
 SELECT source, n, {_list(P.PLATFORMS)}[1 + n % 4] AS platform, {_list(P.GROUPS)}[1 + n % 7] AS grp, {_list(P.PERSPECTIVES)}[1 + n % 3] AS perspective, n * 5 % 101 AS priority, n % 10 <> 0 AS enabled,
  CASE WHEN n % 5 <> 0 THEN n % 5 * 10 END AS cadence, 'https://www.' || source || '.example.com/@user' || n || '/?x=1#y' AS url
 FROM (SELECT DISTINCT source, CAST(substr(source, 4) AS INT) AS n FROM documents))"""

STATE = """state AS (
 SELECT source, CASE kind WHEN 'error' THEN 'error' WHEN 'signup' THEN 'skipped_config' WHEN 'view' THEN 'skipped_cadence' ELSE 'ok' END AS status, checked, last_success, fetched, added
 FROM (SELECT CASE user_id % 20 WHEN 3 THEN 'src93' WHEN 5 THEN 'src95' ELSE 'src' || (user_id % 20) END AS source, arg_max(event_type, struct_pack(a := ts, b := event_id)) AS kind, max(ts) AS checked,
  max(CASE WHEN event_type <> 'error' THEN ts END) AS last_success, count(*) AS fetched, count(*) FILTER (event_type = 'purchase') AS added FROM events GROUP BY 1))"""
