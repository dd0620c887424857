"""Registry of the queries over the engine's own operators, each with the SQL that checks it."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import payload as N
from corvane.functions import text as T
from corvane.functions.canonical import canonicaliser
from corvane.operators import aggregates as A
from corvane.operators import derive as D
from corvane.operators import filters as S
from corvane.operators import joins as J
from corvane.operators import quality as X
from corvane.operators import schema as Y
from corvane.plans import clusters as C
from corvane.plans import documents as B
from corvane.plans import policy as P
from corvane.plans import reports as R
from corvane.plans import schemas as K
from corvane.plans import sql as Q
from corvane.plans import views as V
from corvane.session import settled, shared_dir, table
from corvane.sources import artifact as L
from corvane.sources import captures as G
from corvane.sources import pages as W
from corvane.sources import store
from corvane.sources.archive import duplicate_keys
from corvane.sources.key_index import KeyIndex
from corvane.streaming import source_state as Z

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
DAY = date(2024, 1, 6)


def now():
    return F.lit(P.NOW).cast("timestamp")



def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _items(body: str) -> str:
    return f"WITH {V.ITEMS} {body}"


def _reg(body: str) -> str:
    return f"WITH {V.REGISTRY}, {V.STATE} {body}"


def joined(c):  # an array as text, for comparison
    return F.array_join(c, ",")


# --- scans and time ---


@query(_items("SELECT item_id, stamp FROM items WHERE utc_day = DATE '2024-01-06'"))
def scan_utc_day(spark, sf) -> DataFrame:
    return V.items(spark, sf).where(F.col("utc_day") == F.lit(DAY)).orderBy(F.col("stamp").desc(), "item_id").select("item_id", "stamp")


@query(_items("SELECT item_id, local_day FROM items WHERE local_day = DATE '2024-01-06'"))
def local_day_filter(spark, sf) -> DataFrame:
    return S.local_day(V.items(spark, sf), DAY, P.ZONE).select("item_id", "local_day")


@query(_items("SELECT item_id, local_day FROM items WHERE local_day BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'"))
def day_range_prune(spark, sf) -> DataFrame:
    return S.local_days(V.items(spark, sf), date(2024, 1, 3), date(2024, 1, 9), P.ZONE).select("item_id", "local_day")


@query(_items("SELECT local_day, count(*) AS n FROM items WHERE local_day BETWEEN DATE '2023-12-30' AND DATE '2024-01-05' GROUP BY 1"))
def history_days(spark, sf) -> DataFrame:
    return S.local_days(V.items(spark, sf), date(2023, 12, 30), date(2024, 1, 5), P.ZONE).groupBy("local_day").agg(F.count(F.lit(1)).alias("n"))


@query(_items("SELECT CAST(d AS DATE) AS day, count(i.item_id) AS n FROM range(DATE '2023-12-28', DATE '2024-02-06', INTERVAL 1 DAY) t(d) LEFT JOIN items i ON i.local_day = CAST(d AS DATE) GROUP BY 1"))
def calendar_zero_fill(spark, sf) -> DataFrame:
    return A.zero_filled(V.items(spark, sf), "local_day", "2023-12-28", "2024-02-05")


@query(_items("SELECT max(utc_day) AS latest, count(DISTINCT utc_day) AS days FROM items"))
def latest_partition(spark, sf) -> DataFrame:
    return V.items(spark, sf).agg(F.max("utc_day").alias("latest"), F.count_distinct("utc_day").alias("days"))


@query(_items("SELECT item_id, count(*) AS n FROM (SELECT item_id FROM items UNION ALL SELECT doc_id FROM labels) GROUP BY 1 HAVING count(*) > 1"))
def archive_id_scan(spark, sf) -> DataFrame:
    both = V.items(spark, sf).select("item_id").unionByName(table(spark, sf, "labels").select(F.col("doc_id").alias("item_id")))
    return duplicate_keys(both, "item_id")


# --- filters ---


@query(_reg("SELECT source, priority FROM registry WHERE enabled AND grp IN ('osint', 'international-media', 'ua-media-bloggers') AND platform IN ('telegram', 'web', 'x')"))
def source_select(spark, sf) -> DataFrame:
    return S.select_sources(V.registry(spark, sf), ["osint", "international-media", "ua-media-bloggers"], ["telegram", "web", "x"]).orderBy(F.col("priority").desc(), "source").select("source", "priority")


@query(_reg("SELECT t.s AS source FROM (VALUES ('src1'), ('src77'), ('nobody')) t(s) WHERE t.s NOT IN (SELECT source FROM registry)"))
def unknown_sources(spark, sf) -> DataFrame:
    return S.unknown_ids(V.registry(spark, sf), ["src1", "src77", "nobody"])


_MINUTES = "greatest(1, coalesce(r.cadence, CASE r.platform WHEN 'telegram' THEN 15 WHEN 'x' THEN 15 WHEN 'rss' THEN 60 WHEN 'web' THEN 1440 END, 15))"


@query(_reg(f"SELECT r.source, {_MINUTES} AS minutes FROM registry r"))
def cadence_minutes(spark, sf) -> DataFrame:
    return V.registry(spark, sf).select("source", S.cadence_minutes(F.col("cadence"), F.col("platform"), P.CADENCE, P.POLL_SECONDS).alias("minutes"))


@query(_reg(f"SELECT r.source, (s.last_success IS NULL OR TIMESTAMP '{P.NOW}' >= s.last_success + to_minutes({_MINUTES})) AS due FROM registry r LEFT JOIN state s USING (source)"))
def cadence_due(spark, sf) -> DataFrame:
    j = V.registry(spark, sf).join(V.source_state(spark, sf), "source", "left")
    return j.select("source", S.is_due(now(), F.col("last_success"), S.cadence_minutes(F.col("cadence"), F.col("platform"), P.CADENCE, P.POLL_SECONDS)).alias("due"))


@query(_reg("SELECT source, CASE WHEN platform = 'x' THEN 'skipped_config' ELSE 'due' END AS action FROM registry WHERE enabled"))
def missing_credential(spark, sf) -> DataFrame:
    return S.select_sources(V.registry(spark, sf)).select("source", F.when(S.lacks_credential(F.col("platform"), ["x"], []), "skipped_config").otherwise("due").alias("action"))


@query(_items("SELECT item_id FROM items WHERE published IS NULL OR published >= TIMESTAMP '2024-01-08 00:00:00'"))
def lookback(spark, sf) -> DataFrame:
    return V.items(spark, sf).where(S.within_lookback(F.col("published"), F.lit("2024-01-08 00:00:00").cast("timestamp"))).select("item_id")


_HOURS = "greatest(24.0, CASE WHEN grp IN ('ua-media-bloggers', 'ru-milbloggers') THEN 48.0 ELSE 0 END, CASE WHEN list_contains(tags, 'precise-location') THEN 72.0 ELSE 0 END, CASE WHEN list_contains(tags, 'operational-position') THEN 96.0 ELSE 0 END, CASE WHEN source = 'src7' THEN 120.0 ELSE 0 END)"


def _hours():
    return D.storage_delay(F.col("grp"), F.col("tags"), F.col("source"), P.DELAY_DEFAULT, P.DELAY_BY_GROUP, P.DELAY_BY_TAG, P.DELAY_BY_SOURCE)


@query(_items(f"SELECT item_id, CAST({_HOURS} AS DOUBLE) AS hours FROM items"))
def storage_delay(spark, sf) -> DataFrame:
    return V.items(spark, sf).select("item_id", _hours().alias("hours"))


@query(_items(f"SELECT item_id, CASE WHEN published IS NULL THEN 'withheld_undated' WHEN epoch_us(TIMESTAMP '2024-01-10 12:00:00') - epoch_us(published) < {_HOURS} * 3600000000 THEN 'withheld_recent' ELSE 'storable' END AS state FROM items"))
def embargo_state(spark, sf) -> DataFrame:
    return V.items(spark, sf).select("item_id", S.embargo_state(F.col("published"), F.lit("2024-01-10 12:00:00").cast("timestamp"), _hours()).alias("state"))


@query(_items("SELECT item_id, list_has_any(tags, ['precise-location', 'operational-position']) AS sensitive, list_has_any(tags, ['operational-position']) AS redacted FROM items"))
def sensitive_filter(spark, sf) -> DataFrame:
    t = F.col("tags")
    return V.items(spark, sf).select("item_id", S.tagged(t, P.SENSITIVE_TAGS).alias("sensitive"), S.tagged(t, P.REDACT_TAGS).alias("redacted"))


@query(_items("SELECT item_id FROM items WHERE regexp_matches(url, '^https?://[^/?#@\\s]+([/?#]|$)')"))
def public_url_valid(spark, sf) -> DataFrame:
    return V.items(spark, sf).where(T.public_url(F.col("url"))).select("item_id")


@query("SELECT page_id, (starts_with(url, 'https://') AND (h = p OR h LIKE '%.' || p OR h = 'www.' || p OR h = 'spam-farm.example.org')) AS allowed FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS h, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '^(www|m|blog)\\.', '') AS p FROM pages)")
def publisher_allowed(spark, sf) -> DataFrame:
    p = table(spark, sf, "pages").withColumn("site", F.regexp_replace(T.host(F.col("url")), r"^(www|m|blog)\.", ""))
    domains = S.publisher_domains(F.concat(F.lit("www."), "site"), F.array(F.lit("spam-farm.example.org"), F.lit("not a host")))
    return p.select("page_id", S.publisher_allowed(F.col("url"), domains).alias("allowed"))


@query(_items("SELECT item_id FROM items WHERE list_contains(tags, 'map')"))
def map_items(spark, sf) -> DataFrame:
    return V.items(spark, sf).where(S.tagged(F.col("tags"), ["map", "maps"])).select("item_id")


@query(_items("SELECT item_id FROM items WHERE contains(lower(concat_ws(' ', title, source_name, platform, grp)), 'ering') AND platform = 'rss'"))
def card_search(spark, sf) -> DataFrame:
    return S.card_search(V.items(spark, sf), "Ering", "rss").select("item_id")


_PATHS = ["data/raw/2024/01/{0}/items.ndjson", "data/state.json", "../etc/passwd", "reports/daily/2024-01-{0}.md", "data/raw/2024-01-{0}.ndjson", "data/errors/2024/01/{0}/errors.ndjson", "data/raw/2024/01/{0}/errors.ndjson", "reports/weekly/2024-01-{0}.md", "data//state.json", "/data/state.json", "reports/./summary/{0}.md", "reports/daily/2024-01-{0}.md/", "data/raw/./2024/01/{0}/items.ndjson"]
_PATH = "[" + ", ".join("'" + p.replace("{0}", "' || lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') || '") + "'" for p in _PATHS) + f"][1 + p_partkey % {len(_PATHS)}]"
_SAFE_PATH = "CASE WHEN NOT regexp_matches(path, '^/') AND NOT list_contains(string_split(path, '/'), '..') THEN array_to_string(list_filter(string_split(path, '/'), lambda p: p NOT IN ('', '.')), '/') END"


@query(f"SELECT p_partkey, path, coalesce(regexp_matches(safe, '^(data/raw/\\d{{4}}/\\d\\d/\\d\\d/items\\.ndjson|data/errors/\\d{{4}}/\\d\\d/\\d\\d/errors\\.ndjson|data/state\\.json|reports/daily/\\d{{4}}-\\d\\d-\\d\\d\\.md)$'), FALSE) AS allowed, coalesce(regexp_matches(safe, '^(reports/summary|reports/weekly)(/|$)'), FALSE) AS ignored FROM (SELECT *, {_SAFE_PATH} AS safe FROM (SELECT p_partkey, {_PATH} AS path FROM part))")
def artifact_path_allowed(spark, sf) -> DataFrame:
    day = F.lpad((1 + F.col("p_partkey") % 28).cast("string"), 2, "0")
    path = F.element_at(F.array(*[F.replace(F.lit(p), F.lit("{0}"), day) for p in _PATHS]), (1 + F.col("p_partkey") % len(_PATHS)).cast("int"))
    return table(spark, sf, "part").select("p_partkey", path.alias("path")).withColumns({"allowed": S.artifact_allowed(F.col("path")), "ignored": S.artifact_ignored(F.col("path"))})


@query(_items("SELECT DISTINCT d AS day FROM (SELECT CAST(DATE '2024-01-12' - CAST(k AS INT) AS DATE) AS d, k FROM range(0, 8) t(k)) WHERE k <= 1 OR (day(d) % 3 <> 0 AND d IN (SELECT utc_day FROM items))"))
def report_recovery_days(spark, sf) -> DataFrame:
    days = V.items(spark, sf).select(F.col("utc_day").alias("day")).distinct()
    reports = days.where(F.dayofmonth("day") % 3 == 0)
    return S.recovery_days(reports, days, date(2024, 1, 12))


# --- projections ---


@query(_items("SELECT item_id, substr(sha256(concat_ws(chr(10), CASE WHEN platform = 'x' THEN 'x' ELSE source END, url, coalesce(strftime(published, '%Y-%m-%dT%H:%M:%SZ'), ''), trim(regexp_replace(coalesce(nullif(text, ''), title, ''), '\\s+', ' ', 'g')))), 1, 24) AS id FROM items"))
def stable_id(spark, sf) -> DataFrame:
    i = V.items(spark, sf)
    return i.select("item_id", D.stable_id(i).alias("id"))


@query(_items("SELECT item_id, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS h FROM items"))
def clean_text(spark, sf) -> DataFrame:
    return V.items(spark, sf).select("item_id", F.sha2(T.clean(F.col("text")), 256).alias("h"))


@query(_items("SELECT item_id, array_to_string(list_concat(tags, list_sort(list_filter(['precise-location', 'drones', 'aerial'], lambda t: NOT list_contains(tags, t)))), ',') AS tags FROM items"))
def tag_merge(spark, sf) -> DataFrame:
    found = F.array(F.lit("precise-location"), F.lit("drones"), F.lit("aerial"))
    return V.items(spark, sf).select("item_id", joined(D.merge_tags(F.col("tags"), found)).alias("tags"))


@query("SELECT o_orderkey, abs(lat) <= 90 AND abs(lon) <= 180 AS located FROM (SELECT o_orderkey, CAST(printf('%.4f', 10.5 + o_orderkey % 89) AS DOUBLE) AS lat, CAST(printf('%.4f', 10.5 + o_custkey % 240) AS DOUBLE) AS lon FROM orders)")
def detect_location(spark, sf) -> DataFrame:
    number = lambda c, m: F.format_string("%.4f", 10.5 + F.col(c) % m)
    text = F.concat(F.lit("seen at "), number("o_orderkey", 89), F.lit(", "), number("o_custkey", 240), F.lit(" today"))
    return table(spark, sf, "orders").select("o_orderkey", F.array_contains(D.sensitive_tags(text, "(?i)position|convoy"), "precise-location").alias("located"))


@query(_items(f"SELECT item_id, length(text) AS original_chars, length(text) > {P.EXCERPT} AS truncated, len(media) AS media_count, substr(text, 1, {P.EXCERPT}) AS excerpt, '' AS html FROM items"))
def excerpt_projection(spark, sf) -> DataFrame:
    return D.public_projection(V.items(spark, sf), P.EXCERPT, P.MEDIA_LIMIT).select("item_id", "original_chars", "truncated", "media_count", "excerpt", "html")


_ID = "substr(sha256(concat_ws(chr(10), {0}, {1}, coalesce(strftime(published, '%Y-%m-%dT%H:%M:%SZ'), ''){2})), 1, 24)"
_SCRUB = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^([a-zA-Z]+://)[^/@]*@', '\\1')"
_PUBLIC = "regexp_matches(url, '^https?://[^/?#]')"
_SHORT = f"CASE WHEN NOT {_PUBLIC} THEN '' WHEN platform IN ('telegram', 'x') THEN {_SCRUB} ELSE regexp_extract(url, '^([a-zA-Z]+://)', 1) || regexp_extract({_SCRUB}, '^[a-zA-Z]+://([^/?#]*)', 1) || '/' END"
_HIDDEN = f"substr(sha256(concat_ws(chr(10), source, platform, CASE WHEN {_PUBLIC} THEN {_SCRUB} ELSE '' END, coalesce(strftime(published, '%Y-%m-%dT%H:%M:%SZ'), ''))), 1, 24)"


@query(_items(f"SELECT item_id, CASE WHEN hide THEN {_HIDDEN} ELSE {_ID.format("CASE WHEN platform = 'x' THEN 'x' ELSE source END", 'url', ", trim(regexp_replace(coalesce(nullif(text, ''), title, ''), '\\s+', ' ', 'g'))")} END AS public_id, CASE WHEN hide THEN short ELSE url END AS url, CASE WHEN hide THEN '' ELSE title END AS title, CASE WHEN hide THEN 0 ELSE length(text) END AS chars, CASE WHEN hide THEN 0 ELSE len(media) END AS n_media, hide AS redacted FROM (SELECT *, list_contains(tags, 'operational-position') AS hide, {_SHORT} AS short FROM items)"))
def redaction(spark, sf) -> DataFrame:
    return D.redact(V.items(spark, sf), P.REDACT_TAGS).select("item_id", "public_id", "url", "title", F.char_length("text").alias("chars"), F.size("media").alias("n_media"), "redacted")


@query(_items("SELECT item_id, array_to_string(list_transform(list_filter(list_zip(ok, range(len(ok))), lambda p: list_position(ok, p[1]) = p[2] + 1), lambda p: p[1]), ',') AS media FROM (SELECT item_id, list_filter(media, lambda u: regexp_matches(u, '^https?://')) AS ok FROM items)"))
def media_sanitize(spark, sf) -> DataFrame:
    return V.items(spark, sf).select("item_id", joined(D.safe_media(F.col("media"))).alias("media"))


@query(_items(f"SELECT item_id, {_SCRUB} AS url FROM items"))
def url_scrub(spark, sf) -> DataFrame:
    return V.items(spark, sf).select("item_id", T.scrubbed(F.col("url")).alias("url"))


@query(_reg("SELECT source, regexp_extract(url, '^https?://[^/]+/@?([^/?#]+)', 1) AS handle FROM registry"))
def source_handle(spark, sf) -> DataFrame:
    return V.registry(spark, sf).select("source", T.handle(F.col("url")).alias("handle"))


# what an error must come out as, case by case
_ERRORS = [
    ("Timeout", "read timed out", "timeout"), ("TooManyRedirects", "30", "redirect_error"), ("SSLError", "certificate", "tls_error"), ("ConnectionError", "refused", "connection_error"),
    ("HTTPError", "status 403 here", "http_403"), ("HTTPError", "none", "http_error"), ("JSONDecodeError", "line 1", "invalid_json"), ("CollectionError", "X API 429: slow down", "x_api_http_429"),
    ("CollectionError", "X API answered nothing", "x_api_error"), ("CollectionError", "said X API 429", "collection_error"), ("CollectionError", "DNS lookup failed", "dns_error"),
    ("CollectionError", "private destination 10.0.0.1", "unsafe_destination"), ("CollectionError", "unsafe URL", "unsafe_destination"), ("CollectionError", "cross-host redirect", "cross_host_redirect"),
    ("CollectionError", "too many redirects", "redirect_error"), ("CollectionError", "token not configured", "missing_configuration"), ("CollectionError", "something else", "collection_error"),
    ("gaierror", "dns lookup", "unexpected_error"), ("RuntimeError", "secret", "unexpected_error"),
]


def _cases(k: int) -> str:
    return "[" + ", ".join(f"'{e[k]}'" for e in _ERRORS) + f"][1 + event_id % {len(_ERRORS)}]"


@query(f"SELECT event_id, {_cases(0)} || ': ' || {_cases(2)} AS error FROM events")
def error_category(spark, sf) -> DataFrame:
    i = F.col("event_id") % len(_ERRORS)
    return table(spark, sf, "events").select("event_id", D.error_category(V.pick([e[0] for e in _ERRORS], i), V.pick([e[1] for e in _ERRORS], i)).alias("error"))


@query(_items("SELECT item_id, CASE WHEN list_contains(tags, 'map') THEN 'map' WHEN list_contains(tags, 'drones') THEN 'drones' WHEN list_contains(tags, 'logistics') THEN 'logistics' WHEN list_contains(tags, 'relief') THEN 'relief' WHEN grp = 'osint' THEN 'map' WHEN grp IN ('official-ua', 'official-ru') THEN 'official' ELSE 'other' END AS section FROM items"))
def section_choice(spark, sf) -> DataFrame:
    return V.items(spark, sf).select("item_id", _section().alias("section"))


def _section():
    return D.section(F.col("tags"), F.col("grp"), P.SECTIONS, {"osint": "map", "official-ua": "official", "official-ru": "official"})


@query(_items("SELECT item_id, CASE WHEN greatest(0, (epoch_us(TIMESTAMP '2024-01-12 00:00:00') - epoch_us(coalesce(collected, published))) / 3.6e9) < CASE WHEN list_has_any(tags, ['precise-location', 'operational-position']) THEN 72.0 ELSE 24.0 END THEN 'delayed' WHEN list_contains(tags, 'operational-position') THEN 'redacted' ELSE 'full' END AS mode FROM items"))
def publication_mode(spark, sf) -> DataFrame:
    t = F.col("tags")
    mode = D.publication_mode(F.col("collected"), F.col("published"), S.tagged(t, P.REDACT_TAGS), S.tagged(t, P.SENSITIVE_TAGS), F.lit("2024-01-12 00:00:00").cast("timestamp"), 24.0, 72.0)
    return V.items(spark, sf).select("item_id", mode.alias("mode"))


# first turns of conversations as queries, in their order; two sources of the registry have such an id already
@query("SELECT 'x-discovery-' || (conv_id + 1) AS source, trim(q) AS query, 'x' AS platform, conv_id IN (3, 5) AS collides FROM (SELECT conv_id, CASE WHEN conv_id % 4 = 1 THEN '  ' ELSE substr(text, 1, 30) END AS q FROM conversations WHERE turn = 0) WHERE trim(q) <> ''")
def virtual_sources(spark, sf) -> DataFrame:
    made = D.virtual_sources(_asked(spark, sf))
    known = V.registry(spark, sf).select("source").unionByName(spark.createDataFrame([("x-discovery-4",), ("x-discovery-6",)], "source string"))
    odd = X.collisions(known, made).select(F.col("key").alias("source"), F.lit(True).alias("collides"))
    return made.join(odd, "source", "left").withColumn("collides", F.coalesce("collides", F.lit(False)))


@query(_reg("SELECT coalesce(s.source, u.source) AS source, CASE WHEN u.source IS NOT NULL THEN u.status ELSE s.status END AS status, CASE WHEN u.source IS NOT NULL THEN u.added ELSE s.added END AS added, coalesce(u.last_success, s.last_success) AS last_success FROM state s FULL JOIN (SELECT source, 'error' AS status, CAST(NULL AS TIMESTAMP) AS last_success, CAST(NULL AS BIGINT) AS added FROM registry) u ON s.source = u.source"))
def state_transition(spark, sf) -> DataFrame:
    updates = V.registry(spark, sf).select("source", F.lit("error").alias("status"), F.lit(None).cast("timestamp").alias("last_success"), F.lit(None).cast("bigint").alias("added"))
    return J.upsert(V.source_state(spark, sf).select("source", "status", "last_success", "added"), updates, "source", ["last_success"])


@query("SELECT source, l.at AS at, l.seq AS seq, l.status AS status, l.fetched AS fetched, last_success, last_success + to_minutes(30) AS next_due FROM (SELECT 'src' || (user_id % 20) AS source, arg_max(struct_pack(at := ts, seq := event_id, status := CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'skipped_config' ELSE 'ok' END, fetched := CASE WHEN event_type NOT IN ('error', 'signup') THEN event_id % 10 END), struct_pack(a := ts, b := event_id)) AS l, max(ts) FILTER (event_type NOT IN ('error', 'signup')) AS last_success FROM events GROUP BY 1)")
def source_state_stream(spark, sf) -> DataFrame:
    # events as attempts of sources, through the stream's keyed state
    path, folder = f"{sf.rstrip('/')}/events.parquet", f"{shared_dir(spark)}/corvane-plans/stream-{uuid.uuid4().hex}"
    events = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path[:-1] + "[t]")  # a pattern: the table may be one file
    ok = ~F.col("event_type").isin("error", "signup")
    attempts = events.select(F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("source"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").cast("long").alias("seq"), F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "signup", "skipped_config").otherwise("ok").alias("status"), F.when(ok, F.col("event_id") % 10).cast("long").alias("fetched"), F.lit(None).cast("long").alias("added"), F.lit(None).cast("string").alias("error"), F.lit(30).alias("cadence"))
    out = settled(Z.latest(Z.replayed(attempts, folder)).select("source", "at", "seq", "status", "fetched", "last_success", "next_due"), "states")
    store.delete(spark, folder)
    return out


@query(_items("SELECT item_id, regexp_replace(title, '([\\\\`*_\\[\\]<>])', '\\\\\\1', 'g') AS title FROM items"))
def markdown_escape(spark, sf) -> DataFrame:
    return V.items(spark, sf).select("item_id", T.markdown(F.col("title")).alias("title"))


@query(_items("SELECT item_id, epoch_us(published) // 1000000 AS seconds FROM items WHERE published IS NOT NULL"))
def stamp_parse(spark, sf) -> DataFrame:
    i = V.items(spark, sf).where("published is not null")
    text = F.when(F.col("item_id") % 2 == 0, F.date_format("published", "yyyyMMdd'T'HHmmss'Z'")).otherwise(F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return i.select("item_id", F.unix_timestamp(T.parse_stamp(text)).alias("seconds"))


# --- joins and set operations ---


@query(_items("SELECT item_id FROM items WHERE item_id NOT IN (SELECT doc_id FROM labels)"))
def anti_archive(spark, sf) -> DataFrame:
    seen = table(spark, sf, "labels").select(F.col("doc_id").alias("item_id"))
    return J.drop_seen(V.items(spark, sf), seen).select("item_id")


@query(_items("SELECT item_id, utc_day FROM items WHERE utc_day >= DATE '2024-01-06'"))
def anti_archive_indexed(spark, sf) -> DataFrame:
    # the archive holds the days before; the batch is everything
    i, folder = V.items(spark, sf), f"{shared_dir(spark)}/corvane-plans/keys-{uuid.uuid4().hex}"
    index = KeyIndex(spark, folder)
    index.rebuild(i.where(F.col("utc_day") < F.lit(DAY)).select("item_id"))
    try:
        seen = settled(index.seen(i.select(F.col("item_id").cast("string").alias("key")), "key"), "seen")
    finally:
        store.delete(spark, folder)
    return J.drop_seen(i, seen.select(F.col("key").cast("long").alias("item_id"))).select("item_id", "utc_day")


@query(f"WITH {V.ITEMS}, {V.REGISTRY} SELECT i.item_id, r.priority, r.enabled FROM items i LEFT JOIN registry r USING (source)")
def lookup_enrich(spark, sf) -> DataFrame:
    return V.items(spark, sf).join(V.registry(spark, sf).select("source", "priority", "enabled"), "source", "left").select("item_id", "priority", "enabled")


@query(f"WITH {V.ITEMS}, {V.REGISTRY} SELECT i.item_id, coalesce(r.source, i.source) AS owner FROM items i LEFT JOIN registry r ON i.item_id % 30 = r.n WHERE i.platform = 'x'")
def reattribute(spark, sf) -> DataFrame:
    found = V.items(spark, sf).where("platform = 'x'").select("item_id", "source", F.concat(F.lit("USER"), (F.col("item_id") % 30).cast("string")).alias("handle"))
    reg = V.registry(spark, sf)
    return J.reattribute(found, reg.withColumn("handle", T.handle(F.col("url"))).select("source", "handle"), "handle").select("item_id", "owner")


@query("SELECT o_orderkey AS post_id, coalesce(string_agg(CASE WHEN p.p_partkey % 5 <> 0 THEN 'm/' || l_partkey END, ',' ORDER BY l_linenumber, l_partkey), '') AS media FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part p ON p_partkey = l_partkey GROUP BY 1")
def media_expand(spark, sf) -> DataFrame:
    keys = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("media_keys"))
    posts = table(spark, sf, "orders").select(F.col("o_orderkey").alias("post_id")).join(keys, F.col("post_id") == F.col("l_orderkey"), "left").select("post_id", "media_keys")
    media = table(spark, sf, "part").where("p_partkey % 5 <> 0").select(F.col("p_partkey").alias("media_key"), F.concat(F.lit("m/"), F.col("p_partkey").cast("string")).alias("url"))
    return J.with_media(posts, media).select("post_id", joined(F.col("media")).alias("media"))


@query(_reg("SELECT r.source, coalesce(s.status, 'unknown') AS status, s.last_success FROM registry r LEFT JOIN state s USING (source)"))
def state_left_join(spark, sf) -> DataFrame:
    return V.registry(spark, sf).join(V.source_state(spark, sf), "source", "left").select("source", F.coalesce("status", F.lit("unknown")).alias("status"), "last_success")


@query(_reg("SELECT source FROM state WHERE source NOT IN (SELECT source FROM registry)"))
def orphans(spark, sf) -> DataFrame:
    return J.missing_keys(V.source_state(spark, sf), V.registry(spark, sf), "source").select("source")


@query(_reg("SELECT source FROM state WHERE source NOT IN (SELECT source FROM registry WHERE enabled)"))
def orphans_enabled(spark, sf) -> DataFrame:
    return J.missing_keys(V.source_state(spark, sf), V.registry(spark, sf).where("enabled"), "source").select("source")


@query(_reg("SELECT source, status FROM state WHERE source IN (SELECT source FROM registry)"))
def prune_state(spark, sf) -> DataFrame:
    return V.source_state(spark, sf).join(V.registry(spark, sf), "source", "left_semi").select("source", "status")


@query(_items("SELECT day, bool_or(k = 'r') AS has_report, bool_or(k = 's') AS has_summary, lag(day) OVER (ORDER BY day) AS older, lead(day) OVER (ORDER BY day) AS newer FROM (SELECT DISTINCT utc_day AS day, 'r' AS k FROM items WHERE day(utc_day) % 3 <> 0 UNION ALL SELECT DISTINCT utc_day, 's' FROM items WHERE day(utc_day) % 2 = 0) GROUP BY day"))
def report_summary_outer(spark, sf) -> DataFrame:
    days = V.items(spark, sf).select(F.col("utc_day").alias("day")).distinct()
    return J.merged_days(days.where(F.dayofmonth("day") % 3 != 0), days.where(F.dayofmonth("day") % 2 == 0))


@query("SELECT path, CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'unexpected' WHEN a <> b THEN 'size' ELSE 'digest' END AS problem FROM (SELECT coalesce(x.path, y.path) AS path, x.b AS a, y.b AS b, x.d AS da, y.d AS db FROM (SELECT 'f/' || doc_id AS path, n_chars AS b, 'd' || doc_id AS d FROM documents WHERE doc_id % 10 <> 1) x FULL JOIN (SELECT 'f/' || doc_id AS path, n_chars + (doc_id % 13 = 0)::INT AS b, 'd' || (doc_id - (doc_id % 17 = 0)::INT) AS d FROM documents WHERE doc_id % 10 <> 2) y ON x.path = y.path) WHERE a IS NULL OR b IS NULL OR a <> b OR da <> db")
def manifest_diff(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    i = F.col("doc_id")
    flag = lambda m: F.when(i % m == 0, 1).otherwise(0)
    path = F.concat(F.lit("f/"), i.cast("string")).alias("path")
    want = d.where(i % 10 != 1).select(path, F.col("n_chars").alias("bytes"), F.concat(F.lit("d"), i.cast("string")).alias("digest"))
    have = d.where(i % 10 != 2).select(path, (F.col("n_chars") + flag(13)).alias("bytes"), F.concat(F.lit("d"), (i - flag(17)).cast("string")).alias("digest"))
    return J.difference(want, have)


@query(f"WITH {V.ITEMS}, {V.REGISTRY} SELECT item_id FROM items WHERE source NOT IN (SELECT source FROM registry WHERE enabled)")
def fk_violations(spark, sf) -> DataFrame:
    return J.missing_keys(V.items(spark, sf), V.registry(spark, sf).where("enabled"), "source").select("item_id")


def _asked(spark, sf) -> DataFrame:
    return table(spark, sf, "conversations").where("turn = 0").select((F.col("conv_id") + 1).alias("place"), F.when(F.col("conv_id") % 4 == 1, "  ").otherwise(F.substring("text", 1, 30)).alias("query"))


@query(_reg("SELECT source, platform FROM registry UNION ALL SELECT 'x-discovery-' || (conv_id + 1), 'x' FROM (SELECT conv_id, CASE WHEN conv_id % 4 = 1 THEN '  ' ELSE substr(text, 1, 30) END AS q FROM conversations WHERE turn = 0) WHERE trim(q) <> ''"))
def source_union(spark, sf) -> DataFrame:
    return V.registry(spark, sf).select("source", "platform").unionByName(D.virtual_sources(_asked(spark, sf)).select("source", "platform"))


# --- aggregation ---


def _count(key: str) -> str:
    return _items(f"SELECT {key}, count(*) AS n FROM items WHERE local_day = DATE '2024-01-06' GROUP BY 1")


@query(_count("platform"))
def coverage_by_platform(spark, sf) -> DataFrame:
    return A.counts(S.local_day(V.items(spark, sf), DAY, P.ZONE), "platform", "unknown")


@query(_count("grp"))
def coverage_by_group(spark, sf) -> DataFrame:
    return A.counts(S.local_day(V.items(spark, sf), DAY, P.ZONE), "grp", "other")


@query(_items("SELECT CASE WHEN grouping(source) = 0 THEN 'source' WHEN grouping(platform) = 0 THEN 'platform' WHEN grouping(grp) = 0 THEN 'grp' ELSE 'local_day' END AS dimension, coalesce(source, platform, grp, CAST(local_day AS VARCHAR)) AS value, count(*) AS n FROM items GROUP BY GROUPING SETS ((source), (platform), (grp), (local_day))"))
def coverage_weekly(spark, sf) -> DataFrame:
    return A.coverage_sets(V.items(spark, sf), ["source", "platform", "grp", "local_day"])


@query(_items("SELECT count(*) FILTER (list_contains(tags, 'operational-position')) AS redacted, count(DISTINCT source) AS sources FROM items"))
def redacted_and_sources(spark, sf) -> DataFrame:
    return V.items(spark, sf).agg(F.count_if(S.tagged(F.col("tags"), P.REDACT_TAGS)).alias("redacted"), F.count_distinct("source").alias("sources"))


@query(_reg("SELECT grp, count(*) AS configured, " + ", ".join(f"count(*) FILTER (st = '{s}') AS {s}" for s in A.STATUSES) + " FROM (SELECT r.grp, coalesce(s.status, 'unknown') AS st FROM registry r LEFT JOIN state s USING (source) WHERE r.enabled) GROUP BY 1"))
def status_pivot(spark, sf) -> DataFrame:
    return A.status_pivot(V.registry(spark, sf), V.source_state(spark, sf), "grp")


@query(_reg("SELECT t.st AS status, count(x.source) AS n FROM (VALUES ('ok'), ('error'), ('skipped_config'), ('skipped_cadence'), ('unknown')) t(st) LEFT JOIN (SELECT r.source, coalesce(s.status, 'unknown') AS st FROM registry r LEFT JOIN state s USING (source) WHERE r.enabled) x ON x.st = t.st GROUP BY 1"))
def status_totals(spark, sf) -> DataFrame:
    return A.status_totals(V.registry(spark, sf), V.source_state(spark, sf))


_ROLL = "SELECT count(*) AS configured, count(*) FILTER (status IN ('ok', 'error')) AS attempted, count(*) FILTER (status = 'ok') AS succeeded, count(*) FILTER (status LIKE 'skipped%') AS skipped, count(*) FILTER (status = 'skipped_config') AS blocked, count(*) FILTER (status = 'error') AS errors, CAST(sum(added) AS BIGINT) AS added, CAST(sum(fetched) AS BIGINT) AS fetched FROM state"
_RUN = "CASE WHEN attempted > 0 AND succeeded = 0 THEN 'failed' WHEN attempted = 0 AND blocked > 0 AND (SELECT count(*) FROM registry WHERE enabled AND platform <> 'x') = 0 THEN 'blocked' WHEN errors > 0 OR blocked > 0 THEN 'partial' WHEN attempted = 0 THEN 'idle' ELSE 'ok' END"


def _selected(spark, sf) -> DataFrame:
    return S.select_sources(V.registry(spark, sf))


@query(_reg(f"SELECT *, {_RUN} AS run_status FROM ({_ROLL})"))
def run_rollup(spark, sf) -> DataFrame:
    return A.run_rollup(V.source_state(spark, sf), _selected(spark, sf))


_HEALTH = f"SELECT coalesce(r.source, s.source) AS source, CASE WHEN r.source IS NULL THEN 'orphan_state' WHEN NOT r.enabled THEN 'disabled' WHEN s.status IS NULL THEN 'never_seen' WHEN s.status = 'error' THEN 'current_error' WHEN s.status = 'skipped_config' THEN 'configuration_blocked' WHEN s.last_success IS NULL THEN 'never_succeeded' WHEN (epoch_us(TIMESTAMP '{P.NOW}') - epoch_us(s.last_success)) / 3.6e9 > 12 THEN 'stale_success' WHEN s.status = 'skipped_cadence' THEN 'cadence_wait' ELSE 'healthy' END AS classification FROM registry r FULL JOIN state s ON r.source = s.source"


@query(_reg(_HEALTH))
def health_audit(spark, sf) -> DataFrame:
    return A.health(V.registry(spark, sf), V.source_state(spark, sf), now(), 12.0)


@query(_reg(f"SELECT classification, count(*) AS n FROM ({_HEALTH}) GROUP BY 1"))
def health_counts(spark, sf) -> DataFrame:
    return A.health(V.registry(spark, sf), V.source_state(spark, sf), now(), 12.0).groupBy("classification").agg(F.count(F.lit(1)).alias("n"))


_DEGRADED = "SELECT count(*) FILTER (s.status = 'error') AS source_errors, count(*) FILTER (s.status = 'skipped_config') AS configuration_skips, count(*) FILTER (s.status IS NULL) AS unknown_sources FROM registry r LEFT JOIN state s USING (source) WHERE r.enabled"
_AGES = [(g, st, hours) for g, (st, hours) in enumerate([(st, h) for st in ("ok", "idle", "partial", "blocked", "failed") for h in (0, 1, 2, 9)])]


@query(_reg(f"SELECT a.g, a.st AS run_status, a.st IN ('ok', 'idle') AND a.h <= 1 AS healthy, concat_ws(',', CASE WHEN configuration_skips > 0 THEN 'configuration_skips' END, CASE WHEN a.st NOT IN ('ok', 'idle') THEN 'run_' || a.st END, CASE WHEN source_errors > 0 THEN 'source_errors' END, CASE WHEN a.h > 1 THEN 'state_stale' END, CASE WHEN unknown_sources > 0 THEN 'unknown_sources' END) AS reasons FROM ({_DEGRADED}), (VALUES " + ", ".join(f"({g}, '{st}', {h})" for g, st, h in _AGES) + ") a(g, st, h)"))
def health_result(spark, sf) -> DataFrame:
    runs = spark.createDataFrame(_AGES, "g int, run_status string, hours int").withColumn("last_run", now() - F.make_dt_interval(hours=F.col("hours")))
    run = runs.crossJoin(A.degradation(V.registry(spark, sf), V.source_state(spark, sf)))  # twenty rows with one
    return A.health_result(run, now(), 1.0).select("g", "run_status", "healthy", "reasons")


@query("SELECT user_id AS id, arg_max(event_type, event_id) AS kind, arg_max(value, event_id) AS value, max(event_id) AS seq, min(event_id) AS first_seq FROM events GROUP BY 1")
def dedupe_last_wins(spark, sf) -> DataFrame:
    rows = table(spark, sf, "events").select(F.col("user_id").alias("id"), F.col("event_type").alias("kind"), "value", F.col("event_id").alias("seq"))
    return A.last_wins(rows, "id", "seq")


@query("SELECT text_sha, n FROM (SELECT sha256(text) AS text_sha, count(*) AS n FROM documents GROUP BY 1) WHERE n > 1")
def duplicate_ids(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("text_sha")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(_reg("SELECT m.g AS grp, m.least_ AS least, count(r.source) AS n FROM (VALUES ('osint', 3), ('international-media', 2), ('official-ua', 9)) m(g, least_) LEFT JOIN registry r ON r.grp = m.g AND r.enabled GROUP BY 1, 2 HAVING count(r.source) < m.least_"))
def group_minimums(spark, sf) -> DataFrame:
    least = spark.sql("SELECT * FROM VALUES ('osint', 3), ('international-media', 2), ('official-ua', 9) AS t(grp, least)")
    n = V.registry(spark, sf).where("enabled").groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    return least.join(n, "grp", "left").select("grp", "least", F.coalesce("n", F.lit(0)).alias("n")).where("n < least")


# --- order and top-k ---


@query(_items("SELECT item_id, row_number() OVER (ORDER BY stamp DESC, length(text), item_id) AS place FROM items WHERE local_day = DATE '2024-01-06'"))
def digest_order(spark, sf) -> DataFrame:
    day = S.local_day(V.items(spark, sf), DAY, P.ZONE).select("item_id", "stamp", F.char_length("text").alias("size"))
    return A.placed(day, [F.col("stamp").desc(), F.col("size"), F.col("item_id")]).select("item_id", "place")


@query(_items("SELECT source, n FROM (SELECT source, count(*) AS n, min(item_id) AS f FROM items GROUP BY 1 ORDER BY n DESC, f LIMIT 25)"))
def top_sources(spark, sf) -> DataFrame:
    return V.items(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("f")).orderBy(F.col("n").desc(), "f").limit(25).select("source", "n")


@query(_items("SELECT section, item_id, place, more FROM (SELECT section, item_id, row_number() OVER (PARTITION BY section ORDER BY stamp DESC, item_id) AS place, greatest(0, count(*) OVER (PARTITION BY section) - 8) AS more FROM (SELECT *, CASE WHEN list_contains(tags, 'map') THEN 'map' WHEN list_contains(tags, 'drones') THEN 'drones' WHEN list_contains(tags, 'logistics') THEN 'logistics' WHEN list_contains(tags, 'relief') THEN 'relief' WHEN grp = 'osint' THEN 'map' WHEN grp IN ('official-ua', 'official-ru') THEN 'official' ELSE 'other' END AS section FROM items)) WHERE place <= 8"))
def top_n_per_section(spark, sf) -> DataFrame:
    i = V.items(spark, sf).select("item_id", "stamp", _section().alias("section"))
    n = i.groupBy("section").agg(F.greatest(F.lit(0), F.count(F.lit(1)) - 8).alias("more"))
    top = i.withColumn("place", F.row_number().over(Window.partitionBy("section").orderBy(F.col("stamp").desc(), "item_id"))).where("place <= 8")
    return top.join(F.broadcast(n), "section").select("section", "item_id", "place", "more")  # a row per section


@query(_items("SELECT DISTINCT platform, grp FROM items"))
def control_options(spark, sf) -> DataFrame:
    return V.items(spark, sf).select("platform", "grp").distinct().orderBy("platform", "grp")


# --- text ---


def _prep(spark, sf, words: bool = True) -> DataFrame:
    return C.prepared(V.items(spark, sf), P.TEST_LEXICON, words)


@query(Q.prepared("SELECT item_id, array_to_string(anchors, ',') AS anchors FROM prep"))
def anchors(spark, sf) -> DataFrame:
    return _prep(spark, sf, words=False).select("item_id", joined("anchors").alias("anchors"))


@query(Q.tokens())
def tokens(spark, sf) -> DataFrame:
    return V.items(spark, sf).select("item_id", F.explode(C.tokens(F.col("text"))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))


@query(Q.prepared("SELECT item_id, relevance FROM prep"))
def relevance(spark, sf) -> DataFrame:
    return _prep(spark, sf, words=False).select("item_id", "relevance")


@query(Q.prepared("SELECT item_id, first_topic FROM prep"))
def topic(spark, sf) -> DataFrame:
    return _prep(spark, sf, words=False).select("item_id", "first_topic")


@query(Q.prepared("SELECT item_id, topic, strict FROM prep"))
def strict_gate(spark, sf) -> DataFrame:
    return _prep(spark, sf, words=False).select("item_id", "topic", "strict")


@query(Q.prepared("SELECT item_id, topic FROM prep WHERE topic <> first_topic"))
def editorial_topic(spark, sf) -> DataFrame:
    return _prep(spark, sf, words=False).where("topic <> first_topic").select("item_id", "topic")


@query(Q.prepared("SELECT item_id, array_to_string(locations, ',') AS locations FROM prep"))
def locations(spark, sf) -> DataFrame:
    return _prep(spark, sf, words=False).select("item_id", joined("locations").alias("locations"))


@query(Q.prepared("SELECT item_id, array_to_string(semantic, ',') AS semantic FROM prep"))
def semantic_signature(spark, sf) -> DataFrame:
    return _prep(spark, sf, words=False).select("item_id", joined("semantic").alias("semantic"))


@query(Q.prepared("SELECT relevance, strict, count(*) AS n FROM prep GROUP BY 1, 2"))
def gate_counts(spark, sf) -> DataFrame:
    return _prep(spark, sf, words=False).groupBy("relevance", "strict").agg(F.count(F.lit(1)).alias("n"))


# --- clusters ---


def _clusters(spark, sf, words: bool = True) -> DataFrame:
    return C.clusters(_prep(spark, sf, words))


@query(Q.clusters("SELECT cluster_id, items, families, first_pos, array_to_string(anchor_union, ',') AS anchors FROM clusters"))
def cluster_build(spark, sf) -> DataFrame:
    return _clusters(spark, sf, words=False).select("cluster_id", "items", "families", "first_pos", joined("anchor_union").alias("anchors"))


@query(Q.clusters("SELECT cluster_id, evidence, CASE WHEN evidence >= 6.0 THEN 'strong' WHEN evidence >= 3.2 THEN 'mixed' ELSE 'thin' END AS label FROM clusters"))
def evidence(spark, sf) -> DataFrame:
    best = C.family_best(C.accepted(_prep(spark, sf, words=False)))
    e = C.evidence(best).where(" AND ".join(f"{k} IS NOT NULL" for k in C.KEY))  # as clusters are
    return e.select(C.cluster_id().alias("cluster_id"), "evidence", C.label(F.col("evidence"), 6.0, 3.2, ("strong", "mixed", "thin")).alias("label"))


@query(Q.clusters("SELECT cluster_id, pulse, CASE WHEN pulse >= 6.0 THEN 'high' WHEN pulse >= 3.0 THEN 'medium' ELSE 'low' END AS label FROM clusters"))
def pulse(spark, sf) -> DataFrame:
    return _clusters(spark, sf, words=False).select("cluster_id", "pulse", C.label(F.col("pulse"), 6.0, 3.0, ("high", "medium", "low")).alias("label"))


@query(Q.clusters("SELECT cluster_id, importance FROM clusters"))
def importance(spark, sf) -> DataFrame:
    return _clusters(spark, sf, words=False).select("cluster_id", "importance")


@query(Q.clusters("SELECT cluster_id, routine, broad, weak, thin FROM clusters"))
def cluster_predicates(spark, sf) -> DataFrame:
    return _clusters(spark, sf, words=False).select("cluster_id", "routine", "broad", "weak", "thin")


@query(Q.clusters("SELECT item_id, family FROM best"))
def family_best(spark, sf) -> DataFrame:
    return C.family_best(C.accepted(_prep(spark, sf, words=False))).select("item_id", "family")


@query(Q.samples())
def sample_items(spark, sf) -> DataFrame:
    return C.samples(C.accepted(_prep(spark, sf, words=False))).select("item_id", "place")


@query(Q.clusters("SELECT a.cluster_id AS a, b.cluster_id AS b, round(len(list_intersect(a.anchor_union, b.anchor_union)) / len(list_distinct(list_concat(a.anchor_union, b.anchor_union))), 9) AS similarity FROM clusters a JOIN clusters b ON a.local_day = b.local_day + 1 AND a.topic = b.topic AND a.locations = b.locations WHERE len(a.anchor_union) > 0 AND len(b.anchor_union) > 0"))
def jaccard_pairs(spark, sf) -> DataFrame:
    c = _clusters(spark, sf).where(F.size("anchor_union") > 0).select(F.col("cluster_id").alias("a"), "local_day", "topic", "locations", F.col("anchor_union").alias("x"))
    d = c.select(F.col("a").alias("b"), F.date_add("local_day", 1).alias("local_day"), "topic", "locations", F.col("x").alias("y"))
    return c.join(d, ["local_day", "topic", "locations"]).select("a", "b", F.round(T.jaccard(F.col("x"), F.col("y")), 9).alias("similarity"))


@query(Q.temporal("SELECT * FROM temporal"))
def temporal(spark, sf) -> DataFrame:
    return C.temporal(_clusters(spark, sf))


@query(Q.temporal("SELECT cluster_id, rank FROM ranked"))
def editorial_rank(spark, sf) -> DataFrame:
    return C.ranked(_clusters(spark, sf)).select("cluster_id", "rank")


@query(Q.primary())
def primary_select(spark, sf) -> DataFrame:
    return C.primary(C.ranked(_clusters(spark, sf)))


@query(Q.watch())
def pulse_watch(spark, sf) -> DataFrame:
    r = C.ranked(_clusters(spark, sf))
    return C.watch(r, C.primary(r), least=Q.WATCH)


# --- quality ---


@query(_items("SELECT item_id FROM items WHERE utc_day <> CAST(coalesce(published, collected - INTERVAL 30 HOURS) AS DATE)"))
def partition_violations(spark, sf) -> DataFrame:
    other = F.to_date(F.coalesce("published", F.col("collected") - F.make_dt_interval(hours=F.lit(30))))
    return V.items(spark, sf).where(F.col("utc_day") != other).select("item_id")


_LEAST = {"osint": 3, "international-media": 2, "official-ua": 9}


@query(_reg("SELECT 'registry' AS scope, source AS key, 'perspective' AS rule FROM registry WHERE perspective NOT IN ('north', 'south') UNION ALL SELECT 'registry', source, 'cadence' FROM registry WHERE cadence < 1 UNION ALL SELECT 'registry', m.g, 'group_minimum' FROM (VALUES " + ", ".join(f"('{g}', {n})" for g, n in _LEAST.items()) + ") m(g, n) WHERE m.n > (SELECT count(*) FROM registry r WHERE r.grp = m.g AND r.enabled) UNION ALL SELECT 'settings', t.s, 'unknown_source' FROM (VALUES ('src1'), ('src77')) t(s) WHERE t.s NOT IN (SELECT source FROM registry)"))
def registry_violations(spark, sf) -> DataFrame:
    return X.registry(V.registry(spark, sf), ["north", "south"], _LEAST, ["src1", "src77"])


@query(_reg("SELECT 'state' AS scope, source AS key, unnest(list_filter([CASE WHEN last_success > checked THEN 'order' END, CASE WHEN source NOT IN (SELECT source FROM registry) THEN 'unknown_source' END, CASE WHEN checked > (SELECT avg_ts FROM run) THEN 'checked_after_run' END, CASE WHEN last_success > (SELECT avg_ts FROM run) THEN 'success_after_run' END], lambda r: r IS NOT NULL)) AS rule FROM state").replace("WITH ", "WITH run AS (SELECT TIMESTAMP '2024-01-30 20:00:00' AS avg_ts), "))
def state_violations(spark, sf) -> DataFrame:
    return X.state(V.source_state(spark, sf), V.registry(spark, sf), F.lit("2024-01-30 20:00:00").cast("timestamp"))


# the public form of the tables' captures with faults put in: a relative address, HTML left, a short digest, content of a redacted item, a field too many
@query(_items("SELECT 'projection' AS scope, CAST(item_id AS VARCHAR) AS key, unnest(list_filter([CASE WHEN item_id % 10 = 1 THEN 'html' END, CASE WHEN item_id % 10 = 2 THEN 'media_not_public' END, CASE WHEN item_id % 10 = 3 AND NOT hide THEN 'digest' END, CASE WHEN item_id % 10 = 4 AND hide THEN 'redacted_content' END, CASE WHEN item_id % 10 = 1 AND hide THEN 'redacted_content' END, CASE WHEN item_id % 10 = 2 AND hide THEN 'redacted_content' END, CASE WHEN item_id % 10 = 5 THEN CASE WHEN hide THEN 'redacted_fields' ELSE 'excerpt_fields' END END, CASE WHEN item_id % 10 = 6 THEN 'policy' END], lambda r: r IS NOT NULL)) AS rule FROM (SELECT *, list_contains(tags, 'operational-position') AS hide FROM items)"))
def projection_violations(spark, sf) -> DataFrame:
    p = D.archive_projection(V.captures(spark, sf), P.REDACT_TAGS, r"(?i)\bposition|\bconvoy", P.EXCERPT, P.MEDIA_LIMIT)
    k, text = F.col("item_id") % 10, F.to_json("raw")
    raw = F.when(k == 3, F.regexp_replace(text, '"content_sha256":"....', '"content_sha256":"')).when(k == 5, F.regexp_replace(text, r"^\{", '{"more":1,')).when(k == 6, F.regexp_replace(text, "_v1", "_v9")).otherwise(text)
    media = F.when(k == 2, F.concat("media", F.array(F.lit("/relative.png")))).otherwise(F.col("media"))
    broken = p.withColumns({"html": F.when(k == 1, "<p>").otherwise(F.col("html")), "media": media, "title": F.when(k == 4, "left").otherwise(F.col("title")), "raw": F.parse_json(raw)})
    return X.projection(broken)


# stored items as documents, with faults put in: no id, another platform, a text where none may be, a relative address, a day that isn't one
@query(_items("SELECT 'schema' AS scope, CAST(item_id AS VARCHAR) AS key, unnest(list_filter([CASE WHEN item_id % 10 = 1 THEN '$.id: required' END, CASE WHEN item_id % 10 = 2 THEN '$.platform: enum' END, CASE WHEN item_id % 10 = 3 AND hide THEN '$.text: const' END, CASE WHEN item_id % 10 = 4 THEN '$.media[]: format' END, CASE WHEN item_id % 10 = 4 AND hide THEN '$.media: maxItems' END, CASE WHEN item_id % 10 = 5 THEN '$.collected_at: format' END, CASE WHEN item_id % 10 = 6 THEN '$.raw: oneOf' END], lambda r: r IS NOT NULL)) AS rule FROM (SELECT *, list_contains(tags, 'operational-position') AS hide FROM items)"))
def schema_violations(spark, sf) -> DataFrame:
    p = D.archive_projection(V.captures(spark, sf), P.REDACT_TAGS, r"(?i)\bposition|\bconvoy", P.EXCERPT, P.MEDIA_LIMIT)
    k, time = F.col("item_id") % 10, F.date_format("collected", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fields = {
        "id": F.when(k != 1, F.col("public_id")), "source": F.col("source"), "platform": F.when(k == 2, "fax").otherwise(F.col("platform")), "url": F.when((F.col("url") == "") & F.col("redacted"), "https://none/").otherwise(F.regexp_replace("url", "user:pw@", "")), "collected_at": F.when(k == 5, "2024-13-01T00:00:00Z").otherwise(time),
        "title": F.col("title"), "text": F.when(k == 3, "left").otherwise(F.col("text")), "html": F.col("html"), "media": F.when(k == 4, F.concat("media", F.array(F.lit("rel")))).otherwise(F.col("media")), "author": F.col("author"), "tags": F.col("tags"), "raw": F.when(k == 6, F.parse_json(F.lit("{}"))).otherwise(F.col("raw")),
    }
    text = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return Y.conforming(p.select("item_id", F.parse_json(text).alias("document")), K.ITEM, "document", "item_id")


_ERROR_ROWS = f"(SELECT event_id, 'src' || (event_id % 25) AS source, {_cases(0)} || ': ' || {_cases(1)} AS e, CASE WHEN event_id % 4 = 1 THEN 'https://h/p?q=1' WHEN event_id % 4 = 2 THEN 'ftp://h/' ELSE 'https://h/p' END AS url, CASE WHEN event_id % 6 <> 0 THEN ts END AS collected FROM events)"


@query(_reg(f"SELECT 'errors' AS scope, CAST(event_id AS VARCHAR) AS key, unnest(list_filter([CASE WHEN source NOT IN (SELECT source FROM registry) THEN 'unknown_source' END, CASE WHEN url LIKE 'ftp%' THEN 'url' END, CASE WHEN url LIKE '%?q=1' THEN 'url_query' END, CASE WHEN NOT regexp_matches(e, '^[A-Za-z_][A-Za-z0-9_.]*: [a-z0-9_]+$') THEN 'error' END, CASE WHEN collected IS NULL THEN 'collected' END], lambda r: r IS NOT NULL)) AS rule FROM {_ERROR_ROWS}"))
def safe_error_violations(spark, sf) -> DataFrame:
    i = F.col("event_id")
    error = F.concat(V.pick([e[0] for e in _ERRORS], i % len(_ERRORS)), F.lit(": "), V.pick([e[1] for e in _ERRORS], i % len(_ERRORS)))
    rows = table(spark, sf, "events").select(i, F.concat(F.lit("src"), (i % 25).cast("string")).alias("source"), error.alias("error"), F.when(i % 4 == 1, "https://h/p?q=1").when(i % 4 == 2, "ftp://h/").otherwise("https://h/p").alias("url"), F.when(i % 6 != 0, F.col("ts")).alias("collected"))
    return X.errors(rows, V.registry(spark, sf), "event_id")


@query(f"WITH {V.ITEMS}, {V.CAPTURES}, {V.REGISTRY} SELECT item_id, {_ID.format("CASE WHEN c.platform = 'x' THEN 'x' ELSE c.source END", 'c.url', ", coalesce(nullif(trim(regexp_replace(c.text, '\\s+', ' ', 'g')), ''), trim(regexp_replace(c.title, '\\s+', ' ', 'g')))").replace('published', 'c.published')} AS id, length(trim(regexp_replace(c.text, '\\s+', ' ', 'g'))) AS chars, len(list_distinct(media)) AS n_media, coalesce(r.grp, 'other') AS grp, coalesce(r.perspective, 'unknown') AS perspective, c.language, c.author, c.html, canon AS raw, 'unknown' AS trust, coalesce('Source ' || r.n, c.source) AS source_name FROM captures c LEFT JOIN registry r ON r.source = c.source AND r.enabled")
def make_item(spark, sf) -> DataFrame:
    registry = V.registry(spark, sf).where("enabled").select("source", "grp", "perspective", F.concat(F.lit("Source "), F.col("n").cast("string")).alias("name"))
    made = D.make_item(V.captures(spark, sf), registry)
    return made.select("item_id", "id", F.char_length("text").alias("chars"), F.size("media").alias("n_media"), "grp", "perspective", "language", "author", "html", "raw", "trust", "source_name")


@query(_items("SELECT item_id, sha256(concat_ws(chr(10), title, text, url, array_to_string(media, chr(10)))) AS material FROM items"))
def sensitive_material(spark, sf) -> DataFrame:
    i = V.items(spark, sf)
    return i.select("item_id", F.sha2(D.material(i), 256).alias("material"))


_PRINT = "sha256('{\"html\":' || to_json(html) || ',\"raw\":' || canon || ',\"text\":' || to_json(text) || '}')"
_EXCERPT_RAW = f"""'{{"archive_policy":"public_excerpt_v1","content_sha256":"' || {_PRINT} || '","media_count":' || len(media) || ',"original_html_chars":' || length(html) || ',"original_text_chars":' || length(text) || ',"platform":' || identity || ',"text_truncated":' || (length(text) > {P.EXCERPT}) || '}}'"""
_REDACTED_RAW = """'{"archive_policy":"public_redacted_v1","platform":' || CASE WHEN platform = 'rss' THEN '{}' ELSE identity END || ',"redacted":true}'"""


@query(f"WITH {V.ITEMS}, {V.CAPTURES} SELECT item_id, CASE WHEN hide THEN {_HIDDEN} ELSE {_ID.format("CASE WHEN platform = 'x' THEN 'x' ELSE source END", 'url', ", trim(regexp_replace(coalesce(nullif(text, ''), title, ''), '\\s+', ' ', 'g'))")} END AS public_id, CASE WHEN hide THEN 'public_redacted_v1' ELSE 'public_excerpt_v1' END AS raw_policy, CASE WHEN hide THEN '' ELSE substr(text, 1, {P.EXCERPT}) END AS text, CASE WHEN hide THEN '' ELSE title END AS title, CASE WHEN hide THEN {_SHORT} ELSE url END AS url, CASE WHEN NOT hide THEN {_PRINT} END AS content_sha256, CASE WHEN NOT hide THEN length(text) > {P.EXCERPT} END AS text_truncated, CASE WHEN hide THEN {_REDACTED_RAW} ELSE {_EXCERPT_RAW} END AS raw, CASE WHEN hide THEN '' ELSE author END AS author, '' AS html FROM (SELECT *, list_contains(tags, 'operational-position') AS hide FROM captures)")
def archive_projection(spark, sf) -> DataFrame:
    bounded = D.archive_projection(V.captures(spark, sf), P.REDACT_TAGS, r"(?i)\bposition|\bconvoy", P.EXCERPT, P.MEDIA_LIMIT)
    return bounded.select("item_id", "public_id", "raw_policy", "text", "title", "url", "content_sha256", "text_truncated", F.to_json("raw").alias("raw"), "author", "html")


@query(f"WITH {V.ITEMS}, {V.CAPTURES} SELECT item_id, {_PRINT} AS fingerprint FROM captures")
def content_fingerprint(spark, sf) -> DataFrame:
    return V.captures(spark, sf).select("item_id", N.fingerprint(F.col("text"), F.col("html"), F.col("raw")).alias("fingerprint"))


# the second concept's pattern holds the first one's name, the third the second's
_CONCEPTS = [("drone", [r"(^| )ering[a-z]*"]), ("raid", [r" drone +th[a-z]*", r" drone +an[a-z]*"]), ("wave", [r" raid +[a-z]*e( |$)"])]


def _sequential() -> str:
    step, at = "SELECT item_id, trim(regexp_replace(lower(concat_ws(' ', title, text)), '\\s+', ' ', 'g')) AS v, CAST([] AS VARCHAR[]) AS a FROM items", 0
    out = []
    for name, patterns in _CONCEPTS:
        for p in patterns:
            out.append(f"s{at} AS ({step})")
            step = f"SELECT item_id, regexp_replace(v, '{p}', ' {name} ', 'g') AS v, CASE WHEN regexp_matches(v, '{p}') AND NOT list_contains(a, '{name}') THEN list_append(a, '{name}') ELSE a END AS a FROM s{at}"
            at += 1
    return f"WITH {V.ITEMS}, {', '.join(out)} SELECT item_id, array_to_string(list_sort(a), ',') AS anchors FROM ({step})"


@query(_sequential())
def canonicalize(spark, sf) -> DataFrame:
    found = canonicaliser(_CONCEPTS)(F.concat_ws(" ", "title", "text"))
    return V.items(spark, sf).select("item_id", joined(F.array_sort(found["anchors"])).alias("anchors"))


@query("SELECT max(try_cast(CASE WHEN event_id % 3 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP)) AS latest FROM events")
def latest_time(spark, sf) -> DataFrame:
    text = F.when(F.col("event_id") % 3 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf, "events").agg(F.max(T.parse_stamp(text)).alias("latest"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 40 < 31 THEN o_custkey % 40 + 1 END AS days FROM orders")
def period_days(spark, sf) -> DataFrame:
    first = F.to_date("o_orderdate")
    name = F.concat(first.cast("string"), F.lit("_"), F.date_add(first, (F.col("o_custkey") % 40).cast("int")).cast("string"), F.lit(".md"))
    days = D.period_days(name)
    return table(spark, sf, "orders").select("o_orderkey", F.when(days.isNotNull(), F.size(days)).alias("days"))


@query(f"WITH {V.ITEMS}, {V.REGISTRY}, {V.STATE} SELECT 'archive' AS scope, CAST(item_id AS VARCHAR) AS key, 'url' AS rule FROM items WHERE NOT regexp_matches(url, '^https?://[^/?#@\\s]+([/?#]|$)') UNION ALL SELECT 'archive', CAST(item_id AS VARCHAR), 'unknown_source' FROM items WHERE source NOT IN (SELECT source FROM registry WHERE enabled) UNION ALL SELECT 'state', source, 'unknown_source' FROM state WHERE source NOT IN (SELECT source FROM registry WHERE enabled) UNION ALL SELECT 'documents', h, 'repeated' FROM (SELECT sha256(text) AS h FROM documents GROUP BY 1 HAVING count(*) > 1)")
def violations(spark, sf) -> DataFrame:
    known = V.registry(spark, sf).where("enabled")
    same = table(spark, sf, "documents").select(F.sha2("text", 256).alias("h"))
    return X.violations(X.archive(V.items(spark, sf), known), X.state(V.source_state(spark, sf), known), X.registry(V.registry(spark, sf)), X.repeated(same, "documents", "h"))


_ART = "CASE WHEN doc_id % 23 = 0 THEN 'data/raw/x' || doc_id ELSE 'data/raw/' || (1000 + doc_id // 336) || '/' || lpad(CAST(1 + doc_id // 28 % 12 AS VARCHAR), 2, '0') || '/' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') || '/items.ndjson' END"


# documents as files of an artifact and of its manifest, with faults put in: files left out on either side, other sizes and digests, links, paths that may not be
@query(f"""WITH d AS (SELECT doc_id AS i, {_ART} AS path, n_chars AS b, sha256(text) AS s FROM documents),
 man AS (SELECT i, path, b + CASE WHEN i % 13 = 0 THEN 1 ELSE 0 END AS b, CASE WHEN i % 17 = 0 THEN repeat('0', 64) ELSE s END AS s FROM d WHERE i % 10 <> 1 UNION ALL SELECT -1, 'data/state.json', 5, sha256('state')),
 fnd AS (SELECT i, path, b, s, i % 19 = 0 AS link FROM d WHERE i % 10 <> 2 UNION ALL SELECT -1, 'data/state.json', 5, sha256('state'), FALSE),
 diff AS (SELECT coalesce(m.path, f.path) AS path, CASE WHEN f.path IS NULL THEN 'missing' WHEN m.path IS NULL THEN 'unexpected' WHEN m.b <> f.b THEN 'size' WHEN m.s <> f.s THEN 'digest' END AS rule FROM (SELECT * FROM man WHERE i % 23 <> 0) m FULL JOIN (SELECT * FROM fnd WHERE NOT link AND i % 23 <> 0) f USING (path)),
 n AS (SELECT (SELECT count(*) FROM man) AS mc, (SELECT sum(b) FROM man) AS mb, count(*) AS fc, sum(b) AS fb FROM fnd WHERE NOT link AND i % 23 <> 0)
SELECT 'manifest' AS scope, path AS key, 'path' AS rule FROM man WHERE i % 23 = 0 UNION ALL SELECT 'artifact', path, CASE WHEN link THEN 'link' ELSE 'unexpected_path' END FROM fnd WHERE link OR i % 23 = 0 UNION ALL SELECT 'artifact', path, rule FROM diff WHERE rule IS NOT NULL
 UNION ALL SELECT 'manifest', 'manifest', 'file_count' FROM n WHERE mc <> fc UNION ALL SELECT 'manifest', 'manifest', 'total_bytes' FROM n WHERE mb <> fb""")
def artifact_violations(spark, sf) -> DataFrame:
    i = F.col("doc_id")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    whole = F.concat(F.lit("data/raw/"), (1000 + F.floor(i / 336)).cast("string"), F.lit("/"), two(1 + F.floor(i / 28) % 12), F.lit("/"), two(1 + i % 28), F.lit("/items.ndjson"))
    d = table(spark, sf, "documents").select(i.alias("i"), F.when(i % 23 == 0, F.concat(F.lit("data/raw/x"), i.cast("string"))).otherwise(whole).alias("path"), F.col("n_chars").alias("bytes"), F.sha2("text", 256).alias("digest"))
    i = F.col("i")
    state_file = spark.range(1).select(F.lit("data/state.json").alias("path"), F.lit(5).cast("long").alias("bytes"), F.sha2(F.lit("state"), 256).alias("digest"))
    listed = d.where(i % 10 != 1).select("path", F.when(i % 13 == 0, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"), F.when(i % 17 == 0, F.lit("0" * 64)).otherwise(F.col("digest")).alias("digest")).unionByName(state_file)
    found = d.where(i % 10 != 2).select("path", F.when(i % 19 == 0, "link").otherwise("file").alias("kind"), "bytes", "digest").unionByName(state_file.withColumn("kind", F.lit("file")))
    doc = listed.agg(F.lit(L.SCHEMA).alias("schema"), F.lit("ok").alias("state_status"), F.lit("2024-01-31T00:00:00Z").alias("last_run_at"), F.collect_list(F.struct("path", "bytes", F.col("digest").alias("sha256"))).alias("files"), F.count(F.lit(1)).alias("file_count"), F.sum("bytes").alias("total_bytes"))
    manifest = settled(L.document(doc.select(F.to_json(F.struct("*")))), "manifest")
    state = L.document(spark.range(1).select(F.lit('{"status": "ok", "last_run_at": "2024-01-31T00:00:00Z"}')))
    return L.violations(manifest, found, state)


# --- html, reports ---


@query()
def article_fields(spark, sf) -> DataFrame:
    return W.article_fields(table(spark, sf, "pages")).select("page_id", "title", F.sha2("text", 256).alias("text_sha"), "published")


def _captured(spark, sf):
    """The tables' pages as captured responses, each behind up to nine redirects of its own; every seventh request is of
    a source that has another domain."""
    p = table(spark, sf, "pages").select("page_id", F.regexp_replace("url", "#.*$", "").alias("url"), "html").withColumn("root", F.concat(F.lit("https://"), T.host(F.col("url")), F.lit("/hop/"), F.col("page_id").cast("string"), F.lit("/")))
    own = p.select("url", F.lit(200).alias("status"), F.lit(None).cast("string").alias("location"), "html")
    hop = p.select("root", "url", F.explode(F.sequence(F.lit(0), (F.col("page_id") % 9).cast("int"))).alias("k"))
    hops = hop.select(F.concat("root", F.col("k").cast("string")).alias("url"), F.lit(302).alias("status"), F.when(F.col("k") == 0, F.col("url")).otherwise((F.col("k") - 1).cast("string")).alias("location"), F.lit(None).cast("string").alias("html"))
    asked = p.select(F.col("page_id").cast("string").alias("request"), F.col("page_id").cast("string").alias("source"), F.concat("root", (F.col("page_id") % 9).cast("string")).alias("url"), F.when(F.col("page_id") % 7 == 0, F.array(F.lit("other.org"))).otherwise(F.array(T.host(F.col("url")))).alias("domains"))
    return asked, own.unionByName(hops)


@query("SELECT page_id, CASE WHEN page_id % 7 = 0 THEN root || k WHEN k >= 6 THEN root || (k - 6) ELSE url END AS final, CASE WHEN page_id % 7 = 0 THEN 0 ELSE least(6, k + 1) END AS hops, CASE WHEN page_id % 7 = 0 THEN 'unsafe_destination' WHEN k >= 5 THEN 'redirect_error' WHEN url NOT LIKE 'https://%' THEN 'unsafe_destination' END AS error FROM (SELECT page_id, page_id % 9 AS k, regexp_replace(url, '#.*$', '') AS url, 'https://' || lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) || '/hop/' || page_id || '/' AS root FROM pages)")
def fetch_guard(spark, sf) -> DataFrame:
    return G.followed(*_captured(spark, sf)).select(F.col("request").cast("long").alias("page_id"), "final", "hops", "error")


@query()
def web_collect(spark, sf) -> DataFrame:
    asked, captured = _captured(spark, sf)
    sources = asked.select("source", "url", F.lit(None).cast("array<string>").alias("article_hosts"), F.lit(None).cast("array<string>").alias("tags"), F.lit(None).cast("string").alias("web_mode"))
    return G.collected(sources, captured, F.lit("2000-01-01").cast("timestamp"), least=0).select("source", "kind", "url", F.sha2("text", 256).alias("text_sha"), "error")


# an index of links for each page, made of its number: paths with a hint or a date, headings, long labels, blocked and foreign ones
@query("""SELECT page_id, link, score, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, link) AS place FROM (SELECT page_id, 'https://' || host || path AS link, CASE WHEN regexp_matches(path, '/news/') THEN 3 ELSE 0 END + CASE WHEN regexp_matches(path, '/20[0-9][0-9]/0[1-9]/') THEN 3 ELSE 0 END + CASE WHEN heading THEN 2 ELSE 0 END + CASE WHEN long THEN 1 ELSE 0 END AS score
 FROM (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS host, k, (page_id + k) % 3 = 0 AS heading, (page_id + k) % 4 = 0 AS long, CASE k % 5 WHEN 0 THEN '/news/' WHEN 1 THEN '/2024/0' || (1 + page_id % 9) || '/' WHEN 2 THEN '/news/2023/05/' WHEN 3 THEN '/x/' ELSE '/tag/' END || page_id || '-' || k AS path FROM (SELECT page_id, url, unnest(range(20)) AS k FROM pages)) WHERE k % 5 <> 4) WHERE score >= 2 QUALIFY place <= 12""")
def link_discovery(spark, sf) -> DataFrame:
    i, k = F.col("page_id"), F.col("k")
    path = F.concat(F.when(k % 5 == 0, "/news/").when(k % 5 == 1, F.concat(F.lit("/2024/0"), (1 + i % 9).cast("string"), F.lit("/"))).when(k % 5 == 2, "/news/2023/05/").when(k % 5 == 3, "/x/").otherwise("/tag/"), i.cast("string"), F.lit("-"), k.cast("string"))
    label = F.when((i + k) % 4 == 0, "a label of more than twenty-four characters").otherwise("short")
    a = F.concat(F.lit('<a href="'), path, F.lit('#top">'), label, F.lit('</a><a href="https://other.example.org'), path, F.lit('">x</a>'))
    each = table(spark, sf, "pages").select("page_id", T.host(F.col("url")).alias("host"), F.explode(F.sequence(F.lit(0), F.lit(19))).alias("k")).select("page_id", "host", "k", F.when((i + k) % 3 == 0, F.concat(F.lit("<h2>"), a, F.lit("</h2>"))).otherwise(a).alias("a"))
    index = each.groupBy("page_id", "host").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "a"))), lambda x: x["a"]), "\n").alias("html"))  # twenty links
    return W.discover(index.select("page_id", F.concat(F.lit("https://"), "host", F.lit("/")).alias("url"), "html")).select("page_id", "link", "score", "place")


@query("SELECT page_id, regexp_replace(url, '[?#].*$', '') AS path FROM pages")
def decode_fixed_point(spark, sf) -> DataFrame:
    twice = F.url_encode(F.url_encode(F.regexp_replace("url", "[?#].*$", "")))
    return table(spark, sf, "pages").select("page_id", T.decoded(twice).alias("path"))


@query(_items("SELECT section, count(*) AS n FROM (SELECT section, row_number() OVER (PARTITION BY section ORDER BY stamp DESC, length(text), item_id) AS place FROM (SELECT *, CASE WHEN list_contains(tags, 'map') THEN 'map' WHEN list_contains(tags, 'drones') THEN 'drones' WHEN list_contains(tags, 'logistics') THEN 'logistics' WHEN list_contains(tags, 'relief') THEN 'relief' WHEN grp = 'osint' THEN 'map' WHEN grp IN ('official-ua', 'official-ru') THEN 'official' ELSE 'other' END AS section FROM items WHERE local_day = DATE '2024-01-06')) WHERE place <= 8 GROUP BY 1"))
def digest_sections(spark, sf) -> DataFrame:
    day = S.local_day(V.items(spark, sf), DAY, P.ZONE).withColumn("section", _section())
    return R.digest_lines(day).groupBy("section").agg(F.count(F.lit(1)).alias("n"))


_MD = "regexp_replace({0}, '([\\\\`*_\\[\\]<>])', '\\\\\\1', 'g')"
_SECTIONED = "(SELECT *, CASE WHEN list_contains(tags, 'map') THEN 'map' WHEN list_contains(tags, 'drones') THEN 'drones' WHEN list_contains(tags, 'logistics') THEN 'logistics' WHEN list_contains(tags, 'relief') THEN 'relief' WHEN grp = 'osint' THEN 'map' WHEN grp IN ('official-ua', 'official-ru') THEN 'official' ELSE 'other' END AS section, trim(regexp_replace(coalesce(title, ''), '\\s+', ' ', 'g')) AS t, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS x, coalesce(strftime(published, '%Y-%m-%dT%H:%M:%SZ'), 'undated') AS pub FROM items)"
_LABEL = "coalesce(nullif(t, ''), nullif(substr(x, 1, 280), ''), '(no text)')"
_LINE = f"'- **' || {_MD.format('source_name')} || '** · ' || {_MD.format('pub')} || ' — ' || {_MD.format(_LABEL)} || ' · ' || CASE WHEN regexp_matches(url, '^https?://[^/?#]') THEN '[original](' || url || ')' ELSE 'no original' END"
_ORDER = "coalesce(list_position([" + ", ".join(f"'{x}'" for x in P.SECTIONS) + "], section), 99)"


def _documents(by: str, more: str, source: str, extra: str = "") -> str:
    """The assembled documents of each value of by, as one text a field."""
    counts = lambda c, n="": f"(SELECT {by}, string_agg(name || ': ' || n, ', ' ORDER BY n DESC, name) AS s FROM (SELECT {by}, name, n, row_number() OVER (PARTITION BY {by} ORDER BY n DESC, name) AS r FROM (SELECT {by}, {c} AS name, count(*) AS n FROM d GROUP BY ALL)) {n} GROUP BY 1)"
    return _items(f"""SELECT w.*, p.s AS platforms, g.s AS grps, a.s AS source_names, z.s AS sections{more} FROM (SELECT {by}, count(*) AS items, count(DISTINCT source) AS n_sources, count(*) FILTER (list_contains(tags, 'operational-position')) AS redacted FROM d GROUP BY 1) w
 JOIN {counts('platform')} p USING ({by}) JOIN {counts('grp')} g USING ({by}) JOIN {counts('source_name', 'WHERE r <= 25')} a USING ({by})
 JOIN (SELECT {by}, string_agg(section || ' ' || n || ' ' || greatest(0, n - 8) || chr(10) || lines, chr(10) ORDER BY o, section) AS s FROM (SELECT {by}, section, {_ORDER} AS o, count(*) AS n, string_agg(line, chr(10) ORDER BY place) FILTER (place <= 8) AS lines FROM (SELECT *, {_LINE} AS line, row_number() OVER (PARTITION BY {by}, section ORDER BY stamp DESC, item_id) AS place FROM d) GROUP BY ALL) GROUP BY 1) z USING ({by}) {extra}""").replace("WITH ", "WITH ", 1).replace(" SELECT w.*", f", d AS (SELECT * FROM {source}) SELECT w.*", 1)


def _flat(df: DataFrame) -> DataFrame:
    """Nested parts of documents as text, for comparison."""
    counts = {c: F.array_join(F.transform(c, lambda e: F.concat(e["name"], F.lit(": "), e["n"].cast("string"))), ", ") for c in ("platforms", "grps", "source_names")}
    lines = F.transform("sections", lambda s: F.concat(s["section"], F.lit(" "), s["n"].cast("string"), F.lit(" "), s["more"].cast("string"), F.lit("\n"), F.array_join(s["lines"], "\n")))
    return df.withColumns({**counts, "sections": F.array_join(lines, "\n")})


@query(_documents("local_day", ", previous_day, next_day", f"{_SECTIONED} WHERE local_day IS NOT NULL", "JOIN (SELECT local_day, lag(local_day) OVER (ORDER BY local_day) AS previous_day, lead(local_day) OVER (ORDER BY local_day) AS next_day FROM (SELECT DISTINCT local_day FROM d)) n USING (local_day)"))
def daily_documents(spark, sf) -> DataFrame:
    return _flat(B.daily(V.items(spark, sf).withColumn("section", _section()), P.SECTIONS, P.REDACT_TAGS))


@query(_documents("start", ", c.s AS per_day, start + 6 AS \"end\"", f"(SELECT *, CAST(date_trunc('week', local_day) AS DATE) AS start FROM {_SECTIONED} WHERE local_day IS NOT NULL)", "JOIN (SELECT start, string_agg(day || ' ' || n, ',' ORDER BY day) AS s FROM (SELECT start, CAST(start + CAST(k AS INT) AS DATE) AS day, (SELECT count(*) FROM d WHERE d.local_day = t.start + CAST(k AS INT)) AS n FROM (SELECT start, unnest(range(7)) AS k FROM (SELECT DISTINCT start FROM d)) t) GROUP BY 1) c USING (start)"))
def weekly_documents(spark, sf) -> DataFrame:
    made = B.periods(V.items(spark, sf).withColumn("section", _section()), F.to_date(F.date_trunc("week", "local_day")), 7, P.SECTIONS, P.REDACT_TAGS)
    return _flat(made).withColumn("per_day", F.array_join(F.transform("per_day", lambda d: F.concat(d["day"].cast("string"), F.lit(" "), d["n"].cast("string"))), ","))


@query(_reg(f"""SELECT section, key, n FROM (
 SELECT 'run' AS section, k AS key, CAST(v AS BIGINT) AS n FROM (SELECT unnest(['attempted', 'succeeded', 'skipped', 'errors', 'added']) AS k, unnest([attempted, succeeded, skipped, errors, added]) AS v FROM ({_ROLL}))
 UNION ALL SELECT 'registry', 'configured_total', count(*) FROM registry WHERE enabled UNION ALL SELECT 'registry', 'orphaned_state_sources', count(*) FROM state WHERE source NOT IN (SELECT source FROM registry WHERE enabled)
 UNION ALL SELECT 'source_status_counts', t.st, count(x.source) FROM (VALUES ('ok'), ('error'), ('skipped_config'), ('skipped_cadence'), ('unknown')) t(st) LEFT JOIN (SELECT r.source, coalesce(s.status, 'unknown') AS st FROM registry r LEFT JOIN state s USING (source) WHERE r.enabled) x ON x.st = t.st GROUP BY 2
 UNION ALL SELECT 'by_platform', platform || '.' || st, count(*) FROM (SELECT r.platform, unnest(['configured', coalesce(s.status, 'unknown')]) AS st FROM registry r LEFT JOIN state s USING (source) WHERE r.enabled) GROUP BY 2
 UNION ALL SELECT 'by_group', grp || '.' || st, count(*) FROM (SELECT r.grp, unnest(['configured', coalesce(s.status, 'unknown')]) AS st FROM registry r LEFT JOIN state s USING (source) WHERE r.enabled) GROUP BY 2
 UNION ALL SELECT 'degradation', k, v FROM (SELECT unnest(['source_errors', 'configuration_skips', 'unknown_sources']) AS k, unnest([source_errors, configuration_skips, unknown_sources]) AS v FROM ({_DEGRADED}))
 UNION ALL SELECT 'withholding', t.k, count(i.item_id) FROM (VALUES ('recent', 'withheld_recent'), ('undated', 'withheld_undated')) t(k, st) LEFT JOIN (SELECT item_id, CASE WHEN published IS NULL THEN 'withheld_undated' WHEN epoch_us(TIMESTAMP '{P.NOW}') - epoch_us(published) < 24 * 3600000000 THEN 'withheld_recent' ELSE 'storable' END AS st FROM items) i ON i.st = t.st GROUP BY 2
 UNION ALL SELECT 'freshness', 'latest_source_success_s', max(epoch_us(s.last_success)) // 1000000 FROM registry r JOIN state s USING (source) WHERE r.enabled
 UNION ALL SELECT 'freshness', 'stale', CAST((epoch_us(TIMESTAMP '{P.NOW}') - epoch_us((SELECT max(checked) FROM state))) / 3.6e9 > 1.0 AS INT))""").replace("WITH ", f"WITH {V.ITEMS}, ", 1))
def status_document(spark, sf) -> DataFrame:
    return R.status_tables(V.registry(spark, sf), V.source_state(spark, sf), V.items(spark, sf), now(), P.POLL_SECONDS)


@query(_items("SELECT CASE WHEN grouping(source) = 0 THEN 'source' WHEN grouping(platform) = 0 THEN 'platform' WHEN grouping(grp) = 0 THEN 'grp' ELSE 'section' END AS dimension, coalesce(source, platform, grp, section) AS value, count(*) AS n FROM (SELECT *, CASE WHEN list_contains(tags, 'map') THEN 'map' WHEN list_contains(tags, 'drones') THEN 'drones' WHEN list_contains(tags, 'logistics') THEN 'logistics' WHEN list_contains(tags, 'relief') THEN 'relief' WHEN grp = 'osint' THEN 'map' WHEN grp IN ('official-ua', 'official-ru') THEN 'official' ELSE 'other' END AS section FROM items WHERE local_day BETWEEN DATE '2024-01-01' AND DATE '2024-01-07') GROUP BY GROUPING SETS ((source), (platform), (grp), (section)) UNION ALL SELECT 'local_day', CAST(CAST(d AS DATE) AS VARCHAR), count(i.item_id) FROM range(DATE '2024-01-01', DATE '2024-01-08', INTERVAL 1 DAY) t(d) LEFT JOIN items i ON i.local_day = CAST(d AS DATE) GROUP BY 2"))
def weekly_report(spark, sf) -> DataFrame:
    return R.weekly_counts(V.items(spark, sf), _section(), "2024-01-01", "2024-01-07")


@query(Q.summary())
def summary_documents(spark, sf) -> DataFrame:
    parts = lambda x: [x["place"], x["cluster_id"], x["change"], x["matched_days"], x["evidence_label"], x["pulse_label"], x["items"], x["families"], F.array_join(F.transform(x["samples"], lambda i: i.cast("string")), ",")]
    row = lambda x: F.concat_ws(" ", *[p.cast("string") for p in parts(x)])
    s = B.summary(_prep(spark, sf), Q.WATCH)
    return s.withColumns({c: F.array_join(F.transform(c, row), "\n") for c in ("primary", "watched")})


def flagship(spark, sf) -> DataFrame:
    return editorial_rank(spark, sf)
