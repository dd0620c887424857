"""The cluster analytics as SQL, for the oracle."""

from __future__ import annotations

from corvane.plans import policy as P
from corvane.plans import views as V


def _match(col: str, stems: str) -> str:
    return f"regexp_matches({col}, '{P.word(stems, 'i')}')"


def _has(*names: str) -> str:
    return f"list_has_any(anchors, [{', '.join(repr(n) for n in names)}])"


def _only(*names: str) -> str:
    return f"list_filter(anchors, lambda a: list_contains([{', '.join(repr(n) for n in names)}], a))"


def _case(column: str, values: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " ELSE 0 END"


_ANCHORS = "list_sort(list_filter([" + ", ".join(f"CASE WHEN {_match('body', stem)} THEN '{name}' END" for name, (_, stem) in P.LEXICON.items()) + "], lambda a: a IS NOT NULL))"
_CONTEXT, _ACTION, _SUPPORT = _has(*P.names("context", "location")), _has(*P.names("action", "equipment")), _has(*P.names("support"))
_LOCATED, _CURRENT = "len(locations) > 0", _has("homeland")
_STRIKE = "(list_contains(anchors, 'drone') OR list_contains(anchors, 'missile') OR list_contains(anchors, 'strike'))"
_TOKEN = "([a-zа-яіїєґ0-9][a-zа-яіїєґ0-9''-]{2,})"
_CTX = f"({_LOCATED} OR {_CURRENT} OR grp = 'official-ua')"

def _tokens(text: str) -> str:
    stop = ", ".join(f"'{w}'" for w in P.STOPWORDS)
    return f"list_filter(list_distinct(regexp_extract_all({text}, '{_TOKEN}', 1)), lambda t: length(t) >= 4 AND t NOT IN ({stop}))"


def _canonical(text: str) -> str:
    value = f"lower({text})"
    for name, (_, stem) in P.LEXICON.items():
        value = f"regexp_replace({value}, '{P.word(stem, "i")}[\\p{{L}}\\p{{N}}_]*', '\\1 {name} ', 'g')"
    return value


_DISPLAY = "list_sort(list_filter([" + ", ".join(f"CASE WHEN {_match('body', stem)} THEN '{name}' END" for name, stem in P.DISPLAYED.items()) + "], lambda a: a IS NOT NULL))"

PREP = f"""p0 AS (SELECT item_id, source, platform, grp, perspective, trust, stamp, local_day, lower(source_name) AS family, trim(regexp_replace(concat_ws(' ', title, text), '\\s+', ' ', 'g')) AS body, list_contains(tags, 'operational-position') AS redacted FROM items),
p1 AS (SELECT *, {_ANCHORS} AS anchors, {_canonical('body')} AS canon FROM p0),
p2 AS (SELECT *, CASE WHEN redacted THEN 'redacted' WHEN body = '' THEN 'irrelevant' WHEN grp = 'official-ua' AND ({_ACTION} OR {_SUPPORT}) THEN 'relevant' WHEN {_CONTEXT} AND ({_ACTION} OR {_SUPPORT}) THEN 'relevant' WHEN {_CONTEXT} AND {_match('canon', P.POLITICAL)} THEN 'peripheral' ELSE 'irrelevant' END AS relevance,
 CASE WHEN {_has('casualties')} THEN 'civilian-harm' WHEN {_has('naval')} THEN 'naval' WHEN {_has('air-defence')} THEN 'air-defence' WHEN {_has('drone', 'strike')} THEN 'strikes' WHEN {_has('frontline')} THEN 'frontline' WHEN {_has('refinery', 'railway')} THEN 'energy' WHEN {_has('sanctions', 'aid')} THEN 'support' WHEN {_match('canon', P.INVESTIGATE)} THEN 'investigations' ELSE 'other' END AS first_topic,
 {_only(*P.names('location'))} AS places, {_DISPLAY} AS locations FROM p1),
p3 AS (SELECT *, CASE WHEN {_has('casualties')} THEN CASE WHEN {_STRIKE} THEN 'strikes' ELSE 'civilian-harm' END ELSE first_topic END AS topic FROM p2),
p4 AS (SELECT *, NOT {_match('body', P.MEMORIAL)} AND CASE topic WHEN 'civilian-harm' THEN {_has('casualties')} AND {_CTX} AND ({_LOCATED} OR {_CURRENT} OR {_STRIKE}) WHEN 'strikes' THEN {_CTX} AND {_STRIKE} WHEN 'air-defence' THEN {_CTX} AND {_has('air-defence')} WHEN 'frontline' THEN {_CTX} AND {_has('frontline')}
 WHEN 'energy' THEN {_CTX} AND {_has('refinery', 'railway')} WHEN 'naval' THEN {_CTX} AND {_has('naval')} WHEN 'support' THEN {_has('sanctions', 'aid')} AND ({_CURRENT} OR grp IN ('official-ua', 'international-media', 'analysts')) WHEN 'investigations' THEN grp IN ('osint', 'analysts') AND ({_CTX} OR {_STRIKE} OR {_has('frontline')}) ELSE FALSE END AS strict,
 CASE WHEN topic = 'civilian-harm' THEN ['casualties'] WHEN topic = 'support' THEN CASE WHEN {_has('sanctions')} THEN ['sanctions'] WHEN {_has('aid')} THEN ['aid'] ELSE CAST([] AS VARCHAR[]) END WHEN topic IN ('energy', 'air-defence', 'naval') THEN {_only(*P.names('equipment'))} ELSE CAST([] AS VARCHAR[]) END AS sem FROM p3),
prep AS (SELECT *, CASE WHEN NOT ({_LOCATED}) AND topic NOT IN ('support', 'investigations') THEN list_concat(sem, ['source:' || family]) ELSE sem END AS semantic FROM p4)"""

_KEY = "local_day, topic, locations, semantic"
_WEIGHT = "CASE grp " + " ".join(f"WHEN '{g}' THEN {w}" for g, w in P.WEIGHT.items()) + f" ELSE {P.WEIGHT_OTHER} END"
_RANKS = f"{_case('grp', P.GROUP_RANK)} DESC, {_case('trust', P.TRUST_RANK)} DESC, stamp DESC, item_id"


CLUSTERS = f"""acc AS (SELECT * FROM prep WHERE relevance IN ('relevant', 'peripheral') AND strict),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY}, family ORDER BY {_RANKS}) AS r FROM acc) WHERE r = 1),
eg AS (SELECT {_KEY}, sum(CAST({_WEIGHT} AS DOUBLE) * least(n, 2)) AS score FROM (SELECT {_KEY}, grp, count(*) AS n FROM best GROUP BY {_KEY}, grp) GROUP BY {_KEY}),
ep AS (SELECT {_KEY}, count(DISTINCT CASE WHEN perspective NOT IN ('', 'unknown') THEN perspective END) AS seen FROM best GROUP BY {_KEY}),
ev AS (SELECT {_KEY}, least(10.0, round(score, 9) + CASE WHEN seen >= 2 THEN 1.0 ELSE 0.0 END) AS evidence FROM eg JOIN ep USING ({_KEY})),
tg AS (SELECT {_KEY}, family, count(*) AS n FROM acc WHERE platform = 'telegram' GROUP BY {_KEY}, family),
tp AS (SELECT {_KEY}, count(DISTINCT perspective) FILTER (perspective NOT IN ('', 'unknown')) AS seen FROM acc WHERE platform = 'telegram' GROUP BY {_KEY}),
pu AS (SELECT {_KEY}, round(least(10.0, CAST(1.8 AS DOUBLE) * log2(1 + count(*)) + CAST(0.35 AS DOUBLE) * sum(least(3, n)) + CAST(0.7 AS DOUBLE) * greatest(0, any_value(seen) - 1)), 9) AS pulse FROM tg JOIN tp USING ({_KEY}) GROUP BY {_KEY}),
wo AS (SELECT {_KEY}, list_distinct(flatten(list(toks))) AS token_union FROM (SELECT {_KEY}, {_tokens('canon')} AS toks FROM acc) GROUP BY {_KEY}),
body AS (SELECT {_KEY}, count(*) AS items, min(item_id) AS first_pos, count(DISTINCT family) AS families, list_sort(list_distinct(flatten(list(anchors)))) AS anchor_union, list_sort(list_distinct(flatten(list(places)))) AS place_union, bool_or(place <= 20 AND {_match('body', P.MAJOR)}) AS major, bool_or({_match('body', P.MATERIAL)}) AS material, avg(CAST({_match('body', P.ALERT)} AS INT)) AS alerts
 FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY item_id) AS place FROM acc) GROUP BY {_KEY}),
clusters AS (SELECT b.*, w.token_union, e.evidence, coalesce(p.pulse, 0.0) AS pulse,
 least(10.0, {_case('b.topic', P.IMPORTANCE)} + CASE WHEN major THEN 1.0 ELSE 0.0 END + CASE WHEN list_has_any(anchor_union, ['refinery', 'railway']) THEN 0.5 ELSE 0.0 END + CASE WHEN b.topic = 'civilian-harm' AND list_contains(anchor_union, 'casualties') THEN 0.5 ELSE 0.0 END)::DOUBLE AS importance,
 b.topic IN ('strikes', 'air-defence') AND NOT material AND alerts >= 0.5 AND families <= 3 AS routine, len(b.locations) >= CASE WHEN b.topic = 'civilian-harm' THEN 2 ELSE 3 END AS broad, len(b.locations) = 0 AND b.topic NOT IN ('support', 'investigations') AS weak,
 CASE WHEN b.topic IN ('frontline', 'air-defence', 'naval', 'support') THEN evidence < 3.0 WHEN b.topic = 'energy' THEN evidence < 1.5 ELSE FALSE END AS thin,
 concat_ws('|', CAST(b.local_day AS VARCHAR), b.topic, array_to_string(b.locations, ','), array_to_string(b.semantic, ',')) AS cluster_id
 FROM body b JOIN ev e USING ({_KEY}) JOIN wo w USING ({_KEY}) LEFT JOIN pu p USING ({_KEY}))"""

_PAIRED = "('strikes', 'civilian-harm', 'air-defence', 'energy')"
TEMPORAL = f"""pairs AS (SELECT c.cluster_id, h.local_day AS h_day, h.pulse AS h_pulse, h.first_pos AS h_pos, round(0.55 + 0.30 * (len(list_intersect(c.anchor_union, h.anchor_union)) / len(list_distinct(list_concat(c.anchor_union, h.anchor_union)))) + CASE WHEN len(c.token_union) > 0 AND len(h.token_union) > 0 THEN 0.15 * (len(list_intersect(c.token_union, h.token_union)) / len(list_distinct(list_concat(c.token_union, h.token_union)))) ELSE 0 END, 9) AS score
 FROM clusters c JOIN clusters h ON date_diff('day', h.local_day, c.local_day) BETWEEN 1 AND 7 AND (c.topic = h.topic OR (c.topic IN {_PAIRED} AND h.topic IN {_PAIRED})) AND list_has_any(c.place_union, h.place_union)),
bestday AS (SELECT cluster_id, h_day, h_pulse FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id, h_day ORDER BY score DESC, h_pos) AS r FROM pairs) WHERE r = 1),
base AS (SELECT cluster_id, round(avg(h_pulse), 9) AS baseline, count(*) AS matched_days FROM bestday GROUP BY 1),
ch AS (SELECT c.cluster_id, b.baseline, coalesce(b.matched_days, 0) AS matched_days, CASE WHEN b.baseline IS NULL THEN 'NEW' WHEN b.baseline > 0 AND c.pulse >= b.baseline * CAST(1.8 AS DOUBLE) AND c.pulse - b.baseline >= 1.0 THEN 'ESCALATING' WHEN b.baseline > 0 AND c.pulse <= b.baseline * CAST(0.55 AS DOUBLE) AND b.baseline - c.pulse >= 1.0 THEN 'DECLINING' ELSE 'CONTINUING' END AS change FROM clusters c LEFT JOIN base b USING (cluster_id)),
temporal AS (SELECT cluster_id, change, CAST(CASE change WHEN 'NEW' THEN 9.0 WHEN 'ESCALATING' THEN 7.0 WHEN 'DECLINING' THEN 4.0 ELSE 2.0 END AS DOUBLE) AS novelty, baseline, matched_days FROM ch),
ranked AS (SELECT c.*, round(greatest(0.0, least(10.0, CAST(0.42 AS DOUBLE) * importance + CAST(0.22 AS DOUBLE) * novelty + CAST(0.18 AS DOUBLE) * pulse + CAST(0.18 AS DOUBLE) * evidence + CASE WHEN families >= 4 THEN 0.5 WHEN families = 1 AND topic IN ('strikes', 'air-defence') THEN -0.4 ELSE 0.0 END - CASE WHEN routine THEN 3.0 ELSE 0.0 END - CASE WHEN broad THEN 1.2 ELSE 0.0 END - CASE WHEN weak THEN 1.5 ELSE 0.0 END - CASE WHEN thin THEN 1.0 ELSE 0.0 END)), 9) AS rank FROM clusters c JOIN temporal USING (cluster_id))"""

# a day's clusters by rank, one a step; the chosen ones travel as lists of structs
PRIMARY = """cand AS (SELECT *, row_number() OVER (PARTITION BY local_day ORDER BY rank DESC, first_pos) AS rn FROM ranked WHERE NOT (routine OR broad OR weak OR thin)),
fold AS (SELECT DISTINCT local_day, CAST(0 AS BIGINT) AS rn, CAST([] AS STRUCT(id VARCHAR, topic VARCHAR, locs VARCHAR[], ev DOUBLE, fam BIGINT, items BIGINT, rank DOUBLE)[]) AS sel FROM cand
 UNION ALL SELECT f.local_day, c.rn, CASE WHEN len(f.sel) >= 14 OR len(list_filter(f.sel, lambda s: s.topic = c.topic)) >= 4 OR len(list_filter(f.sel, lambda s: s.topic = c.topic AND len(s.locs) > 0 AND len(s.locs) < len(c.place_union) AND list_has_all(c.place_union, s.locs) AND s.ev >= c.evidence AND (s.fam >= c.families + 2 OR s.items >= greatest(3, 2 * c.items)))) > 0 THEN f.sel
  ELSE list_append(f.sel, struct_pack(id := c.cluster_id, topic := c.topic, locs := c.place_union, ev := c.evidence, fam := c.families, items := c.items, rank := c.rank)) END FROM fold f JOIN cand c ON c.local_day = f.local_day AND c.rn = f.rn + 1),
chosen AS (SELECT local_day, unnest(range(1, len(sel) + 1)) AS place, unnest(sel) AS s FROM (SELECT local_day, arg_max(sel, rn) AS sel FROM fold GROUP BY 1))"""


#: The tests' texts are calm: with the usual threshold of 4 nothing is watched.
WATCH = 1.5


def prepared(body: str) -> str:
    return f"WITH {V.ITEMS}, {PREP} {body}"


def clusters(body: str) -> str:
    return f"WITH {V.ITEMS}, {PREP}, {CLUSTERS} {body}"


def temporal(body: str) -> str:
    return f"WITH {V.ITEMS}, {PREP}, {CLUSTERS}, {TEMPORAL} {body}"


def primary() -> str:
    return f"WITH RECURSIVE {V.ITEMS}, {PREP}, {CLUSTERS}, {TEMPORAL}, {PRIMARY} SELECT local_day, place, s.id AS cluster_id, s.topic AS topic, s.rank AS rank FROM chosen"


def watch() -> str:
    return f"WITH RECURSIVE {V.ITEMS}, {PREP}, {CLUSTERS}, {TEMPORAL}, {PRIMARY} SELECT local_day, place, cluster_id, pulse FROM (SELECT *, row_number() OVER (PARTITION BY local_day ORDER BY pulse DESC, rank DESC, first_pos) AS place FROM ranked WHERE pulse >= {WATCH} AND cluster_id NOT IN (SELECT s.id FROM chosen)) WHERE place <= 6"


def samples() -> str:
    return clusters(f"SELECT item_id, place FROM (SELECT item_id, row_number() OVER (PARTITION BY {_KEY} ORDER BY g > 1, {_RANKS}) AS place FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY}, grp ORDER BY {_RANKS}) AS g FROM best)) WHERE place <= 5")


def tokens() -> str:
    return f"WITH {V.ITEMS} SELECT t, count(*) AS n FROM (SELECT unnest({_tokens('lower(text)')}) AS t FROM items) GROUP BY 1"


def summary() -> str:
    """Each day's counters and, as text, its primary and watched clusters with their labels and samples."""
    row = "place || ' ' || x.cluster_id || ' ' || change || ' ' || matched_days || ' ' || CASE WHEN evidence >= 6.0 THEN 'strong' WHEN evidence >= 3.2 THEN 'mixed' ELSE 'thin' END || ' ' || CASE WHEN pulse >= 6.0 THEN 'high' WHEN pulse >= 3.0 THEN 'medium' ELSE 'low' END || ' ' || items || ' ' || families || ' ' || ids"
    named = f"SELECT {', '.join('c.' + k for k in _KEY.split(', '))}, c.cluster_id, c.evidence, c.pulse, c.items, c.families, t.change, t.matched_days, s.ids FROM clusters c JOIN temporal t USING (cluster_id) JOIN sampled s USING ({_KEY})"
    return f"""WITH RECURSIVE {V.ITEMS}, {PREP}, {CLUSTERS}, {TEMPORAL}, {PRIMARY},
 firsts AS (SELECT {_KEY}, item_id, row_number() OVER (PARTITION BY {_KEY} ORDER BY g > 1, {_RANKS}) AS place FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY}, grp ORDER BY {_RANKS}) AS g FROM best)),
 sampled AS (SELECT {_KEY}, string_agg(item_id, ',' ORDER BY place) AS ids FROM firsts WHERE place <= 5 GROUP BY {_KEY}), named AS ({named}),
 pri AS (SELECT c.local_day, string_agg({row}, chr(10) ORDER BY place) AS primary_ FROM (SELECT local_day, place, s.id AS id FROM chosen) c JOIN named x ON x.cluster_id = c.id GROUP BY 1),
 wat AS (SELECT c.local_day, string_agg({row}, chr(10) ORDER BY place) AS watched FROM (SELECT local_day, cluster_id AS id, row_number() OVER (PARTITION BY local_day ORDER BY pulse DESC, rank DESC, first_pos) AS place FROM ranked WHERE pulse >= {WATCH} AND cluster_id NOT IN (SELECT s.id FROM chosen)) c JOIN named x ON x.cluster_id = c.id WHERE place <= 6 GROUP BY 1),
 gates AS (SELECT local_day, count(*) AS items, count(*) FILTER (relevance IN ('relevant', 'peripheral') AND strict) AS accepted, count(*) FILTER (relevance IN ('relevant', 'peripheral') AND NOT strict) AS strict_filtered, count(*) FILTER (relevance = 'relevant') AS relevant, count(*) FILTER (relevance = 'peripheral') AS peripheral, count(*) FILTER (relevance = 'irrelevant') AS irrelevant, count(*) FILTER (relevance = 'redacted') AS redacted FROM prep WHERE local_day IS NOT NULL GROUP BY 1)
 SELECT g.*, coalesce(n.clusters, 0) AS clusters, p.primary_ AS "primary", w.watched FROM gates g LEFT JOIN (SELECT local_day, count(*) AS clusters FROM clusters GROUP BY 1) n USING (local_day) LEFT JOIN pri p USING (local_day) LEFT JOIN wat w USING (local_day)"""
