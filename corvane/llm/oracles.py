"""DuckDB SQL for the queries that SQL can express: plain groupings of all windows or payloads, with none of the operators' structures."""

from __future__ import annotations

#: Start rows of windows of a smaller document, put together to the stretches that they cover: (doc_id, lo, hi), from 1, hi inclusive.
_STRETCHES = """covered AS (SELECT w.doc_id, w.k FROM wins w JOIN least l ON l.w = w.w WHERE l.d < w.doc_id),
 edges AS (SELECT doc_id, k, CASE WHEN k <= lag(k) OVER (PARTITION BY doc_id ORDER BY k) + {n} THEN 0 ELSE 1 END AS fresh FROM covered),
 numbered AS (SELECT doc_id, k, sum(fresh) OVER (PARTITION BY doc_id ORDER BY k) AS island FROM edges),
 spans AS (SELECT doc_id, island, min(k) AS lo, max(k) + {n} - 1 AS hi FROM numbered GROUP BY 1, 2),
 kept AS (SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) + 1 AS a, lo - 1 AS z FROM spans
  UNION ALL SELECT d.doc_id, coalesce((SELECT max(hi) FROM spans s WHERE s.doc_id = d.doc_id), 0) + 1, d.n FROM docs d)"""

SUFFIX_TREE = f"""WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS u, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n FROM documents),
 wins AS (SELECT doc_id, k, md5(array_to_string(u[k : k + 12], ' ')) AS w FROM (SELECT doc_id, u, unnest(range(1, n - 11)) AS k FROM docs WHERE n >= 13)),
 least AS (SELECT w, min(doc_id) AS d FROM wins GROUP BY 1),
 {_STRETCHES.format(n=13)}
SELECT d.doc_id, CAST(any_value(d.n) AS BIGINT) AS n_words, CAST(any_value(d.n) - sum(greatest(0, z - a + 1)) AS BIGINT) AS n_removed,
 sha256(coalesce(string_agg(array_to_string(d.u[a : z], ' '), ' ' ORDER BY a) FILTER (z >= a), '')) AS kept_sha256
FROM docs d JOIN kept USING (doc_id) GROUP BY d.doc_id"""

SUFFIX_ARRAY = f"""WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS u, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
 blocks AS (SELECT doc_id, o, substr(u, 2 * o + 1, 2 * (256 + 49)) AS u FROM (SELECT doc_id, u, unnest(range(0, n, 256)) AS o FROM docs)),
 wins AS (SELECT doc_id, o + j AS k, md5(substr(u, 2 * j - 1, 100)) AS w FROM (SELECT doc_id, o, u, unnest(range(1, least(257, CAST(len(u) / 2 AS BIGINT) - 48))) AS j FROM blocks)),
 least AS (SELECT w, min(doc_id) AS d FROM wins GROUP BY 1),
 {_STRETCHES.format(n=50)}
SELECT d.doc_id, CAST(any_value(d.n) AS BIGINT) AS n_bytes, CAST(any_value(d.n) - sum(greatest(0, z - a + 1)) AS BIGINT) AS n_removed,
 (SELECT count(*) FROM spans s WHERE s.doc_id = d.doc_id) AS n_spans,
 sha256(unhex(coalesce(string_agg(substr(d.u, 2 * a - 1, 2 * (z - a + 1)), '' ORDER BY a) FILTER (z >= a), ''))) AS kept_sha256
FROM docs d JOIN kept USING (doc_id) GROUP BY d.doc_id"""

_FIVE = " + ".join(f"{16 >> j} * CAST(substr(b, 5 * i + {j + 1}, 1) AS INT)" for j in range(5))
WARC = f"""WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
 d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, CAST(CAST(unhex(sha1(payload)) AS BIT) AS VARCHAR) AS b, max(page_id) OVER (PARTITION BY payload) AS top FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_FIVE}, 1)), '') AS payload_digest,
 CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM d"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
DECONTAMINATION = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS u FROM documents),
 b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS u FROM benchmark),
 iw AS (SELECT DISTINCT item, least(len(u), 10) AS m, array_to_string(u[k : k + least(len(u), 10) - 1], ' ') AS w FROM (SELECT item, u, unnest(range(1, greatest(2, len(u) - 8))) AS k FROM b WHERE len(u) > 0)),
 dw AS (SELECT r, k, m, array_to_string(u[k : k + m - 1], ' ') AS w FROM (SELECT r, u, m, unnest(range(1, len(u) - m + 2)) AS k FROM d JOIN (SELECT DISTINCT m FROM iw) ON len(u) >= m)),
 hits AS (SELECT r, k, m, item FROM dw JOIN iw USING (m, w)),
 hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(k, k + m)) AS p FROM hits) GROUP BY 1),
 its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hits) GROUP BY 1)
SELECT doc_id, len(u) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)"""

COLLOCATIONS = f"""WITH p AS (SELECT lang, row_number() OVER () AS r, piece FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
 q AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS u FROM p),
 g AS (SELECT lang, u, unnest(range(1, len(u) + 1)) AS k FROM q WHERE len(u) > 0),
 f AS (SELECT lang, m, array_to_string(u[k : k + m - 1], ' ') AS s, count(*) AS f FROM g, (SELECT unnest([1, 2, 3]) AS m) WHERE k + m - 1 <= len(u) GROUP BY ALL),
 t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY 1),
 c AS (SELECT lang, m, s, f AS a, string_split(s, ' ') AS u FROM f WHERE m > 1 AND f >= 10),
 cuts AS (SELECT c.lang, c.m, s, a, u, k, x.f AS l, y.f AS r, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS score FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
  JOIN (SELECT lang, s AS xs, f FROM f) x ON x.lang = c.lang AND xs = array_to_string(u[1:k], ' ') JOIN (SELECT lang, s AS ys, f FROM f) y ON y.lang = c.lang AND ys = array_to_string(u[k + 1:], ' ')),
 best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, k) = 1),
 held AS (SELECT lang, s, max(a) AS a FROM (SELECT lang, a, unnest([array_to_string(u[1:2], ' '), array_to_string(u[2:3], ' ')]) AS s FROM c WHERE m = 3) GROUP BY 1, 2),
 kept AS (SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.s = b.s AND b.m = 2 WHERE h.a IS NULL OR 100 * h.a < 50 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank, s AS phrase, a, l, r, CAST(score AS BIGINT) AS score FROM kept) JOIN t USING (lang) WHERE rank <= 2000"""


def _repair() -> str:
    """Damage by checksum, faults by windows, and the cheapest audits turn by turn: for each state what the roles end in,
    the least (cost, audit, repaired) of all macros, with audits and texts as they are."""
    after, name = (lambda s: 3 if s == 2 else 2), {2: "user", 3: "assistant"}
    to: dict[int, list[str]] = {t: [f"{{'c': s[{t + 1}].c + 3, 'a': s[{t + 1}].a || 'D', 'r': s[{t + 1}].r}}"] for t in range(4)}
    for s in range(4):
        at, put = s, ""
        for k in range(3):
            made = lambda e, t, cost, text, s=s, k=k, put=put: to[t].append(f"{{'c': s[{s + 1}].c + {2 * k} + (f = 3)::INT + {cost} + CASE WHEN f IN (1, 2) THEN 1000000000 ELSE 0 END, 'a': s[{s + 1}].a || '{'I' * k}{e}', 'r': s[{s + 1}].r || {put or chr(39) * 2} || {text}}}")
            kept = {"s": 1} if at == 0 and k == 0 else {}
            kept |= {"u": 2} if at != 2 else {"a": 3}
            for i, t in kept.items():
                made("K", t, f"CASE WHEN i = '{i}' THEN 0 ELSE 1000000000 END", "chr(10) || role || ':' || text")
            made("R", after(at), 2, f"chr(10) || '{name[after(at)]}:' || text")
            at = after(at)
            put = (put + " || " if put else "") + f"chr(10) || '{name[at]}:'"
    best = ", ".join(f"list_sort([{', '.join(to[t])}])[1]" for t in range(4))
    ends = "[s[1], s[4], {'c': s[3].c + 2, 'a': s[3].a || 'I', 'r': s[3].r || chr(10) || 'assistant:'}, {'c': s[2].c + 4, 'a': s[2].a || 'II', 'r': s[2].r || chr(10) || 'user:' || chr(10) || 'assistant:'}]"
    kind = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR)[]"
    return f"""WITH RECURSIVE tbl AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) x(i))),
 keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ord(ch) AS BIGINT)) AS codes FROM conversations),
 crc AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295], codes), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS k FROM keyed, tbl),
 dam AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM crc WHERE k <> 0),
 num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM dam),
 rows_ AS (SELECT conv_id, turn, role, text, rn, substr(role, 1, 1) AS i, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 2 WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 3 ELSE 0 END AS f, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY rn) AS before FROM num),
 facts AS (SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps, count(*) FILTER (f = 1) AS blank, count(*) FILTER (f = 2) AS duplicate, count(*) FILTER (f = 3) AS truncated, count(*) FILTER (rn > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, max(rn) AS n FROM rows_ GROUP BY 1),
 fold AS (SELECT conv_id, CAST(0 AS BIGINT) AS rn, CAST([{{'c': 0, 'a': '', 'r': ''}}, {{'c': 1000000000, 'a': '', 'r': ''}}, {{'c': 1000000000, 'a': '', 'r': ''}}, {{'c': 1000000000, 'a': '', 'r': ''}}] AS {kind}) AS s FROM facts
  UNION ALL SELECT d.conv_id, d.rn, CAST([{best}] AS {kind}) FROM fold o JOIN rows_ d ON d.conv_id IS NOT DISTINCT FROM o.conv_id AND d.rn = o.rn + 1),
 done AS (SELECT f.conv_id, f.gaps, f.blank, f.duplicate, f.truncated, f.illegal, list_sort({ends})[1] AS e FROM facts f JOIN fold o ON o.conv_id IS NOT DISTINCT FROM f.conv_id AND o.rn = f.n),
 every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, CAST(coalesce(d.gaps, 0) AS BIGINT) AS gaps, coalesce(d.blank, 0) AS blank, coalesce(d.duplicate, 0) AS duplicate, coalesce(d.truncated, 0) AS truncated, coalesce(d.illegal, 0) AS illegal, CAST(coalesce(d.e.c, 0) AS BIGINT) AS cost, coalesce(d.e.a, '') AS audit, sha256(coalesce(substr(d.e.r, 2), '')) AS repaired_sha256
FROM every e LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM e.conv_id"""


REPAIR = _repair()
