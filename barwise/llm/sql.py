"""DuckDB twins of the queries that SQL can express, with their own lists."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS size,
               array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
g AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
      FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
occ AS (SELECT DISTINCT g.doc_id, g.i, g.size, win.item_id FROM g JOIN win ON g.size = win.size AND g.gram = win.gram),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM occ)) GROUP BY doc_id),
its AS (SELECT doc_id, count(item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
        FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP3 = f"""
WITH u AS (SELECT page_id, coalesce({_LOWER.format("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
                  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, {_LOWER.format("host || path")} AS low, CASE
        WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
    WHEN regexp_matches(low, '(^|[^a-z0-9])(casino-.*\\.|online-casino|free-bets|sports-betting|cheap-pills|viagra|adult-.*\\.|porn|xxx|ads-track|doubleclick|payday-loans|/cgi-bin/|/wp-login|/trackback/)([^a-z0-9]|$)', 's') THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(CAST(doc_id AS VARCHAR)[i])::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295::BIGINT)"""

OP12 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_LEAF.format(n="n_chars")} AS leaf,
         CASE WHEN {_CRC32} % 7 = 0 AND n_chars IS NOT NULL THEN {_LEAF.format(n="(n_chars + 1)")} END AS moved FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY g) AS n FROM d),
low AS (SELECT 0 AS level, g, place, n, leaf AS h FROM l
        UNION ALL
        SELECT level + 1, g, place // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM low WHERE n > 1 GROUP BY level, g, place // 2),
tops AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (SELECT 0 AS level, place, n, h FROM tops
         UNION ALL
         SELECT level + 1, place // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM high WHERE n > 1 GROUP BY level, place // 2),
root AS (SELECT h AS root FROM high WHERE n = 1),
steps AS (SELECT l.g, l.place, 0 AS part, a.level, a.place % 2 AS slot, coalesce(b.h, '') AS other
          FROM l JOIN low a ON a.g = l.g AND a.n > 1 AND a.place = l.place >> a.level LEFT JOIN low b ON b.g = l.g AND b.level = a.level AND b.place = xor(a.place, 1)
          UNION ALL
          SELECT l.g, l.place, 1, a.level, a.place % 2, coalesce(b.h, '')
          FROM l JOIN tops t ON t.g = l.g JOIN high a ON a.n > 1 AND a.place = t.place >> a.level LEFT JOIN high b ON b.level = a.level AND b.place = xor(a.place, 1)),
p AS (SELECT g, place, string_agg(other, '' ORDER BY part, level) AS proof, list(slot || other ORDER BY part, level) AS path FROM steps GROUP BY g, place),
f AS (SELECT l.doc_id, l.leaf, t.h AS subroot, root, coalesce(proof, '') AS proof,
             list_reduce(list_prepend(coalesce(moved, leaf), coalesce(path, [])),
                         lambda a, s: sha256(CASE WHEN s[1] = '0' THEN a || s[2:] ELSE s[2:] || a END)) AS folded_root
      FROM l JOIN tops t ON t.g = l.g CROSS JOIN root LEFT JOIN p ON p.g = l.g AND p.place = l.place)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified FROM f
"""
