"""DuckDB twins of the dealt queries that SQL can express, over the same tables."""

from __future__ import annotations

from gleaner.llm import licenses, secrets, urlpaths

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _kind(number: int, kind: str, pattern: str, group: int = 0, least: int = 0) -> str:
    p = _quoted(pattern)
    return f"""SELECT doc_id, {number} AS kind, '{kind}' AS name, regexp_extract_all(t, {p}) AS hits,
      regexp_extract_all(t, {p}, {group}) AS parts, string_split_regex(t, {p}) AS gaps, {least} AS least FROM d WHERE regexp_matches(t, {p})"""


def secrets_sql(window: int = 200) -> str:
    kinds = [
        ("assign", secrets.ASSIGN, 2, 8), ("access", secrets.ACCESS, 0, 0), ("hex", secrets.HEX, 0, 0),
        ("weak_secret", secrets.WEAK, 0, 0), ("identifier", secrets.IDENTIFIER, 0, 0), ("endpoint", secrets.ENDPOINT, 0, 0),
    ]
    each = "\n  UNION ALL ".join(_kind(i, k, p, g, n) for i, (k, p, g, n) in enumerate(kinds))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS ({each}),
u AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM k),
s AS (
  SELECT doc_id, kind, name, CAST(start AS BIGINT) AS start, CAST(start + length(hits[i]) AS BIGINT) AS stop FROM (
    SELECT *, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
    FROM u WHERE length(parts[i]) >= least)),
base AS (SELECT * FROM s WHERE kind < 3),
parts AS (
  SELECT * FROM base UNION ALL
  SELECT * FROM s WHERE kind >= 3 AND NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = s.doc_id AND b.start < s.stop AND s.start < b.stop)),
linked AS (
  SELECT * FROM parts w WHERE kind IN (3, 4) AND EXISTS (
    SELECT 1 FROM parts o WHERE o.doc_id = w.doc_id AND (o.kind IN (0, 2, 3)) = (w.kind = 4)
      AND o.start <= w.stop + {window} AND o.stop >= w.start - {window})),
b AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans FROM base GROUP BY doc_id),
a AS (
  SELECT doc_id, string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans
  FROM (SELECT * FROM base UNION ALL SELECT * FROM linked) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(b.spans, '')) AS base_sha256, coalesce(a.spans, '') AS spans
FROM d LEFT JOIN b ON b.doc_id = d.doc_id LEFT JOIN a ON a.doc_id = d.doc_id
"""


def licenses_sql(slack: int = 3, share: float = 0.7) -> str:
    given = [*licenses.PHRASES, *licenses.TEMPLATES]
    rows = ", ".join(f"({i}, '{label}', '{words}')" for i, (label, words) in enumerate(given))
    base = len(licenses.PHRASES)
    return f"""
WITH t AS (SELECT template, label, string_split(phrase, ' ') AS w FROM (VALUES {rows}) v(template, label, phrase)),
tg AS (
  SELECT template, i - 1 AS tpos, len(w) - 2 AS grams, array_to_string(w[i:i + 2], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM t)),
d AS (SELECT doc_id, {WORDS} AS w FROM documents),
dg AS (SELECT doc_id, i - 1 AS pos, array_to_string(w[i:i + 2], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM d)),
v AS (
  SELECT doc_id, template, grams, pos - tpos AS diagonal, list_distinct(list(tpos)) AS mask, min(pos) AS low, max(pos) AS high
  FROM dg JOIN tg USING (gram) GROUP BY ALL),
o AS (
  SELECT *, coalesce(abs(diagonal - lag(diagonal) OVER x) > {slack} OR low - max(high) OVER y > {licenses.K + slack}, false) AS opens FROM v
  WINDOW x AS (PARTITION BY doc_id, template ORDER BY low, diagonal),
    y AS (PARTITION BY doc_id, template ORDER BY low, diagonal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id, template ORDER BY low, diagonal ROWS UNBOUNDED PRECEDING) AS part FROM o),
s AS (
  SELECT doc_id, template, part, len(list_distinct(flatten(list(mask)))) / any_value(grams) AS coverage,
    list(diagonal) FILTER (len(mask) = grams) AS exact FROM p GROUP BY ALL),
k AS (SELECT s.*, label, template < {base} AND coalesce(len(exact), 0) > 0 AS is_base FROM s JOIN t USING (template)
  WHERE coverage >= {share} OR coalesce(len(exact), 0) > 0),
g AS (
  SELECT doc_id, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels,
    array_to_string(list_sort(list_distinct(list(label) FILTER (is_base))), ',') AS base_labels, max(coverage) AS score,
    flatten(list(exact) FILTER (is_base)) AS places FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_base,
  CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""


DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, {WORDS} AS w FROM documents),
b AS (
  SELECT item_id, {WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win, least(13, len(w)) AS k
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
h AS (SELECT DISTINCT doc_id, i, k, dw.win FROM dw SEMI JOIN iw USING (win)),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM h) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h JOIN iw USING (win)) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def urls_sql(purity: float = 0.8) -> str:
    fits = [
        (f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", verdict, h + p)
        for verdict, h, p in sorted(urlpaths.RULES, key=lambda r: -len(r[1] + r[2]))
    ]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{text}'" for f, _, text in fits) + " END"
    said = "CASE " + " ".join(f"WHEN {f} THEN '{verdict}'" for f, verdict, _ in fits) + " END"
    return rf"""
WITH RECURSIVE u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{urlpaths.UPPER}', '{urlpaths.LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, {rule} AS rule, {said} AS said FROM u),
t(host, path, n, blocked, allowed, parts, level, parent, template) AS (
  SELECT host, path, n, blocked, allowed, string_split(path[2:], '/'), 0, '', ''
  FROM (SELECT host, path, count(*) AS n, count(*) FILTER (said = 'block') AS blocked, count(*) FILTER (said = 'allow') AS allowed FROM r GROUP BY ALL)
  UNION ALL
  SELECT host, path, n, blocked, allowed, parts, level + 1, template, template || '/' || CASE WHEN pages >= {urlpaths.LEAST_PAGES} THEN segment
    ELSE CASE WHEN regexp_matches(stem, '^[0-9]+$') THEN '{{n}}' WHEN segment = '' THEN '' ELSE '{{s}}' END || ending END
  FROM (SELECT *, parts[level + 1] AS segment, sum(n) OVER (PARTITION BY host, template, parts[level + 1]) AS pages,
      regexp_extract(segment, '(\.[A-Za-z0-9]{{1,5}})$', 1) AS ending, segment[:length(segment) - length(ending)] AS stem
    FROM t WHERE level < len(parts))),
l AS (SELECT * FROM t WHERE level = len(parts)),
o AS (SELECT host, parent, template, sum(blocked) AS b, sum(allowed) AS a FROM l GROUP BY ALL),
p AS (SELECT *, sum(b) OVER w / greatest(sum(a + b) OVER w, 1) AS share FROM o WINDOW w AS (PARTITION BY host, parent)),
q AS (
  SELECT *, CASE WHEN a + b = 0 THEN false
    ELSE abs(b / (a + b) - share) <= {urlpaths.SIMILAR} * sqrt(share * (1 - share) / (a + b)) END AS pooled FROM p),
z AS (
  SELECT host, template, CASE WHEN pooled THEN sum(b) FILTER (pooled) OVER w ELSE b END AS b,
    CASE WHEN pooled THEN sum(a) FILTER (pooled) OVER w ELSE a END AS a FROM q WINDOW w AS (PARTITION BY host, parent)),
k AS (SELECT host, template, CAST((b + 1) / (a + b + 2) AS DOUBLE) AS purity FROM z)
SELECT page_id, r.host, r.path, rule, coalesce(said, CASE WHEN purity >= {purity} THEN 'block' ELSE 'allow' END) AS verdict, t.template, purity
FROM r JOIN l t ON t.host = r.host AND t.path = r.path JOIN k ON k.host = t.host AND k.template = t.template
"""


EXACT = r"""WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
  SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256 FROM t"""
