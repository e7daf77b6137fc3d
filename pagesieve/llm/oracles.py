"""The queries of this folder that SQL can express, as DuckDB runs them."""

from __future__ import annotations

from pagesieve.llm.decontaminate import WINDOW
from pagesieve.llm.licences import GAP, RULES, SENTENCES, normalised_text
from pagesieve.llm.mixing import BLANKS, Mix
from pagesieve.llm.queries import LINKED, URL_RULES
from pagesieve.llm.url_rules import SMALL, UPPER
from pagesieve.llm.warc import REVISIT_BYTES


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


WARC = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), t AS (
  SELECT payload_digest, max(page_id) AS target FROM p WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN t.target > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN t.target > p.page_id THEN t.target END AS refers_to
FROM p LEFT JOIN t ON p.payload_digest = t.payload_digest AND p.payload_bytes >= {REVISIT_BYTES}
"""

OVERLAP = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), w AS (
  SELECT DISTINCT item_id, least(len(words), {WINDOW}) AS size,
    array_to_string(list_slice(words, pos, pos + least(len(words), {WINDOW}) - 1), ' ') AS line
  FROM (SELECT *, unnest(range(1, greatest(len(words) - {WINDOW} + 1, 1) + 1)) AS pos FROM b WHERE len(words) > 0)
), r AS (
  SELECT row, pos, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS line
  FROM (SELECT d.*, s.size, unnest(range(1, len(words) - s.size + 2)) AS pos FROM d, (SELECT DISTINCT size FROM w) s)
), h AS (
  SELECT r.row, r.pos, w.size, w.item_id FROM r JOIN w ON r.line = w.line AND r.size = w.size
), c AS (
  SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(pos, pos + size)) AS word FROM h) GROUP BY row
), i AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY row
)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (row) LEFT JOIN i USING (row)
"""


def _licences() -> str:
    known = ", ".join(f"({quoted(normalised_text(text))}, {quoted(name)})" for text, name in SENTENCES.items())
    steps, last = [], "s0"
    for at, (_, of) in enumerate(RULES):
        line = quoted("".join(f"<{x}>" for x in of))
        steps.append(f"s{at + 1} AS (SELECT *, replace(rest{at}, {line}, '|') AS rest{at + 1}, contains(rest{at}, {line}) AS f{at} FROM {last})")
        last = f"s{at + 1}"
    parts = ", ".join(f"CASE WHEN f{at} THEN {quoted(name)} END" for at, (name, _) in enumerate(RULES))
    return rf"""
WITH known(line, id) AS (VALUES {known}),
d AS (
  SELECT row_number() OVER () AS row, doc_id,
    list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\n+|[.!?;:]+[ \t\r\n]+|[.!?;:]+$'),
      lambda s: trim(regexp_replace(translate(s, '{UPPER}', '{SMALL}'), '[^a-z0-9\x{{80}}-\x{{10FFFF}}]+', ' ', 'g'))), lambda s: s <> '') AS cut
  FROM documents
), m AS (
  SELECT row, pos, id, lag(pos) OVER (PARTITION BY row ORDER BY pos) AS before
  FROM (SELECT row, unnest(cut) AS line, unnest(range(0, len(cut))) AS pos FROM d) JOIN known USING (line)
), q AS (
  SELECT row, count(*) AS n_known, string_agg(CASE WHEN pos - before > {GAP + 1} THEN '| ' ELSE '' END || id, ' ' ORDER BY pos) AS sentence_ids
  FROM m GROUP BY row
), s0 AS (SELECT row, n_known, sentence_ids, '<' || replace(sentence_ids, ' ', '><') || '>' AS rest0 FROM q),
{", ".join(steps)},
f AS (SELECT *, list_filter([{parts}], lambda x: x IS NOT NULL) AS found FROM {last})
SELECT d.doc_id, len(d.cut) AS n_sentences, coalesce(f.n_known, 0) AS n_known, coalesce(f.sentence_ids, '') AS sentence_ids,
  coalesce(array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ','), '') AS licences
FROM d LEFT JOIN f USING (row)
"""


NEAR = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, pos, pos + {LINKED.shingle - 1}), ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(len(words) - {LINKED.shingle - 1}, 1) + 1)) AS pos FROM d WHERE len(words) > 0)
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id
), l AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * common >= {LINKED.percent} * (p.n_shingles + q.n_shingles - common)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a
)
SELECT d.doc_id, coalesce(n.n_shingles, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

_RULES = ", ".join(f"({quoted(host)}, {quoted(path)}, {quoted(verdict)})" for host, path, verdict in URL_RULES)
URLS = rf"""
WITH r(rule_host, rule_path, verdict) AS (VALUES {_RULES}),
a AS (
  SELECT row_number() OVER () AS row, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), u AS (
  SELECT row, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{SMALL}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a
), f AS (
  SELECT u.row, r.rule_host || r.rule_path AS rule, r.verdict,
    row_number() OVER (PARTITION BY u.row ORDER BY length(r.rule_host || r.rule_path) DESC) AS n
  FROM u JOIN r ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path)
)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM u LEFT JOIN f ON u.row = f.row AND f.n = 1
"""

def _mixing(mix: Mix = Mix()) -> str:
    weights = "[" + ", ".join(map(str, mix.weights)) + "]"
    cap = f"CAST({mix.cap!r} AS DOUBLE)"
    return rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^{BLANKS}]+')), 0) AS BIGINT) AS size,
    md5(concat_ws(chr(0), coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))) AS ord
  FROM documents
), g AS (
  SELECT source, sum(size) AS size FROM d GROUP BY source
), w AS (
  SELECT source, size, CAST({weights}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mix.weights)}) + 1] AS BIGINT) AS weight FROM g
), k AS (
  SELECT DISTINCT {cap} * size / weight AS theta FROM w
), c AS (
  SELECT (SELECT coalesce(sum(size), 0) FROM w WHERE {cap} * w.size / w.weight <= k.theta) AS capped_size,
    (SELECT coalesce(sum(weight), 0) FROM w WHERE {cap} * w.size / w.weight > k.theta) AS free_weight FROM k
  UNION ALL SELECT 0, (SELECT sum(weight) FROM w)
), m AS (
  SELECT ((SELECT sum(size) FROM w) - {cap} * capped_size) / free_weight AS mu, capped_size, free_weight FROM c WHERE free_weight > 0
), fixed AS (
  SELECT coalesce(min(mu), 0) AS mu FROM m
  WHERE capped_size = (SELECT coalesce(sum(size), 0) FROM w WHERE w.weight * m.mu >= {cap} * w.size)
    AND free_weight = (SELECT coalesce(sum(weight), 0) FROM w WHERE NOT (w.weight * m.mu >= {cap} * w.size))
), t AS (
  SELECT w.source, w.size AS source_size, w.weight, least({cap} * w.size, fixed.mu * w.weight) AS target FROM w, fixed
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t
), swept AS (
  SELECT d.doc_id, d.source, d.size, r.source_size, r.weight, r.target, r.rate,
    r.target - floor(r.rate) * r.source_size AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, source, size, source_size, weight, target, rate,
  CAST(floor(rate) AS BIGINT) + CASE WHEN CAST(2 AS DOUBLE) * before + size < CAST(2 AS DOUBLE) * budget THEN 1 ELSE 0 END AS copies,
  (CAST(floor(rate) AS BIGINT) + CASE WHEN CAST(2 AS DOUBLE) * before + size < CAST(2 AS DOUBLE) * budget THEN 1 ELSE 0 END) * size AS taken
FROM swept
"""


ORACLES = {
    "op3_warc_archives": WARC,
    "op4_benchmark_overlap": OVERLAP,
    "op5_licence_scan": _licences(),
    "op9_near_duplicates": NEAR,
    "op10_url_rules": URLS,
    "op11_source_mixing": _mixing(),
}
