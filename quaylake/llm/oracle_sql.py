"""DuckDB SQL of the corpus-selection queries (11 to 13)."""

from __future__ import annotations

from quaylake.llm.license_scan import BASE_PHRASES, NOTICES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

# CRC-32 of the reflected polynomial 0xEDB88320, byte by byte over its table
IMPORTANCE = f"""
WITH RECURSIVE bits AS (
  SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT {_WORDS} AS w FROM benchmark),
doc_word AS (SELECT doc_id, unnest(w) AS f FROM doc),
item_word AS (SELECT unnest(w) AS f FROM item),
known AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM doc_word UNION SELECT f FROM item_word)),
octets AS (SELECT f, list_transform(range(len(h) // 2), lambda j:
             16 * (instr('0123456789ABCDEF', substr(h, CAST(2 * j + 1 AS INTEGER), 1)) - 1)
               + instr('0123456789ABCDEF', substr(h, CAST(2 * j + 2 AS INTEGER), 1)) - 1) AS o FROM known),
bucket AS (SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), o), lambda c, b:
             xor(c >> 8, steps[xor(c & 255, b) + 1])), 4294967295) % 10000 AS b FROM octets, crc),
s AS (SELECT b, count(*) AS n FROM doc_word JOIN bucket USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM item_word JOIN bucket USING (f) GROUP BY b),
total AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s, (SELECT coalesce(sum(n), 0) FROM t) AS t),
gain AS (SELECT s.b, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1.0::DOUBLE) * (total.s + 10000.0::DOUBLE))
                                          / ((s.n + 1.0::DOUBLE) * (total.t + 10000.0::DOUBLE)))) AS BIGINT) AS gain
         FROM s LEFT JOIN t USING (b), total),
weighed AS (SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
            FROM doc_word JOIN bucket USING (f) JOIN gain USING (b) GROUP BY doc_id),
noise AS (SELECT doc_id, len(w) AS n_words, list_reduce(list_transform(range(1, 9), lambda j:
            CAST(instr('0123456789abcdef', substr(sha256('2024:' || doc_id), CAST(j AS INTEGER), 1)) - 1 AS BIGINT)), lambda x, y: 16 * x + y) AS h FROM doc),
scored AS (SELECT n.doc_id, n.n_words, CAST(coalesce(w.n, 0) AS BIGINT) AS n_features, coalesce(w.weight, 0) AS weight,
             coalesce(w.weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
           FROM noise n LEFT JOIN weighed w USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS many FROM scored WHERE n_words >= 20)
SELECT s.doc_id, CAST(s.n_words AS BIGINT) AS n_words, s.n_features, s.weight, s.score,
       CASE WHEN place <= 10 * many // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed USING (doc_id)
"""


def _template_rows() -> str:
    rows = []
    for t, template in enumerate(BASE_PHRASES + NOTICES):
        for at, (word, must) in enumerate(template.words()):
            rows.append(f"({t}, {at}, '{word}', {str(must).lower()}, '{template.label}', {str(template.base).lower()})")
    return ",\n  ".join(rows)


LICENSES = f"""
WITH part(t, pos, w, must, label, base) AS (VALUES {_template_rows()}),
doc AS (SELECT row_number() OVER () AS d, doc_id, {_WORDS} AS words FROM documents),
word AS (SELECT d, unnest(range(len(words))) AS i, unnest(words) AS w FROM doc),
seen AS (SELECT w, count(DISTINCT d) AS df FROM word WHERE w IN (SELECT w FROM part) GROUP BY w),
weight AS (SELECT w, 1 + CAST(floor(1000 * ln(((SELECT count(*) FROM doc) + 1)::DOUBLE / (coalesce(df, 0) + 1)::DOUBLE)) AS BIGINT) AS weight
           FROM (SELECT DISTINCT w FROM part) LEFT JOIN seen USING (w)),
whole AS (SELECT t, any_value(label) AS label, any_value(base) AS base, sum(weight) AS total, count(*) FILTER (must) AS musts
          FROM part JOIN weight USING (w) GROUP BY t),
hit AS (SELECT d, t, i - pos AS start, sum(weight) AS weight, count(*) FILTER (must) AS musts
        FROM word JOIN part USING (w) JOIN weight USING (w) GROUP BY ALL),
found AS (SELECT d, start, label, base, CAST(weight AS DOUBLE) / CAST(total AS DOUBLE) AS share
          FROM hit JOIN whole USING (t) WHERE hit.musts = whole.musts AND weight * 100 >= total * 80),
told AS (SELECT d, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM found GROUP BY d)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM doc LEFT JOIN told USING (d)
"""

DIVERGENCE = f"""
WITH doc AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
word AS (SELECT d, lang, source, unnest(w) AS t FROM doc),
kept AS (SELECT lang, t, count(*) AS lang_n FROM word GROUP BY lang, t HAVING count(DISTINCT d) >= 3),
grp AS (SELECT DISTINCT lang, source FROM doc),
cnt AS (SELECT lang, source, t, count(*) AS n FROM word GROUP BY ALL),
every AS (SELECT g.lang, g.source, k.t, k.lang_n, coalesce(c.n, 0) AS n
          FROM grp g JOIN kept k ON k.lang = g.lang LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t),
share AS (SELECT lang, source, t, n,
            CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // (sum(n) OVER g + count(*) OVER g) AS BIGINT) AS p,
            CAST(1 + (CAST(1000000000 AS HUGEINT) * (lang_n + 1)) // (sum(lang_n) OVER g + count(*) OVER g) AS BIGINT) AS q
          FROM every WINDOW g AS (PARTITION BY lang, source)),
apart AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
          FROM share a JOIN share b ON b.lang = a.lang AND b.t = a.t AND b.source <> a.source GROUP BY ALL),
pair AS (SELECT g.lang, g.source, h.source AS item, coalesce(a.value, 0) AS value
         FROM grp g JOIN grp h ON h.lang = g.lang AND h.source <> g.source
         LEFT JOIN apart a ON a.lang = g.lang AND a.source = g.source AND a.item = h.source),
term AS (SELECT lang, source, t AS item, (p - q) * (p - q) // q AS value FROM share WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pair
UNION ALL
SELECT lang, source, 'term', item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS k FROM term
QUALIFY k <= 200
"""

ORACLE = {
    "op11_importance_resampling": IMPORTANCE,
    "op12_license_scans": LICENSES,
    "op13_source_divergence": DIVERGENCE,
}
