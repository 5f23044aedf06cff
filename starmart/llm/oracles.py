"""Expected answers in SQL, written from the definitions, for the queries that SQL can express on whole tables.

None for the trained models (5, 8, 10), the random mix (6) and the chunks (9): their tests hold them against plain code.
"""

from __future__ import annotations

from starmart.llm import licenses, lines

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Words of both kinds, as RE2 classes of bytes below 0x80.
_SPACED = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_LETTERS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_REACH = """
reach AS (
  SELECT a AS id, a AS other FROM links UNION SELECT b, b FROM links
  UNION SELECT r.id, CASE WHEN l.a = r.other THEN l.b ELSE l.a END FROM reach r JOIN links l ON l.a = r.other OR l.b = r.other),
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACED.format(_LOWER)} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.t = b.t AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
{_REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM s LEFT JOIN component ON id = doc_id"""


def _op2() -> str:
    rules = licenses.rules()
    values = ",\n".join(f"({i}, '{r.label}', {r.base}, {r.priority}, ' {r.keyword} ', '{r.regex}')" for i, r in enumerate(rules))
    spaces = "[length(x) - length(replace(x, ' ', '')) FOR x IN {0}]"
    return f"""
WITH rules(rule, label, base, priority, keyword, regex) AS (VALUES {values}),
n AS (SELECT doc_id, trim(regexp_replace({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', '  ', 'g')) AS n FROM documents),
d AS (SELECT doc_id, CASE WHEN n = '' THEN '' ELSE ' ' || n || ' ' END AS words FROM n),
m AS (SELECT doc_id, r.*, {spaces.format('string_split_regex(words, regex)')} AS p, {spaces.format('regexp_extract_all(words, regex)')} AS q
  FROM d JOIN rules r ON contains(words, keyword) AND ({' OR '.join(f"contains(words, '{g}')" for g in licenses.GATES)})),
f AS (SELECT doc_id, rule, label, base, priority, i,
        CAST((list_sum(p[1:i]) + coalesce(list_sum(q[1:i - 1]), 0)) // 2 AS BIGINT) AS start,
        CAST((list_sum(p[1:i]) + list_sum(q[1:i])) // 2 - 1 AS BIGINT) AS last
  FROM (SELECT *, unnest(range(1, len(q) + 1)) AS i FROM m)),
k AS (SELECT *, NOT EXISTS (SELECT 1 FROM f e WHERE e.doc_id = f.doc_id AND e.start <= f.start AND e.last >= f.last AND e.priority >= f.priority
        AND (e.start < f.start OR e.last > f.last OR e.priority > f.priority OR e.rule < f.rule)) AS kept FROM f),
g AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR kept) AS labels, max(priority) FILTER (kept) / 100.0 AS score
  FROM k GROUP BY doc_id)
SELECT doc_id, CAST((length(words) - length(replace(words, ' ', ''))) // 2 AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN g USING (doc_id)"""


OP3 = f"""
WITH l AS (SELECT doc_id, source, string_split(text, chr(10)) AS a FROM documents),
e AS (SELECT doc_id, source, unnest(a) AS value, unnest(range(len(a))) AS line FROM l),
k AS (SELECT *, trim(translate(value, chr(9) || chr(11) || chr(12) || chr(13), '    ')) AS bare FROM e),
b AS (SELECT bare, min((doc_id, line)) AS kept FROM k WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {lines.MIN_SITES}),
r AS (SELECT doc_id, line, value, b.bare IS NOT NULL AND (doc_id, line) <> kept AS gone FROM k LEFT JOIN b USING (bare))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  coalesce(string_agg(value, chr(10) ORDER BY line) FILTER (NOT gone), '') AS text
FROM r GROUP BY doc_id"""

OP4 = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
g AS (SELECT * FROM v WHERE x IS NOT NULL AND len([c FOR c IN x IF c IS NULL OR NOT isfinite(c)]) = 0 AND len([c FOR c IN x IF c <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id < b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
{_REACH},
n AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM v LEFT JOIN component c ON c.id = vec_id LEFT JOIN n ON n.id = vec_id"""

OP7 = f"""
WITH i AS (SELECT item_id, {_LETTERS.format(_LOWER)} AS w FROM benchmark),
p AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS size,
        unnest([array_to_string(w[j:j + least(len(w), 10) - 1], ' ') FOR j IN range(1, greatest(len(w) - 10, 0) + 2)]) AS pattern FROM i WHERE len(w) > 0),
d AS (SELECT doc_id, {_LETTERS.format(_LOWER)} AS w FROM documents),
o AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM d, (SELECT DISTINCT size FROM p) WHERE len(w) >= size),
f AS (SELECT doc_id, pos, o.size, item FROM o JOIN p ON o.size = p.size AND array_to_string(w[pos:pos + o.size - 1], ' ') = pattern),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS x FROM f) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM f GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""

ORACLES = {"op1_ngram_jaccard": OP1, "op2_license_scan": _op2(), "op3_line_dedup": OP3, "op4_embedding_neardup": OP4,
           "op7_benchmark_decontamination": OP7}
