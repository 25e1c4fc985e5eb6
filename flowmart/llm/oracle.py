"""DuckDB SQL of the queries of this subpackage that SQL can express."""

from __future__ import annotations

_SPACE_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Operator 4: exact links on distinct four-word shingles, components by reachability.
NEAR_DEDUP = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_SPACE_WORD}') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]) END AS s FROM w),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c
  FROM one a JOIN one b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM pairs WHERE 100 * c >= 80 * (n + m - c)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM sets UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.v) AS component_id, s.doc_id = min(r.v) AS kept
FROM sets s JOIN reach r ON r.u = s.doc_id GROUP BY s.doc_id, s.s
"""

# Operator 6: windows of each item, their occurrences in the documents, the words they cover.
DECONTAMINATE = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws
  FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS k,
    array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS x
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM bw WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
place AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS x
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM dw, sizes WHERE len(ws) >= k)),
hit AS (SELECT p.doc_id, p.k, p.i, w.item_id FROM place p JOIN win w ON p.k = w.k AND p.x = w.x),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT dw.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
  sha256(coalesce(t.list, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered c USING (doc_id) LEFT JOIN items t USING (doc_id)
"""

# Operator 10: every window of 35 words by its words, counted; the words of repeated ones go.
SUBSTRING_DEDUP = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACE_WORD}') AS ws FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS x
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
twice AS (SELECT x FROM win GROUP BY x HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM win JOIN twice USING (x)),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS t FROM word ANTI JOIN gone USING (doc_id, j)
  GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.t, '')) AS kept_sha256
FROM w LEFT JOIN kept k USING (doc_id)
"""


def _centroids() -> str:
    """Operator 11: assignments and updates written out round by round, one row per component."""
    def assign(i: int) -> str:
        return f"""
d{i} AS MATERIALIZED (
  SELECT r, c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN c{i} m USING (j) GROUP BY r, c),
a{i} AS MATERIALIZED (
  SELECT r, c, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, c) AS o FROM d{i}) WHERE o = 1)"""

    def update(i: int) -> str:
        return f"""
c{i + 1} AS MATERIALIZED (
  SELECT m.c, m.j, coalesce(n.x, m.x) AS x FROM c{i} m LEFT JOIN (
    SELECT a.c, v.j, CAST(floor(CAST(sum(v.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
    FROM a{i} a JOIN v USING (r) GROUP BY a.c, v.j) n USING (c, j))"""

    steps = ",".join(assign(i) + "," + update(i) for i in range(5)) + "," + assign(5)
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (
  SELECT r, j, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, unnest(embedding) AS x, unnest(range(64)) AS j FROM k)),
first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, r) - 1 AS c FROM k),
c0 AS MATERIALIZED (SELECT c, j, x FROM first JOIN v USING (r) WHERE c < 40),{steps},
mark AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS s FROM c5 GROUP BY c)
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, mark.s AS centroid_sha256
FROM a5 a JOIN k USING (r) JOIN mark USING (c)
"""


# Operator 12: the digests straight from the rows; the template's marks count 23 code points a turn.
CHAT_FORMAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g'))
  + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + 23 AS n FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

# Operator 13: all phrases counted, cuts joined with the counts of their parts, exact integers.
COLLOCATIONS = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(
    unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws
  FROM documents),
f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS a FROM (
    SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (VALUES (1), (2), (3)) t(k)
          WHERE len(ws) >= k))
  GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(ws)) AS n FROM p GROUP BY lang),
cand AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cut AS (
  SELECT c.lang, c.phrase, c.a, j, x.a AS l, y.a AS r,
    CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.a AS HUGEINT) * y.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(ws[j + 1:], ' ')),
low AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM cut)
        WHERE o = 1),
inner_ AS (
  SELECT lang, part, max(a) AS most FROM (
    SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part
    FROM cand WHERE k = 3) GROUP BY ALL),
ranked AS (
  SELECT low.*, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM low LEFT JOIN inner_ i ON i.lang = low.lang AND i.part = phrase
  WHERE i.part IS NULL OR 100 * i.most < 50 * a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_near_dedup": NEAR_DEDUP, "op6_decontaminate": DECONTAMINATE,
            "op10_substring_dedup": SUBSTRING_DEDUP, "op11_centroids": _centroids(),
            "op12_chat_format": CHAT_FORMAT, "op13_collocations": COLLOCATIONS}
