"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

# Components: the smallest id reached over the links (a, b) from every id.
_COMPONENTS = """
  reached(id, other) AS (
    SELECT a, b FROM links
    UNION
    SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a),
  lowest AS (SELECT id, least(id, min(other)) AS low FROM reached GROUP BY id)"""

_USABLE = """vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"""

LATTICE = f"""
WITH RECURSIVE
  fit AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND {_USABLE}
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
  {_COMPONENTS},
  counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(low, e.vec_id) AS component_id,
       e.vec_id = coalesce(low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counted ON a = e.vec_id LEFT JOIN lowest ON id = e.vec_id"""

TOP_K = f"""
WITH
  v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE {_USABLE}),
  scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
  ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 5"""

JACCARD = f"""
WITH RECURSIVE
  worded AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
  shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1),
                            lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS shingle
    FROM worded),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY ALL),
  links AS (
    SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * common >= 90 * (p.n + q.n - common)),
  {_COMPONENTS}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN lowest ON id = d.doc_id"""


def _escaped(text: str, role: bool = False) -> str:
    coded = f"replace(replace({text}, '%', '%25'), '<|', '%3C|')"
    return f"replace({coded}, chr(10), '%0A')" if role else coded


CHAT = f"""
WITH
  said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, n, role, '<|im_end|><|im_start|>assistant ok'
    FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(n, role)),
  told AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), ''
                      ORDER BY turn NULLS FIRST, role, text) AS turns,
           coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                    FILTER (WHERE role = 'assistant'), '') AS loss,
           CAST(sum(length('<|im_start|>') + length({_escaped("role", role=True)}) + 1
                    + length({_escaped("text")}) + length('<|im_end|>') + 1) AS BIGINT)
             AS formatted_chars
    FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM told"""

PHRASES = """
WITH
  pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
    FROM pieces),
  placed AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
             FROM worded, (VALUES (1), (2), (3)) AS t(k) WHERE len(w) >= k),
  counts AS (SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f FROM placed GROUP BY ALL),
  totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
  found AS (SELECT * FROM counts WHERE k > 1 AND f >= 10),
  cuts AS (
    SELECT c.lang, c.g, c.k, c.f AS a, x.f AS l, y.f AS r, j,
           CAST(CAST(1000000 AS HUGEINT) * c.f * c.f // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM found) c
    JOIN counts x ON x.lang = c.lang AND x.g = c.g[:j]
    JOIN counts y ON y.lang = c.lang AND y.g = c.g[j + 1:]),
  lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
  inner_parts AS (
    SELECT lang, unnest([g[:2], g[2:]]) AS g, f FROM found WHERE k = 3),
  covered AS (
    SELECT DISTINCT p.lang, p.g FROM inner_parts p JOIN found s ON s.lang = p.lang AND s.g = p.g
    WHERE 100 * p.f >= 50 * s.f),
  ranked AS (
    SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM lowest
    ANTI JOIN covered USING (lang, g))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000"""

# CRC-32 of an ASCII text: eight shifts for each byte.
_CRC = """xor(list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT)),
    lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda s, n: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295)"""

PREFIXES = f"""
WITH
  said AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
             sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
    FROM conversations WHERE conv_id IS NOT NULL),
  ids AS (
    SELECT c, c - c % 100 AS base, {_CRC.format(text="CAST(c AS VARCHAR)")} % 6 AS h
    FROM (SELECT DISTINCT conv_id AS c FROM said)),
  steps AS (
    SELECT c, 0 AS part, n, role, text FROM ids JOIN said ON conv_id = base AND n <= h
    UNION ALL
    SELECT c, 1, n, role, text FROM ids JOIN said ON conv_id = c AND n > h),
  told AS (
    SELECT c, CAST(coalesce(list({{'role': role, 'text': text}} ORDER BY part, n)
                     FILTER (n IS NOT NULL), []) AS STRUCT(role VARCHAR, text VARCHAR)[]) AS s
    FROM ids LEFT JOIN steps USING (c) GROUP BY c),
  nodes AS (
    SELECT s[:d] AS p, d, min(c) AS id, count(*) AS n, any_value(length(s[d].text)) AS chars,
           string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d) AS ends
    FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM told) GROUP BY ALL),
  kids AS (SELECT p[:d - 1] AS p, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY 1),
  sized AS (SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN kids ON kids.p = nodes.p),
  above AS (SELECT p, d AS far, unnest(range(0, d + 1)) AS d, n, chars, kids FROM sized),
  summed AS (
    SELECT p[:d] AS p, count(*) FILTER (kids = 0) AS leaves,
           sum(CASE WHEN far = 0 THEN 0 ELSE (n - 1) * chars END) AS saved
    FROM above GROUP BY 1)
SELECT x.id AS conv_id, x.d AS depth, y.id AS parent_conv_id, x.n AS n_convs, x.kids AS n_children,
       leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(x.ends, '')) AS ends_sha256
FROM sized x JOIN summed z ON z.p = x.p LEFT JOIN nodes y ON x.d > 0 AND y.p = x.p[:x.d - 1]"""
