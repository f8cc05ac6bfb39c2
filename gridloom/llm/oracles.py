"""SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES["op5_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, {_WHITE}), '{_UPPER}', '{_LOWER}') AS key FROM lines
), frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_RULES = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 10 * n_words",
    "copied_lines": "100 * n_dup_lines > 50 * n_lines",
}


def _host_rules() -> str:
    fails = ", ".join(f"sum(CAST({rule} AS INT)) AS f_{name}" for name, rule in _RULES.items())
    sums = ", ".join(f"sum(f_{r}) AS t_{r}, sum(f_{r} * f_{r} * 1.0 / n_docs) AS q_{r}" for r in _RULES)
    between = ", ".join(
        f"t_{r} / n AS p_{r}, (q_{r} - t_{r} * t_{r} / n - (k - 1) * (t_{r} / n) * (1 - t_{r} / n))"
        f" / nullif(n - n2 / n, 0) AS b_{r}"
        for r in _RULES
    )
    rates = ", ".join(
        f"CASE WHEN k > 1 AND p_{r} > 0 AND p_{r} < 1 AND b_{r} > 0 THEN"
        f" (f_{r} + p_{r} * greatest(p_{r} * (1 - p_{r}) / b_{r} - 1, 2))"
        f" / (n_docs + greatest(p_{r} * (1 - p_{r}) / b_{r} - 1, 2)) ELSE p_{r} END"
        for r in _RULES
    )
    return f"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), grams AS (
  SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), often AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM often) GROUP BY doc_id
), counts AS (
  SELECT words.doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), hosts AS (
  SELECT source, count(*) AS n_docs, {fails} FROM counts WHERE source IS NOT NULL GROUP BY source
), totals AS (
  SELECT count(*) AS k, CAST(sum(n_docs) AS DOUBLE) AS n, sum(n_docs * n_docs * 1.0) AS n2, {sums} FROM hosts
), priors AS (
  SELECT k, {between} FROM totals
), bad AS (
  SELECT source FROM hosts, priors WHERE greatest({rates}) > 0.9
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND bad.source IS NULL AS kept
FROM counts LEFT JOIN bad ON counts.source = bad.source
"""


ORACLES["op6_host_rules"] = _host_rules()


_LINK = r"""["'']?\x20*[:=]\x20*["'']?"""
#: Kind, pattern, group that counts, its length, role: in the order of kinds. A run that must
#: have some length is asked for by that length, which matches the same whole runs.
_PARTS = (
    ("assign", rf"(?i:(password|passwd|secret|token|api_?key)){_LINK}([A-Za-z0-9+/_.=-]+)", 2, ">= 8", "secret"),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, ">= 16", "name"),
    ("hex", r"[0-9a-f]{32,}", 0, ">= 32", "secret"),
    ("user", rf"(?i:(access_?key_?id|client_?id|user_?name|user|login)){_LINK}([A-Za-z0-9_.@-]+)", 2, ">= 3", "name"),
    ("key", r"[A-Za-z0-9+/]{40,}", 0, "= 40", "secret"),
    ("endpoint", r"[a-z][a-z0-9+.-]{0,31}://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+", 0, ">= 8", "endpoint"),
)


def _credentials() -> str:
    parts = " UNION ALL ".join(
        f"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind, '{role}' AS role, i, e - length(m[i]) AS a, e AS b
        FROM (SELECT *, sum(length(g[i]) + length(m[i])) OVER (PARTITION BY doc_id ORDER BY i) AS e
          FROM (SELECT doc_id, m, n, g, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS m,
                         regexp_extract_all(text, '{pattern}', {group}) AS n,
                         regexp_split_to_array(text, '{pattern}') AS g FROM texts)))
        WHERE length(n[i]) {passes}"""
        for rank, (kind, pattern, group, passes, role) in enumerate(_PARTS)
    )
    within = "p.doc_id = q.doc_id AND greatest(p.a - q.b, q.a - p.b) <= 200"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({parts}),
judged AS (
  SELECT *, exists(SELECT 1 FROM parts q WHERE {within} AND q.role = 'secret') AS by_secret,
         exists(SELECT 1 FROM parts q WHERE {within} AND q.role = 'name') AS by_name,
         exists(SELECT 1 FROM parts q WHERE p.doc_id = q.doc_id AND q.rank < 3 AND q.a < p.b AND p.a < q.b) AS taken
  FROM parts p
),
spans AS (
  SELECT * FROM judged WHERE rank < 3 OR NOT taken AND CASE role WHEN 'name' THEN by_secret
    WHEN 'secret' THEN by_name ELSE by_name AND by_secret END
)
SELECT t.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (rank >= 3) AS n_linked,
       sha256(coalesce(string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a, rank)
              FILTER (rank < 3), '')) AS base_sha256,
       coalesce(string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a, rank), '') AS spans
FROM texts t LEFT JOIN spans s ON t.doc_id = s.doc_id GROUP BY t.doc_id
"""


ORACLES["op10_credentials"] = _credentials()

ORACLES["op1_minhash_join"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, len(s) AS n FROM shingles
), each AS (
  SELECT doc_id, unnest(s) AS g FROM shingles
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM each a JOIN each b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, n AS n_shingles, least(s.doc_id, coalesce(min(b), s.doc_id)) AS component_id,
       s.doc_id <= coalesce(min(b), s.doc_id) AS kept
FROM sizes s LEFT JOIN reach r ON s.doc_id = r.a GROUP BY s.doc_id, n
"""

ORACLES["op3_cross_polytope"] = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.93
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), n AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, least(vec_id, coalesce(min(b), vec_id)) AS component_id,
       vec_id <= coalesce(min(b), vec_id) AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN reach r ON e.vec_id = r.a GROUP BY vec_id
"""


def _host_trust(rounds: int = 40) -> str:
    """As many rounds as bring scores within a thousandth of where they end."""

    def host(url: str) -> str:
        return f"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"

    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = (
        f"CASE WHEN {fits('example.net', '/en/')} THEN 'example.net/en/'"
        f" WHEN {fits('example.com', '/de/')} THEN 'example.com/de/'"
        f" WHEN {fits('org', '/fr/')} THEN 'org/fr/' WHEN {fits('net', '/')} THEN 'net/' END"
    )
    steps = "".join(
        f""", s{k} AS MATERIALIZED (
  SELECT host, kind, sum(score) AS score FROM (
    SELECT * FROM s0 UNION ALL
    SELECT taker AS host, kind, 0.85 * score * part FROM ways JOIN s{k - 1} s ON s.host = giver AND s.kind = way)
  GROUP BY host, kind
)"""
        for k in range(1, rounds + 1)
    )
    return f"""
WITH parts AS (
  SELECT page_id, {host("coalesce(url, '')")} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path, html FROM pages
), ruled AS (
  SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS verdict
  FROM (SELECT *, {rule} AS rule FROM parts)
), tags AS (
  SELECT host AS source, regexp_extract(unnest(string_split(html, '<')), '(?is)^a[\\s/][^>]*', 0) AS tag FROM parts
), found AS (
  SELECT source, regexp_extract(tag, '(?is)[\\s"''/]href\\s*=\\s*["'']?([^"''\\s>]+)', 1) AS link FROM tags
), edges AS (
  SELECT source, target, count(*) AS n FROM (
    SELECT source, {host("CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END")} AS target FROM found
    WHERE regexp_matches(link, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//'))
  WHERE source <> '' AND target <> '' AND source <> target GROUP BY ALL
), shares AS (
  SELECT source, target, n / sum(n) OVER (PARTITION BY source) AS part FROM edges
), ways AS (
  SELECT 't' AS way, source AS giver, target AS taker, part FROM shares
  UNION ALL
  SELECT 'd', target, source, part FROM shares
), seeds AS (
  SELECT host, count(*) FILTER (verdict = 'allow') / count(*) AS t, count(*) FILTER (verdict = 'block') / count(*) AS d
  FROM ruled WHERE host <> '' GROUP BY host
), s0 AS (
  SELECT host, 't' AS kind, t * (1 - 0.85) AS score FROM seeds UNION ALL SELECT host, 'd', d * (1 - 0.85) FROM seeds
){steps}, bad AS (
  SELECT host, coalesce(sum(score) FILTER (kind = 'd'), 0) AS d, coalesce(sum(score) FILTER (kind = 't'), 0) AS t
  FROM s{rounds} GROUP BY host HAVING d > t AND d >= 0.5 * (1 - 0.85)
)
SELECT page_id, r.host, path, rule, coalesce(verdict, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN bad ON r.host = bad.host
"""


ORACLES["op4_host_trust"] = _host_trust()

_LINKED = """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, conv_id || '-' || turn AS call_id, text,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) AS nth
  FROM conversations WHERE role = 'user'
), results AS (
  SELECT conv_id, turn, conv_id || '-' || (turn - 1) AS call_id, text,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY text NULLS FIRST) AS nth
  FROM conversations WHERE role = 'assistant'
), firsts AS (
  SELECT * FROM calls WHERE nth = 1
), levels AS (
  SELECT conv_id, turn, CAST(0 AS BIGINT) AS level FROM firsts WHERE turn < 2
  UNION ALL
  SELECT f.conv_id, f.turn, level + 1 FROM firsts f JOIN levels l ON f.conv_id = l.conv_id AND f.turn = l.turn + 2
), rows AS (
  SELECT c.conv_id, c.turn, 'call' AS part, c.call_id,
         CASE WHEN nth > 1 THEN 'repeated'
              WHEN exists(SELECT 1 FROM results r WHERE r.call_id = c.call_id AND r.conv_id = c.conv_id) THEN 'answered'
              ELSE 'open' END AS status,
         CASE WHEN nth = 1 THEN level END AS level,
         text IS NOT NULL AND length(text) BETWEEN 1 AND 300 AS valid,
         '{"arguments":{' || coalesce('"question":' || CAST(to_json(text) AS VARCHAR) || ',', '') || '"turn":' || c.turn
           || '},"id":"' || c.call_id || '","name":"ask","type":"call"}' AS line
  FROM calls c LEFT JOIN levels l ON c.conv_id = l.conv_id AND c.turn = l.turn
  UNION ALL
  SELECT r.conv_id, r.turn, 'result', r.call_id,
         CASE WHEN f.call_id IS NULL THEN 'orphan' WHEN r.nth = 1 THEN 'answer' ELSE 'repeated' END,
         CASE WHEN r.nth = 1 THEN level END, NULL,
         '{"content":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || ',"id":"' || r.call_id || '","type":"result"}'
  FROM results r LEFT JOIN firsts f ON r.conv_id = f.conv_id AND r.call_id = f.call_id
  LEFT JOIN levels l ON l.conv_id = r.conv_id AND l.turn = r.turn - 1
)
SELECT conv_id, turn, part, call_id, status, level, valid, sha256(line) AS line_sha256 FROM rows
"""

ORACLES["op2_tool_chat"] = f"""
WITH loose AS (SELECT * FROM conversations WHERE conv_id IS NULL OR turn IS NULL)
SELECT * FROM ({_LINKED}) WHERE conv_id IS NOT NULL AND turn IS NOT NULL
UNION ALL
SELECT conv_id, turn, 'call', NULL, 'open', NULL, coalesce(length(text) BETWEEN 1 AND 300 AND turn >= 0, false),
       sha256('{{"arguments":{{' || concat_ws(',', '"question":' || CAST(to_json(text) AS VARCHAR), '"turn":' || turn)
         || '}},"id":null,"name":"ask","type":"call"}}')
FROM loose WHERE role = 'user'
UNION ALL
SELECT conv_id, turn, 'result', NULL, 'orphan', NULL, NULL,
       sha256('{{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"id":null,"type":"result"}}')
FROM loose WHERE role = 'assistant'
UNION ALL
SELECT conv_id, turn, 'message', NULL, NULL, NULL, NULL,
       sha256('{{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":'
         || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || ',"type":"message"}}')
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""

#: Holds where the traversal visits all rows, as it does up to ``multi_index.LEAST`` of them.
ORACLES["op11_multi_index"] = """
WITH sound AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
  FROM (SELECT * FROM sound WHERE vec_id % 100 = 0) q
  JOIN sound c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
