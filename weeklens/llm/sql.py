"""DuckDB SQL for the queries that SQL can express (the others are tested against brute force)."""

from __future__ import annotations

from .reputation import STRENGTH

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _shrunk(level: str, key: str, parents: str) -> str:
    """CTEs: the prior strength of a level by moments, and the level with its posterior means."""
    lo, hi = STRENGTH
    return f"""
{level}_fit AS (
  SELECT least(greatest(coalesce(CASE WHEN rho > 0 THEN 1 / rho - 1 ELSE {hi} END, {hi}), {lo}), {hi}) AS strength
  FROM (SELECT CASE WHEN room = 0 THEN NULL ELSE (spread - (g - 1)) / room END AS rho
        FROM (SELECT count(*)::DOUBLE AS g,
                     sum(CASE WHEN mean * (1 - mean) = 0 THEN NULL
                              ELSE n * pow(k / n - mean, 2) / (mean * (1 - mean)) END) AS spread,
                     sum(n) - sum(n * n) / sum(n) - (count(*)::DOUBLE - 1) AS room
              FROM {parents} WHERE n > 0))),
{level}_post AS (
  SELECT p.*, strength, (strength * mean + k) / (strength + n) AS post FROM {parents} p, {level}_fit)"""


OP3 = rf"""
WITH urls AS (
  SELECT page_id,
         coalesce({_LOWER.format("regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
counts AS (
  SELECT host, count(*)::DOUBLE AS n, sum(quality)::DOUBLE AS k
  FROM urls JOIN labels ON page_id = labels.doc_id WHERE quality IS NOT NULL GROUP BY host),
hosts AS (
  SELECT h.host, coalesce(n, 0) AS n, coalesce(k, 0) AS k,
         array_to_string(string_split(h.host, '.')[-2:], '.') AS domain, string_split(h.host, '.')[-1] AS suffix
  FROM (SELECT DISTINCT host FROM urls) h LEFT JOIN counts c ON h.host = c.host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
suffixes AS (
  SELECT suffix, sum(n) AS n, sum(k) AS k,
         (SELECT coalesce(sum(k) / nullif(sum(n), 0), 0.5) FROM domains) AS mean
  FROM domains GROUP BY ALL),
{_shrunk("suffix", "suffix", "suffixes")},
domains_m AS (SELECT d.*, p.post AS mean FROM domains d JOIN suffix_post p USING (suffix)),
{_shrunk("domain", "domain", "domains_m")},
hosts_m AS (SELECT h.*, p.post AS mean FROM hosts h JOIN domain_post p ON h.domain = p.domain),
{_shrunk("host", "host", "hosts_m")},
bounds AS (
  SELECT host, m + 2.0 * sqrt(m * (1 - m) / (ab + 1)) AS upper
  FROM (SELECT host, strength + n AS ab, post AS m FROM host_post)),
rules(verdict, host, path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM urls) u
  JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY ALL)
SELECT u.page_id, u.host, u.path, f.rule,
       coalesce(f.verdict, CASE WHEN b.upper < 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM urls u JOIN bounds b ON u.host = b.host LEFT JOIN fits f ON f.host = u.host AND f.path = u.path
"""

OP6 = f"""
WITH lines AS (
  SELECT d.rowid AS row, doc_id, g.i AS pos, l[g.i] AS line,
         {_LOWER.format(f"trim(l[g.i], {_BLANKS})")} AS key, len(l) AS n_lines
  FROM (SELECT row_number() OVER () AS rowid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d,
       LATERAL (SELECT unnest(range(1, len(l) + 1)) AS i) g),
common AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN common c ON lines.key = c.key
GROUP BY row
"""

OP10 = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
g AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
         CASE WHEN octet_length(payload) >= 1000 THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS first
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM g
"""

_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS.format(_LOWER.format("coalesce(text, '')"))} AS t FROM documents),
totals AS (SELECT count(*) FILTER (len(t) > 0) AS nd, sum(len(t))::BIGINT AS nl FROM docs),
wanted AS (
  SELECT DISTINCT item_id, unnest({_TERMS.format(_LOWER.format("coalesce(text, '')"))}) AS term FROM benchmark),
tfs AS (
  SELECT row, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(t) AS n, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY row, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals),
scored AS (
  SELECT item_id, row, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nd) // nl))))::BIGINT AS score
  FROM wanted JOIN tfs USING (term) JOIN weights USING (term), totals GROUP BY item_id, row),
ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""


def _score(left: str, right: str) -> str:
    return f"((1000000::HUGEINT * a * a) // ({left}::HUGEINT * {right}))::BIGINT"


OP12 = f"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents)),
words AS (SELECT lang, piece, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
ones AS (SELECT lang, w[i] AS p, count(*) AS f FROM words GROUP BY ALL),
twos AS (SELECT lang, w[i] || ' ' || w[i + 1] AS p, any_value(w[i]) AS w1, any_value(w[i + 1]) AS w2, count(*) AS a
         FROM words WHERE i < len(w) GROUP BY lang, w[i] || ' ' || w[i + 1]),
threes AS (SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS p, any_value(w[i]) AS w1, any_value(w[i + 2]) AS w3,
                  any_value(w[i] || ' ' || w[i + 1]) AS head, any_value(w[i + 1] || ' ' || w[i + 2]) AS tail, count(*) AS a
           FROM words WHERE i + 1 < len(w) GROUP BY lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] HAVING count(*) >= 10),
longest AS (SELECT lang, p, max(a) AS m FROM (
  SELECT lang, head AS p, a FROM threes UNION ALL SELECT lang, tail, a FROM threes) GROUP BY lang, p),
found AS (
  SELECT t.lang, t.p AS phrase, a, x.f AS l, y.f AS r, {_score("x.f", "y.f")} AS score
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.p = t.w1 JOIN ones y ON y.lang = t.lang AND y.p = t.w2
  LEFT JOIN longest g ON g.lang = t.lang AND g.p = t.p
  WHERE a >= 10 AND NOT (100 * coalesce(m, 0) >= 50 * a)
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
  FROM (SELECT t.lang, t.p AS phrase, t.a, x.f AS l1, y.a AS r1, u.a AS l2, v.f AS r2,
               {_score("x.f", "y.a").replace(" a ", " t.a ").replace(" a)", " t.a)")} AS s1,
               {_score("u.a", "v.f").replace(" a ", " t.a ").replace(" a)", " t.a)")} AS s2
        FROM threes t JOIN ones x ON x.lang = t.lang AND x.p = t.w1 JOIN twos y ON y.lang = t.lang AND y.p = t.tail
        JOIN twos u ON u.lang = t.lang AND u.p = t.head JOIN ones v ON v.lang = t.lang AND v.p = t.w3)),
ranked AS (SELECT lang, (row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase))::INT AS rank, phrase, a, l, r, score
           FROM found)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang) USING (lang) WHERE rank <= 2000
"""

OP13 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON a = d.doc_id GROUP BY d.doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op3_reputation": OP3,
    "op6_linededup": OP6,
    "op10_warc": OP10,
    "op11_search": OP11,
    "op12_collocations": OP12,
    "op13_jaccard": OP13,
}
