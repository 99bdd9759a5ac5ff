"""What SQL can say of the queries, for DuckDB over the same tables."""

from __future__ import annotations

from sectorgauge.llm import centroids, mixing, phrases, urls

_SPACES = r"[^\x20\x09-\x0D]+"

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), formed AS (
  SELECT *, replace(replace(role, '\', '\\'), chr(10), '\n') AS line FROM turns
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>' || line || chr(10) || text || '<|im_end|>' || chr(10))
    + len(regexp_extract_all(line, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars
FROM formed GROUP BY conv_id
"""

_MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(md5(doc_id::VARCHAR), md5('')) AS key,
    len(regexp_extract_all(coalesce(text, ''), '{_SPACES}'))::BIGINT AS size
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, {list(mixing.WEIGHTS)}[((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::INT]::BIGINT AS weight
  FROM per_source
), tried AS (  -- the level at which everything fits, for every set of sources at their limit
  SELECT ({mixing.SHARE_PERCENT} * (SELECT sum(source_size) FROM weighed) / 100.0::DOUBLE
      - coalesce(sum(b.source_size * {mixing.MAX_EPOCHS}) FILTER (b.source_size * a.weight < a.source_size * b.weight), 0))
    / sum(b.weight) FILTER (b.source_size * a.weight >= a.source_size * b.weight) AS level,
    {mixing.MAX_EPOCHS}.0::DOUBLE * any_value(a.source_size) / any_value(a.weight) AS ratio
  FROM weighed a CROSS JOIN weighed b GROUP BY a.source
), targets AS (
  SELECT source, source_size,
    least(({mixing.MAX_EPOCHS} * source_size)::DOUBLE, weight * (SELECT max(level) FROM tried WHERE level <= ratio)) AS target
  FROM weighed
), ordered AS (
  SELECT d.*, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
FROM ordered
"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}', '{h}{p}')" for v, h, p in urls.RULES)

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _rest(url: str) -> str:
    return f"CASE WHEN contains({url}, '://') THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END"


def _path(url: str) -> str:
    return rf"regexp_extract({_rest(url)}, '(?s)^[^/?#]*([^?#]*)', 1)"


def _resource(url: str) -> str:
    parts = rf"string_split(regexp_replace({_path(url)}, '(/\.{{1,2}})$', '\1/'), '/')"
    solved = (
        f"list_reduce(list_transform({parts}, lambda s: [s]), lambda done, s: CASE WHEN s[1] = '.' THEN done"
        " WHEN s[1] = '..' THEN done[:greatest(len(done) - 1, 1)] ELSE done || s END)"
    )
    return rf"""CASE WHEN contains({url}, '://') THEN
      translate(regexp_extract({url}, '(?s)^(.*?://[^/?#]*)', 1), {_LOWER})
      || coalesce(nullif(array_to_string({solved}, '/'), ''), '/')
      || regexp_extract({_rest(url)}, '(?s)^[^?#]*(\?[^#]*)', 1) ELSE {url} END"""


def _ruled(url: str) -> str:
    return rf"""translate(regexp_extract({_rest(url)}, '(?s)^[^/?#]*'), {_LOWER}) AS host, {_path(url)} AS path"""


_BEST = """(SELECT max({'size': length(rule), 'allow': verdict = 'allow', 'rule': rule}) FROM rules r
     WHERE (s.host = rule_host OR ends_with(s.host, '.' || rule_host)) AND starts_with(s.path, rule_path)) AS best"""

_URLS = rf"""
WITH RECURSIVE rules(verdict, rule_host, rule_path, rule) AS (VALUES {_RULES}),
split AS (
  SELECT page_id, html, url, {_resource("url")} AS node, {_ruled("url")} FROM pages
), ruled AS (
  SELECT s.page_id, s.node, s.host, s.path, {_BEST} FROM split s
), tags AS (
  SELECT node, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<(?:link|meta)\b[^>]*>')) AS tag
  FROM split WHERE contains(url, '://')
), found AS (
  SELECT node, regexp_replace(CASE
    WHEN regexp_matches(tag, '(?is)^<link.*\brel\s*=\s*["'']?canonical\b')
      THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta.*\bhttp-equiv\s*=\s*["'']?refresh\b')
      THEN regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1) ELSE '' END,
    '(?i)&(amp|#38|#x26);', '&', 'g') AS link
  FROM tags
), seen AS (
  SELECT node, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN starts_with(link, '//') THEN regexp_extract(node, '(?s)^(.*?)://', 1) || ':' || link
    WHEN starts_with(link, '/') THEN regexp_extract(node, '(?s)^(.*?://[^/?#]*)', 1) || link
    WHEN starts_with(link, '?') THEN regexp_extract(node, '(?s)^([^?]*)', 1) || link
    WHEN starts_with(link, '#') THEN node
    WHEN NOT regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:')
      THEN regexp_extract(node, '(?s)^(.*?://[^?#]*/)', 1) || link END AS target
  FROM found WHERE link <> ''
), links AS (
  SELECT node, {_resource("target")} AS target FROM seen WHERE target IS NOT NULL
), near AS (
  SELECT node AS a, target AS b FROM links UNION SELECT target, node FROM links
), reach AS (
  SELECT a, a AS b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a
), ends AS (
  SELECT s.v, {_BEST} FROM (SELECT a AS v, {_ruled("a")} FROM (SELECT DISTINCT a FROM near)) s
), opinions AS (
  SELECT r.a, bool_or(e.best.allow) AS allowed
  FROM reach r JOIN ends e ON e.v = r.b WHERE e.best IS NOT NULL GROUP BY r.a
)
SELECT page_id, host, path, best.rule AS rule,
  CASE WHEN best.allow THEN 'allow' WHEN NOT best.allow THEN 'block'
    WHEN NOT coalesce(o.allowed, true) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN opinions o ON o.a = ruled.node
"""


_PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, range(1, {phrases.LONGEST + 1}) t(k)
), counted AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM placed GROUP BY ALL
), candidates AS MATERIALIZED (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND f >= {phrases.LEAST}
), inner_phrases AS (
  SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM candidates, range(2, {phrases.LONGEST}) t(m) WHERE m < k
), covered AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL
), cuts AS (
  SELECT c.*, j, array_to_string(w[1:j], ' ') AS first_part, array_to_string(w[j + 1:], ' ') AS rest
  FROM candidates c, range(1, {phrases.LONGEST}) t(j) WHERE j < k
), scored AS (
  SELECT c.lang, c.phrase, c.a, min(struct_pack(
    score := (({phrases.SCALE}::HUGEINT * c.a) // (x.f + y.f))::BIGINT, j := j, l := x.f, r := y.f)) AS cut
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = first_part
  JOIN counted y ON y.lang = c.lang AND y.phrase = rest GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, encode(phrase)) AS rank
  FROM scored s LEFT JOIN covered v USING (lang, phrase)
  WHERE 100 * coalesce(longer, 0)::HUGEINT < {phrases.COVERED_PERCENT} * a
)
SELECT lang, rank, phrase, a, cut.l AS l, cut.r AS r, n, cut.score AS score
FROM ranked JOIN (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang) USING (lang)
WHERE rank <= {phrases.TOP}
"""


def _centroids(rounds: int = centroids.ROUNDS, clusters: int = centroids.CLUSTERS) -> str:
    """One row a vector and dimension; every round a pair of named subqueries."""
    size, scale = centroids.DIMENSIONS, centroids.SCALE
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, embedding) AS rid, vec_id, embedding
  FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}
), cells AS MATERIALIZED (
  SELECT rid, unnest(range({size})) AS dim, floor({scale} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM kept
), c0 AS MATERIALIZED (SELECT rid - 1 AS cluster, dim, x FROM cells WHERE rid <= {clusters})"""
    ]
    for k in range(rounds + 1):
        parts.append(
            f"""a{k} AS MATERIALIZED (
  SELECT rid, min(struct_pack(distance, cluster)) AS best FROM (
    SELECT v.rid, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
    FROM cells v JOIN c{k} c USING (dim) GROUP BY v.rid, c.cluster)
  GROUP BY rid)"""
        )
        if k < rounds:
            parts.append(
                f"""c{k + 1} AS MATERIALIZED (
  SELECT c.cluster, c.dim, coalesce(((s - ((s % n) + n) % n) // n)::BIGINT, c.x) AS x
  FROM c{k} c LEFT JOIN (
    SELECT best.cluster AS cluster, dim, sum(x) AS s, count(*) AS n
    FROM cells JOIN a{k} USING (rid) GROUP BY best.cluster, dim) m USING (cluster, dim))"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, best.cluster::INTEGER AS cluster, best.distance AS distance,
  (sum(best.distance) OVER (PARTITION BY best.cluster))::BIGINT AS cluster_inertia,
  (sum(best.distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM kept JOIN a{rounds} USING (rid) JOIN (
  SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster
) ON cluster = best.cluster"""


ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": _CHAT,
    "op5_mixing": _MIXING,
    "op6_url_filter": _URLS,
    "op12_phrase_collocations": _PHRASES,
    "op13_centroid_clustering": _centroids(),
}
