"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from tenantflow.llm.queries import URL_RULES
from tenantflow.llm.url_templates import TreeSettings

_EXACT = """
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body
  FROM documents
), marked AS (
  SELECT doc_id, sha256(body) AS text_sha256,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY n_chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM plain
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM marked
"""

_VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reached(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), smallest AS (
  SELECT a, min(b) AS b FROM reached GROUP BY a
), counted AS (
  SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(s.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(s.b, vec_id)) AS kept
FROM embeddings e LEFT JOIN smallest s ON e.vec_id = s.a LEFT JOIN counted c ON e.vec_id = c.a
"""

_NEAR = """
WITH RECURSIVE words AS (
  SELECT doc_id, [x FOR x IN
           regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\\x20\\x09-\\x0D]+')
           IF x <> ''] AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)
), reached(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), smallest AS (
  SELECT a, min(b) AS b FROM reached GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(s.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(s.b, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN smallest s ON s.a = d.doc_id
"""


def _first_fitting(value: str) -> str:
    cases = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
        f"THEN '{getattr(r, value)}'"
        for r in sorted(URL_RULES, key=lambda r: (len(r.text), len(r.host)), reverse=True)
    ]
    return f"CASE {' '.join(cases)} END"


def _level(level: int, s: TreeSettings) -> str:
    """The step of the tree from the table ``shapes<level>`` to the next."""
    prefix = f"array_to_string(segments[1:{level}], '/')" if level else "''"
    return f"""
, at{level} AS (SELECT *, {prefix} AS prefix, segments[{level + 1}] AS segment FROM shapes{level})
, children{level} AS (
  SELECT host, prefix, segment, sum(pages) AS pages, sum(labelled) AS labelled, sum(blocked) AS blocked
  FROM at{level} WHERE segment IS NOT NULL GROUP BY ALL
), nodes{level} AS (
  SELECT *, count(*) OVER node AS all_children, sum(pages) OVER node AS all_pages,
         sum(labelled) OVER node AS l, sum(blocked) OVER node AS b
  FROM children{level} WINDOW node AS (PARTITION BY host, prefix)
), merged{level} AS (
  SELECT host, prefix, segment FROM nodes{level}
  WHERE all_children > 1 AND (
    (all_children >= {s.min_children} AND all_pages < {s.pages_per_child} * all_children)
    OR CASE WHEN labelled > 0 AND l > labelled AND b > 0 AND b < l
       THEN pow(blocked / labelled - (b - blocked) / (l - labelled), 2)
            < {s.critical**2!r} * (b / l * (1 - b / l) * (1.0::DOUBLE / labelled + 1.0::DOUBLE / (l - labelled)))
       ELSE labelled = 0 OR l > labelled END)
), shapes{level + 1} AS (
  SELECT t.host, shape, pages, labelled, blocked,
         CASE WHEN m.segment IS NULL THEN segments
              ELSE list_concat(list_append(segments[1:{level}], '*'), segments[{level + 2}:]) END AS segments
  FROM at{level} t LEFT JOIN merged{level} m
    ON t.host = m.host AND t.prefix = m.prefix AND t.segment = m.segment
)"""


def _urls(s: TreeSettings = TreeSettings()) -> str:
    return f"""
WITH rest AS (
  SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '') AS rest
  FROM pages
), parsed AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), judged AS (
  SELECT *, {_first_fitting("text")} AS rule, {_first_fitting("verdict")} AS ruled,
         regexp_replace(regexp_replace(path, '[0-9]+', '#', 'g'), '/$', '') AS shape
  FROM parsed
), shapes0 AS (
  SELECT host, shape, count(*) AS pages, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS blocked,
         string_split(ltrim(shape, '/'), '/') AS segments
  FROM judged GROUP BY host, shape
), share AS (
  SELECT (coalesce(sum(blocked), 0) + 0.5) / (coalesce(sum(labelled), 0) + 1) AS share FROM shapes0
)
{"".join(_level(k, s) for k in range(s.levels))}
, templates AS (
  SELECT host, segments,
         (sum(blocked) + {s.smoothing!r} * any_value(share)) / (sum(labelled) + {s.smoothing!r}) AS purity
  FROM shapes{s.levels}, share GROUP BY host, segments
)
SELECT page_id, j.host, path, rule,
       coalesce(ruled, CASE WHEN purity >= {s.threshold!r} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j JOIN shapes{s.levels} x ON j.host = x.host AND j.shape = x.shape
JOIN templates t ON t.host = x.host AND t.segments = x.segments
"""

_WHOLE = """
whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
)"""

_TOP = f"""
WITH {_WHOLE}, scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

_NEGATIVES = f"""
WITH {_WHOLE}, labelled AS (
  SELECT vec_id, x, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM whole WHERE label IS NOT NULL
), scored AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM labelled q JOIN labelled c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
  WHERE q.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


LLM_ORACLE: dict[str, str] = {
    "op5_minhash_inverted_join": _NEAR,
    "op7_epsilon_grid_join": _VECTORS,
    "op8_tree_merge_dedup": _EXACT,
    "op10_path_template_tree": _urls(),
    "op11_shared_list_negatives": _NEGATIVES,
    "op12_no_random_access": _TOP,
}
