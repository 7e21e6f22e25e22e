"""DuckDB statements for operators whose answer SQL can state plainly: all
pairs by shared shingles, all windows by their words, all cosines."""

GAP = "'[\\x20\\x09-\\x0D]+'"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, {GAP}), lambda x: x <> '')"


def _components(key: str, table: str) -> str:
    """``links`` (a, b) to ``component`` (key, component_id)."""
    return f"""
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach({key}, root) AS (
  SELECT {key}, {key} FROM {table}
  UNION SELECT l.b, r.root FROM reach r JOIN both_ways l ON l.a = r.{key}),
component AS (SELECT {key}, min(root) AS component_id FROM reach GROUP BY {key})"""


MINHASH = f"""
WITH RECURSIVE cut AS (SELECT doc_id, {_words(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM cut)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
{_components("doc_id", "documents")}
SELECT c.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM component c LEFT JOIN sizes ON sizes.doc_id = c.doc_id"""

SUBSTRING = f"""
WITH cut AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
spots AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM cut WHERE len(w) >= 35),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY array_to_string(w[i:i + 34], ' ')) AS n FROM spots),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows WHERE n > 1),
single AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM cut),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words, count(*) AS n FROM single
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = single.doc_id AND g.i = single.i) GROUP BY doc_id)
SELECT cut.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM cut LEFT JOIN kept ON kept.doc_id = cut.doc_id"""

EMBEDDINGS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
  ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.93),
degrees AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id),
{_components("vec_id", "embeddings")}
SELECT c.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, c.vec_id = component_id AS kept
FROM component c LEFT JOIN degrees ON id = c.vec_id"""
