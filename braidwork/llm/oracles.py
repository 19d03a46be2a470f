"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _leaf(n_chars: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + "))"


_WORD = r"[^\x20\x09-\x0D]+"

LLM_SQL: dict[str, str] = {
    "op1_ngram_jaccard": f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id""",
    "op4_curriculum_mix": f"""WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
k AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind FROM s),
m AS (
  SELECT *, CASE kind WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
    source_size * 2.0::DOUBLE AS most FROM k),
l AS (
  SELECT *, most / weight AS ratio, row_number() OVER o AS place,
    ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM m WINDOW o AS (ORDER BY most / weight, source NULLS LAST)),
t AS (
  SELECT *, coalesce(least(most, weight * (SELECT arg_min(level, place) FROM l WHERE level <= ratio)), most) AS target
  FROM l),
o AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY md5('mix:' || doc_id), doc_id, size
                            ROWS UNBOUNDED PRECEDING) - size AS start FROM d),
p AS (
  SELECT doc_id, size, source_size, target, kind, round(target)::BIGINT AS need, start,
    greatest(0, least(size, round(target)::BIGINT - start)) AS once,
    greatest(0, least(size, round(target)::BIGINT - start - source_size)) AS twice
  FROM o JOIN t ON t.source IS NOT DISTINCT FROM o.source),
q AS (SELECT *, start / greatest(need, 1)::DOUBLE AS x FROM p)
SELECT doc_id, size, source_size, round(target, 6) AS target, (once + twice)::BIGINT AS taken,
  coalesce(CASE WHEN once > 0 THEN round(CASE kind
    WHEN 0 THEN 6.0::DOUBLE * x / (1.5::DOUBLE + sqrt(2.25::DOUBLE + 18.0::DOUBLE * x))
    WHEN 1 THEN 2.0::DOUBLE * x / (1.5::DOUBLE + sqrt(2.25::DOUBLE - 2.0::DOUBLE * x))
    ELSE x END, 6) END, -1) AS first_position FROM q""",
    "op7_kdtree_topk": """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op12_filter_audit": f"""WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
f AS (
  SELECT part, doc_id, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM w),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, concat(CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END,
      CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END) AS mask,
    count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT concat(p.x, q.x, r.x, s.x, t.x) AS filter_order FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
k AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM o),
r AS (
  SELECT part, filter_order, step, mask, n, good, toxic, filter_order[step] AS x, contains(mask, filter_order[step]) AS fails,
    len(mask) > 0 AND len(translate(filter_order[:step - 1], mask, '')) < step - 1 AS gone FROM m, k),
s AS (
  SELECT part, filter_order, step, any_value(x) AS x, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (NOT gone AND fails), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (gone AND fails), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = x), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND fails), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (NOT gone AND fails), 0)::BIGINT AS toxic_lost
  FROM r GROUP BY part, filter_order, step)
SELECT * EXCLUDE (x), (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM s""",
    # CRC-32 bit by bit over the digits of the id; then the tree level by level.
    "op11_merkle_manifest": f"""WITH RECURSIVE c AS (
  SELECT doc_id, source, lang, n_chars, text,
    xor(list_reduce(flatten([[4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))]),
      lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384::BIGINT * (a & 1)) END),
      4294967295::BIGINT) % 7 = 0 AS hit
  FROM documents),
l AS (
  SELECT *, {_leaf("n_chars")} AS leaf, {_leaf("n_chars + 1")} AS changed, (lang IS NULL) AS bare FROM c),
p AS (
  SELECT *, CASE WHEN coalesce(hit AND n_chars IS NOT NULL, false) THEN changed ELSE leaf END AS tampered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
t AS (
  SELECT lang, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM p
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1
  GROUP BY lang, level, pos // 2, n),
s AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM t WHERE n = 1),
u AS (
  SELECT 0 AS level, pos, subroot AS h, n FROM s
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM u WHERE n > 1
  GROUP BY level, pos // 2, n),
r AS (SELECT h AS root FROM u WHERE n = 1),
w AS (
  SELECT row_number() OVER () AS k, p.doc_id, p.lang, p.pos, p.leaf, p.tampered, s.subroot, s.pos AS part FROM p
  JOIN s ON s.lang IS NOT DISTINCT FROM p.lang),
v AS (
  SELECT k, t.level AS step, w.pos >> t.level & 1 AS odd, x.h AS sibling
  FROM w JOIN t ON t.lang IS NOT DISTINCT FROM w.lang AND t.pos = w.pos >> t.level AND t.n > 1
  LEFT JOIN t x ON x.lang IS NOT DISTINCT FROM w.lang AND x.level = t.level AND x.pos = xor(t.pos, 1)
  UNION ALL
  SELECT k, 1000 + u.level, w.part >> u.level & 1, x.h
  FROM w JOIN u ON u.pos = w.part >> u.level AND u.n > 1 LEFT JOIN u x ON x.level = u.level AND x.pos = xor(u.pos, 1)),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY step) AS i FROM v),
q AS (
  SELECT k, 0::BIGINT AS i, tampered AS h FROM w
  UNION ALL
  SELECT q.k, o.i, sha256(CASE WHEN odd = 1 THEN concat(sibling, h) ELSE concat(h, sibling) END)
  FROM q JOIN o ON o.k = q.k AND o.i = q.i + 1),
f AS (SELECT k, arg_max(h, i) AS folded_root FROM q GROUP BY k),
g AS (SELECT k, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM w LEFT JOIN v USING (k) GROUP BY k)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM w JOIN f USING (k) JOIN g USING (k), r""",
    "op13_vector_near_dedup": """WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.b) AS component_id, vec_id = min(r.b) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id JOIN reach r ON r.a = vec_id GROUP BY vec_id""",
}
