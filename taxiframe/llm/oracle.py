"""DuckDB SQL for the document queries that SQL can express, written from what
they compute; each runs over the whole ``documents`` table."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
s AS (SELECT DISTINCT rid, unnest([array_to_string(w[i:i + 4], ' ')
      FOR i IN range(1, greatest(1, len(w) - 4) + 1)]) AS shingle FROM d WHERE len(w) > 0),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
common AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s a JOIN s b USING (shingle)
           WHERE a.rid <> b.rid GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n p ON p.rid = x JOIN n q ON q.rid = y
          WHERE c >= 0.8 * (p.n + q.n - c)
          UNION ALL
          SELECT a.rid, b.rid FROM d a JOIN d b ON len(a.w) = 0 AND len(b.w) = 0 AND a.rid <> b.rid),
reach AS (SELECT rid AS x, rid AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, (SELECT min(e.doc_id) FROM reach r JOIN d e ON e.rid = r.y WHERE r.x = d.rid) AS class_id,
       (SELECT count(*) FROM links l WHERE l.x = d.rid) AS n_links
FROM d
"""

OP3 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text,
                  md5(coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')) AS k,
                  regexp_extract_all(text, '[^\n]{32,}?[.!?] +|[^\n]*\n[ \t\r\n]*|[^\n]+') AS us FROM documents),
u AS (SELECT rid, doc_id, k, generate_subscripts(us, 1) - 1 AS i, unnest(us) AS u FROM d),
t AS (SELECT *, rtrim(u, ' ' || chr(9) || chr(10) || chr(13)) AS unit FROM u),
v AS (SELECT *, strlen(unit) AS bytes FROM t),
l AS (SELECT rid, any_value(doc_id) AS doc_id, any_value(k) AS k, list(unit ORDER BY i) AS us, list(bytes ORDER BY i) AS ws,
             list(i ORDER BY i) AS ats FROM v GROUP BY rid),
f AS (SELECT *, unnest(range(len(ws))) AS first FROM l),
c AS (SELECT *, CASE WHEN ws[first + 1] >= 300 THEN 1 ELSE list_filter(range(2, 9), lambda n:
                first + n <= len(ws) AND list_sum(ws[first + 1:first + n]) >= 50)[1] END AS n FROM f),
chunks AS (SELECT rid, doc_id, k, first, array_to_string(us[first + 1:first + n], chr(10)) AS chunk,
                  ats[first + 1] AS a, ats[first + n] AS b FROM c WHERE n IS NOT NULL),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY chunk ORDER BY doc_id NULLS LAST, k, first) AS place FROM chunks),
again AS (SELECT * FROM ranked WHERE place > 1),
gone AS (SELECT DISTINCT rid, unnest(range(a, b + 1)) AS i FROM again),
kept AS (SELECT u.rid, string_agg(u.u, '' ORDER BY u.i) AS text FROM u ANTI JOIN gone USING (rid, i) GROUP BY u.rid),
removed AS (SELECT rid, count(*) AS chunks FROM again GROUP BY rid),
removed_units AS (SELECT rid, count(*) AS units FROM gone GROUP BY rid)
SELECT d.doc_id, CASE WHEN r.rid IS NULL THEN d.text ELSE coalesce(kept.text, '') END AS text,
       coalesce(r.chunks, 0)::BIGINT AS n_removed_chunks, coalesce(e.units, 0)::BIGINT AS n_removed_units
FROM d LEFT JOIN removed r USING (rid) LEFT JOIN removed_units e USING (rid) LEFT JOIN kept USING (rid)
"""

OP4 = rf"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS digest,
                  length(text) AS n, length(text) - length(translate(text, '0123456789#*$%&|<>', '')) AS noise
           FROM documents),
k AS (SELECT *, -ln((('0x' || substr(digest, 1, 13))::BIGINT::DOUBLE + 1.0) / 4503599627370496.0)
             / CASE WHEN n > 0 THEN greatest(0.1::DOUBLE, 1.0::DOUBLE - 2.0::DOUBLE * noise::DOUBLE / n)
                    ELSE 0.1::DOUBLE END AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
      FROM d GROUP BY source),
r AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))
             / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
      FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level FROM l WHERE ratio > level ORDER BY ratio LIMIT 1),
t AS (SELECT source, source_size, coalesce(least(cap, (SELECT level FROM f) * weight), cap) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
m AS (SELECT k.doc_id, k.source, k.size, e.source_size, e.target, e.epochs + (
          sum(size) OVER (PARTITION BY k.source ORDER BY key, digest ROWS UNBOUNDED PRECEDING) - size / 2.0::DOUBLE
          <= e.target - e.epochs * e.source_size)::BIGINT AS times
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, times * size AS taken, source, times FROM m
"""

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
x AS (SELECT rid, generate_subscripts(w, 1) AS i, len(w) AS n, w FROM d),
v AS (SELECT rid, i, array_to_string(w[i:i + 2], ' ') AS win FROM x WHERE i + 2 <= n),
rep AS (SELECT rid, i FROM v QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
cov AS (SELECT rid, count(DISTINCT i + j) AS n_repeat_words FROM rep, range(3) t(j) GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln
          WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) > 0 GROUP BY rid),
m AS (SELECT rid, doc_id, source, len(w)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines
      FROM d LEFT JOIN cov USING (rid) LEFT JOIN lines USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS f0, 10 * n_symbols > n_words AS f1,
             10 * n_dup_lines > 3 * n_lines AS f2,
             word_chars < 3 * n_words OR word_chars > 12 * n_words AS f3 FROM m),
h AS (SELECT source, count(*) AS n, [sum(f1::INT), sum(f2::INT), sum(f3::INT)] AS k FROM f GROUP BY source),
q AS (SELECT source, n, r, k[r] AS k FROM h, range(1, 4) t(r)),
mo AS (SELECT r, least(greatest(avg(k / n), 1e-6), 1 - 1e-6) AS mean, var_pop(k / n) AS var FROM q GROUP BY r),
pr AS (SELECT r, mean, CASE WHEN var > 0 THEN least(greatest(mean * (1 - mean) / var - 1, 2), 1000) ELSE 1000 END AS w
       FROM mo),
sh AS (SELECT source, r, mean, n + w AS nw, (k + mean * w) / (n + w) AS rate FROM q JOIN pr USING (r)),
bad AS (SELECT source, r, rate - sqrt(rate * (1 - rate) / (nw + 1)) > 1.25::DOUBLE * mean AS bad FROM sh),
bh AS (SELECT source, bool_or(bad AND r = 1) AS b1, bool_or(bad AND r = 2) AS b2, bool_or(bad AND r = 3) AS b3
       FROM bad GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f0 AS base_failed,
       NOT (f0 OR (b1 AND f1) OR (b2 AND f2) OR (b3 AND f3)) AS kept
FROM f JOIN bh ON f.source IS NOT DISTINCT FROM bh.source
"""

OP11 = r"""
WITH e AS (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.row AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.row, b.vec_id,
             CASE WHEN len(a.v) = 0 THEN 0 ELSE list_inner_product(a.v, b.v) END::HUGEINT AS score
      FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.row <> b.row),
p AS (SELECT anchor, anchor_id, row AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, row) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id,
       positive_score::BIGINT AS positive_score, s.score::BIGINT AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id NULLS LAST, s.row)
QUALIFY row_number() OVER w <= 3
"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR END"


_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''),
  lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
  lambda v, bit: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)))"""
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# tree 1 has the leaves of each language, tree 2 the subroots.
OP12 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, lang,
    sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text")))}) AS leaf,
    CASE WHEN {_CRC32} % 3 = 0 THEN
      sha256({" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", _LOWER)))}) END AS changed FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS idx,
             count(*) OVER (PARTITION BY lang) AS n FROM d),
t AS (SELECT 0 AS lvl, lang, idx, n, leaf AS h FROM l
      UNION ALL
      SELECT lvl + 1, lang, idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM t WHERE n > 1
      GROUP BY lvl, lang, idx // 8),
s AS (SELECT lang, lvl AS top, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx,
             count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, idx, n, subroot AS h FROM s
      UNION ALL
      SELECT lvl + 1, idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM u WHERE n > 1
      GROUP BY lvl, idx // 8),
runs AS (SELECT 1 AS tree, lang, lvl, idx // 8 AS run, list(h ORDER BY idx) AS hs FROM t WHERE n > 1 GROUP BY ALL
         UNION ALL SELECT 2, NULL, lvl, idx // 8, list(h ORDER BY idx) FROM u WHERE n > 1 GROUP BY ALL),
f AS (SELECT rid, l.lang, 1 AS tree, 0 AS lvl, l.idx, s.top, s.idx AS place, coalesce(changed, leaf) AS node, '' AS proof
      FROM l JOIN s ON s.lang IS NOT DISTINCT FROM l.lang
      UNION ALL
      SELECT rid, f.lang, CASE WHEN f.tree = 1 AND f.lvl >= top THEN 2 ELSE f.tree END,
             CASE WHEN f.tree = 1 AND f.lvl >= top THEN 0 ELSE f.lvl + 1 END,
             CASE WHEN f.tree = 1 AND f.lvl >= top THEN place ELSE f.idx // 8 END, top, place,
             CASE WHEN f.tree = 1 AND f.lvl >= top THEN node ELSE sha256(array_to_string(list_concat(
               hs[:f.idx % 8], [node], hs[f.idx % 8 + 2:]), '')) END,
             CASE WHEN f.tree = 1 AND f.lvl >= top THEN proof ELSE proof || array_to_string(list_concat(
               hs[:f.idx % 8], hs[f.idx % 8 + 2:]), '') END
      FROM f LEFT JOIN runs r ON r.tree = f.tree AND r.lvl = f.lvl AND r.run = f.idx // 8
        AND (f.tree = 2 OR r.lang IS NOT DISTINCT FROM f.lang)
      WHERE (f.tree = 1 AND f.lvl >= top) OR r.run IS NOT NULL),
e AS (SELECT * FROM f WHERE tree = 2 QUALIFY row_number() OVER (PARTITION BY rid ORDER BY lvl DESC) = 1),
root AS (SELECT h AS root FROM u WHERE n = 1)
SELECT l.doc_id, l.leaf, s.subroot, root, sha256(e.proof) AS proof_sha256, e.node AS folded_root, e.node = root AS verified
FROM l JOIN s ON s.lang IS NOT DISTINCT FROM l.lang JOIN e USING (rid), root
"""

OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body,
                  length(coalesce(text, '')) AS n FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body ORDER BY n DESC, doc_id NULLS LAST, rid)
"""

ORACLE = {"op2_ngram_jaccard_join": OP2, "op3_line_dedup": OP3, "op4_source_mix": OP4, "op8_host_rules": OP8,
          "op11_hard_negatives": OP11, "op12_merkle_manifest": OP12, "op13_exact_dedup": OP13}
