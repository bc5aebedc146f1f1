"""DuckDB twins of the training-data queries that SQL can express; plain statements, meant for small tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SOLID = r"[^\x20\x09-\x0D]+"


def _words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


JACCARD = f"""WITH RECURSIVE w AS (SELECT doc_id, {_words(_SOLID)} AS words FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) < 5 THEN list_transform(range(least(len(words), 1)), lambda i: array_to_string(words, ' '))
  ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS n FROM s), t AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_ >= 80 * (x.n + y.n - both_)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a), k AS (SELECT a, count(*) AS links FROM l GROUP BY a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.low AS component_id, CAST(coalesce(k.links, 0) AS BIGINT) AS n_links FROM n JOIN c ON c.a = n.doc_id LEFT JOIN k ON k.a = n.doc_id"""

DECONTAM = f"""WITH d AS (SELECT doc_id, {_words(_LETTERS)} AS words FROM documents),
i AS (SELECT item_id, {_words(_LETTERS)} AS words FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(words) - n + 2), lambda o: array_to_string(words[o:o + n - 1], ' '))) AS win FROM (SELECT *, least(len(words), 10) AS n FROM i WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, unnest(list_transform(range(1, len(words) - n + 2), lambda o: {{'o': o, 'win': array_to_string(words[o:o + n - 1], ' ')}})) AS x FROM d, sizes),
h AS (SELECT dw.doc_id, dw.x.o AS o, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.x.win = iw.win),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(o, o + n)) AS p FROM h) GROUP BY doc_id),
q AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS said FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(said, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN q ON q.doc_id = d.doc_id"""

#: The 16 half bytes in a row: half byte ``x`` stands at ``4 * x + 1``.
_NIBBLES = "".join(f"{x:04b}" for x in range(16))
WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), h AS (SELECT page_id, html, sha1(html) AS digest FROM p),
f AS (SELECT html, min(page_id) AS first_page FROM p GROUP BY html),
b AS (SELECT digest, array_to_string(list_transform(range(1, 41), lambda i: substr('{_NIBBLES}', 4 * strpos('0123456789abcdef', digest[i]) - 3, 4)), '') AS bits FROM (SELECT DISTINCT digest FROM h)),
c AS (SELECT digest, array_to_string(list_transform(range(32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(list_transform(range(1, 6), lambda j: CAST(substr(bits, CAST(5 * g + j AS BIGINT), 1) AS INTEGER) << CAST(5 - j AS INTEGER))) AS BIGINT), 1)), '') AS base32 FROM b)
SELECT h.page_id, CAST(strlen(h.html) AS BIGINT) AS payload_bytes, c.base32 AS payload_digest, CASE WHEN h.page_id = f.first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN h.page_id <> f.first_page THEN f.first_page END AS refers_to FROM h JOIN f ON f.html = h.html JOIN c ON c.digest = h.digest"""

CHAT = r"""WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) x(i))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(6 + length(replace(replace(replace(role, '\', '\\'), '>', '\g'), chr(10), '\n')) + 2 + length(regexp_replace(text, '<(\\*)(/?turn)', '<\\\1\2', 'g')) + 9) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id"""

_INTS = "list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT))"
_WHOLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

_ROUNDS = range(1, 4)
_NEAREST = "SELECT v.vec_id, v.row, v.vec, c.j, c.cen, list_sum(list_transform(range(1, 65), lambda i: (v.vec[i] - c.cen[i]) * (v.vec[i] - c.cen[i]))) AS d FROM v, c{r} c QUALIFY row_number() OVER (PARTITION BY v.row ORDER BY d, c.j) = 1"
CENTROIDS = f"""WITH v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS row, {_INTS} AS vec FROM embeddings WHERE {_WHOLE} AND len(embedding) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), vec) - 1 AS j, vec AS cen FROM v QUALIFY j < 16),
""" + "\n".join(
    f"""a{r} AS MATERIALIZED ({_NEAREST.format(r=r - 1)}),
s{r} AS (SELECT j, i, sum(vec[i]) AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY j, i),
f{r} AS (SELECT j, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS cen FROM s{r} GROUP BY j),
c{r} AS MATERIALIZED (SELECT c.j, coalesce(f.cen, c.cen) AS cen FROM c{r - 1} c LEFT JOIN f{r} f USING (j)),"""
    for r in _ROUNDS
) + f"""
e AS MATERIALIZED ({_NEAREST.format(r=3)})
SELECT vec_id, CAST(j AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(cen, ',')) AS centroid_sha256 FROM e"""

EXACT_SEARCH = f"""WITH v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS row, {_INTS} AS vec FROM embeddings WHERE {_WHOLE}),
p AS (SELECT q.row, q.vec_id AS query_id, x.vec_id, CAST(coalesce(list_sum(list_transform(range(1, least(len(q.vec), len(x.vec)) + 1), lambda i: q.vec[i] * x.vec[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v x ON q.row <> x.row WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score FROM p QUALIFY rank <= 20"""

PHRASES = f"""WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM t),
n AS (SELECT lang, CAST(sum(len(words)) AS HUGEINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda o: array_to_string(words[o:o + size - 1], ' '))) AS phrase FROM w, range(1, 6) s(size)),
f AS MATERIALIZED (SELECT lang, size, phrase, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
k AS (SELECT lang, size, phrase, a, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k FROM f WHERE size > 1),
c AS (SELECT k.lang, k.size, k.phrase, k.a, k.k, x.a AS l, y.a AS r, n.n, (1000 * k.a * n.n) // (x.a * y.a) AS score FROM k
  JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.words[1:k.k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.words[k.k + 1:], ' ') JOIN n ON n.lang = k.lang),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lang = b.lang AND f.size > b.size AND f.a >= b.a AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM o QUALIFY rank <= 2000"""

ORACLES = {
    "op3_jaccard_join": JACCARD,
    "op6_decontam": DECONTAM,
    "op8_warc": WARC,
    "op9_chat": CHAT,
    "op11_centroids": CENTROIDS,
    "op12_exact_search": EXACT_SEARCH,
    "op13_phrases": PHRASES,
}
