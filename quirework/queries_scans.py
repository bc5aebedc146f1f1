"""Queries of the scan, figure, key and store operators with their DuckDB twins; importing it registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import patterns as P
from .functions import text as T
from .operators import figures, items, keys, reports, scans
from .plans import oracles as O
from .plans.lines import md_lines
from .plans.markup import ITEMS, SCANS, STRUCTURE, marked_sql
from .queries import ORACLES, add, lines_of, read, thousandths
from .sources import stores
from .streaming import incremental

_D = marked_sql("d", SCANS)
_B = f"{_D}, b AS (SELECT * FROM (SELECT doc_id AS book, CAST((line_no - 1) // 10 + 1 AS INTEGER) AS page, line_no AS block, {O.strip('line')} AS text, CAST(doc_id % 9 + 1 AS INTEGER) AS ch, line_no AS y FROM d) WHERE text <> '')"


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line is a block, ten lines are a page, a document is a book with one chapter."""
    page = (F.floor((F.col("line_no") - 1) / 10) + 1).cast("int")
    return lines_of(spark, sf_dir, SCANS).select(F.col("doc_id").alias("book"), page.alias("page"), F.col("line_no").alias("block"), T.strip(F.col("line")).alias("text"), F.col("line_no").alias("y")).where("text <> ''")


def _chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book"))
    return docs.select("book", F.expr("cast(book % 9 + 1 as int)").alias("ch"), F.lit(1).alias("start"), F.lit(1 << 30).alias("end"))


def _joined(numbers: str):
    return F.array_join(F.col(numbers).cast("array<string>"), ",")


# --- scanners

_X = [f"regexp_extract(text, {O.q(P.SCAN_SECTION)}, {i})" for i in range(5)]
_SCAN = f"""{_B}, s0 AS (SELECT *, CASE WHEN {O.m('text', P.SCAN_SECTION)} AND ({_X[2]} = CAST(ch AS VARCHAR) OR ({_X[1]} = '8' AND '8' || {_X[2]} = CAST(ch AS VARCHAR))) THEN ch || '.' || {_X[3]} END AS heads FROM b),
s1 AS (SELECT *, last_value(heads IGNORE NULLS) OVER (PARTITION BY book ORDER BY page, block ROWS UNBOUNDED PRECEDING) AS section FROM s0), {O.matches('s1', 'm', P.SCAN_ITEM)},
u AS (SELECT book, page, block, 0 AS beg, 'section' AS kind, heads AS key, {_X[3]} AS number, NULL AS label, {O.strip(_X[4])} AS text FROM s1 WHERE heads IS NOT NULL
  UNION ALL SELECT book, page, block, beg, CASE WHEN g1 = '定义' THEN 'definition' ELSE 'theorem' END, g2 || '.' || g3, g3, g1, {O.part('text', 'beg - 2', 'beg + 55')} FROM m WHERE g2 = CAST(ch AS VARCHAR)),
scan AS (SELECT book, kind, key, TRY_CAST(number AS BIGINT) AS number, label, page, text FROM (SELECT *, row_number() OVER (PARTITION BY book, kind, key ORDER BY page, block, beg) AS k FROM u) WHERE k = 1
  UNION ALL SELECT book, 'example', section, TRY_CAST(regexp_extract(text, {O.q(P.SCAN_EXAMPLE)}, 1) AS BIGINT), '例', page, substring(text, 1, 55) FROM s1 WHERE {O.m('text', P.SCAN_EXAMPLE)} AND NOT {O.m('text', P.SCAN_EXAMPLE + '[.·][0-9]')})"""
add("two_level_scan", lambda s, d: scans.two_level_scan(_blocks(s, d), _chapters(s, d)), f"WITH {_SCAN} SELECT * FROM scan")
add(
    "scan_holes",
    lambda s, d: scans.holes(scans.two_level_scan(_blocks(s, d), _chapters(s, d)), ["book", "kind"], "number").select("book", "kind", "low", "high", "n", F.size("holes").alias("n_holes"), F.aggregate("holes", F.lit(0).cast("long"), lambda acc, h: acc + h["last"] - h["first"] + 1).alias("missing")),
    f"""WITH {_SCAN}, n AS (SELECT DISTINCT book, kind, number FROM scan WHERE number IS NOT NULL), g AS (SELECT *, number - lag(number) OVER (PARTITION BY book, kind ORDER BY number) - 1 AS gap FROM n)
SELECT book, kind, min(number) AS low, max(number) AS high, count(*) AS n, CAST(count(*) FILTER (gap > 0) AS INTEGER) AS n_holes, CAST(coalesce(sum(gap), 0) AS BIGINT) AS missing FROM g GROUP BY 1, 2""",
)
_AROUND = [f"{O.part('text', 'beg - 15', 'beg')} || {O.part('text', 'upto', 'upto + 20')}", "right(prev, 20) || substring(text, 1, 20)", "right(text, 20) || substring(following, 1, 20)"]
_TAG = ", ".join(f"nullif(regexp_extract({x}, '{scans.FOUND_LABEL}', 1), '')" for x in _AROUND)
add(
    "found_items",
    lambda s, d: scans.found_items(_blocks(s, d), _chapters(s, d)),
    f"""WITH {_B}, o AS (SELECT *, lag(text) OVER w AS prev, lead(text) OVER w AS following FROM b WINDOW w AS (PARTITION BY book ORDER BY page, block)), {O.matches('o', 'm', items.NUMBER)},
f AS (SELECT *, ch || '.' || TRY_CAST(g2 AS BIGINT) || '-' || TRY_CAST(g3 AS BIGINT) AS key, CASE WHEN {O.m(O.part('text', 'beg - 15', 'beg'), items.CITES)} THEN 'REF' ELSE coalesce({_TAG}, 'NUM') END AS tag FROM m WHERE TRY_CAST(g1 AS INTEGER) = ch)
SELECT book, key, page, tag, said, {O.part('text', 'beg - 5', 'upto + 30')} AS snippet FROM (SELECT *, row_number() OVER (PARTITION BY book, key ORDER BY page, block, beg) AS k FROM f) WHERE k = 1""",
)
_PAGES = f"{_B}, pt AS (SELECT book, page, string_agg(text, chr(10) ORDER BY y, block) AS text FROM b GROUP BY 1, 2)"
add(
    "figure_references",
    lambda s, d: scans.figure_references(_blocks(s, d)),
    f"""WITH {_PAGES}, r AS (SELECT book, page, y, coalesce(sum(length(text) + 1) OVER (PARTITION BY book, page ORDER BY y, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo, length(text) AS n FROM b), {O.matches('pt', 'm', P.FIGURE_REFERENCE)}
SELECT m.book, m.page, m.g1 AS label, CAST(coalesce(r.y, 0) AS DOUBLE) AS y FROM m LEFT JOIN r ON m.book = r.book AND m.page = r.page AND m.beg >= r.lo AND m.beg < r.lo + r.n""",
)
add("raw_dump", lambda s, d: scans.raw_dump(_blocks(s, d)), f"WITH {_PAGES} SELECT book, page, chr(10) || '===== PAGE ' || page || ' =====' || chr(10) || chr(10) || text || chr(10) AS text FROM pt")
add(
    "source_sections",
    lambda s, d: scans.source_sections(_blocks(s, d), _chapters(s, d)),
    f"""WITH {_B}, {O.matches('b', 'm', P.SOURCE_NUMBER)}, h AS (SELECT DISTINCT book, section FROM (
  SELECT book, ch, regexp_extract(text, {O.q(P.SOURCE_HEAD_GLUED)}, 1) AS c, TRY_CAST(regexp_extract(text, {O.q(P.SOURCE_HEAD_GLUED)}, 2) AS INTEGER) AS section FROM b
  UNION ALL SELECT book, ch, regexp_extract(text, {O.q(P.SOURCE_HEAD_PLAIN)}, 1), TRY_CAST(regexp_extract(text, {O.q(P.SOURCE_HEAD_PLAIN)}, 2) AS INTEGER) FROM b
  UNION ALL SELECT book, ch, regexp_extract(text, {O.q(P.SOURCE_HEAD_SHORT)}, 1), TRY_CAST(regexp_extract(text, {O.q(P.SOURCE_HEAD_SHORT)}, 2) AS INTEGER) FROM b WHERE length(text) < 60) WHERE TRY_CAST(c AS INTEGER) = ch AND section IS NOT NULL),
n AS (SELECT book, CAST(g2 AS INTEGER) AS section, max(CAST(g3 AS INTEGER)) AS high FROM m WHERE CAST(g1 AS INTEGER) = ch AND CAST(g3 AS INTEGER) > 0 AND {O.m(O.part('text', 'beg - 10', 'upto + 10'), P.SOURCE_LABEL)} GROUP BY 1, 2)
SELECT coalesce(h.book, n.book) AS book, coalesce(h.section, n.section) AS section, h.book IS NOT NULL AS headed, high FROM n FULL JOIN h ON n.book = h.book AND n.section = h.section""",
)
add(
    "summary_headings",
    lambda s, d: scans.summary_headings(lines_of(s, d, SCANS), _chapters(s, d).withColumnRenamed("book", "doc_id")),
    f"WITH {_D} SELECT DISTINCT doc_id, CAST(regexp_extract(t, {O.q(P.SUMMARY_HEAD)}, 2) AS INTEGER) AS section FROM (SELECT doc_id, {O.strip('line')} AS t FROM d) WHERE TRY_CAST(regexp_extract(t, {O.q(P.SUMMARY_HEAD)}, 1) AS INTEGER) = doc_id % 9 + 1",
)
add(
    "context_labels",
    lambda s, d: scans.context_labels(lines_of(s, d, SCANS)),
    f"""WITH {_D}, a AS (SELECT doc_id, line_no, {', '.join(f'lag(line, {k}) OVER w AS a{k}' for k in range(1, 6))} FROM d WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))
SELECT doc_id, line_no, coalesce({', '.join(f"nullif({O.strip(f'regexp_extract(a{k}, {O.q(P.NOTES)}, 1)')}, '')" for k in range(5, 0, -1))},
{', '.join(f"CASE WHEN {O.strip(f'a{k}')} <> '' AND NOT starts_with({O.strip(f'a{k}')}, '-') THEN substring({O.strip(f'a{k}')}, 1, 30) END" for k in range(1, 5))}, '') AS context FROM a""",
)


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lists of a document, one of them with a context."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book"), F.explode(F.array(F.lit(0), F.lit(1))).alias("list_id"))
    return docs.select("book", "list_id", F.lit(1).alias("start"), F.when(F.col("list_id") == 1, "注：").otherwise("").alias("context"), F.sequence(F.lit(1), F.expr("cast(book % 5 + 3 as int)")).alias("numbers"))


add(
    "list_tails",
    lambda s, d: scans.list_tails(_lists(s, d), scans.page_texts(_blocks(s, d))).withColumn("missing", _joined("missing")),
    f"""WITH {_PAGES}, l AS (SELECT doc_id AS book, CAST(i AS INTEGER) AS list_id, CASE WHEN i = 1 THEN '注' ELSE '' END AS word, doc_id % 5 + 3 AS top FROM documents, range(2) t(i)),
j AS (SELECT l.*, pt.text FROM l JOIN pt ON l.book = pt.book WHERE page <= {scans.TAIL_PAGES} AND (word = '' OR contains(text, word))), {O.matches('j', 'm', P.PAREN_NUMBER)},
c AS (SELECT *, CAST(g1 AS INTEGER) AS n, {O.part('text', f'beg - {scans.AROUND}', f'upto + {scans.AROUND}')} AS near FROM m)
SELECT book, list_id, array_to_string(list_sort(list(DISTINCT n)), ',') AS missing FROM c WHERE n > top AND n <= top + {scans.TAIL_REACH} AND len(list_filter(regexp_extract_all(near, {O.q(P.PAREN_NUMBER)}, 1), lambda x: CAST(x AS INTEGER) BETWEEN 1 AND top)) > 0 GROUP BY 1, 2""",
)


def _said_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.coalesce(F.nullif(F.regexp_extract("text", "(定义|定理|引理|例)", 1), F.lit("")), F.lit(items.BARE))
    return _blocks(spark, sf_dir).select("book", F.concat(F.lit("k"), (F.col("block") % 5).cast("string")).alias("key"), "page", label.alias("label"), "text", F.col("block").alias("seq"))


_SAID = f"{_B}, i AS (SELECT book, 'k' || block % 5 AS key, page, coalesce(nullif(regexp_extract(text, '(定义|定理|引理|例)', 1), ''), '{items.BARE}') AS label, text, block AS seq FROM b)"
_CONFLICT = "CASE " + " ".join(f"WHEN {O.m('substring(text, 1, 60)', pattern)} THEN '{label}'" for label, pattern in P.TEXT_LABELS) + " END"
add("label_conflicts", lambda s, d: scans.label_conflicts(_said_items(s, d)), f"WITH {_SAID}, c AS (SELECT *, {_CONFLICT} AS said FROM i) SELECT * FROM c WHERE said <> label")


def _wanted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("book"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda k: F.concat(F.lit("k"), k.cast("string")))).alias("key"))


add(
    "item_details",
    lambda s, d: scans.details(_wanted_keys(s, d), _said_items(s, d), _blocks(s, d)),
    f"""WITH {_SAID}, w AS (SELECT doc_id AS book, 'k' || k AS key FROM documents, range(7) t(k)), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book, key ORDER BY seq) AS k FROM i) WHERE k = 1),
r AS (SELECT w.book, w.key, f.label, f.page, substring({O.strip('f.text')}, 1, 150) AS text FROM w LEFT JOIN f ON w.book = f.book AND w.key = f.key),
c AS (SELECT r.book, r.key, arg_min(b.text, b.block) AS whole FROM r JOIN b ON r.book = b.book AND r.page = b.page AND contains(b.text, substring(r.text, 1, 30)) GROUP BY 1, 2)
SELECT r.*, substring({O.strip('whole')}, 1, 200) AS context FROM r LEFT JOIN c ON r.book = c.book AND r.key = c.key""",
)
_NUMS = "list_transform(regexp_extract_all(key, '\\d+'), lambda x: CAST(x AS BIGINT))"
add(
    "item_orders",
    lambda s, d: scans.natural(scans.by_page_and_key(scans.found_items(_blocks(s, d), _chapters(s, d)).select("book", "key", "page")).withColumnRenamed("nth", "by_page"), ["book"]),
    f"""WITH {_B}, {O.matches('b', 'm', items.NUMBER)}, f AS (SELECT book, ch || '.' || TRY_CAST(g2 AS BIGINT) || '-' || TRY_CAST(g3 AS BIGINT) AS key, min(page) AS page FROM m WHERE TRY_CAST(g1 AS INTEGER) = ch GROUP BY 1, 2)
SELECT book, key, page, CAST(row_number() OVER (PARTITION BY book ORDER BY page, key) AS INTEGER) AS by_page, CAST(row_number() OVER (PARTITION BY book ORDER BY {_NUMS}, key) AS INTEGER) AS nth FROM f WHERE key IS NOT NULL""",
)

# --- scalar functions

_FIG = lambda pattern: f"CASE WHEN {O.m('line', pattern)} THEN concat_ws('.', " + ", ".join(f"nullif(regexp_extract(line, {O.q(pattern)}, {i}), '')" for i in (1, 2, 3)) + ") END"
_SHORT = f"substring(regexp_replace(regexp_replace({O.strip("regexp_replace(line, '^图\\s*\\d+\\s*', '')")}, '图中.*$', '示意图'), '中的.*$', '示意图'), 1, 40)"
_EN, _CN = f"({'|'.join(P.CAPTION_KINDS_EN)})\\s*{P.CAPTION_NUMBER}", f"({P.CAPTION_KINDS})\\s*{P.CAPTION_NUMBER}"
_CANON = "CASE k " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in P.CANONICAL.items()) + " ELSE k END"
_RAISED = "line"
for _signs, _letters, _mark in ((P.RAISED, P.RAISED_AS, "^"), (P.LOWERED, P.LOWERED_AS, "_")):
    _RAISED = f"translate(regexp_replace(regexp_replace({_RAISED}, '([{_signs}]+)', '{_mark}{{\\1}}', 'g'), '\\{_mark}\\{{([{_signs}])\\}}', '{_mark}\\1', 'g'), '{_signs}', '{_letters}')"
_NAME = "line"
for _pattern in ("§", r"\$[^$]*\$", r'[<>:"/\\|?*$]', r"\s+"):
    _NAME = f"regexp_replace({_NAME}, {O.q(_pattern)}, '', 'g')"
add(
    "caption_scalars",
    lambda s, d: lines_of(s, d, SCANS).select("doc_id", "line_no", figures.figure_label("line").alias("figure"), T.short_caption(F.col("line")).alias("short"), T.caption_reference(F.col("line")).alias("r"), T.raised_lowered(F.col("line")).alias("plain"), T.file_name(F.col("line")).alias("name"), T.normal_figure(F.col("line")).alias("tight"), T.first_number(F.col("line")).alias("first"))
    .select("doc_id", "line_no", "figure", "short", F.col("r.kind").alias("kind"), F.col("r.number").alias("number"), F.col("r.of_proof").alias("of_proof"), "plain", "name", "tight", "first"),
    f"""WITH {_D}, r AS (SELECT *, contains(line, '习题') AS skip, {O.m('line', _EN)} AS en, {O.m('line', _CN)} AS cn, regexp_extract(line, {O.q(_EN)}, 1) AS k FROM d)
SELECT doc_id, line_no, coalesce({_FIG(figures.FIGURE_CN)}, {_FIG(figures.FIGURE_EN)}) AS figure, {_SHORT} AS short,
  CASE WHEN skip THEN NULL WHEN en THEN {_CANON} WHEN cn THEN regexp_extract(line, {O.q(_CN)}, 1) END AS kind,
  CASE WHEN skip THEN NULL WHEN en THEN regexp_replace(regexp_extract(line, {O.q(_EN)}, 2), '\\s+', '', 'g') WHEN cn THEN regexp_replace(regexp_extract(line, {O.q(_CN)}, 2), '\\s+', '', 'g') END AS number,
  CASE WHEN skip THEN NULL WHEN en THEN contains(lower(line), 'proof') WHEN cn THEN contains(line, '证明') END AS of_proof, {_RAISED} AS plain, substring({_NAME}, 1, 60) AS name, replace({O.strip('line')}, ' ', '') AS tight,
  coalesce(TRY_CAST(nullif(regexp_extract(line, '\\d+', 0), '') AS BIGINT), -1) AS first FROM r""",
)
_DIGITS = [[("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")[k].translate(str.maketrans("ivx", sub)) for k in range(10)] for sub in ("ivx", "xlc", "cdm")]
add(
    "roman_numbers",
    lambda s, d: read(s, d, "part").select("p_partkey", T.int_to_roman(F.expr("cast(p_partkey % 3999 + 1 as int)")).alias("roman")).withColumn("back", T.roman_to_int(F.col("roman"))),
    f"WITH n AS (SELECT p_partkey, p_partkey % 3999 + 1 AS n FROM part) SELECT p_partkey, repeat('m', n // 1000) || " + " || ".join(f"{_DIGITS[k]}[n // {10**k} % 10 + 1]" for k in (2, 1, 0)) + " AS roman, CAST(n AS INTEGER) AS back FROM n",
)

# --- figures: every vector is a figure on one plane and a caption or word on another, forty of them are a page


def _figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return rows.select("vec_id", F.expr("cast(vec_id div 40 as int)").alias("page"), F.expr("cast(vec_id div 400 as int)").alias("ch"), *[thousandths("embedding", k).alias(n) for k, n in enumerate(("x", "y", "x2", "y2"))])


_V = "v AS (SELECT vec_id, CAST(vec_id // 40 AS INTEGER) AS page, CAST(vec_id // 400 AS INTEGER) AS ch, CAST(round(embedding[1] * 1000) AS DOUBLE) AS x, CAST(round(embedding[2] * 1000) AS DOUBLE) AS y, CAST(round(embedding[3] * 1000) AS DOUBLE) AS x2, CAST(round(embedding[4] * 1000) AS DOUBLE) AS y2 FROM embeddings)"
add(
    "page_nearest_caption",
    lambda s, d: figures.nearest_within(_figures(s, d).select("page", "vec_id", "x", "y"), _figures(s, d).select("page", F.col("vec_id").alias("cap_id"), F.col("x2").alias("x"), F.col("y2").alias("y")), ["page"], "vec_id", "cap_id"),
    f"""WITH {_V}, n AS (SELECT a.page, a.vec_id, b.vec_id AS cap_id, CAST(abs(a.y - b.y2) + 0.5 * abs(a.x - b.x2) AS DOUBLE) AS distance, row_number() OVER (PARTITION BY a.vec_id ORDER BY abs(a.y - b.y2) + 0.5 * abs(a.x - b.x2), b.vec_id) AS k FROM v a JOIN v b ON a.page = b.page)
SELECT page, vec_id, cap_id, distance FROM n WHERE k = 1""",
)
add(
    "text_in_boxes",
    lambda s, d: figures.text_in_boxes(_figures(s, d).selectExpr("page", "vec_id as box", "x - 300 as x0", "x + 300 as x1", "y - 300 as y0", "y + 300 as y1"), _figures(s, d).selectExpr("page", "x2 as cx", "y2 as cy", "cast(vec_id as string) as word"), ["page"], "box"),
    f"WITH {_V} SELECT a.page, a.vec_id AS box, string_agg(CAST(b.vec_id AS VARCHAR), ' ' ORDER BY b.y2, b.x2, CAST(b.vec_id AS VARCHAR)) AS text FROM v a JOIN v b ON a.page = b.page AND b.x2 BETWEEN a.x - 300 AND a.x + 300 AND b.y2 BETWEEN a.y - 300 AND a.y + 300 GROUP BY 1, 2",
)
add(
    "crop_widths",
    lambda s, d: _figures(s, d).selectExpr("vec_id", "case when vec_id % 7 > 0 then x end as x0", "x + abs(x2) as x1").select("vec_id", figures.width_percent("x0", "x1").alias("width")),
    f"WITH {_V} SELECT vec_id, coalesce(round_even(((x + abs(x2)) - CASE WHEN vec_id % 7 > 0 THEN x END + {figures.PADDING}) / {figures.PAGE_WIDTH} * 100, 1), {figures.DEFAULT_WIDTH}) AS width FROM v",
)


def _index(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    """Figures of an index: some without a label, some labels shared, some added by hand."""
    label = f"case when (vec_id + {shift}) % 3 > 0 then concat(cast(ch + 1 as string), '.', cast((vec_id + {shift}) % 11 as string)) end"
    return _figures(spark, sf_dir).selectExpr("ch", "page", "cast(vec_id as int) as fig_idx", f"{label} as label", f"case when (vec_id + {shift}) % 5 = 0 then 'manual' else 'detect' end as source", f"concat('f', cast(vec_id as string), '_{shift}.png') as file")


def _index_sql(name: str, shift: int = 0) -> str:
    return f"""{name} AS (SELECT ch, page, CAST(vec_id AS INTEGER) AS fig_idx, CASE WHEN (vec_id + {shift}) % 3 > 0 THEN (ch + 1) || '.' || (vec_id + {shift}) % 11 END AS label,
CASE WHEN (vec_id + {shift}) % 5 = 0 THEN 'manual' ELSE 'detect' END AS source, 'f' || vec_id || '_{shift}.png' AS file FROM v)"""


add(
    "figure_names",
    lambda s, d: figures.file_names(_index(s, d)),
    f"""WITH {_V}, {_index_sql('i')}, n AS (SELECT *, row_number() OVER (PARTITION BY ch, label ORDER BY page, fig_idx) AS k FROM i)
SELECT * EXCLUDE (k), 'ch' || printf('%02d', ch) || CASE WHEN label IS NULL THEN '_unnamed_' || printf('%02d', k) ELSE '_fig' || label || CASE WHEN k > 1 THEN '_' || k ELSE '' END END AS name FROM n""",
)
add(
    "figure_merge",
    lambda s, d: figures.merged_index(_index(s, d), _index(s, d, 1).where("ch % 2 = 0")),
    f"""WITH {_V}, {_index_sql('o')}, {_index_sql('n0', 1)}, n AS (SELECT * FROM n0 WHERE ch % 2 = 0)
SELECT * FROM o WHERE source = 'manual' OR ch NOT IN (SELECT ch FROM n) UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE source = 'manual' AND o.ch = n.ch AND o.label = n.label)""",
)
add(
    "figure_completeness",
    lambda s, d: figures.completeness(_index(s, d, 1).where("label is not null and fig_idx % 11 < 9").select("ch", "label"), _index(s, d).where("fig_idx % 11 > 2").select("ch", "label"), _index(s, d, 2).where("fig_idx % 33 = 0 and label is not null").select("ch", "label")),
    f"""WITH {_V}, {_index_sql('i')}, {_index_sql('c', 1)}, {_index_sql('g', 2)}, x AS (SELECT ch, label FROM i WHERE label IS NOT NULL AND fig_idx % 11 > 2), k AS (SELECT ch, label FROM c WHERE label IS NOT NULL AND fig_idx % 11 < 9), z AS (SELECT ch, label FROM g WHERE fig_idx % 33 = 0 AND label IS NOT NULL)
SELECT *, 'missing' AS status FROM (SELECT * FROM k EXCEPT SELECT * FROM x EXCEPT SELECT * FROM z) UNION ALL SELECT *, 'extra' FROM (SELECT * FROM x EXCEPT SELECT * FROM k)""",
)
add("figure_counts", lambda s, d: figures.chapter_counts(_index(s, d)), f"WITH {_V}, {_index_sql('i')} SELECT ch, count(*) AS total, count(label) AS named, count(*) - count(label) AS unnamed FROM i GROUP BY 1")
add(
    "figure_index_lines",
    lambda s, d: figures.index_lines(_index(s, d)),
    f"""WITH {_V}, {_index_sql('i')} SELECT ch, CAST(row_number() OVER (PARTITION BY ch ORDER BY label IS NULL, page, fig_idx) AS INTEGER) AS nth,
CASE WHEN label IS NULL THEN '- 图(未标号, p' || page || ')：![fig](' || file || ')' ELSE '- 图 ' || label || '：![图 ' || label || '](' || file || ')' END AS line FROM i""",
)
add("figure_pages", lambda s, d: figures.detected_pages(_index(s, d)).withColumn("pages", _joined("pages")), f"WITH {_V} SELECT ch, array_to_string(list_sort(list(DISTINCT page)), ',') AS pages FROM v GROUP BY 1")
add(
    "figure_faults",
    lambda s, d: figures.file_faults(_figures(s, d).selectExpr("concat('f', cast(vec_id as string)) as file", "case when vec_id % 6 > 0 then abs(x) end as width", "abs(y) as height", "abs(x2) as variance")),
    f"""WITH {_V}, f AS (SELECT 'f' || vec_id AS file, CASE WHEN vec_id % 6 = 0 THEN 'unreadable' WHEN least(abs(x), abs(y)) < 20 THEN 'small' WHEN abs(x2) < 50 THEN 'blank' END AS fault FROM v)
SELECT file, CASE WHEN fault = 'blank' THEN 'warns' ELSE 'blocks' END AS severity, fault FROM f WHERE fault IS NOT NULL""",
)
add(
    "detections_stored",
    lambda s, d: incremental.stored(_index(s, d), _index(s, d, 1).where("page % 3 = 0"), ("page", "fig_idx")),
    f"WITH {_V}, {_index_sql('o')}, {_index_sql('n', 1)} SELECT * FROM o WHERE page % 3 > 0 UNION ALL SELECT * FROM n WHERE page % 3 = 0",
)


def _anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two candidates a document: what its third line ends with, then what its second line begins with."""
    lines = md_lines(read(spark, sf_dir, "documents")).where("length(line) >= 6")
    return lines.where("line_no in (2, 3)").select("doc_id", F.lit(1).alias("fig"), F.expr("3 - line_no").alias("nth"), F.expr("case when line_no = 3 then right(line, 6) else left(ltrim(line), 6) end").alias("text"))


add(
    "first_anchor",
    lambda s, d: figures.first_anchor(md_lines(read(s, d, "documents")), _anchors(s, d)),
    """WITH l AS (SELECT doc_id, CAST(unnest(range(1, len(string_split(text, chr(10))) + 1)) AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
a AS (SELECT doc_id, 1 AS fig, 3 - line_no AS nth, CASE WHEN line_no = 3 THEN right(line, 6) ELSE left(ltrim(line, ' '), 6) END AS text FROM l WHERE line_no IN (2, 3) AND length(line) >= 6),
m AS (SELECT l.doc_id, fig, line_no, row_number() OVER (PARTITION BY l.doc_id, fig ORDER BY CASE WHEN starts_with(ltrim(line, ' '), a.text) THEN 0 ELSE 1 END, nth, line_no) AS k FROM l JOIN a ON l.doc_id = a.doc_id AND contains(line, a.text))
SELECT doc_id, fig, line_no FROM m WHERE k = 1""",
)

# --- keys, ignore lists and stores


def _ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").selectExpr("p_size as ch", "concat(cast(p_size as string), '.', cast(p_partkey % 13 as string), '-', cast(p_partkey % 7 as string)) as key", "p_brand as reason", "p_partkey as seq")


_IGNORED = "g AS (SELECT p_size AS ch, p_size || '.' || p_partkey % 13 || '-' || p_partkey % 7 AS key, p_brand AS reason, p_partkey AS seq FROM part)"
_MORE = "h AS (SELECT l_linenumber AS ch, l_linenumber || '.' || l_partkey % 17 || '-' || l_suppkey % 9 AS key FROM lineitem)"
_more = lambda s, d: read(s, d, "lineitem").selectExpr("l_linenumber as ch", "concat(' ', cast(l_linenumber as string), '.', cast(l_partkey % 17 as string), '.', cast(l_suppkey % 9 as string)) as key")
add("ignore_list_upserted", lambda s, d: keys.upsert(_ignored(s, d), _ignored(s, d).where("seq % 2 = 0").withColumn("reason", F.lit("by hand")), ["ch", "key"], ["seq"]), f"WITH {_IGNORED}, r AS (SELECT *, 1 AS p FROM g UNION ALL SELECT ch, key, 'by hand', seq, 0 FROM g WHERE seq % 2 = 0) SELECT ch, key, reason, seq FROM (SELECT *, row_number() OVER (PARTITION BY ch, key ORDER BY p, seq DESC) AS k FROM r) WHERE k = 1")
add("ignore_list_added", lambda s, d: keys.with_ignored(_ignored(s, d), _more(s, d)), f"WITH {_IGNORED}, {_MORE} SELECT ch, key, reason FROM g UNION ALL SELECT ch, key, 'added' FROM (SELECT DISTINCT ch, key FROM h) h WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.ch = h.ch AND g.key = h.key)")
add("ignore_list_removed", lambda s, d: keys.without_ignored(_ignored(s, d), _more(s, d)), f"WITH {_IGNORED}, {_MORE} SELECT ch, key, reason, seq FROM g WHERE NOT EXISTS (SELECT 1 FROM h WHERE g.ch = h.ch AND g.key = h.key)")
add(
    "messages_left",
    lambda s, d: keys.suppressed(read(s, d, "orders").selectExpr("o_custkey as doc_id", "o_orderkey as message_id", "transform(sequence(0, cast(o_orderkey % 4 as int)), i -> case when i > 0 then cast((o_orderkey + i) % 6 as string) end) as keys").withColumn("keys", F.array_compact("keys")), read(s, d, "customer").selectExpr("c_custkey as doc_id", "cast(c_nationkey % 6 as string) as key").unionByName(read(s, d, "customer").selectExpr("c_custkey as doc_id", "cast((c_nationkey + 1) % 6 as string) as key"))).select("doc_id", "message_id"),
    """WITH m AS (SELECT o_custkey AS doc_id, o_orderkey AS message_id, list_transform(range(1, o_orderkey % 4 + 1), lambda i: CAST((o_orderkey + i) % 6 AS VARCHAR)) AS keys FROM orders),
g AS (SELECT c_custkey AS doc_id, list_value(CAST(c_nationkey % 6 AS VARCHAR), CAST((c_nationkey + 1) % 6 AS VARCHAR)) AS known FROM customer)
SELECT m.doc_id, message_id FROM m LEFT JOIN g ON m.doc_id = g.doc_id WHERE len(keys) = 0 OR len(list_filter(keys, lambda k: NOT list_contains(coalesce(known, []), k))) > 0""",
)
_file = "case doc_id % 4 when 0 then concat('第', cast(doc_id div 4 as string), '章_', lang, '.md') when 1 then concat('Chapter', cast(doc_id div 8 as string), '_x.md') when 2 then concat('Chapter', cast(doc_id div 4 as string), '_x_1.md') else 'readme.md' end"
_FILES = "f AS (SELECT CASE doc_id % 4 WHEN 0 THEN '第' || doc_id // 4 || '章_' || lang || '.md' WHEN 1 THEN 'Chapter' || doc_id // 8 || '_x.md' WHEN 2 THEN 'Chapter' || doc_id // 4 || '_x_1.md' ELSE 'readme.md' END AS file FROM documents)"
add("chapter_files", lambda s, d: read(s, d, "documents").selectExpr(f"{_file} as file").select("file", stores.chapter_of("file").alias("ch")), f"WITH {_FILES} SELECT file, TRY_CAST(coalesce(nullif(regexp_extract(file, '^第(\\d+)章_[^_]*\\.md$', 1), ''), nullif(regexp_extract(file, '^Chapter(\\d+)_[^_]*\\.md$', 1), '')) AS INTEGER) AS ch FROM f")
add(
    "chapter_languages",
    lambda s, d: reports.languages(read(s, d, "documents").selectExpr(f"{_file} as file").distinct()),
    f"""WITH {_FILES}, n AS (SELECT DISTINCT file, CAST(coalesce(nullif(regexp_extract(file, '^第(\\d+)章', 1), ''), nullif(regexp_extract(file, '^Chapter(\\d+)_', 1), '')) AS INTEGER) AS ch FROM f),
c AS (SELECT ch, file AS cn FROM n WHERE ch IS NOT NULL AND starts_with(file, '第')), e AS (SELECT ch, file AS en FROM n WHERE ch IS NOT NULL AND NOT starts_with(file, '第')) SELECT coalesce(c.ch, e.ch) AS ch, cn, en FROM c FULL JOIN e ON c.ch = e.ch""",
)
add(
    "long_chapters_split",
    lambda s, d: reports.split_chapters(read(s, d, "documents"), lines_of(s, d)),
    f"""WITH {marked_sql('d', STRUCTURE)}, s AS (SELECT *, regexp_matches(line, '^##\\s') AS opens, greatest({O.through("regexp_matches(line, '^##\\s')")}, 1) AS section FROM d WHERE doc_id IN (SELECT doc_id FROM documents WHERE length(text) > {reports.SPLIT}))
SELECT doc_id, CAST(section AS BIGINT) AS section, arg_min(line, CASE WHEN opens THEN line_no END) AS title, string_agg(line, chr(10) ORDER BY line_no) AS body FROM s GROUP BY doc_id, section""",
)
_spans = lambda s, d: read(s, d, "customer").selectExpr("cast(c_nationkey as long) as book", "cast(c_custkey as int) as ch", "cast(c_custkey % 20 as int) as start", "cast(c_custkey % 20 + 2 + c_custkey % 3 as int) as `end`")
_ledger = lambda s, d: read(s, d, "orders").selectExpr("cast(o_custkey % 25 as long) as book", "cast(o_orderkey % 29 as int) as page")
_SPANS = 'c AS (SELECT c_nationkey AS book, CAST(c_custkey AS INTEGER) AS ch, c_custkey % 20 AS lo, c_custkey % 20 + 2 + c_custkey % 3 AS hi FROM customer), l AS (SELECT DISTINCT o_custkey % 25 AS book, o_orderkey % 29 AS page FROM orders)'
add("chapters_ready", lambda s, d: incremental.ready(_spans(s, d), _ledger(s, d)), f"WITH {_SPANS} SELECT CAST(c.book AS BIGINT) AS book, ch, count(*) AS pages FROM c JOIN l ON c.book = l.book AND page BETWEEN lo AND hi GROUP BY c.book, ch, lo, hi HAVING count(*) = hi - lo + 1")
add("chapters_passed", lambda s, d: incremental.progressed(_spans(s, d), _ledger(s, d)), f"WITH {_SPANS}, t AS (SELECT book, max(page) AS top FROM l GROUP BY 1) SELECT CAST(c.book AS BIGINT) AS book, ch FROM c JOIN t ON c.book = t.book WHERE hi <= top")
add("section_only_keys", lambda s, d: keys.section_only_keys(lines_of(s, d)), f"WITH {marked_sql('d', STRUCTURE)}, e AS (SELECT doc_id, unnest(regexp_extract_all(line, {O.q(P.SECTION_ONLY_ENTRY)}, 0)) AS said FROM d), k AS (SELECT DISTINCT doc_id, regexp_extract(said, {O.q(P.SECTION_ONLY_ENTRY)}, 1) || CAST(regexp_extract(said, {O.q(P.SECTION_ONLY_ENTRY)}, 2) AS INTEGER) || '.' || CAST(regexp_extract(said, {O.q(P.SECTION_ONLY_ENTRY)}, 3) AS INTEGER) AS key FROM e) SELECT * FROM k")
# --- twins of the three-level items and of their gaps, which need match positions


def _label_sql(text: str) -> str:
    said = f"regexp_extract({text}, {O.q(f'({items.LABEL})')}, 1)"
    pairs = (("例", "Example"), ("定义", "Definition"), ("定理", "Theorem"), ("引理", "Lemma"), ("推论", "Corollary"), ("命题", "Proposition"))
    return "CASE " + " ".join(f"WHEN {O.m(said, f'{cn}|{en}')} THEN '{cn}'" for cn, en in pairs) + " END"


_LEAD, _TAIL = O.part("text", "0", "beg"), "substring(text, CAST(upto + 1 AS BIGINT))"
_BEFORE, _AFTER = O.part("text", "beg - 25", "beg"), O.part("text", "upto", "upto + 40")
_THREE = f"""{marked_sql('d', ITEMS)}, b AS (SELECT doc_id AS book, CAST((line_no - 1) // 10 + 1 AS INTEGER) AS page, line_no AS block, line AS text, CAST(doc_id % 9 + 1 AS INTEGER) AS ch FROM d),
ends AS (SELECT book, max(page) AS last_page FROM b GROUP BY 1), t AS (SELECT *, regexp_replace(trim(text, ' '), '[：:．.，, ]+$', '') AS tidy FROM b WHERE trim(text, ' ') <> ''),
e AS (SELECT *, row_number() OVER w AS seq, lag(text) OVER w AS prev, lead(text) OVER w AS following, CASE WHEN {O.m('tidy', items.SECTION_LABEL)} THEN '例' WHEN {O.m('tidy', items.SECTION_HEAD)} THEN '' END AS event FROM t WINDOW w AS (PARTITION BY book ORDER BY page, block)),
o AS (SELECT *, nullif(last_value(event IGNORE NULLS) OVER (PARTITION BY book ORDER BY page, block ROWS UNBOUNDED PRECEDING), '') AS force FROM e),
r AS (SELECT * FROM o WHERE NOT {O.m('tidy', items.SECTION_LABEL)}), {O.matches('r', 'm0', items.NUMBER)}, {O.matches('r', 'm1', items.GARBLED)},
m AS (SELECT *, 0 AS kind FROM m0 UNION ALL SELECT *, 1 FROM m1 WHERE nth = 0 AND length(trim({_TAIL}, ' ')) >= 8 AND {O.m(f"substring(trim({_TAIL}, ' '), 1, 12)", chr(92) + 'p{L}')}),
n AS (SELECT *, TRY_CAST(g2 AS INTEGER) AS section, TRY_CAST(g3 AS INTEGER) AS number, {_LEAD} AS ahead, {_TAIL} AS tail, {_BEFORE} AS before_, {_AFTER} AS after_ FROM m WHERE TRY_CAST(g1 AS INTEGER) = ch AND TRY_CAST(g2 AS INTEGER) <= {items.MOST_SECTION} AND TRY_CAST(g3 AS INTEGER) <= {items.MOST_NUMBER}),
p AS (SELECT *, CASE WHEN contains(ahead, '（') THEN string_split(ahead, '（')[-1] WHEN contains(ahead, '(') THEN string_split(ahead, '(')[-1] END AS opened, CASE WHEN contains(tail, '）') THEN string_split(tail, '）')[1] WHEN contains(tail, ')') THEN string_split(tail, ')')[1] END AS closed FROM n),
q AS (SELECT *, printf('%d.%d-%d', ch, section, number) AS key FROM p WHERE NOT {O.m('before_', items.CITES)} AND NOT coalesce({O.m("trim(right(prev, 15), ' ')", items.CITES)}, false)
  AND NOT ({O.m('right(ahead, 8)', f'(?:{items.FULL_LABEL})' + chr(91) + chr(92) + 's（）()]*$')} AND NOT {O.m("trim(ahead, ' ')", f'^(?:{items.FULL_LABEL})$')})
  AND NOT coalesce(len(regexp_extract_all(opened || said || closed, {O.q(items.NUMBER)}, 0)) >= 2, false)
  AND NOT ({O.m('before_', '[例定引推]')} AND ({O.m('before_', items.NUMBER)} OR {O.m('after_', items.NUMBER)} OR {O.m('before_ || after_', '[到至～]')}))),
x AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book, key ORDER BY seq, kind, beg) AS nth_key FROM q) WHERE kind = 0 OR nth_key = 1),
y AS (SELECT *, {_label_sql('before_ || after_')} AS own, {_label_sql('right(prev, 40)')} AS of_prev, {_label_sql('substring(following, 1, 40)')} AS of_next FROM x),
z AS (SELECT *, coalesce(own, force, CASE WHEN of_prev IN ('例', '定义') THEN of_prev END, CASE WHEN of_next IN ('例', '定义', '定理') THEN of_next END, '{items.BARE}') AS label FROM y),
three AS (SELECT book, key, section, number, page, label, {O.part('text', 'beg - 5', 'upto + 80')} AS text FROM (SELECT *, row_number() OVER (PARTITION BY book, key ORDER BY label = '{items.BARE}', seq, kind, beg) AS best FROM z) WHERE best = 1)"""
ORACLES["items_three_level"] = f"WITH {_THREE} SELECT * FROM three"
ORACLES["section_gaps"] = f"""WITH {_THREE}, s AS (SELECT book, section, min(number) AS low, max(number) AS high, arg_min(page, (number, page)) AS from_page, arg_max(page, (number, page)) AS to_page, min(page) AS min_page, count(DISTINCT number) AS held,
  arg_min(label, CASE WHEN label <> '{items.BARE}' THEN number END) AS section_label FROM three GROUP BY 1, 2),
f AS (SELECT s.*, CAST(s.book % 9 + 1 AS INTEGER) AS ch, coalesce(lead(min_page) OVER (PARTITION BY s.book ORDER BY section) - 1, last_page) AS stop FROM s JOIN ends ON s.book = ends.book),
g AS (SELECT *, 'head' AS gap, 1 AS gap_low, low - 1 AS gap_high, 1 AS first_page, from_page - 1 AS last_page FROM f WHERE low > 1
  UNION ALL SELECT *, 'internal', low, high, from_page, to_page FROM f WHERE held < high - low + 1 UNION ALL SELECT *, 'tail', high + 1, NULL, to_page + 1, stop FROM f WHERE stop - to_page >= 1)
SELECT book, ch, section, section_label, gap, gap_low, gap_high, CAST(first_page AS INTEGER) AS first_page, CAST(last_page AS INTEGER) AS last_page FROM g"""
_GAPS = ORACLES["section_gaps"].removeprefix("WITH ").replace("\nSELECT book, ch, section", ",\ngaps AS (SELECT book, ch, section").replace("AS last_page FROM g", "AS last_page, CASE gap WHEN 'head' THEN 0 WHEN 'internal' THEN 1 ELSE 2 END AS stage FROM g)")
_SNIPPET = O.part("text", "beg - 5", "upto + 30")
_RECOVERED = f"""{_GAPS}, gp AS (SELECT * EXCLUDE (ch), unnest(range(first_page, last_page + 1)) AS page FROM gaps WHERE last_page >= first_page),
again AS (SELECT gp.*, b.block, b.ch, trim(b.text, ' ') AS text FROM b JOIN gp ON b.book = gp.book AND b.page = gp.page WHERE trim(b.text, ' ') <> ''), {O.matches('again', 'w0', items.NUMBER)}, {O.matches('again', 'w1', items.GARBLED)},
w AS (SELECT *, 0 AS kind FROM w0 UNION ALL SELECT *, 1 FROM w1 WHERE nth = 0), v0 AS (SELECT *, TRY_CAST(g3 AS INTEGER) AS number, {_SNIPPET} AS snippet FROM w WHERE TRY_CAST(g1 AS INTEGER) = ch AND TRY_CAST(g2 AS INTEGER) = section),
v1 AS (SELECT *, printf('%d.%d-%d', ch, section, number) AS key, coalesce({_label_sql('snippet')}, section_label, '{items.BARE}') AS label FROM v0),
v2 AS (SELECT * FROM v1 WHERE (label <> '{items.BARE}' OR len(regexp_extract_all(snippet, '\\p{{L}}', 0)) >= 2 OR contains(snippet, '\\')) AND NOT EXISTS (SELECT 1 FROM three WHERE three.book = v1.book AND three.key = v1.key)),
back AS (SELECT book, key, section, number, CAST(page AS INTEGER) AS page, label, substring(snippet, 1, 120) AS text, stage FROM (SELECT *, row_number() OVER (PARTITION BY book, key ORDER BY stage, page, block, kind, beg) AS k FROM v2) WHERE k = 1)"""
ORACLES["gap_recovered"] = f"WITH {_RECOVERED} SELECT * EXCLUDE (stage) FROM back"
ORACLES["gap_verdicts"] = f"""WITH {_RECOVERED}, held AS (SELECT book, section, number, -1 AS since FROM three UNION ALL SELECT book, section, number, stage FROM back),
c AS (SELECT gaps.book, gaps.section, gap, gap_low, gap_high, first_page, last_page, count(DISTINCT CASE WHEN number BETWEEN gap_low AND gap_high AND since <= stage THEN number END) AS filled, count(*) FILTER (since = stage) AS recovered
  FROM gaps JOIN held ON gaps.book = held.book AND gaps.section = held.section GROUP BY ALL), k AS (SELECT *, gap_high - gap_low + 1 - filled AS missing FROM c)
SELECT book, section, gap, recovered, CAST(coalesce(missing, 0) AS INTEGER) AS missing, CASE WHEN gap = 'tail' THEN CASE WHEN recovered = 0 AND last_page - first_page + 1 > {items.TAIL} THEN 'suspicious' ELSE 'resolved' END WHEN recovered > 0 AND missing > 0 THEN 'blocking' ELSE 'resolved' END AS verdict FROM k"""

# --- orders and states built on queries above


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .queries import QUERIES

    return QUERIES["key_compare"](spark, sf_dir)


add(
    "key_status_order",
    lambda s, d: scans.status_order(_compared(s, d)),
    f"WITH k AS ({ORACLES['key_compare']}) SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, status ORDER BY CASE WHEN status = 'missing' THEN key END, CASE WHEN status <> 'missing' THEN {_NUMS} END, key) AS INTEGER) AS nth FROM k",
)
add(
    "section_only_state",
    lambda s, d: keys.section_only_state(items.section_only(lines_of(s, d, ITEMS).select(F.col("doc_id").alias("book"), F.lit(1).alias("page"), F.col("line_no").alias("block"), F.col("line").alias("text"))).withColumnRenamed("book", "doc_id"), keys.section_only_keys(lines_of(s, d))),
    f"""WITH i AS (SELECT DISTINCT book AS doc_id, key FROM ({ORACLES['items_section_only']})), k AS ({ORACLES['section_only_keys']})
SELECT doc_id, key, 'missing' AS status FROM (SELECT * FROM i EXCEPT SELECT doc_id, key FROM k) UNION ALL SELECT doc_id, key, 'extra' FROM (SELECT doc_id, key FROM k EXCEPT SELECT * FROM i)""",
)
add(
    "polygon_centres",
    lambda s, d: _figures(s, d).select("vec_id", T.centre(F.array("x", "y", "x2", "y2")).alias("c")).select("vec_id", "c.x", "c.y"),
    f"WITH {_V} SELECT vec_id, (x + x2) / 2 AS x, (y + y2) / 2 AS y FROM v",
)
