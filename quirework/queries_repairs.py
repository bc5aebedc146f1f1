"""Queries of the maths repairs and of the gate over all layers; importing it registers them."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import patterns as P
from .functions.text import SPACE
from .operators import braces, embedding, figures, formulas, keys, maths, one_pass, plain_maths, quotes, repairs, reports, rewriters, rules, terms
from .plans import oracles as O
from .plans.lines import line_context, md_lines, spread
from .plans.markup import BRACES, FIGURED, LAYOUT, MATHS, REPAIRS, SCANS, STRUCTURE
from .plans.stored import stored_tables
from .queries import ORACLES, QUERIES, _blocks, _first_sql, _noise, _wanted, add, lines_of, over_lines, read
from . import queries_scans  # noqa: F401  (the gate reads its queries)

_REST = r"regexp_replace(regexp_replace(line, '\\.', '', 'g'), '\$\$.*?(?:\$\$|$)', '', 'g')"
_ODD = f"((length({_REST}) - length(replace({_REST}, '$', ''))) % 2 = 1)"
_SPACED = "line"
for _pattern, _meant in P.BROKEN:
    for _ in range(2):
        _SPACED = f"regexp_replace({_SPACED}, {O.q(_pattern)}, {O.q(_meant.replace('$1', chr(92) + '1').replace('$2', chr(92) + '2'))}, 'g')"
_LONE = "t = '$$'"
_STRAY = f"""s0 AS (SELECT *, contains(line, {O.q(repairs.CD_CLOSE)}) AND {O.latch(f"contains(line, {O.q(repairs.CD_OPEN)})", f"contains(line, {O.q(repairs.CD_CLOSE)})")} AS ends, {_LONE} AS lone FROM c),
s AS (SELECT *, lone AND coalesce({O.before('CASE WHEN NOT lone THEN ends END')}, false) AND (coalesce({O.strip('n1')}, '') = '$$' OR {O.after('CASE WHEN lone THEN true END')} IS NULL) AS gone FROM s0)"""
_LEAD = f"regexp_replace(line, {O.q(f'^{SPACE}+')}, '')"
_BODY = f"CASE WHEN starts_with({_LEAD}, '>') THEN regexp_replace(substring(line, CAST(strpos(line, '>') + 1 AS BIGINT)), {O.q(f'^{SPACE}+')}, '') ELSE {_LEAD} END"
_FOR = {c: f"CASE WHEN starts_with({O.strip(c)}, '>') THEN '> ' ELSE '' END" for c in ("p1", "n1")}
_REBUILT = f"r0 AS (SELECT *, {_LONE} AS lone, {O.through(_LONE)} AS nth FROM c), r1 AS (SELECT *, {_BODY} AS body FROM r0)"
_NEW = f"""list_concat(CASE WHEN lone AND nth % 2 = 1 THEN CASE WHEN coalesce({O.strip('p1')}, '') NOT IN ('', '$$', '>') THEN [{_FOR['p1']}, '$$'] ELSE ['$$'] END
WHEN lone THEN CASE WHEN coalesce({O.strip('n1')}, '') <> '' THEN ['$$', {_FOR['n1']}] ELSE ['$$'] END WHEN nth % 2 = 1 THEN CASE WHEN {O.strip('body')} = '' THEN [] ELSE [body] END ELSE [line] END, CASE WHEN n1 IS NULL AND nth % 2 = 1 THEN ['$$'] ELSE [] END)"""
_IN = f"i AS (SELECT *, {O.latch(O.m('line', P.QUOTE_HEAD), f'({O.m("line", P.QUOTE_END)} AND NOT bqi)')} AND NOT {O.m('line', P.QUOTE_HEAD)} AND NOT ({O.m('line', P.QUOTE_END)} AND NOT bqi) AS inside FROM c)"
_JOINED = f"""j AS (SELECT *, CASE WHEN inside AND blank AND nnb IS NOT NULL AND NOT ({O.m('nnb', P.QUOTE_HEAD)} OR ({O.m('nnb', P.QUOTE_END)} AND NOT {O.quoted('nnb')})) THEN '> ' WHEN inside AND starts_with(t, '$$') AND NOT bqi THEN '> ' || t ELSE line END AS joined FROM i)"""
_SQL = {
    "close_dollars": O.over_context(f"SELECT doc_id, line_no, CASE WHEN {_ODD} AND coalesce(starts_with({O.strip('nnb')}, '$$'), false) THEN regexp_replace(line, {O.q(f'({repairs._MARKS}{SPACE}*)$')}, '$\\1') ELSE line END AS line FROM c", REPAIRS),
    "spaced_commands": O.over_context(f"SELECT doc_id, line_no, {_SPACED} AS line FROM c", REPAIRS),
    "stray_after_diagram": O.over_context(O.renumbered("(SELECT * FROM s WHERE NOT gone)", "[line]"), REPAIRS, _STRAY),
    "display_rebuilt": O.over_context(O.renumbered("r1", _NEW), REPAIRS, _REBUILT),
    "gaps_quoted": O.over_context("SELECT doc_id, line_no, CASE WHEN regexp_matches(joined, '^\\s*>\\s+>') THEN regexp_replace(joined, '^(?:\\s*>\\s*)+', '> ') ELSE joined END AS line FROM j", REPAIRS, f"{_IN}, {_JOINED}"),
}
for _name, _repair in repairs.REPAIRS.items():
    add(f"fix_{_name}", lambda s, d, f=_repair: f(lines_of(s, d, REPAIRS)), _SQL[_name])
add("exercises", lambda s, d: repairs.exercises(lines_of(s, d, REPAIRS)), O.over_context("SELECT doc_id, line_no FROM c WHERE regexp_matches(line, '^(?:>\\s*)?\\*\\*(?:习题|练习|Exercise|Problem)') OR regexp_matches(line, '^#{1,6}\\s.*(?:习题|练习|Exercises?|Problems?)')", REPAIRS))
add(
    "items_single_level",
    lambda s, d: repairs.single_level(_blocks(s, d)),
    _first_sql("(定义|定理|引理|推论|命题|例)\\s*(\\d+)([^\\d.\\-·]|$)", "", "true", "g1", "g1 || regexp_replace(g2, '^0+([0-9])', '\\1')"),
)


add(
    "arrow_ends",
    lambda s, d: repairs.arrow_ends(lines_of(s, d, REPAIRS)),
    O.over_context("SELECT doc_id, line_no, arrow FROM (SELECT doc_id, line_no, unnest(regexp_extract_all(line, '@[><VA][^@&]*', 0)) AS arrow FROM c) WHERE length(arrow) - length(replace(arrow, arrow[2], '')) < 3", REPAIRS),
)
add(
    "after_proof_end",
    lambda s, d: repairs.after_proof_end(line_context(lines_of(s, d, REPAIRS))),
    O.over_context(
        "SELECT doc_id, line_no FROM g2 WHERE ended AND t <> '>'",
        REPAIRS,
        f"""g0 AS (SELECT *, {O.through(f"(bqi AND (NOT {O.quoted('p1')} OR {O.m('line', P.QUOTE_OPENER)} OR {O.m('line', P.QUOTE_FOOTNOTE)}))")} AS quote FROM c), g1 AS (SELECT * FROM g0 WHERE bqi),
g2 AS (SELECT *, coalesce(bool_or({O.m('line', P.PROOF_END)}) OVER (PARTITION BY doc_id, quote ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS ended FROM g1)""",
    ),
)
add(
    "missing_languages",
    lambda s, d: repairs.expected_languages(
        read(s, d, "documents").selectExpr("doc_id div 6 as book", "cast(doc_id % 3 as int) as ch", "case when doc_id % 2 = 0 then 'cn' else lang end as lang"),
        read(s, d, "documents").where("doc_id % 6 = 0").selectExpr("doc_id div 6 as book", "case when doc_id % 18 = 0 then 'cn' else lang end as lang"),
    ).withColumn("missing", F.array_join("missing", ",")),
    """WITH f AS (SELECT DISTINCT doc_id // 6 AS book, CAST(doc_id % 3 AS INTEGER) AS ch, CASE WHEN doc_id % 2 = 0 THEN 'cn' ELSE lang END AS lang FROM documents),
b AS (SELECT doc_id // 6 AS book, CASE WHEN doc_id % 18 = 0 THEN 'cn' ELSE lang END AS lang FROM documents WHERE doc_id % 6 = 0),
w AS (SELECT book, unnest(CASE WHEN lang = 'cn' THEN ['cn'] WHEN lang = 'en' THEN ['cn', 'en'] ELSE ['cn', 'en', lang] END) AS lang FROM b), c AS (SELECT DISTINCT book, ch FROM f)
SELECT book, ch, string_agg(lang, ',' ORDER BY lang) AS missing FROM (SELECT DISTINCT c.book, ch, w.lang FROM c JOIN w ON c.book = w.book WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.book = c.book AND f.ch = c.ch AND f.lang = w.lang)) GROUP BY 1, 2""",
)


def _maths_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_of(spark, sf_dir, REPAIRS)
    return rewriters.changes(lines, repairs.maths_repaired(lines))


add("maths_chain_counts", _maths_chain)
add("maths_chain_fired", lambda s, d: braces.fired(lines_of(s, d, REPAIRS), repairs.MATHS_STEPS)[1].groupBy("step").agg(F.count("*").alias("documents")))
add("fix_braces", lambda s, d: braces.braces(lines_of(s, d, BRACES)))
add("fix_maths_fixpoint", lambda s, d: braces.settled(lines_of(s, d, MATHS), braces.edited)[0])


add("fix_plain_maths", lambda s, d: plain_maths.plain_maths(lines_of(s, d, SCANS)))

# --- the format run and its stages

for _stage in (quotes.quote_stage, quotes.leaked_quotes, quotes.separators_between):
    add(f"fix_{_stage.__name__}", lambda s, d, f=_stage: f(lines_of(s, d, STRUCTURE)))
add("fix_formatted", lambda s, d: quotes.formatted(lines_of(s, d, LAYOUT), number=True))

# --- figures in summaries: four of each document, one by the number of a line's item, one by hand

_FIGURES = """f AS (SELECT doc_id, i AS fig, (doc_id + i) % 3 AS page, 'f' || i || '.png' AS file,
CASE i WHEN 0 THEN '图 1 定理' || k || ' 的示意' WHEN 1 THEN '图 2 例' || k || '图中的点' WHEN 2 THEN '例' || k || ' 的证明' END AS caption, CASE WHEN i % 2 = 0 THEN 10.0 * i END AS x0, 100.0 * (doc_id % 15) + 50 AS x1
FROM (SELECT doc_id, i, (doc_id % 9 + 1) || '.' || ((doc_id + i) % 5 + 1) || '-' || ((doc_id + i) % 6 + 1) AS k FROM documents, range(4) t(i)))"""


def _figured(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(*map(F.lit, range(4)))).alias("fig"))
    docs = docs.withColumn("k", F.expr("concat(cast(doc_id % 9 + 1 as string), '.', cast((doc_id + fig) % 5 + 1 as string), '-', cast((doc_id + fig) % 6 + 1 as string))"))
    return docs.selectExpr(
        "doc_id", "fig", "cast((doc_id + fig) % 3 as int) as page", "concat('f', cast(fig as string), '.png') as file",
        "case fig when 0 then concat('图 1 定理', k, ' 的示意') when 1 then concat('图 2 例', k, '图中的点') when 2 then concat('例', k, ' 的证明') end as caption",
        "case when fig % 2 = 0 then cast(10 * fig as double) end as x0", "cast(100 * (doc_id % 15) + 50 as double) as x1", "case when fig = 3 then array('## §', '$$') end as anchors", "fig = 3 and doc_id % 2 = 0 as anchors_proof",
    )


_SPOTS = f"""{_FIGURES}, sh AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(line, {O.q(embedding.SHOWN)}, 1)) AS file FROM c), n AS (SELECT f.* FROM f WHERE NOT EXISTS (SELECT 1 FROM sh WHERE sh.doc_id = f.doc_id AND sh.file = f.file)),
g AS (SELECT *, CASE WHEN fig = 3 THEN ['## §', '$$'] ELSE flatten(list_transform(CASE WHEN fig = 0 THEN ['定理', 'Theorem'] ELSE ['例', '示例', 'Example'] END, lambda x: ['**' || x || ' ' || num, '**' || x || num, '**' || num || ' ' || x])) END AS cands
  FROM (SELECT *, CASE WHEN fig < 3 THEN regexp_extract(caption, '(?:定理|例)(\\d+\\.\\d+-\\d+)', 1) END AS num FROM n)),
w AS (SELECT * EXCLUDE (cands), unnest(cands) AS cand, unnest(range(len(cands))) AS nth FROM g),
s0 AS (SELECT *, {O.m('line', embedding.ITEM_STOP)} OR starts_with(line, '>') OR starts_with(t, '---') OR starts_with(line, '##') OR starts_with(line, '# ') AS stop FROM c),
s AS (SELECT doc_id, line_no, line, {O.after("CASE WHEN stop THEN {'no': line_no, 'quoted': starts_with(line, '>')} END")} AS stop, max(line_no) OVER (PARTITION BY doc_id) AS last_no FROM s0),
m AS (SELECT w.doc_id, fig, page, file, caption, x0, x1, s.stop, s.last_no, CASE WHEN fig = 3 THEN w.doc_id % 2 = 0 ELSE contains(caption, '证明') END AS proof, row_number() OVER (PARTITION BY w.doc_id, fig ORDER BY starts_with({O.strip("regexp_replace(line, '^\\s*[> ]*', '')")}, cand) DESC, nth, line_no) AS r
  FROM w JOIN s ON s.doc_id = w.doc_id AND contains(s.line, cand)),
p AS (SELECT *, proof AND coalesce(stop.quoted, false) AS quoted, coalesce(nullif(regexp_extract(coalesce(caption, ''), '(图\\s*\\d+)', 1), ''), '图') AS tag,
  substring(regexp_replace(regexp_replace({O.strip("regexp_replace(coalesce(caption, ''), '^图\\s*\\d+\\s*', '')")}, '图中.*$', '示意图'), '中的.*$', '示意图'), 1, 40) AS short,
  coalesce(round_even((x1 - x0 + {figures.PADDING}) / {figures.PAGE_WIDTH} * 100, 1), {figures.DEFAULT_WIDTH}) AS width FROM m WHERE r = 1),
i AS (SELECT *, '<img src="_extract/figure/' || file || '" alt="' || tag || ' ' || short || '" width="' || width || '%" height="auto">' AS img FROM p),
a AS (SELECT doc_id, CASE WHEN quoted THEN stop.no + 1 ELSE coalesce(stop.no, last_no + 1) END AS place, 0 AS side, -page AS o1, -fig AS o2, unnest(CASE WHEN quoted THEN ['>', '> ' || img] WHEN proof THEN ['', img, ''] ELSE ['', img] END) AS line,
  unnest(range(CASE WHEN proof AND NOT quoted THEN 3 ELSE 2 END)) AS pos FROM i),
u AS (SELECT doc_id, place, side, o1, o2, pos, line FROM a UNION ALL SELECT doc_id, line_no, 1, 0, 0, 0, line FROM c)"""
add(
    "fix_figures_embedded",
    lambda s, d: embedding.embedded(lines_of(s, d, FIGURED), _figured(s, d)),
    O.over_context("SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY place, side, o1, o2, pos) AS INTEGER) AS line_no, line FROM u", FIGURED, _SPOTS),
)
_TERM = lambda c: f"({O.m(c, embedding.IMAGE_END)} AND NOT coalesce(starts_with(ltrim({c}), '>'), false))"
add(
    "fix_images_continued",
    lambda s, d: embedding.images_continued(lines_of(s, d, FIGURED)),
    O.over_context(f"SELECT doc_id, line_no, CASE WHEN blank AND inside AND nnb IS NOT NULL AND NOT {O.m('nnb', embedding.IMAGE_HEAD)} AND NOT {_TERM('nnb')} THEN '> ' ELSE line END AS line FROM k", FIGURED, f"k AS (SELECT *, {O.latch(O.m('line', embedding.IMAGE_HEAD), _TERM('line'))} AS inside FROM c)"),
)
add("fix_images_side_by_side", lambda s, d: embedding.images_side_by_side(lines_of(s, d, FIGURED)))
_ITEM_NO = f"nullif(regexp_replace(regexp_extract(line, {O.q(chr(94) + chr(92) + f's*(?:>{chr(92)}s*)?{chr(92)}*{chr(92)}*(?:{P.CAPTION_KINDS}|' + '|'.join(P.CAPTION_KINDS_EN) + f'){chr(92)}s*{P.CAPTION_NUMBER}')}, 1), '\\s+', '', 'g'), '')"
add(
    "figure_out_of_block",
    lambda s, d: embedding.out_of_block(lines_of(s, d, FIGURED), _figured(s, d)),
    O.over_context(
        """SELECT * FROM (SELECT j.doc_id, line_no, j.file, CASE WHEN fig > 0 AND NOT open THEN 'outside' WHEN coalesce(item, '') <> num THEN 'other_item' END AS fault
FROM (SELECT doc_id, line_no, item, open, unnest(files) AS file FROM v) j JOIN (SELECT *, regexp_extract(caption, '(?:定理|例)([0-9]+[.][0-9]+-[0-9]+)', 1) AS num FROM f WHERE fig < 3) f ON f.doc_id = j.doc_id AND f.file = j.file) WHERE fault IS NOT NULL""",
        FIGURED,
        f"{_FIGURES}, v AS (SELECT doc_id, line_no, regexp_extract_all(line, {O.q(embedding.SHOWN)}, 1) AS files, {O.before(_ITEM_NO)} AS item, {O.latch(O.m('line', embedding.IMAGE_HEAD), _TERM('line'))} AND starts_with(ltrim(line), '>') AS open FROM c)",
    ),
)

# --- formulas and terms: words of a line as symbols of a formula, words of the benchmark as terms


def _formulas(spark: SparkSession, sf_dir: str, summary: bool) -> DataFrame:
    """A formula of each line's first twelve words; in the summary every third one has another symbol, every fifth one more."""
    words = F.slice(F.regexp_extract_all("line", F.lit("[A-Za-z]+"), F.lit(0)), 1, 12)
    rows = md_lines(read(spark, sf_dir, "documents")).select("doc_id", F.col("line_no").alias("id"), words.alias("w")).where("size(w) > 0")
    if summary:
        changed = F.when(F.col("id") % 3 == 0, F.transform("w", lambda x, i: F.when(i == 0, F.lit("emptyset")).otherwise(x))).otherwise(F.col("w"))
        rows = rows.withColumn("w", F.when(F.col("id") % 5 == 0, F.concat(changed, F.array(F.lit("cup")))).otherwise(changed))
    return rows.select("doc_id", "id", F.concat(F.lit("\\pmb "), F.array_join(F.transform("w", lambda x: F.concat(F.lit("\\"), x)), " ")).alias("latex"))


add("formula_drift", lambda s, d: formulas.drift(_formulas(s, d, True), _formulas(s, d, False)).withColumns({c: F.array_join(c, " ") for c in ("missing", "extra")}))


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the benchmark of five letters or more; their English name is the word in capitals."""
    word = F.explode(F.regexp_extract_all("text", F.lit("[a-z]{5,}"), F.lit(0))).alias("term")
    return read(spark, sf_dir, "benchmark").select(word).distinct().withColumn("english", F.upper("term"))


add(
    "term_without_english",
    lambda s, d: terms.without_english(md_lines(read(s, d, "documents")), _terms(s, d)),
    """WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-z]{5,}')) AS term FROM benchmark),
l AS (SELECT doc_id, CAST(unnest(range(1, len(string_split(text, chr(10))) + 1)) AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
m AS (SELECT doc_id, term, line_no, strpos(line, term) - 1 AS spot, substring(line, CAST(strpos(line, term) + length(term) AS BIGINT)) AS tail, row_number() OVER (PARTITION BY doc_id, term ORDER BY line_no) AS k FROM l JOIN w ON contains(line, term))
SELECT doc_id, term, line_no, CAST(spot AS INTEGER) AS "at" FROM m WHERE k = 1 AND NOT starts_with(lower(regexp_replace(tail, '^[*\\s”」』]*[(（]\\s*', chr(1))), chr(1) || lower(term))""",
)

# --- chapters too long in either language, exercises with their sections

add(
    "oversized_chapters",
    lambda s, d: reports.oversized_chapters(read(s, d, "documents").selectExpr("doc_id div 4 as book", "cast(doc_id % 2 as int) as ch", "lang", "text")),
    f"""WITH f AS (SELECT doc_id // 4 AS book, CAST(doc_id % 2 AS INTEGER) AS ch, lang, max(length(text)) AS n_chars FROM documents WHERE text IS NOT NULL GROUP BY ALL),
m AS (SELECT *, max(n_chars) OVER (PARTITION BY book, ch) AS most FROM f) SELECT book, ch, lang, CAST(n_chars AS INTEGER) AS n_chars FROM m WHERE most > {reports.SPLIT}""",
)
_LEVEL, _EXERCISE = "CASE WHEN regexp_matches(line, '^#{1,6}\\s') THEN length(regexp_extract(line, '^(#+)', 1)) END", O.m("line", repairs.EXERCISE_HEAD)
add(
    "exercise_sections",
    lambda s, d: repairs.exercise_sections(lines_of(s, d, REPAIRS)),
    O.over_context(
        "SELECT doc_id, line_no FROM e1 WHERE " + " OR ".join(f"coalesce(x{k} > coalesce(o{k}, 0), false)" for k in range(1, 7)),
        REPAIRS,
        f"e0 AS (SELECT *, {_LEVEL} AS level, {_EXERCISE} AS ex FROM c), e1 AS (SELECT *, "
        + ", ".join(f"max(CASE WHEN level = {k} AND ex THEN line_no END) OVER w AS x{k}, max(CASE WHEN level <= {k} AND NOT ex THEN line_no END) OVER w AS o{k}" for k in range(1, 7))
        + " FROM e0 WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING))",
    ),
)

# --- the gate: every layer's findings, counted


def _severity(blocks: str):
    return F.when(F.expr(blocks), "blocks").otherwise("warns").alias("severity")


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of the sections that a scan heads and labels, against headings and numbers of the summary."""
    source = QUERIES["source_sections"](spark, sf_dir).where("headed and high is not null").select(F.col("book").alias("doc_id"), "section", "high")
    return keys.section_state(source, QUERIES["section_numbers"](spark, sf_dir), QUERIES["summary_headings"](spark, sf_dir))


_LAYERS = {
    "0": lambda s, d: QUERIES["label_conflicts"](s, d).select(F.col("book").alias("doc_id"), F.lit("label_conflict").alias("rule"), F.lit("warns").alias("severity")),
    "A": lambda s, d: QUERIES["key_compare"](s, d).where("status <> 'ignored'").select("doc_id", F.col("status").alias("rule"), _severity("status = 'missing'")),
    "B": lambda s, d: QUERIES["gap_verdicts"](s, d).where("verdict <> 'resolved'").select(F.col("book").alias("doc_id"), F.concat("gap", F.lit("_gap")).alias("rule"), _severity("verdict = 'blocking'")),
    "C": lambda s, d: over_lines(s, d, MATHS, maths.maths_findings, "maths").select("doc_id", "rule", F.lit("blocks").alias("severity")),
    "D": lambda s, d: _sections(s, d).select("doc_id", F.concat(F.lit("section_"), "state").alias("rule"), _severity("state = 'missing'")),
    "E": lambda s, d: QUERIES["figure_completeness"](s, d).select(F.col("ch").cast("long").alias("doc_id"), F.concat(F.lit("figure_"), "status").alias("rule"), _severity("status = 'missing'")),
    "F": lambda s, d: QUERIES["figure_faults"](s, d).select(F.expr("cast(substring(file, 2) as long) div 400").alias("doc_id"), F.concat(F.lit("file_"), "fault").alias("rule"), "severity"),
    "G": lambda s, d: QUERIES["findings"](s, d).select("doc_id", "rule", "severity"),
}
LAYERS = tuple(_LAYERS)


def _keys_of(scheme: str, ignored: DataFrame | None):
    """Layer A with the keys of a scheme and further ignored keys ``doc_id, key``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if scheme == "two-level":
            wanted, held, noise = QUERIES["items_two_level"](spark, sf_dir).select(F.col("book").alias("doc_id"), "key"), QUERIES["md_keys_two_level"](spark, sf_dir), None
        else:
            wanted, held, noise = _wanted(spark, sf_dir), keys.md_keys(lines_of(spark, sf_dir)), _noise(spark, sf_dir)
        known = [x.select(F.col("doc_id").cast("long"), F.col("key").cast("string")) for x in (noise, ignored) if x is not None]
        left_out = reduce(DataFrame.unionByName, known) if known else wanted.limit(0)
        state = keys.compare(wanted, held, left_out).where("status <> 'ignored'")
        return state.select("doc_id", F.col("status").alias("rule"), _severity("status = 'missing'"))

    return run


def _shown_by_hand(manual: DataFrame):
    """Layer E without the missing figures ``ch, label`` that are known by hand."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = QUERIES["figure_completeness"](spark, sf_dir)
        by_hand = manual.select(F.col("ch").cast(found.schema["ch"].dataType), F.col("label").cast("string"), F.lit("missing").alias("status"))
        left = found.join(by_hand, ["ch", "label", "status"], "left_anti")
        return left.select(F.col("ch").cast("long").alias("doc_id"), F.concat(F.lit("figure_"), "status").alias("rule"), _severity("status = 'missing'"))

    return run


def layers(spark: SparkSession, sf_dir: str, disabled: Iterable[str] = (), scheme: str = "three-level", ignored: DataFrame | None = None, manual: DataFrame | None = None) -> DataFrame:
    """``doc_id, layer, rule, severity, n`` of every layer that is not disabled; a code of structure rules disables these."""
    off, own = set(disabled), {}
    if off:
        own["G"] = lambda s, d: over_lines(s, d, STRUCTURE, lambda c: rules.findings(c, off), "findings").select("doc_id", "rule", "severity")
    if scheme != "three-level" or ignored is not None:
        own["A"] = _keys_of(scheme, ignored)
    if manual is not None:
        own["E"] = _shown_by_hand(manual)
    # The layer of structure rules goes when all of their codes are disabled; its letter is one of these.
    structure = not {r.code for r in rules.RULES.values()} <= off
    on = {code: run for code, run in (_LAYERS | own).items() if (structure if code == "G" else code not in off)}
    if not on:
        raise ValueError("every layer is disabled")
    # G's own run only leaves codes out, which the pass does as well.
    passed = [code for code in on if code in one_pass.LAYERS and (code == "G" or code not in own)]
    parts = [rules.all_layers(**{code: run(spark, sf_dir) for code, run in on.items() if code not in passed})] if len(passed) < len(on) else []
    if passed:
        docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text"))
        odd = read(spark, sf_dir, "documents").groupBy("doc_id").agg(F.count("*").alias("n")).where(f"n > 1 or doc_id is null or doc_id not between 0 and {one_pass.MOST_ID}").select(F.col("doc_id").alias("odd_id"))
        if odd.isEmpty():
            parts.append(one_pass.counted(docs, passed, off))
        else:
            meets = docs["doc_id"].eqNullSafe(odd["odd_id"])
            parts.append(one_pass.counted(docs.join(odd, meets, "left_anti"), passed, off))
            # Rows that share their id, or have one that the pass can't take, go the way of the layers' own queries.
            rest = stored_tables(spark, documents=docs.join(odd, meets, "left_semi"))
            parts.append(rules.all_layers(**{code: on[code](spark, rest) for code in passed}))
    return reduce(DataFrame.unionByName, parts)


def _layer_sql(layer: str, rule: str, severity: str, source: str, doc: str = "doc_id", where: str = "true") -> str:
    return f"SELECT CAST({doc} AS BIGINT) AS doc_id, '{layer}' AS layer, {rule} AS rule, {severity} AS severity FROM ({source}) q_{layer} WHERE {where}"


_blocks_if = lambda what: f"CASE WHEN {what} THEN 'blocks' ELSE 'warns' END"
_STATES = f"""WITH so AS ({ORACLES['source_sections']}), sn AS ({ORACLES['section_numbers']}), sh AS ({ORACLES['summary_headings']}), st AS (SELECT so.book AS doc_id, CASE WHEN sh.section IS NULL THEN 'missing'
WHEN so.high - coalesce(sn.high, 0) > 5 THEN 'suspect' WHEN so.high > coalesce(sn.high, 0) THEN 'tail' END AS state FROM so LEFT JOIN sn ON sn.doc_id = so.book AND sn.section = so.section LEFT JOIN sh ON sh.doc_id = so.book AND sh.section = so.section
WHERE so.headed AND so.high IS NOT NULL) SELECT * FROM st WHERE state IS NOT NULL"""
_MATHS_FOUND = " UNION ALL ".join(f"SELECT doc_id, '{n}' AS rule FROM ({ORACLES[n]})" for n in maths.MATHS_RULES)
_COUNTED = "SELECT doc_id, layer, rule, severity, count(*) AS n FROM (" + " UNION ALL ".join((
    _layer_sql("0", "'label_conflict'", "'warns'", ORACLES["label_conflicts"], "book"),
    _layer_sql("A", "status", _blocks_if("status = 'missing'"), ORACLES["key_compare"], where="status <> 'ignored'"),
    _layer_sql("B", "gap || '_gap'", _blocks_if("verdict = 'blocking'"), ORACLES["gap_verdicts"], "book", "verdict <> 'resolved'"),
    _layer_sql("C", "rule", "'blocks'", _MATHS_FOUND),
    _layer_sql("D", "'section_' || state", _blocks_if("state = 'missing'"), _STATES),
    _layer_sql("E", "'figure_' || status", _blocks_if("status = 'missing'"), ORACLES["figure_completeness"], "ch"),
    _layer_sql("F", "'file_' || fault", "severity", ORACLES["figure_faults"], "CAST(substring(file, 2) AS BIGINT) // 400"),
    _layer_sql("G", "rule", "severity", ORACLES["findings"]),
)) + ") GROUP BY ALL"
add("gate_layers", layers, _COUNTED)
add(
    "gate_summary",
    lambda s, d: rules.gate(read(s, d, "documents"), layers(s, d)),
    f"""WITH f AS (SELECT doc_id, CAST(coalesce(sum(n) FILTER (severity = 'blocks'), 0) AS BIGINT) AS b, CAST(coalesce(sum(n) FILTER (severity = 'warns'), 0) AS BIGINT) AS w FROM ({_COUNTED}) GROUP BY doc_id)
SELECT documents.doc_id, coalesce(b, 0) AS n_blocking, coalesce(w, 0) AS n_warning, coalesce(b, 0) = 0 AS passed FROM documents LEFT JOIN f ON documents.doc_id = f.doc_id""",
)
add(
    "gate_report",
    lambda s, d: rules.report(layers(s, d)),
    f"""SELECT doc_id, count(*) FILTER (severity = 'blocks') = 0 AS passed, string_agg(CASE severity WHEN 'blocks' THEN 'FAIL ' ELSE 'warn ' END || layer || ' ' || rule || ': ' || n, chr(10) ORDER BY severity <> 'blocks', layer, rule, n) AS text
FROM ({_COUNTED}) GROUP BY doc_id""",
)
