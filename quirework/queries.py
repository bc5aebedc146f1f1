"""Queries over the driver's tables with their DuckDB twins; rules and rewriters run over marked-up documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import patterns as P
from .operators import figures, items, keys, maths, reports, rewriters, rules
from .plans import oracles as O
from .plans.lines import TASK_CHARS, dealt, line_context, md_lines
from .plans.markup import ITEMS, LAYOUT, MATHS, STRUCTURE, marked, marked_sql
from .plans.stored import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def add(name: str, run: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"two queries are named {name}")
    QUERIES[name] = run
    if sql:
        ORACLES[name] = sql


def lines_of(spark: SparkSession, sf_dir: str, table: dict[int, str] = STRUCTURE) -> DataFrame:
    return marked(dealt(read(spark, sf_dir, "documents"), size=TASK_CHARS), table)


def over_lines(spark: SparkSession, sf_dir: str, table: dict[int, str], run: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """``run`` over a line context that many rules read: kept with its partitioning and order until the result is written, then released."""
    ctx = line_context(lines_of(spark, sf_dir, table)).persist()
    try:
        return stored(run(ctx), label)
    finally:
        ctx.unpersist()


# --- lines and their context

add(
    "md_lines",
    lambda s, d: md_lines(read(s, d, "documents")),
    "SELECT doc_id, CAST(unnest(range(1, len(string_split(text, chr(10))) + 1)) AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL",
)
add("line_context", lambda s, d: line_context(lines_of(s, d)), O.over_context("SELECT * FROM c"))

# --- rules

_EXAMPLE_GAP = """, g AS (SELECT *, {stop} AS stop, {count} AS stops FROM c),
h AS (SELECT *, {proof} AS proof, {bad} AS first_bad FROM g)
SELECT doc_id, line_no, first_bad AS gap_line, proof.line_no AS proof_line FROM h
WHERE {example} AND proof.line_no < line_no + 25 AND proof.stops = stops + CAST(stop AS INTEGER) AND first_bad < proof.line_no"""


def _example_gap(pattern: str) -> str:
    stop = f"({O.m('line', pattern)} OR head OR {O.m('line', P.DASH)} OR {O.m('line', P.BARE_STATEMENT)})"
    proof = O.after(f"CASE WHEN {O.m('line', P.PROOF)} THEN {{'line_no': line_no, 'stops': stops}} END")
    bad = O.after("CASE WHEN blank OR NOT bq THEN line_no END")
    body = _EXAMPLE_GAP.format(stop=stop, count=O.count_before(stop), proof=proof, bad=bad, example=O.m("line", pattern))
    head, _, tail = body.partition("\nSELECT doc_id, line_no, first_bad")
    return O.over_context("SELECT doc_id, line_no, first_bad" + tail, more=head[2:])


_ENDS = f"({O.m('nnb', P.QUOTE_HEAD)} OR ({O.m('nnb', P.QUOTE_END)} AND NOT {O.quoted('nnb')}))"
_INSIDE = O.latch(O.m("line", P.QUOTE_HEAD), f"(({O.m('line', P.QUOTE_END)} AND NOT bqi) OR (NOT blank AND NOT bq))")
_GROUPS = f"""g0 AS (SELECT *, {O.through(f"(bqi AND (NOT {O.quoted('p1')} OR {O.m('line', P.QUOTE_OPENER)} OR {O.m('line', P.QUOTE_FOOTNOTE)}))")} AS quote FROM c),
g AS (SELECT *, arg_min(line, CASE WHEN regexp_replace(line, '^\\s+', '') <> '>' THEN line_no END) OVER (PARTITION BY doc_id, quote) AS decides FROM g0 WHERE bqi)"""
_FINE = f"({O.m('decides', P.QUOTE_OPENER)} OR {O.m('decides', P.QUOTE_FOOTNOTE)} OR {O.m('decides', P.QUOTED_STATEMENT_CN)})"
_MISSING = f"(NOT bqi AND NOT head AND ({O.m('t', P.QUOTE_MISSING)} OR {O.m('t', P.FOOTNOTE)}))"
_ITEM = f"({O.m('line', P.STATEMENT)} OR {O.m('line', P.ITEM_EXAMPLE)})"
_PAIRS = f"""p0 AS (SELECT *, {O.count_before('(dash OR head)')} AS stops FROM c),
p AS (SELECT *, {O.after(f"CASE WHEN {_ITEM} THEN {{'line_no': line_no, 'stops': stops}} END")} AS follows FROM p0),
pairs AS (SELECT doc_id, line_no, follows.line_no AS next_line FROM p WHERE {_ITEM} AND follows.line_no - line_no <= 100 AND follows.stops = stops)"""
_WRONG = f"({O.m('line', P.DASH)} AND inside AND {O.m('nnb', P.SUBPOINT)})"
_DASHES = f"""j0 AS (SELECT *, {O.latch(f"({O.m('line', P.STATEMENT_OR_FORMULA)} OR {O.m('line', P.SUBPOINT)})", '(bqi OR head)')} AS inside FROM c),
j AS (SELECT *, {_WRONG} AS wrong FROM j0)"""
_LISTED = f"({O.m('line', P.LISTED)} AND coalesce(starts_with({O.strip('n1')}, '> **证明'), false))"
_TIGHT = {k: f"coalesce({O.strip(k)} <> '', false)" for k in ("p1", "n1")}
_FENCE = "t = '$$'"
_DISPLAY = f"m AS (SELECT *, (NOT ({_FENCE}) AND {O.count_before(_FENCE)} % 2 = 1 AND {O.after(f'CASE WHEN {_FENCE} THEN true END')} IS NOT NULL) AS display FROM c)"
_RUN_ON = "(starts_with(t, '> **') AND (contains(t, '证明') OR contains(t, '例') OR contains(t, '注')))"
_RUN_OFF = f"({O.m('t', P.DASH)} OR {O.m('t', P.HEADING)} OR {O.m('t', P.STATEMENT_CN)})"
_RUNS = f"""n0 AS (SELECT *, {O.latch(_RUN_ON, _RUN_OFF)} AS inside, t = '>' AS empty, coalesce(lag(t = '>') OVER (PARTITION BY doc_id ORDER BY line_no), false) AS was FROM c),
n1_ AS (SELECT *, CASE WHEN empty THEN {O.through('(empty AND NOT was)')} END AS run FROM n0),
n AS (SELECT *, CASE WHEN empty THEN row_number() OVER (PARTITION BY doc_id, run ORDER BY line_no) END AS nth FROM n1_)"""
_LABEL = (
    f"coalesce(nullif(regexp_extract(line, {O.q(P.ORDINAL_PAREN)}, 1), ''), nullif(regexp_extract(line, {O.q(P.ORDINAL_BOLD)}, 1), ''),"
    f" CASE WHEN NOT bqi THEN nullif(regexp_extract(line, {O.q(P.ORDINAL_PLAIN)}, 1), '') END)"
)
_ROMAN = (
    "(len(label) - len(replace(label, 'i', '')) + 5 * (len(label) - len(replace(label, 'v', ''))) + 10 * (len(label) - len(replace(label, 'x', ''))) + 50 * (len(label) - len(replace(label, 'l', '')))"
    " + 100 * (len(label) - len(replace(label, 'c', ''))) + 500 * (len(label) - len(replace(label, 'd', ''))) + 1000 * (len(label) - len(replace(label, 'm', '')))"
    " - CASE WHEN regexp_matches(label, 'i[vx]') THEN 2 ELSE 0 END - CASE WHEN regexp_matches(label, 'x[lc]') THEN 20 ELSE 0 END - CASE WHEN regexp_matches(label, 'c[dm]') THEN 200 ELSE 0 END)"
)


def _ordinals(rows: str) -> str:
    """Blocks of ordinals over ``rows(doc_id, line_no, label)``; the last expression is ``blocks``."""
    return f"""o0 AS (SELECT *, CASE WHEN line_no - lag(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) <= 4 THEN 0 ELSE 1 END AS starts FROM {rows}),
o1 AS (SELECT *, {O.through('starts')} AS block FROM o0),
o2 AS (SELECT doc_id, block, count(*) AS n, bool_and(regexp_matches(label, '^[0-9]+$')) AS digits, bool_and(NOT regexp_matches(label, '^[0-9]+$')) AS letters,
  coalesce(bool_and(regexp_matches(label, {O.q(P.ROMAN)})) FILTER (len(label) > 1), bool_and(regexp_matches(label, '^[ivxlcdm]$'))) AS romans FROM o1 GROUP BY doc_id, block),
o3 AS (SELECT o1.doc_id, o1.block, o1.line_no, o1.label, CASE WHEN digits THEN 'numeric' WHEN letters AND romans THEN 'roman' WHEN letters THEN 'alpha' ELSE 'numeric' END AS kind
  FROM o1 JOIN o2 ON o1.doc_id = o2.doc_id AND o1.block = o2.block WHERE n >= 3),
o4 AS (SELECT *, CASE WHEN kind = 'roman' THEN CASE WHEN regexp_matches(label, {O.q(P.ROMAN)}) THEN {_ROMAN} ELSE 0 END WHEN kind = 'alpha' THEN CASE WHEN len(label) = 1 THEN ascii(label) - 96 END
  ELSE coalesce(CASE WHEN regexp_matches(label, '^[0-9]+$') THEN try_cast(label AS BIGINT) ELSE 0 END, NULL) END AS value FROM o3),
blocks AS (SELECT doc_id, block, kind, count(*) AS n, min(line_no) AS line_no, min(value) AS low, max(value) AS high, count(DISTINCT value) AS held FROM o4 WHERE value > 0 GROUP BY ALL HAVING count(*) >= 3)"""


_GAPS = "SELECT doc_id, line_no, kind, 'head' AS gap, CAST(low - 1 AS BIGINT) AS missing FROM blocks WHERE low > 1 UNION ALL SELECT doc_id, line_no, kind, 'internal', CAST(high - low + 1 - held AS BIGINT) FROM blocks WHERE high - low + 1 > held"


def _where(what: str, more: str = "", source: str = "c") -> str:
    return O.over_context(f"SELECT doc_id, line_no FROM {source} WHERE {what}", more=more)


_RULES = {
    "quote_continuity": _where(f"blank AND NOT bq AND inside AND nnb IS NOT NULL AND NOT {_ENDS}", f"g AS (SELECT *, {_INSIDE} AS inside FROM c)", "g"),
    "nested_quote": _where(O.m("line", P.NESTED_QUOTE)),
    "same_line_proof": _where("starts_with(t, '> **例') AND contains(t, '**证明')"),
    "example_proof_gap": _example_gap(P.EXAMPLE),
    "numbered_example_proof_gap": _example_gap(P.EXAMPLE_NUMBERED),
    "struct_in_quote": _where(f"{O.m('line', P.QUOTED_STATEMENT)} AND NOT {O.m('line', P.QUOTED_PROOF_OF)}"),
    "orphan_quote": _where(f"{O.m('line', P.EMPTY_QUOTE)} AND NOT {O.quoted('pnb')} AND NOT {O.quoted('nnb')}"),
    "stmt_in_quote": _where(f"inside AND {O.m('line', P.QUOTE_WRAPPED)}", f"h AS (SELECT *, {O.latch(O.m('line', P.STATEMENT_OR_FORMULA), O.m('line', P.QUOTE_LEGIT))} AS inside FROM c)", "h"),
    "unlabeled_quote": _where(f"decides IS NOT NULL AND NOT {_FINE} AND t <> '>'", _GROUPS, "g"),
    "missing_quote": _where(_MISSING),
    "missing_separator": O.over_context("SELECT * FROM pairs", more=_PAIRS),
    "dash_in_item": _where("wrong", _DASHES, "j"),
    "proof_after_list": _where(_LISTED),
    "separator_blanks": O.over_context(
        f"SELECT doc_id, line_no, 'before' AS side FROM c WHERE dash AND {_TIGHT['p1']} UNION ALL SELECT doc_id, line_no, 'after' FROM c WHERE dash AND {_TIGHT['n1']}"
    ),
    "displaymath_gt": _where("display AND bqi", _DISPLAY, "m"),
    "empty_quote_runs": O.over_context("SELECT doc_id, min(line_no) AS line_no, max(line_no) AS last_line FROM n WHERE empty AND inside GROUP BY doc_id, run HAVING count(*) > 1", more=_RUNS),
    "ordinal_gaps": O.over_context(_GAPS, more=f"r AS (SELECT doc_id, line_no, {_LABEL} AS label FROM c WHERE {_LABEL} IS NOT NULL), {_ordinals('r')}"),
    "dash_under_heading": _where(f"dash AND {O.m('pnb', P.HEADING)}"),
    "dash_before_proof": _where(f"dash AND inside AND NOT {O.m('pnb', P.HEADING)} AND coalesce(starts_with(nnb, '> **证明'), false)", f"s AS (SELECT *, {O.latch(O.m('line', P.STATEMENT), 'head')} AS inside FROM c)", "s"),
    "item_as_heading": _where(f"{O.m('line', f'^#{{1,6}}\\s+\\*{{0,2}}(?:{P.LABELS}|{P.LABELS_EN})')} OR ({O.m('line', '^##\\s')} AND NOT {O.m('line', '^##\\s+§')})"),
    "mojibake": _where(O.m("line", P.MOJIBAKE)),
    "bracket_display": _where(O.m("line", r"\\[\[\]]")),
}

def _laid_out(sql: str) -> str:
    """The same statement over the other markup."""
    return sql.replace(marked_sql("d"), marked_sql("d", LAYOUT))


#: Rules that only lines of the layout markup can break.
_OF_LAYOUT = {"same_line_proof", "example_proof_gap", "item_as_heading", "mojibake", "bracket_display"}
for _name, _rule in rules.RULES.items():
    _laid = _name in _OF_LAYOUT
    add(_name, lambda s, d, find=_rule.find, t=LAYOUT if _laid else STRUCTURE: find(line_context(lines_of(s, d, t))), _laid_out(_RULES[_name]) if _laid else _RULES[_name])


def _all_findings() -> str:
    parts = [f"SELECT doc_id, '{r.code}' AS code, '{n}' AS rule, '{r.severity}' AS severity, line_no FROM ({_RULES[n]})" for n, r in rules.RULES.items()]
    return " UNION ALL ".join(parts)


add("findings", lambda s, d: over_lines(s, d, STRUCTURE, rules.findings, "findings"), _all_findings())
add(
    "gate_pivot",
    lambda s, d: over_lines(s, d, STRUCTURE, lambda c: rules.gate_pivot(rules.findings(c)), "pivot"),
    "SELECT doc_id, " + ", ".join(f"count(*) FILTER (rule = '{n}') AS {n}" for n in sorted(rules.RULES)) + f" FROM ({_all_findings()}) GROUP BY doc_id",
)

# --- rewriters

_KEEP = "[line]"


def _line(new: str, source: str = "c", more: str = "") -> str:
    return O.over_context(f"SELECT doc_id, line_no, {new} AS line FROM {source}", more=more)


def _content(c: str) -> str:
    return f"coalesce(starts_with({c}, '>') AND {O.strip(c)} NOT IN ('', '>'), false)"


_STRUCT = f"(({O.m('line', P.QUOTED_STATEMENT)} OR {O.m('line', P.QUOTED_STATEMENT_CN)}) AND NOT {O.m('line', P.QUOTED_PROOF_OF)})"
_BARE = lambda c: f"(regexp_replace({c}, '\\s+$', '') = '>')"
_HELD = lambda c: f"coalesce(starts_with({c}, '>') AND NOT {_BARE(c)}, false)"
_UNWRAPPED = "regexp_replace(regexp_replace(regexp_replace(line, '^\\s*>\\s*', ''), '^（([0-9a-zA-Z]+)）', '**(\\1)**'), '^- （([0-9a-zA-Z]+)）', '- (\\1)')"
_STMT = f"""s0 AS (SELECT *, {O.m('line', P.STATEMENT_OR_FORMULA)} AS hd, {O.m('line', P.QUOTE_LEGIT)} AS legit FROM c),
s1 AS (SELECT *, ({O.latch('hd', 'legit')} AND NOT hd AND NOT legit) AS inside, {O.through('hd')} AS item FROM s0),
s AS (SELECT *, bool_or(inside AND {O.m('line', P.QUOTE_WRAPPED)}) OVER (PARTITION BY doc_id, item) AS wrapped FROM s1)"""
_MARKS = f"""e0 AS (SELECT *, CASE WHEN {O.m('line', P.EXAMPLE_NUMBERED)} THEN 'example' WHEN {O.m('line', P.PROOF)} THEN 'proof' WHEN head OR {O.m('line', P.DASH)} OR {O.m('line', P.BARE_STATEMENT)} THEN 'stop' END AS event FROM c),
e1 AS (SELECT *, {O.before("CASE WHEN event IS NOT NULL THEN {'event': event, 'line_no': line_no} END")} AS was, {O.after("CASE WHEN event IS NOT NULL THEN {'event': event, 'line_no': line_no} END")} AS next FROM e0),
e AS (SELECT *, coalesce(event IS NULL AND was.event = 'example' AND next.event = 'proof' AND next.line_no - was.line_no < 25, false) AS gap FROM e1)"""
_PAIRED = f"""q0 AS (SELECT *, t = '$$' AS lone, {O.through("t = '$$'")} AS nth, {O.after("CASE WHEN t = '$$' THEN true END")} IS NOT NULL AS closes FROM c),
q1 AS (SELECT *, CASE WHEN (nth % 2 = 1 AND closes) OR (lone AND nth % 2 = 0) THEN (nth + 1) // 2 END AS pair, len(line) - len(ltrim(line, ' ')) AS ld FROM q0)"""


def _collapsed(source: str, name: str) -> str:
    return f"""{name}0 AS (SELECT *, {O.through("line <> ''")} AS solid FROM {source}), {name}1 AS (SELECT *, row_number() OVER (PARTITION BY doc_id, solid ORDER BY line_no) AS nth, solid = max(solid) OVER (PARTITION BY doc_id) AS ends FROM {name}0),
{name} AS ({O.renumbered(f"(SELECT * FROM {name}1 WHERE line <> '' OR nth <= CASE WHEN ends THEN 3 ELSE 2 END)", "[line]")})"""


_WRAP = f"""x0 AS (SELECT *, {O.m('line', P.TOP_EXAMPLE)} AS opens, ({O.m('line', '^\\s*---\\s*$')} OR head OR {O.m('line', P.TOP_STOP)}) AND NOT {O.m('line', P.TOP_EXAMPLE)} AS stops FROM c),
x1 AS (SELECT *, opens OR (NOT stops AND {O.latch('opens', 'stops')}) AS inside, {O.through('(opens OR stops)')} AS part FROM x0),
x2 AS (SELECT *, max(CASE WHEN inside AND t NOT IN ('', '>') THEN line_no END) OVER (PARTITION BY doc_id, part) AS final FROM x1),
x3 AS ({O.renumbered("(SELECT *, CASE WHEN NOT opens AND blank THEN '>' WHEN NOT opens AND bq THEN line ELSE '> ' || line END AS quote FROM x2 WHERE NOT inside OR line_no <= final)", "CASE WHEN inside AND line_no = final THEN [quote, ''] WHEN inside THEN [quote] ELSE [line] END")})"""
_REWRITES = {
    "unwrap_struct": O.over_context(
        f"SELECT doc_id, line_no, CASE WHEN starts_with(line, '>') AND t = '>' AND NOT ({_content('p1')} AND {_content('n1')}) THEN '' ELSE line END AS line FROM e",
        more=f"u AS (SELECT doc_id, line_no, CASE WHEN {_STRUCT} THEN regexp_replace(line, '^\\s*>\\s+', '') ELSE line END AS line FROM c), {O.context('u', 'e')}",
    ),
    "unwrap_statement": _line(f"CASE WHEN inside AND bqi AND wrapped THEN {_UNWRAPPED} ELSE line END", "s", _STMT),
    "strip_unlabeled": O.over_context(
        f"SELECT doc_id, line_no, CASE WHEN decides IS NOT NULL AND NOT {_FINE} AND regexp_replace(line, '^\\s+', '') NOT IN ('>', '> ') THEN regexp_replace(line, '^>\\s?', '') ELSE line END AS line FROM g"
        " UNION ALL SELECT doc_id, line_no, line FROM c WHERE NOT bqi",
        more=_GROUPS,
    ),
    "add_quote": _line(f"CASE WHEN {_MISSING} THEN '> ' || line ELSE line END"),
    "quote_blanks": O.over_context(
        f"SELECT doc_id, line_no, CASE WHEN {_BARE('line')} AND line <> '> ' AND NOT ({_HELD('p1')} AND {_HELD('n1')}) THEN '' ELSE line END AS line FROM v",
        more=f"g AS (SELECT *, {_INSIDE} AS inside FROM c), u AS (SELECT doc_id, line_no, CASE WHEN blank AND inside AND NOT {_ENDS} THEN '> ' ELSE line END AS line FROM g),"
        " v AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS p1, lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS n1 FROM u)",
    ),
    "add_separators": O.over_context(
        O.renumbered("(SELECT d.*, next_line FROM d LEFT JOIN pairs ON d.doc_id = pairs.doc_id AND d.line_no = pairs.next_line)", "CASE WHEN next_line IS NOT NULL THEN ['---', line] ELSE [line] END"), more=_PAIRS
    ),
    "drop_dash_in_item": O.over_context(
        O.renumbered("(SELECT * FROM x WHERE NOT (wrong OR (was AND blank)))", _KEEP),
        more=_DASHES + ", x AS (SELECT *, coalesce(lag(wrong) OVER (PARTITION BY doc_id ORDER BY line_no), false) AS was FROM j)",
    ),
    "list_blank": O.over_context(O.renumbered("c", f"CASE WHEN {_LISTED} THEN [line, ''] ELSE [line] END")),
    "separator_blanks_added": O.over_context(
        O.renumbered("c", f"CASE WHEN dash THEN (CASE WHEN {_TIGHT['p1']} AND {O.strip('p1')} <> '---' THEN [''] ELSE [] END) || [line] || (CASE WHEN {_TIGHT['n1']} THEN [''] ELSE [] END) ELSE [line] END")
    ),
    "display_unquoted": _line("CASE WHEN display AND bqi THEN regexp_replace(regexp_replace(line, '^(\\s*)>', '\\1'), '^ ', '') ELSE line END", "m", _DISPLAY),
    "single_empty_quote": O.over_context(O.renumbered("(SELECT * FROM n WHERE NOT coalesce(empty AND inside AND nth > 1, false))", _KEEP), more=_RUNS),
    "heading_separators": O.over_context(
        "SELECT * FROM w",
        more=f"""h0 AS (SELECT *, {O.before('CASE WHEN NOT blank AND NOT dash THEN head END')} AS rules FROM c),
h1 AS ({O.renumbered("(SELECT * FROM h0 WHERE NOT (dash AND coalesce(rules, false)))", _KEEP)}), {_collapsed('h1', 'w')}""",
    ),
    "display_without_blanks": O.over_context(O.renumbered("(SELECT * FROM m WHERE NOT (display AND blank))", _KEEP), more=_DISPLAY),
    "split_display": O.over_context(
        O.renumbered(
            "c",
            f"CASE WHEN {O.m('t', '^> [$][$].*[$][$]$')} AND len(t) > 6 THEN ['> $$', '> ' || {O.strip('substring(t, 5, len(t) - 6)')}, '> $$']"
            f" WHEN {O.m('t', '^[$][$].*[$][$]$')} AND len(t) > 4 THEN ['$$', {O.strip('substring(t, 3, len(t) - 4)')}, '$$'] ELSE [line] END",
        ),
        MATHS,
    ),
    "split_example_proof": O.over_context(
        O.renumbered("c", "CASE WHEN starts_with(t, '> **例') AND contains(t, '**证明') THEN [regexp_replace(substring(line, 1, strpos(line, '**证明') - 1), '\\s+$', ''), '>', '> ' || substring(line, strpos(line, '**证明'))] ELSE [line] END")
    ),
    "wrapping_display": O.over_context(
        O.renumbered("(SELECT * FROM q WHERE NOT (lone AND pair IS NOT NULL AND (heading OR (NOT display AND ((chinese AND (inline OR NOT maths)) OR (inline AND NOT maths))))))", _KEEP),
        more=f"""{_PAIRED}, q2 AS (SELECT *, pair IS NOT NULL AND NOT lone AND NOT blank AS body FROM q1),
q AS (SELECT *, coalesce(bool_or(contains(line, '$')) FILTER (body) OVER p, false) AS inline, coalesce(bool_or(contains(line, '\\begin{{')) FILTER (body) OVER p, false) AS display, coalesce(bool_or(regexp_matches(line, '^##? ')) FILTER (body) OVER p, false) AS heading,
 coalesce(bool_or(regexp_matches(line, '[\u4e00-\u9fff]')) FILTER (body) OVER p, false) AS chinese, coalesce(regexp_matches(arg_min(line, CASE WHEN body THEN line_no END) OVER p, '^\\\\[a-zA-Z]'), false) AS maths
 FROM q2 WINDOW p AS (PARTITION BY doc_id, pair))""",
    ),
    "display_dedented": _line(
        "CASE WHEN pair IS NOT NULL AND NOT blank AND indent > 0 THEN substring(line, least(indent, ld) + 1) ELSE line END",
        "q",
        f"{_PAIRED}, q AS (SELECT *, arg_min(ld, CASE WHEN lone THEN line_no END) OVER (PARTITION BY doc_id, pair) AS indent FROM q1)",
    ),
    "example_proof_merged": O.over_context(O.renumbered("(SELECT * FROM e WHERE NOT (gap AND blank))", "[CASE WHEN gap AND NOT (starts_with(line, '> ') OR line = '>') THEN '> ' || line ELSE line END]"), more=_MARKS),
    "examples_wrapped": O.over_context("SELECT * FROM w", more=f"{_WRAP}, {_collapsed('x3', 'w')}"),
    "images_quoted": _line(f"CASE WHEN open AND NOT bqi AND {O.m('line', P.IMAGE)} THEN '> ' || ltrim(line, ' ') ELSE line END", "g", f"g AS (SELECT *, {O.latch(O.m('line', P.QUOTE_HEAD), f"({O.m('line', P.QUOTE_END)} AND NOT bqi)")} AS open FROM c)"),
    "broken_commands": _line("regexp_replace(line, '\\$\\$(\\d+pt\\])', '\\\\\\\\[\\1', 'g')"),
}


_OVER_LAYOUT = {"wrapping_display", "display_dedented", "example_proof_merged", "examples_wrapped", "proof_steps", "images_quoted", "broken_commands", "split_example_proof"}
for _name, _rewrite in rewriters.REWRITERS.items():
    _table = MATHS if _name == "split_display" else LAYOUT if _name in _OVER_LAYOUT else STRUCTURE
    _sql = _REWRITES.get(_name)
    add(f"fix_{_name}", lambda s, d, f=_rewrite, t=_table: f(lines_of(s, d, t)), _laid_out(_sql) if _sql and _name in _OVER_LAYOUT else _sql)
add("layout_findings", lambda s, d: over_lines(s, d, LAYOUT, rules.findings, "layout"), _laid_out(_all_findings()))


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_of(spark, sf_dir)
    return rewriters.changes(lines, rewriters.repaired(lines))


add("fix_chain_counts", _chain)

# --- maths markup

_OUT = f"""x0 AS (SELECT *, t = '$$' AS lone, starts_with(t, '> $$') AS qf, (p1 IS NULL OR n1 IS NULL) AS edge FROM c),
x AS (SELECT *, {O.count_before('(lone AND NOT edge)')} % 2 = 1 AS in_plain, {O.count_before('qf')} % 2 = 1 AS in_quoted FROM x0)"""
_OUTSIDE = "NOT (lone OR qf OR in_plain OR in_quoted)"
_CUT = "line"
for _pattern, _new in ((r"\\\[.*?\\\]", " "), (r"\\[\[\]]", "$$"), (r"\\\(.*?\\\)", " "), (r"\\\$", " "), (r"`[^`]*`", " "), (r"\$\$.*?\$\$", " "), (r"(^|[^$])\$[^$]+\$", "\\1 ")):
    _CUT = f"regexp_replace({_CUT}, {O.q(_pattern)}, {O.q(_new)}, 'g')"
_CODE = "starts_with(t, '```')"
_PLAIN = f"""y0 AS (SELECT *, {O.count_before(_CODE)} % 2 = 1 AS in_code FROM c),
y1 AS (SELECT *, CASE WHEN NOT {_CODE} AND NOT in_code THEN {_CUT} END AS cut FROM y0),
y2 AS (SELECT *, CASE WHEN cut IS NOT NULL THEN (len(cut) - len(replace(cut, '$$', ''))) // 2 ELSE 0 END AS fences FROM y1),
y3 AS (SELECT *, coalesce(sum(fences) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS display FROM y2),
y AS (SELECT *, CASE WHEN NOT display AND fences = 0 THEN cut END AS plain FROM y3)"""
_CORE = f"k_ AS (SELECT *, CASE WHEN starts_with(t, '> ') THEN {O.strip('substring(t, 3)')} ELSE t END AS core FROM c)"
_SIGNS = f"({O.m('line', f'[{P.FENCE_SIGNS}]')} OR " + " OR ".join(f"contains(line, {O.q(x)})" for x in P.FENCE_TOKENS) + ")"


def _maths(what: str, more: str = "", source: str = "c", columns: str = "doc_id, line_no") -> str:
    return O.over_context(f"SELECT {columns} FROM {source} WHERE {what}", MATHS, more)


_P1, _N1 = O.strip("p1"), O.strip("n1")
_MATHS_SQL = {
    "escaped_display": _maths(r"t IN ('\$\$', '> \$\$')"),
    "nested_display": _maths(f"{O.m('t', r'^>\s+>')} AND contains(t, '$$')"),
    "one_line_display": _maths("ends_with(t, '$$') AND ((starts_with(t, '> $$') AND len(t) > 6) OR (starts_with(t, '$$') AND len(t) > 4))"),
    "attached_display": _maths(
        "len(core) > 2 AND ((starts_with(core, '$$') AND NOT ends_with(core, '$$')) OR (ends_with(core, '$$') AND NOT starts_with(core, '$$') AND NOT contains(substring(core, 1, len(core) - 2), '$$')))", _CORE, "k_"
    ),
    "div_blanks": _maths(f"(starts_with(t, '<div') AND {_TIGHT['p1']}) OR (t = '</div>' AND {_TIGHT['n1']})"),
    "deep_quoted_display": _maths(O.m("line", P.DEEP_QUOTED_FENCE)),
    "display_needs_blank": _maths(
        f"coalesce(lone AND NOT edge AND NOT in_plain AND {_N1} NOT IN ('', '$$') AND {_P1} <> '' AND NOT starts_with({_P1}, '>'), false) OR coalesce(qf AND NOT in_quoted AND {_P1} NOT IN ('>', ''), false)", _OUT, "x"
    ),
    "odd_dollars": O.over_context(
        rf"SELECT doc_id, 0 AS line_no, CAST(sum(n) AS BIGINT) AS dollars FROM (SELECT doc_id, len(regexp_replace(line, '\\\$', '', 'g')) - len(replace(regexp_replace(line, '\\\$', '', 'g'), '$', '')) AS n FROM x WHERE {_OUTSIDE}) GROUP BY doc_id HAVING sum(n) % 2 = 1",
        MATHS,
        _OUT,
    ),
    "bad_macros": _maths(f"{_OUTSIDE} AND {O.m('line', '|'.join(P.BAD_MACROS))}", _OUT, "x"),
    "maths_in_fence": O.over_context(
        "SELECT f.doc_id, f.line_no FROM (SELECT doc_id, nth, min(line_no) AS line_no, bool_or(signs AND NOT fence) AS maths FROM f0 WHERE nth % 2 = 1 GROUP BY doc_id, nth) f"
        " JOIN (SELECT doc_id, max(nth) AS fences FROM f0 WHERE fence GROUP BY doc_id) g ON f.doc_id = g.doc_id WHERE maths AND nth < fences",
        MATHS,
        f"f0 AS (SELECT *, {_CODE} AS fence, {O.through(_CODE)} AS nth, {_SIGNS} AS signs FROM c)",
    ),
    "raw_arrows": _maths(O.m("plain", f"[{P.RAW_ARROWS}]"), _PLAIN, "y"),
    "naked_commands": _maths(O.m("plain", P.NAKED_COMMAND), _PLAIN, "y", f"doc_id, line_no, regexp_extract(plain, {O.q(f'({P.NAKED_COMMAND})')}, 1) AS command"),
    "swallowed_prefix": _maths(f"NOT {_CODE} AND NOT in_code AND NOT starts_with(t, '$$') AND {O.m('line', P.SWALLOWED_PREFIX)}", f"z AS (SELECT *, {O.count_before(_CODE)} % 2 = 1 AS in_code FROM c)", "z"),
    "equation_note": _maths(
        f"{O.m('t', P.EQUATION_NOTE)} AND (coalesce(ends_with({_P1}, '$$'), false) OR (coalesce({_P1} = '', false) AND coalesce(ends_with({O.strip('p2')}, '$$'), false)))",
        "z AS (SELECT *, lag(line, 2) OVER (PARTITION BY doc_id ORDER BY line_no) AS p2 FROM c)",
        "z",
    ),
    "escaped_from_quote": _maths(f"{_FENCE} AND coalesce(starts_with({O.strip('pnb')}, '> '), false) AND closes", f"z AS (SELECT *, {O.after(f'CASE WHEN {_FENCE} THEN true END')} AS closes FROM c)", "z"),
    "list_gap": _maths(f"{O.m('line', P.TOP_ITEM)} AND {O.m('p1', P.BULLET)}"),
    "bare_struct_in_quote": _maths(O.m("line", P.BARE_QUOTED_STATEMENT)),
    "unclosed_display": _maths(f"{_FENCE} AND earlier % 2 = 0 AND later IS NULL", f"z AS (SELECT *, {O.count_before(_FENCE)} AS earlier, {O.after(f'CASE WHEN {_FENCE} THEN true END')} AS later FROM c)", "z"),
}
for _name, _find in maths.MATHS_RULES.items():
    add(_name, lambda s, d, find=_find: find(line_context(lines_of(s, d, MATHS))), _MATHS_SQL[_name])
add(
    "maths_counts",
    lambda s, d: over_lines(s, d, MATHS, maths.maths_findings, "maths").groupBy("rule").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("documents")),
    "SELECT rule, count(*) AS n, count(DISTINCT doc_id) AS documents FROM (" + " UNION ALL ".join(f"SELECT doc_id, '{n}' AS rule FROM ({sql})" for n, sql in _MATHS_SQL.items()) + ") GROUP BY rule",
)

# --- keys, items and gaps: a line is a scanned block, ten lines are a page, a document is a book with one chapter


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_of(spark, sf_dir, ITEMS)
    return lines.select(F.col("doc_id").alias("book"), F.floor((F.col("line_no") - 1) / 10).cast("int").alias("page"), F.col("line_no").alias("block"), F.col("line").alias("text")).withColumn("page", F.col("page") + 1)


def _chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = lines_of(spark, sf_dir, ITEMS).groupBy(F.col("doc_id").alias("book")).agg(F.max("line_no").alias("last"))
    return ends.select("book", F.expr("cast(book % 9 + 1 as int)").alias("ch"), F.lit(1).alias("start"), (F.floor((F.col("last") - 1) / 10) + 1).cast("int").alias("end"))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.three_level(_blocks(spark, sf_dir), _chapters(spark, sf_dir))


_NORMAL = "regexp_replace(key, '^([^.]*)\\.([^.]*)\\.([^.]*)$', '\\1.\\2-\\3')"
_CANON = "CASE regexp_extract(k, '^([^\\d\\s]+)', 1) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in P.CANONICAL.items()) + " ELSE regexp_extract(k, '^([^\\d\\s]+)', 1) END || regexp_extract(k, '(\\d+\\.\\d+)', 1)"
_KEYS = f"""keys AS (SELECT doc_id, {_NORMAL} AS key, bool_or(entry) AS entry FROM (
  SELECT doc_id, unnest(regexp_extract_all(line, {O.q(P.ENTRY)}, 1)) AS key, true AS entry FROM d UNION ALL SELECT doc_id, unnest(regexp_extract_all(line, {O.q(f'({P.KEY})')}, 1)), false FROM d) GROUP BY 1, 2)"""
_WANTED = "wanted AS (SELECT DISTINCT doc_id, (doc_id % 9 + 1) || '.' || s || '-' || n AS key FROM documents, range(1, 6) a(s), range(1, 7) b(n) WHERE text IS NOT NULL)"
_NOISE = "noise AS (SELECT doc_id, (doc_id % 9 + 1) || '.1-1' AS key FROM documents WHERE text IS NOT NULL)"


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thirty keys that a document's chapter should have."""
    docs = read(spark, sf_dir, "documents").where("text is not null").select("doc_id")
    grid = F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(5)), lambda s: F.transform(F.sequence(F.lit(1), F.lit(6)), lambda n: F.concat(F.expr("cast(doc_id % 9 + 1 as string)"), F.lit("."), s.cast("string"), F.lit("-"), n.cast("string"))))))
    return docs.select("doc_id", grid.alias("key"))


def _noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.concat(F.expr("cast(doc_id % 9 + 1 as string)"), F.lit(".1-1")).alias("key"))


_D = marked_sql("d")
add("md_keys", lambda s, d: keys.md_keys(lines_of(s, d)), f"WITH {_D}, {_KEYS} SELECT doc_id, key, entry FROM keys")
add(
    "md_keys_two_level",
    lambda s, d: keys.md_keys(lines_of(s, d), "two-level"),
    f"""WITH {_D} SELECT doc_id, {_CANON} AS key, bool_or(entry) AS entry FROM (SELECT doc_id, unnest(regexp_extract_all(line, {O.q(P.LABELLED_ENTRY)}, 1)) AS k, true AS entry FROM d
UNION ALL SELECT doc_id, unnest(regexp_extract_all(line, {O.q(P.LABELLED_MENTION)}, 1)), false FROM d) GROUP BY 1, 2""",
)
add(
    "key_compare",
    lambda s, d: keys.compare(_wanted(s, d), keys.md_keys(lines_of(s, d)), _noise(s, d)),
    f"""WITH {_D}, {_KEYS}, {_WANTED}, {_NOISE}, b AS (SELECT coalesce(w.doc_id, k.doc_id) AS doc_id, coalesce(w.key, k.key) AS key, w.key IS NOT NULL AS wanted, n.key IS NOT NULL AS noise, k.entry
FROM wanted w FULL JOIN keys k ON w.doc_id = k.doc_id AND w.key = k.key LEFT JOIN noise n ON w.doc_id = n.doc_id AND w.key = n.key)
SELECT * FROM (SELECT doc_id, key, CASE WHEN noise THEN 'ignored' WHEN wanted AND entry IS NULL THEN 'missing' WHEN wanted AND NOT entry THEN 'mentioned' WHEN NOT wanted THEN 'extra' END AS status FROM b) WHERE status IS NOT NULL""",
)


def _headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document has a heading for each section whose number its length in lines divides by."""
    rows = lines_of(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n"))
    return rows.select("doc_id", F.explode(F.filter(F.sequence(F.lit(1), F.lit(5)), lambda s: F.col("n") % s == 0)).alias("section"))


_SECTION_MAX = "SELECT doc_id, CAST(string_split(k, '.')[2] AS INTEGER) AS section, CAST(string_split(k, '.')[3] AS INTEGER) AS n FROM (SELECT doc_id, regexp_replace(unnest(regexp_extract_all(line, '(\\d{1,3}\\.\\d{1,3}[.\\-·]\\d{1,3})', 1)), '[-·]', '.') AS k FROM d WHERE contains(line, '**'))"
add("section_numbers", lambda s, d: keys.section_numbers(lines_of(s, d)), f"WITH {_D} SELECT doc_id, section, max(n) AS high FROM ({_SECTION_MAX}) WHERE n > 0 GROUP BY 1, 2")
add(
    "section_state",
    lambda s, d: keys.section_state(_wanted(s, d).select("doc_id", F.split("key", r"[.\-]")[1].cast("int").alias("section"), F.split("key", r"[.\-]")[2].cast("int").alias("n")).groupBy("doc_id", "section").agg(F.max("n").alias("high")), keys.section_numbers(lines_of(s, d)), _headings(s, d)),
    f"""WITH {_D}, h AS (SELECT doc_id, max(n) AS high, section FROM ({_SECTION_MAX}) WHERE n > 0 GROUP BY ALL), n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1),
g AS (SELECT n.doc_id, CAST(s AS INTEGER) AS section, n % s = 0 AS headed FROM n, range(1, 6) a(s))
SELECT * FROM (SELECT g.doc_id, g.section, 6 AS source_high, coalesce(high, 0) AS summary_high, CASE WHEN NOT headed THEN 'missing' WHEN 6 - coalesce(high, 0) > 5 THEN 'suspect' WHEN 6 > coalesce(high, 0) THEN 'tail' END AS state
FROM g LEFT JOIN h ON g.doc_id = h.doc_id AND g.section = h.section) WHERE state IS NOT NULL""",
)
add("items_three_level", _items)


def _first_sql(pattern: str, groups: str, keep: str, label: str, key: str) -> str:
    """First match of a key in reading order, over the marked lines as blocks."""
    names = ["said", "g1", "g2", "g3"]
    structs = ", ".join(f"regexp_extract(said, {O.q(pattern)}, {i}) AS {n}" for i, n in enumerate(names) if i)
    return f"""WITH {marked_sql('d', ITEMS)}, s AS (SELECT doc_id AS book, line_no, unnest(regexp_extract_all(line, {O.q(pattern)}, 0)) AS said, unnest(range(len(regexp_extract_all(line, {O.q(pattern)}, 0)))) AS nth FROM d),
m AS (SELECT book, line_no, nth, {structs} FROM s), r AS (SELECT *, {label} AS label, {key} AS key FROM m WHERE {keep})
SELECT book, key, label, CAST((line_no - 1) // 10 + 1 AS INTEGER) AS page FROM (SELECT *, row_number() OVER (PARTITION BY book, key ORDER BY line_no, nth) AS k FROM r) WHERE k = 1{groups}"""


_CN = "CASE g1 " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in P.CANONICAL.items()) + " ELSE g1 END"
add("items_two_level", lambda s, d: items.two_level(_blocks(s, d), _chapters(s, d)), _first_sql(items.TWO_LEVEL, "", "CAST(g2 AS INTEGER) = book % 9 + 1", "g1", "g1 || CAST(g2 AS INTEGER) || '.' || CAST(g3 AS INTEGER)"))
add(
    "items_section_only",
    lambda s, d: items.section_only(_blocks(s, d)),
    f"""WITH {marked_sql('d', ITEMS)}, s AS (SELECT doc_id AS book, line_no, line FROM d), {O.matches('s', 'm', items.SECTION_ONLY, 'line')},
r AS (SELECT *, {_CN} AS label, {_CN} || CAST(g2 AS INTEGER) || '.' || CAST(g3 AS INTEGER) AS key FROM m WHERE CAST(g2 AS INTEGER) <= 20 AND CAST(g3 AS INTEGER) <= 80 AND NOT regexp_matches({O.part('line', 'beg - 12', 'beg')}, {O.q(items.TRAILING_CITE)}))
SELECT book, key, label, CAST((line_no - 1) // 10 + 1 AS INTEGER) AS page FROM (SELECT *, row_number() OVER (PARTITION BY book, key ORDER BY line_no, nth) AS k FROM r) WHERE k = 1""",
)
add("items_english", lambda s, d: items.english(_blocks(s, d), _chapters(s, d)), _first_sql(items.ENGLISH, "", "CAST(g2 AS INTEGER) = book % 9 + 1", _CN, f"{_CN} || ' ' || g2 || '.' || g3"))
add("section_gaps", lambda s, d: items.section_gaps(_items(s, d), _chapters(s, d)))
add("gap_verdicts", lambda s, d: items.recover_gaps(_blocks(s, d), _items(s, d), _chapters(s, d))[1])
add("gap_recovered", lambda s, d: items.recover_gaps(_blocks(s, d), _items(s, d), _chapters(s, d))[0])

# --- the same operators on tables that need no markup

add(
    "line_number_continuity",
    lambda s, d: items.continuity(read(s, d, "lineitem"), ["l_orderkey"], "l_linenumber"),
    "SELECT l_orderkey, min(l_linenumber) AS low, max(l_linenumber) AS high, count(DISTINCT l_linenumber) AS n, max(l_linenumber) - min(l_linenumber) + 1 - count(DISTINCT l_linenumber) AS missing FROM lineitem GROUP BY 1 HAVING max(l_linenumber) - min(l_linenumber) + 1 > count(DISTINCT l_linenumber)",
)
add(
    "dedup_first_seen",
    lambda s, d: read(s, d, "documents").groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")),
    "SELECT sha256(text) AS digest, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1",
)
add("oversized_documents", lambda s, d: reports.oversized(read(s, d, "documents")), "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM documents WHERE length(text) > 30000")
add(
    "section_split",
    lambda s, d: reports.sections(lines_of(s, d)),
    f"""WITH {_D}, s AS (SELECT *, regexp_matches(line, '^##\\s') AS opens, greatest({O.through("regexp_matches(line, '^##\\s')")}, 1) AS section FROM d)
SELECT doc_id, CAST(section AS BIGINT) AS section, arg_min(line, CASE WHEN opens THEN line_no END) AS title, string_agg(line, chr(10) ORDER BY line_no) AS body FROM s GROUP BY doc_id, section""",
)
add(
    "expected_labels",
    lambda s, d: read(s, d, "documents").select("doc_id").join(read(s, d, "labels"), "doc_id", "left_anti").withColumn("status", F.lit("unlabelled")).unionByName(read(s, d, "labels").select("doc_id").join(read(s, d, "documents"), "doc_id", "left_semi").withColumn("status", F.lit("labelled"))),
    "SELECT d.doc_id, CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 'labelled' ELSE 'unlabelled' END AS status FROM documents d",
)


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping ranges of days since 1970 that the orders fall into: quarters, then half years."""
    return spark.range(120).selectExpr("cast(id as int) as map_idx", "cast(8000 + id * 91 as int) as start", "cast(8000 + id * 91 + 120 as int) as end")


add(
    "range_assignment",
    lambda s, d: figures.assign_ranges(read(s, d, "orders").selectExpr("o_orderkey", "unix_date(cast(o_orderdate as date)) as day"), _months(s, d), "day"),
    """WITH m AS (SELECT CAST(i AS INTEGER) AS map_idx, CAST(8000 + i * 91 AS INTEGER) AS start, CAST(8000 + i * 91 + 120 AS INTEGER) AS "end" FROM range(120) t(i)),
o AS (SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS day FROM orders),
f AS (SELECT o.*, arg_min(m, m.map_idx) AS r FROM o LEFT JOIN m ON o.day BETWEEN m.start AND m."end" GROUP BY ALL)
SELECT o_orderkey, day, r.map_idx, r.start, r."end" AS "end" FROM f""",
)


def thousandths(vector: str, k: int) -> Column:
    """Component ``k`` (from 0) times 1000, rounded half away from zero, as a double; null beyond a vector's end.

    Floats are multiplied as floats, as in the twins: by an integer Spark takes them for doubles, and what a float's
    rounding brings to a half is then rounded another way. A negative number rounds to a negative zero.
    """
    value = F.get(F.col(vector), F.lit(k)) * F.lit(1000.0).cast("float")
    return F.when(value < 0, -F.round(-value)).otherwise(F.round(value)).cast("double")


def _plane(spark: SparkSession, sf_dir: str, low: int, high: int) -> DataFrame:
    """Vectors as points: their label is the page, two coordinates the place."""
    return read(spark, sf_dir, "embeddings").select("vec_id", "label", thousandths("embedding", low).alias("x"), thousandths("embedding", high).alias("y"))


add(
    "nearest_caption",
    lambda s, d: figures.nearest(_plane(s, d, 0, 1), _plane(s, d, 2, 3).withColumnRenamed("vec_id", "cap_id"), ["label"], "vec_id", "cap_id"),
    """WITH a AS (SELECT vec_id, label, round(embedding[1] * 1000) AS x, round(embedding[2] * 1000) AS y FROM embeddings), b AS (SELECT vec_id AS cap_id, label, round(embedding[3] * 1000) AS x, round(embedding[4] * 1000) AS y FROM embeddings),
n AS (SELECT a.label, a.vec_id, b.cap_id, CAST(abs(a.y - b.y) + 0.5 * abs(a.x - b.x) AS DOUBLE) AS distance, row_number() OVER (PARTITION BY a.label, a.vec_id ORDER BY abs(a.y - b.y) + 0.5 * abs(a.x - b.x), b.cap_id) AS k FROM a JOIN b ON a.label = b.label)
SELECT label, vec_id, cap_id, distance FROM n WHERE k = 1""",
)
add(
    "greedy_assignment",
    lambda s, d: figures.assign_greedily(
        _plane(s, d, 0, 1).select(F.lit(1).alias("ch"), F.expr("cast(vec_id div 40 as int)").alias("page"), F.col("vec_id").alias("fig_idx"), "y"),
        _plane(s, d, 2, 3).select(F.lit(1).alias("ch"), F.expr("cast(vec_id div 40 as int)").alias("page"), F.col("vec_id").cast("string").alias("label"), "y"),
    ),
)
add(
    "event_blocks",
    lambda s, d: _event_blocks(read(s, d, "events")),
    """WITH e AS (SELECT *, CASE WHEN epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 3600 THEN 0 ELSE 1 END AS starts FROM events),
b AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS block FROM e)
SELECT user_id, CAST(block AS BIGINT) AS block, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM b GROUP BY 1, 2""",
)


def _event_blocks(events: DataFrame) -> DataFrame:
    """Events of a user at most an hour apart are one block."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    starts = F.when(F.timestamp_diff("MICROSECOND", F.lag("ts").over(order), F.col("ts")) <= 3_600_000_000, 0).otherwise(1)
    rows = events.withColumn("starts", starts).withColumn("block", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("user_id", "block").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


add(
    "tag_blanks",
    lambda s, d: maths.div_blanks(line_context(md_lines(read(s, d, "pages").select(F.col("page_id").alias("doc_id"), F.regexp_replace("html", "(</?(?:div|p)\\b)", "\n$1").alias("text"))))),
    f"""WITH h AS (SELECT page_id AS doc_id, regexp_replace(html, '(</?(?:div|p)\\b)', chr(10) || '\\1', 'g') AS text FROM pages WHERE html IS NOT NULL),
d AS (SELECT doc_id, CAST(unnest(range(1, len(string_split(text, chr(10))) + 1)) AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS line FROM h), {O.context('d', 'c')}
SELECT doc_id, line_no FROM c WHERE (starts_with(t, '<div') AND {_TIGHT['p1']}) OR (t = '</div>' AND {_TIGHT['n1']})""",
)
add(
    "document_dollars",
    lambda s, d: maths.odd_dollars(line_context(md_lines(read(s, d, "documents")))),
    f"""WITH d AS (SELECT doc_id, CAST(unnest(range(1, len(string_split(text, chr(10))) + 1)) AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL), {O.context('d', 'c')}, {_OUT}
SELECT doc_id, 0 AS line_no, CAST(sum(n) AS BIGINT) AS dollars FROM (SELECT doc_id, len(regexp_replace(line, '\\\\\\$', '', 'g')) - len(replace(regexp_replace(line, '\\\\\\$', '', 'g'), '$', '')) AS n FROM x WHERE {_OUTSIDE}) GROUP BY doc_id HAVING sum(n) % 2 = 1""",
)
add(
    "order_rollup",
    lambda s, d: reports.rollup(read(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("md_count"), F.count_if(F.col("o_orderstatus") == "F").alias("f")).select(F.col("o_custkey").alias("book"), "md_count", F.concat(F.col("f").cast("string"), F.lit("/"), F.col("md_count").cast("string")).alias("verify_pass"))),
    """WITH b AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1)
SELECT count(*) AS books, CAST(sum(n) AS BIGINT) AS files, CAST(sum(f) AS BIGINT) AS passed, CAST(sum(n) AS BIGINT) AS total, count(*) FILTER (f < n) AS failing, CAST(0 AS BIGINT) AS broken FROM b""",
)

from . import queries_scans  # noqa: E402,F401
from . import queries_repairs  # noqa: E402,F401  (they register their queries)
