"""DuckDB twins of the line plans: common table expressions that query oracles build on."""

from __future__ import annotations

from ..functions import patterns as P
from ..functions.text import SPACE
from .markup import STRUCTURE, marked_sql


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, {q(f'^{SPACE}+')}, ''), {q(f'{SPACE}+$')}, '')"


def m(column: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({column}, {q(pattern)}), false)"


def quoted(column: str) -> str:
    return f"coalesce(starts_with({strip(column)}, '>'), false)"


def before(value: str) -> str:
    return f"last_value({value} IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def after(value: str) -> str:
    return f"first_value({value} IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"


def latch(on: str, off: str) -> str:
    return f"coalesce({before(f'CASE WHEN {on} THEN true WHEN {off} THEN false END')}, false)"


def count_before(what: str) -> str:
    return f"coalesce(sum(CAST({what} AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"


def through(what: str) -> str:
    return f"sum(CAST({what} AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)"


def context(source: str, name: str) -> str:
    """``name``: the columns of ``line_context`` over the line table ``source``."""
    return f"""{name}_t AS (SELECT doc_id, line_no, line, {strip('line')} AS t FROM {source}),
{name}_k AS (SELECT *, t = '' AS blank, starts_with(line, '>') AS bq, starts_with(t, '>') AS bqi, {m('line', P.HEADING)} AS head, t = '---' AS dash FROM {name}_t),
{name} AS (SELECT *, lag(line) OVER w AS p1, lead(line) OVER w AS n1, {before("CASE WHEN NOT blank THEN line END")} AS pnb, {after("CASE WHEN NOT blank THEN line END")} AS nnb
  FROM {name}_k WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))"""


def over_context(body: str, table: dict[int, str] = STRUCTURE, more: str = "") -> str:
    """A whole statement: marked lines ``d``, their context ``c``, further expressions, then ``body``."""
    return f"WITH {marked_sql('d', table)}, {context('d', 'c')}{', ' + more if more else ''} {body}"


def renumbered(rows: str, lines: str) -> str:
    """A line table from rows ``doc_id, line_no`` and a list of lines each."""
    return f"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, pos) AS INTEGER) AS line_no, line
FROM (SELECT doc_id, line_no, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM (SELECT doc_id, line_no, {lines} AS ls FROM {rows}))"""


def matches(source: str, name: str, pattern: str, text: str = "text") -> str:
    """``name``: one row a match of ``source`` with ``nth`` (from 0), ``said``, ``beg``, ``upto`` and groups ``g1`` to ``g3``."""
    groups = ", ".join(f"regexp_extract(said, {q(pattern)}, {i}) AS g{i}" for i in range(1, 1 + min(3, pattern.replace("(?:", "").replace("(?i)", "").replace("\\(", "").replace("[（(", "").count("("))))
    length = lambda xs: f"coalesce(list_sum(list_transform({xs}, lambda x: length(x))), 0)"
    return f"""{name}_s AS (SELECT *, regexp_extract_all({text}, {q(pattern)}, 0) AS saids, string_split_regex({text}, {q(pattern)}) AS parts FROM {source} WHERE regexp_matches({text}, {q(pattern)})),
{name}_n AS (SELECT *, unnest(range(len(saids))) AS nth FROM {name}_s),
{name}_a AS (SELECT * EXCLUDE (saids, parts), saids[nth + 1] AS said, CAST({length('parts[1:nth + 1]')} + {length('saids[1:nth]')} AS BIGINT) AS beg FROM {name}_n),
{name} AS (SELECT *, beg + length(said) AS upto, {groups} FROM {name}_a)"""


def part(text: str, start: str, end: str) -> str:
    """Characters from ``start`` to ``end``, counted from 0."""
    return f"substring({text}, CAST(greatest({start}, 0) + 1 AS BIGINT), CAST(greatest(({end}) - greatest({start}, 0), 0) AS BIGINT))"
