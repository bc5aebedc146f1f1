"""Deterministic markup over the driver's plain texts, so that the document rules have something to find.

A line's kind is a polynomial in document and line number; each kind wraps the raw line in other markup. Where a kind
leaves no room for it, the raw line follows as a line of its own: every line of every text stays in the table, whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kind -> markup around the raw line (``{raw}``), the item key (``{key}``) and a small number (``{n}``).
STRUCTURE = {
    0: "---", 1: "", 2: "> **证明**：{raw}", 3: "> **例{key}**：{raw}", 4: "**定理{key}**：{raw}", 5: "> {raw}", 6: ">", 7: "$$", 8: "> $$", 9: "## §{raw}",
    10: "> **定义{key}**：{raw}", 11: "**证明**：{raw}", 12: "({n}) {raw}", 13: "    1. {raw}", 14: "> > {raw}", 15: "**(2)** {raw}", 16: "- (i) {raw}",
    17: "（式 (1.2)）", 18: "**(1)** {raw}", 19: "---", 20: ">",
}
#: The same for maths markup.
MATHS = {
    0: "\\$\\$", 1: "> \\$\\$", 2: "> > $$", 3: "$$x+y$$", 4: "> $$x+y$$", 5: "$$\\begin", 6: "\\end$$", 7: "<div>", 8: "</div>", 9: ">   $$", 10: "$$", 11: "> $$",
    12: "```", 13: "a → b {raw}", 14: "\\mathrm x {raw}", 15: "$- a$ {raw}", 16: "- (i) {raw}", 17: "({n}) {raw}", 18: "（式 (1.2)）", 19: "> **定义** {raw}", 20: "",
    21: "\\left.\\frac x $ {raw}",
}
#: The same with the forms that layout rewriters work on.
LAYOUT = {
    0: "**例{key}** {raw}", 1: "---", 2: "", 3: "> **例**", 4: "> **证明思路**：首先{raw}其次 b", 5: "  $$", 6: "<img src=a>", 7: "a $$4pt] b", 8: "$$", 9: "> **证明**", 10: "**定义** {raw}",
    11: "## §{raw}", 12: "中文 $x$", 13: "  x", 14: ">", 15: "> b", 16: "# {raw}", 17: "\\[x\\]", 18: "### 定义 {raw}", 19: "Ã© {raw}", 20: "> **例{key}**：{raw} **证明**：c", 22: "",
}
#: Scanned blocks with numbered items, references to them, section heads and label heads.
ITEMS = {
    0: "{key} 定理（名）{raw}", 1: "例子", 2: "{key} {raw}", 3: "见{key} {raw}", 4: "定理{key} {raw}", 5: "定义（{raw}", 6: "{key}：{raw}", 7: "§1.1  {raw}", 8: "Theorem {n}.2 {raw}",
    9: "（{key}，1.2-3）{raw}", 10: "例{key}到1.2-9 {raw}", 11: "{key} Definition {raw}", 12: "由", 13: "Example {n}.4 {raw}", 14: "见定理{n}.3 {raw}", 15: "由 引理 {n}.5 {raw}", 16: "定理{n} {raw}",
}
#: Scanned blocks for the scanners and look-ups: section heads, items, examples, figure captions, lists and their notes.
SCANS = {
    0: "定义{key} {raw}", 1: "定理 {key}（{raw}", 2: "§{key} {raw}", 3: "S{key} {raw}", 4: "8{key}：{raw}", 5: "例{n} {raw}", 6: "例 {n}.2 {raw}", 7: "引理 {n}.3 {raw}", 8: "见{key} {raw}",
    9: "{key} {raw}", 10: "图{n}.2 {raw}图中", 11: "见 Fig. {n}-4 {raw}", 12: "Figure {n}.1.3: Theorem 2.5 {raw}", 13: "（{n}）{raw}", 14: "(1{n}) {raw}", 15: "注：{raw}", 16: "## §{key} {raw}",
    17: "图 3 例{n}.1 的证明 {raw}", 18: "x²⁺ⁿ+y₁+z₁₂ {raw}", 19: "图", 20: "{n}.4 $a$ <b>|{raw}", 21: "定理一 引 理（定义（{raw}",
}
#: Lines that maths repairs work on.
REPAIRS = {
    0: "$$", 1: "$$", 2: "a $x$ 和 $y，", 3: "> **证明**：{raw}", 4: "\\begin{CD}", 5: "A @>>> \\end{CD}", 6: "\\in t x\\in fty\\in f \\in t\\in t{raw}", 7: "\\qquad   x\\quad y\\frac1a{2}{raw}", 8: "", 9: "> ",
    10: ">  > b {raw}", 11: "> $$", 12: "**定理{key}** {raw}", 13: "  $$  ", 14: "b \\$ $$c$$ $d$ $e) ", 15: "> ", 16: "定理{n} {raw}", 17: "## 习题 {raw}", 18: "**练习{n}** {raw}", 19: "$$", 20: "A @>f>g> B @VVV C @>h>k< D{raw}", 21: "> 证毕 {raw}", 22: "> c {raw}",
}
#: Lines whose maths has braces with a backslash too many or too few.
BRACES = {
    0: "$$", 1: "$$", 2: "\\mathcal\\{A\\}_\\{n\\} {raw}", 3: "$x_\\{a\\}$ {raw}", 4: "\\{x} $y", 5: "$\\{x}$ {raw}", 6: "\\frac\\{a\\}\\{b\\}", 7: "\\sqrt{1-x\\}}", 8: "a$ {raw}",
    9: "$\\mathbb \\{R\\}^\\{n\\}$ {raw}", 10: "\\}{raw}", 11: "$\\{x \\in A\\}$ {raw}",
}
#: Summaries into which figures are put: items, proofs, and images that are there already.
FIGURED = {
    0: "**定理{key}** {raw}", 1: "> **例{key}**：{raw}", 2: "> **证明**：{raw}", 3: "", 4: "---", 5: "> {raw}", 6: '<img src="_extract/figure/f1.png">', 7: '> <img src="_extract/figure/f2.png">', 8: "**例 {key}** {raw}",
    9: "## §{raw}", 10: ">", 11: "$$", 12: '<div style="display:flex; gap:6px; flex-wrap:wrap; justify-content:center">', 13: "</div>", 14: '<img src="_extract/figure/f0.png">', 15: "**Theorem {key}** {raw}",
}
KINDS = 23


def kind(doc: str = "doc_id", line: str = "line_no") -> str:
    """SQL of a line's kind."""
    return f"((({doc} * 7919 + {line} * {line} * 131 + {line} * 613) % 10007) % {KINDS})"


def _parts(markup: str) -> tuple[str, str, str, bool, str]:
    """Markup is text, then key or number or neither, then text, then the raw line or nothing, then text."""
    head, raw, tail = markup.partition("{raw}")
    for name in ("key", "n"):
        first, found, second = head.partition(f"{{{name}}}")
        if found:
            return first, name, second, bool(raw), tail
    return head, "", "", bool(raw), tail


def marked(docs: DataFrame, table: dict[int, str] = STRUCTURE) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, line_no, line`` with markup."""
    parts = [_parts(table.get(k, "{raw}")) for k in range(KINDS)]

    table_ = F.array(*[F.struct(*[F.lit(x).alias(f"p{i}") for i, x in enumerate(p)]) for p in parts])

    def kinds(raw: Column, i: Column) -> Column:
        # Functions of a lambda are interpreted: a line's kind is worked out once, not once for each part of its markup.
        n = (i + 1).cast("long")
        k = (((F.col("doc_id") * 7919 + n * n * 131 + n * 613) % 10007) % KINDS).cast("int")
        return F.struct(raw.alias("raw"), n.alias("n"), F.get(table_, k).alias("p"))

    def lines(x: Column) -> Column:
        p, n = x["p"], x["n"]
        key = F.concat((F.col("doc_id") % 9 + 1).cast("string"), F.lit("."), (n % 5 + 1).cast("string"), F.lit("-"), (n % 6 + 1).cast("string"))
        value = F.when(p["p1"] == "key", key).when(p["p1"] == "n", (n % 9 + 1).cast("string")).otherwise("")
        return F.when(p["p3"], F.array(F.concat(p["p0"], value, p["p2"], x["raw"], p["p4"]))).otherwise(F.array(F.concat(p["p0"], value, p["p2"], p["p4"]), x["raw"]))

    every = F.flatten(F.transform(F.transform(F.split("text", "\n", -1), kinds), lines))
    return docs.select("doc_id", F.posexplode(every).alias("pos", "line")).select("doc_id", (F.col("pos") + 1).alias("line_no"), "line")


def marked_sql(name: str, table: dict[int, str] = STRUCTURE) -> str:
    """The same as DuckDB common table expressions; the last one is ``name``."""
    swaps = {"{raw}": "' || raw || '", "{key}": "' || key || '", "{n}": "' || (line_no % 9 + 1) || '"}
    cases = []
    for k, markup in table.items():
        said = "'" + markup.replace("'", "''") + "'"
        for mark, value in swaps.items():
            said = said.replace(mark, value)
        cases.append(f"WHEN {k} THEN [{said}{'' if '{raw}' in markup else ', raw'}]")
    return f"""{name}_raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents WHERE text IS NOT NULL),
{name}_key AS (SELECT *, (doc_id % 9 + 1) || '.' || (line_no % 5 + 1) || '-' || (line_no % 6 + 1) AS key FROM {name}_raw),
{name}_ls AS (SELECT doc_id, line_no, CASE {kind()} {' '.join(cases)} ELSE [raw] END AS ls FROM {name}_key),
{name} AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, pos) AS INTEGER) AS line_no, line FROM (SELECT doc_id, line_no, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM {name}_ls))"""
