"""Plain-text maths in prose becomes inline maths: ``x² ∈ A`` -> ``$x^2$ $\\in$ $A...$``, token by token.

A line outside fences, display maths and HTML is cut at its dollar signs, and what is not maths yet at its tokens: runs of
letters, digits, signs and symbols. A token with a sign that only maths has is wrapped. Parts and tokens are elements of
their line's row, so no token travels; one fold over a token's braces tells which of them group and which are meant as signs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import beyond, raised_lowered, strip
from ..plans.lines import count_before, line_context
from .braces import _once

# Greek letters by their names, symbols and the commands that they stand for.
GREEK_SMALL = dict(zip("αβγδεζηθικλμνξπρστυφχψω", "alpha beta gamma delta varepsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau upsilon varphi chi psi omega".split(), strict=True))
GREEK_LARGE = dict(zip("ΓΔΘΛΞΠΣΦΨΩϕϵ", "Gamma Delta Theta Lambda Xi Pi Sigma Phi Psi Omega phi epsilon".split(), strict=True))
ARROWS = dict(zip("→←↦⇒⇐⇔", "to leftarrow mapsto Rightarrow Leftarrow Leftrightarrow".split(), strict=True))
RELATIONS = dict(zip("⊆⊇⊂⊃∈∉≅≃≠≥≤≈≡⊣⊥", "subseteq supseteq subset supset in notin cong simeq neq ge le approx equiv dashv perp".split(), strict=True))
OPERATORS = dict(zip("⊗×∩∪⋊⋉∑∏⊕⊖∘·⋅∧∨±∓√", "otimes times cap cup rtimes ltimes sum prod oplus ominus circ cdot cdot wedge vee pm mp sqrt".split(), strict=True))
OTHERS = dict(zip("∀∃∂∇⟨⟩∅∞…⋯", "forall exists partial nabla langle rangle varnothing infty dots cdots".split(), strict=True))
NUMBERS = {c: f"mathbb{{{name}}}" for c, name in zip("ℂℤℝℚℕ", "CZRQN", strict=True)}
COMMANDS = {c: f"\\{name} " for names in (GREEK_SMALL, GREEK_LARGE, ARROWS, RELATIONS, OPERATORS, OTHERS, NUMBERS) for c, name in names.items()} | {"−": "- "}
#: Signs that a token may hold, that alone make it none of maths, and that end the sentence and not the token.
SIGNS, DASHES, TRAIL = "()[]{}=^_+-*/\\|.,:;'!?~&<>", "–—′″", ".,;:!?"
QUIET = "…–—′″−"

_SYMBOLS = "".join(COMMANDS)
_class = lambda chars: "".join("\\" + c if c in "[]\\^-&~" else c for c in chars)
TOKEN = f"[A-Za-z0-9{_class(SIGNS)}{beyond(P.RAISED + P.LOWERED + _SYMBOLS + DASHES)}]+"
TRIGGER = f"[{_class('[]=^_')}\\\\{{}}{beyond(P.RAISED + P.LOWERED + ''.join(c for c in _SYMBOLS if c not in QUIET))}]"
#: What stands behind a token and is no part of it: marks of a sentence, and hyphens that no script sign makes a minus.
TAIL = rf"(?:[{TRAIL}]|(?<![\^_])-)+$"
_MARK = "\x01"


def latexified(token: Column) -> Column:
    """A token as maths: raised and lowered signs as scripts, symbols as commands, braces that group nothing escaped.

    A brace groups behind ``^``, ``_`` or a backslash; a closing one is what its opening one was. Escaped ``*`` and ``_`` of
    the markup are plain signs.
    """
    pieces = F.regexp_extract_all(raised_lowered(token), F.lit(r"(?s)\\.|\\$|[{}]|[^\\{}]+"), F.lit(0))
    commands = F.create_map(*[F.lit(x) for pair in COMMANDS.items() for x in pair])
    spelled = lambda piece: F.array_join(F.transform(F.split(piece, ""), lambda c: F.coalesce(F.element_at(commands, c), c)), "")

    def step(acc: Column, piece: Column) -> Column:
        groups = F.endswith(acc["last"], F.lit("^")) | F.endswith(acc["last"], F.lit("_"))
        kept = F.endswith(acc["open"], F.lit("g"))
        said = (
            F.when(piece.isin("\\*", "\\_"), F.substring(piece, 2, 1))
            .when(piece == "{", F.when(groups, piece).otherwise(F.lit("\\{")))
            .when(piece == "}", F.when(kept, piece).otherwise(F.lit("\\}")))
            .when(F.startswith(piece, F.lit("\\")), piece)
            .otherwise(spelled(piece))
        )
        pushed = F.when(piece == "\\{", "g").when(piece == "{", F.when(groups, "g").otherwise("s")).otherwise("")
        popped = F.when(piece == "}", F.expr("1")).otherwise(0)
        open_ = F.concat(F.substring(acc["open"], F.lit(1), F.greatest(F.length(acc["open"]) - popped, F.lit(0))), pushed)
        return F.struct(F.concat(acc["said"], said).alias("said"), open_.alias("open"), piece.alias("last"))

    start = F.struct(F.lit("").alias("said"), F.lit("").alias("open"), F.lit("").alias("last"))
    return strip(F.regexp_replace(F.aggregate(pieces, start, step, lambda acc: acc["said"]), r"\s+", " "))


def plain_maths(lines: DataFrame) -> DataFrame:
    """Wraps the maths tokens of prose; inside maths only raised and lowered signs change.

    Lines with an odd number of dollar signs, HTML, images, links and code stay as they are.
    """
    ctx = line_context(lines)
    core = strip(F.regexp_replace(F.col("t"), r"^[> ]+", ""))
    ctx = ctx.withColumn("fence", F.startswith(core, F.lit("```")))
    ctx = ctx.withColumn("code", F.col("fence") | (count_before(F.col("fence")) % 2 == 1))
    sign = (core == "$$") & ~F.col("code")
    ctx = ctx.withColumns({"sign": sign, "display": count_before(sign) % 2 == 1})
    markup = reduce(Column.__or__, [F.contains("line", F.lit(x)) for x in ("<div", "</div", "<img", "![", "](")])
    parts = F.when(F.contains("line", F.lit("$")), F.split("line", r"(?<!\\)\$", -1)).otherwise(F.array("line"))
    prose = ~F.col("code") & ~F.col("sign") & ~F.col("display") & ~markup & (F.size(parts) % 2 == 1)
    line = F.when(F.col("display") & ~F.col("sign") & ~F.col("code"), raised_lowered(F.col("line"))).otherwise(F.col("line"))
    # Without any of these signs no token is wrapped, and nothing is raised or lowered.
    busy = F.col("line").rlike(TRIGGER) | F.contains("line", F.lit(_MARK))
    rows = ctx.select("doc_id", "line_no", line.alias("line"), F.when(busy & prose, parts).alias("parts"))
    cut = lambda text: F.split(F.regexp_replace(F.translate(text, _MARK, "\x02"), f"({TOKEN})", f"{_MARK}$1{_MARK}"), _MARK, -1)
    rows = _once(rows, "cuts", F.transform("parts", lambda text, part: F.when(part % 2 == 1, F.array(text)).otherwise(cut(text))))
    # What a token is without its tail; gaps, which stand at even places, have none.
    rows = _once(rows, "bodies", F.transform("cuts", lambda pieces: F.transform(pieces, lambda piece, nth: F.when(nth % 2 == 1, F.regexp_replace(piece, TAIL, "")).otherwise(""))))

    def said(pieces: Column, part: Column, piece: Column, nth: Column) -> Column:
        body = F.get(F.get("bodies", part), nth)
        wrapped = (body != "") & body.rlike(TRIGGER) & ~F.contains(body, F.lit("**")) & ~F.contains(body, F.lit("%")) & ~F.startswith(body, F.lit("---"))
        # A token right at a dollar sign is left alone, be it that of maths or an escaped one in the text.
        before, behind = F.get(pieces, nth - 1), F.get(pieces, nth + 1)
        touches = F.when(before != "", F.endswith(before, F.lit("$"))).otherwise((nth == 1) & (part > 0)) | F.when(behind != "", F.startswith(behind, F.lit("$"))).otherwise(
            (nth == F.size(pieces) - 2) & (part < F.size("cuts") - 1)
        )
        return F.when(wrapped & ~touches, F.concat(F.lit("$"), latexified(body), F.lit("$"), F.substring(piece, F.length(body) + 1, F.length(piece)))).otherwise(piece)

    joined = lambda pieces, part: F.when(part % 2 == 1, raised_lowered(F.get(pieces, F.lit(0)))).otherwise(F.array_join(F.transform(pieces, lambda piece, nth: said(pieces, part, piece, nth)), ""))
    return rows.select("doc_id", "line_no", F.coalesce(F.array_join(F.transform("cuts", joined), "$"), F.col("line")).alias("line"))
