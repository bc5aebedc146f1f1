"""Plain-text maths against a plain version that walks over characters."""

import random
import re

from pyspark.sql import functions as F

from quirework.functions import patterns as P
from quirework.functions.text import beyond
from quirework.operators import plain_maths as M
from quirework.operators.braces import texts
from quirework.plans.lines import md_lines

LETTERS = dict(zip(P.RAISED, P.RAISED_AS, strict=True)), dict(zip(P.LOWERED, P.LOWERED_AS, strict=True))
PARTS = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") | set(M.SIGNS) | set(P.RAISED) | set(P.LOWERED) | set(M.COMMANDS) | set(M.DASHES)
MARKS = (set("[]=^_\\{}") | set(P.RAISED) | set(P.LOWERED) | set(M.COMMANDS)) - set(M.QUIET)


def scripts(text):
    for letters, mark in zip(LETTERS, "^_", strict=True):
        text = re.sub(f"[{''.join(letters)}]+", lambda m: mark + ("{%s}" if len(m[0]) > 1 else "%s") % "".join(letters[c] for c in m[0]), text)  # noqa: B023
    return text


def latex(token):
    text, out, groups, k = scripts(token), "", [], 0
    while k < len(text):
        c, two = text[k], text[k : k + 2]
        if c == "\\":
            out += two[1] if two[1:] in ("*", "_") else two
            groups += [True] * (two == "\\{")
            k += len(two)
            continue
        if c == "{":
            groups.append(k > 0 and text[k - 1] in "^_")
            c = c if groups[-1] else "\\{"
        elif c == "}":
            c = c if groups and groups.pop() else "\\}"
        out += M.COMMANDS.get(c, c)
        k += 1
    return re.sub(r"\s+", " ", out).strip()


def prose(text, left, right):
    out, k = "", 0
    while k < len(text):
        end = k
        while end < len(text) and text[end] in PARTS:
            end += 1
        if end == k:
            out, k = out + text[k], k + 1
            continue
        token = text[k:end]
        while token and (token[-1] in M.TRAIL or (token[-1] == "-" and token[-2:-1] not in ("^", "_"))):
            token = token[:-1]
        before, behind = text[k - 1] if k else left, text[end] if end < len(text) else right
        fine = token and set(token) & MARKS and "**" not in token and not token.startswith("---") and "$" not in (before, behind)
        out, k = out + (f"${latex(token)}$" + text[k + len(token) : end] if fine else text[k:end]), end
    return out


def plain(lines):
    out, code, display = [], False, False
    for line in lines:
        core = line.strip().lstrip("> ").strip()
        if core.startswith("```"):
            code = not code
        elif code:
            pass
        elif core == "$$":
            display = not display
        elif display:
            line = scripts(line)
        elif not re.search(r"</?div|<img|!\[|\]\(", line):
            parts = re.split(r"(?<!\\)\$", line)
            if len(parts) % 2:
                line = "$".join(scripts(p) if k % 2 else prose(p, "$" if k else "", "$" if k < len(parts) - 1 else "") for k, p in enumerate(parts))
        out.append(line)
    return out


def test_equals_plain_walk(spark):
    rng = random.Random(5)
    bits = [*"xy²³ⁿ₁₂αφΓ→∈∅ℝ…−–", "^{2}", "_{", "{", "}", "\\{", "\\}", "\\*", "\\_", "\\alpha", "\\", "$", "\\$", " ", " ", " ", "**", "---", "-", "^-", "=", ".", ",", "中文", "%", "[a]", "(b)", "|"]
    lines = ["```", "> ```", "$$", "> $$", "<div>", "![a](b) x²", "", "> x² y", "a_1 = b"]
    docs = [(d, "\n".join(rng.choice(lines) if rng.random() < 0.2 else "".join(rng.choices(bits, k=rng.randrange(14))) for _ in range(rng.randrange(1, 9)))) for d in range(200)]
    docs += [(900, ""), (901, "x² ∈ ℝⁿ, {a} and f_{i}(x₁)."), (902, "a " + "x²" * 5000)]
    got = {r.doc_id: r.text for r in texts(M.plain_maths(md_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)))).collect()}
    wrong = {d: (t, got[d], want) for d, t in docs if got[d] != (want := "\n".join(plain(t.split("\n"))))}
    assert not wrong, (len(wrong), next(iter(wrong.values())))
    assert got[901] == "$x^2$ $\\in$ $\\mathbb{R} ^n$, $\\{a\\}$ and $f_{i}(x_1)$."


def test_tokens_stay_in_the_row_of_their_line(spark):
    """Each token was a row that went through windows, groups and a join."""
    docs = spark.createDataFrame([(1, "a x² $y$ z_1\n\x01 b")], "doc_id long, text string")
    made = M.plain_maths(md_lines(docs))
    assert [r.line for r in made.orderBy("line_no").collect()] == ["a $x^2$ $y$ $z_1$", "\x02 b"]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and plan.count("Window") <= 4


def test_signs_beyond_ascii_are_these_alone(spark):
    chars = spark.range(1, 0x10000).where("id not between 55296 and 57343").select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    for signs in (P.RAISED, P.LOWERED, M._SYMBOLS):
        assert {r.c for r in chars.where(F.col("c").rlike(f"^{beyond(signs)}$")).collect()} == set(signs)
