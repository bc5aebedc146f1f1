"""The formatting stages, against plain versions that build their result line by line."""

import random
import re

from quirework.operators import quotes as Q
from quirework.operators.braces import texts
from quirework.plans.lines import md_lines

SCHEMA = "doc_id long, text string"
POOL = [
    "**定理 1.1**：a", "**定义**（b）: c", "> **例 1.2**：d", "> > **证明** e", "**证明思路**：f", "> **证明概要**：g", "**定理**：h **证明梗概**：i", "text **证明思路** j", "   **证明思路** k",
    "## 节", "# 章", "---", " --- ", "", "", "", " ", "> l", ">", "> ", "plain", "$$", "**粗**", "> **Theorem 2.1** m", "**断言** n", "## **证明思路**", "> **注记**x", "> **定理组** y",
]


def corpus(seed, n=250):
    rng = random.Random(seed)
    return [(d, "\n".join(rng.choices(POOL, k=rng.randrange(1, 14)))) for d in range(n)] + [(9000, ""), (9001, "---"), (9002, "**定理**：x\n\n"), (9003, "**定理**：x\n\n---\n\n---\n\n**定理**：y")]


def block(line):
    return re.match(r"\*\*[^*]+\*\*.*?[:：]", line)


def quoted(out):
    return bool(out) and out[-1].lstrip().startswith(">")


def drop_blanks(out):
    while out and not out[-1].strip():
        out.pop()


def plain_stage(lines):
    out, inside = [], False

    def start(line):
        nonlocal inside
        if inside:
            drop_blanks(out)
            if out and out[-1].strip() == "---":
                out.pop()
            drop_blanks(out)
            out.extend(["---", ""] if quoted(out) else ["", "---", ""])
        out.append(line)

    def close():
        drop_blanks(out)
        if out and out[-1].strip() != "---":
            out.extend(["---"] if quoted(out) else ["", "---"])

    for line in lines:
        if re.match(r">\s+>\s+\*\*(?:证明|证|例|证明思路|证明梗概|证明概要|定理|引理|推论|命题|定义)(?!\w)", line):
            line = re.sub(r"^>\s+>\s+", "> ", line)
        found = re.search(Q.OUTLINE, line)
        if found and line.startswith("> "):
            out.append(line)
        elif found:
            lead = line[: found.start()].rstrip()
            if lead.strip() and block(lead):
                start(lead)
            elif lead.strip():
                out.append(lead)
            out.append("> " + line[found.start() :])
        elif re.match(r"#{2,6}\s", line):
            if inside:
                close()
            out.append(line)
            inside = False
            continue
        elif block(line):
            start(line)
        else:
            out.append(line)
            continue
        inside = True
    if inside:
        close()
    return out


def plain_leaks(lines):
    out, inside = [], False
    for line in lines:
        if re.match(Q.QUOTED_ITEM.replace(Q.WORD_END, r"(?!\w)"), line):
            out += ["---", ""] * inside + [line]
            inside = True
        elif re.match(Q.TOP_ITEM, line):
            while out and out[-1].rstrip() == ">":
                out.pop()
            out.append(line)
            inside = False
        elif not inside or line.strip() == "---" or re.match(r"#{2,6}\s", line):
            out.append(line)
            inside = False
        elif not line.strip():
            out += ["> "] * (out[-1].strip() != ">")
        else:
            out.append(line if line.startswith(">") else "> " + line)
    return out


def plain_separators(lines):
    items = [i for i, ln in enumerate(lines) if re.match(r"\*\*(?:定义|定理|引理|推论|命题|断言|公理|Definition|Theorem|Lemma|Corollary|Proposition|Axiom)|> \*\*(?:例|Example)", ln)]
    parts, at = [], 0
    for i, j in zip(items, items[1:], strict=False):
        between = lines[i + 1 : j]
        if j - i > Q.NEAR or any(ln.strip() == "---" or re.match(r"#{2,6}\s", ln) for ln in between):
            continue
        end = j
        while end > i + 1 and not lines[end - 1].strip():
            end -= 1
        parts += lines[at : i + 1] + [ln for ln in lines[i + 1 : end] if ln.strip()] + ["", "---", ""] + lines[end:j]
        at = j
    return parts + lines[at:]


def both(spark, seed, step, plain):
    docs = corpus(seed)
    got = {r.doc_id: r.text for r in texts(step(md_lines(spark.createDataFrame(docs, SCHEMA).repartition(3)))).collect()}
    want = {d: "\n".join(plain(t.split("\n"))) for d, t in docs}
    wrong = {d: (dict(docs)[d], got.get(d), want[d]) for d in want if want[d] != got.get(d, "")}
    assert not wrong, (len(wrong), next(iter(wrong.values())))


def test_quote_stage(spark):
    both(spark, 1, Q.quote_stage, plain_stage)


def test_leaked_quotes(spark):
    both(spark, 2, Q.leaked_quotes, plain_leaks)


def test_separators_between(spark):
    both(spark, 3, Q.separators_between, plain_separators)


def test_format_run_settles(spark):
    docs = [(1, "> **例1.2-3** a\n\nb\n> **证明思路**：c"), (2, "**定理 1**：x **证明思路**：y\n## 节\n\n---\n\n**定义**：z\n$$q$$"), (3, "")]
    out = Q.formatted(md_lines(spark.createDataFrame(docs, SCHEMA)))
    got = {r.doc_id: r.text for r in texts(out).collect()}
    assert got[1] == "> **例1.2-3** a\n> b\n> **证明思路**：c\n---" and got[3] == ""
    assert got[2].startswith("**定理 1**：x\n> **证明思路**：y\n---\n## 节\n") and "$$\nq\n$$" in got[2]
