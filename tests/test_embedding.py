"""Figures in summaries, against plain versions that walk over lines."""

import random
import re

import pytest

from quirework.functions import patterns as P
from quirework.operators import embedding as E
from quirework.operators.braces import texts
from quirework.plans.lines import md_lines

FIGURES = "doc_id long, fig int, page int, file string, caption string, x0 double, x1 double, anchors array<string>, anchors_proof boolean"
ENGLISH = {"定理": "Theorem", "例": "Example", "评注": "Remark"}


def plain_embedded(lines, figures):
    lines, inserts = list(lines), []
    for _, fig, page, file, caption, x0, x1, anchors, by_hand in sorted(figures, key=lambda f: (f[2], f[1])):
        if any(f'src="_extract/figure/{file}"' in ln for ln in lines):
            continue
        found = re.search(rf"(定理|例|注)\s*{P.CAPTION_NUMBER}", caption or "")
        wanted = []
        if found and "习题" not in caption:
            kind, number = found[1], re.sub(r"\s", "", found[2])
            for k in [*({"例": ["例", "示例"]}.get(kind, [kind])), ENGLISH.get(kind, kind)]:
                wanted += [f"**{k} {number}", f"**{k}{number}", f"**{number} {k}"]
        spots = []
        for hand, texts_, proof in ((0, wanted, "证明" in (caption or "")), (1, anchors or [], bool(by_hand))):
            for n, text in enumerate(texts_):
                for i, ln in enumerate(lines):
                    if text and text in ln:
                        spots.append((hand, not ln.lstrip().lstrip("> ").strip().startswith(text), n, i, proof))
        if not spots:
            continue
        *_, start, proof = min(spots)
        stop = next((i for i in range(start + 1, len(lines)) if lines[i].startswith((">", "##", "# ")) or lines[i].strip().startswith("---") or re.match(r"\s*\*\*[定理引命题推论例义公]", lines[i])), len(lines))
        quoted = proof and stop < len(lines) and lines[stop].startswith(">")
        tag = re.search(r"图\s*\d+", caption or "")
        short = re.sub("中的.*$", "示意图", re.sub("图中.*$", "示意图", re.sub(r"^图\s*\d+\s*", "", caption or "").strip()))[:40]
        width = 45.0 if x0 is None else round((x1 - x0 + 16) / 1653 * 100, 1)
        image = f'<img src="_extract/figure/{file}" alt="{(tag[0] if tag else "图") + " " + short}" width="{width}%" height="auto">'
        inserts.append((stop + quoted, [">", f"> {image}"] if quoted else ["", image, ""] if proof else ["", image]))
    for at, new in sorted(inserts, key=lambda x: x[0], reverse=True):
        lines[at:at] = new
    return lines


def corpus(seed):
    rng = random.Random(seed)
    pool = ["**定理 1.2** x", "**定理1.3**", "> **例 2.1** y", "> **证明** z", "> w", "", "text", "---", "## 节", "**Theorem 1.4** q", "see **定理 1.2** there", "> ", "**示例 2.2** u", "$$", '<img src="_extract/figure/f3.png">']
    docs = [(d, "\n".join(rng.choices(pool, k=rng.randrange(1, 25)))) for d in range(60)] + [(900, ""), (901, "**定理 1.2**")]
    captions = ["图 1 定理 1.2 的示意", "图2 例 2.1 图中曲线", "定理1.3 的证明", "例2.1的证明过程中的点", "习题 定理 1.2", None, "", "无", "图 4 定理 1 . 4"]
    figures = []
    for d, _ in docs:
        for k in range(rng.randrange(5)):
            figures.append((d, k, rng.randrange(3), f"f{k}.png", rng.choice(captions), *rng.choice([(None, None), (10.0, 500.0)]), rng.choice([None, [], ["> w", "text"], ["**定理 1.2"]]), rng.choice([None, True])))
    return docs, figures


def test_embedding_equals_plain_version_and_is_idempotent(spark):
    docs, figures = corpus(1)
    lines, table = md_lines(spark.createDataFrame(docs, "doc_id long, text string")), spark.createDataFrame(figures, FIGURES)
    once = E.embedded(lines, table)
    got = {r.doc_id: r.text for r in texts(once).collect()}
    want = {d: "\n".join(plain_embedded(t.split("\n"), [f for f in figures if f[0] == d])) for d, t in docs}
    assert got == want and sum(want[d] != t for d, t in docs) > 20
    assert {r.doc_id: r.text for r in texts(E.embedded(once, table)).collect()} == want


def plain_flex(lines):
    core = lambda ln: ln.strip().lstrip(">").lstrip()
    prefix = lambda ln: "> " if ln.lstrip().startswith("> ") else ">" if ln.lstrip().startswith(">") else ""
    image = lambda ln: core(ln).startswith("<img") and core(ln).endswith(">")
    void = lambda ln: ln.strip() in ("", ">")
    out, i = [], 0
    while i < len(lines):
        ln, j, run = lines[i], i, []
        if core(ln).startswith(E.FLEX):
            j += 1
            while j < len(lines) and core(lines[j]) != "</div>":
                run += [core(lines[j])] * image(lines[j])
                j += 1
            j += 1
        elif image(ln):
            while j < len(lines) and (image(lines[j]) or void(lines[j])):
                rest = [x for x in lines[j:] if not void(x)]
                if void(lines[j]) and rest and rest[0].strip() in ("$$", "> $$"):
                    break
                run += [core(lines[j])] * image(lines[j])
                j += 1
        else:
            out.append(ln)
            i += 1
            continue
        out += [prefix(ln) + E.FLEX, *(f"{prefix(ln)}  {x}" for x in run), prefix(ln) + "</div>"]
        i = j
    final = []
    for k, ln in enumerate(out):
        mark = ">" if prefix(ln) else ""
        if core(ln).startswith(E.FLEX) and k and not void(out[k - 1]) and core(out[k - 1]) != "</div>":
            final.append(mark)
        final.append(ln)
        if core(ln) == "</div>" and k + 1 < len(out) and not void(out[k + 1]):
            final.append(mark)
    return final


def test_side_by_side_equals_plain_version_and_is_idempotent(spark):
    rng = random.Random(3)
    pool = ["<img a>", "> <img b>", "", ">", "text", "$$", "> $$", E.FLEX, "</div>", "> q", "  <img c>"]
    docs = [(d, "\n".join(rng.choices(pool, [4, 3, 4, 2, 2, 1, 1, 1, 1, 1, 2], k=rng.randrange(1, 16)))) for d in range(150)] + [(900, ""), (901, "<img a>")]
    once = E.images_side_by_side(md_lines(spark.createDataFrame(docs, "doc_id long, text string")))
    got = {r.doc_id: r.text for r in texts(once).collect()}
    want = {d: "\n".join(plain_flex(t.split("\n"))) for d, t in docs}
    assert got == want
    tidy = {d: t for d, t in want.items() if plain_flex(t.split("\n")) == t.split("\n")}
    assert len(tidy) > 100 and {r.doc_id: r.text for r in texts(E.images_side_by_side(once)).collect() if r.doc_id in tidy} == tidy


def test_images_stay_in_their_quote(spark):
    text = "> **证明** a\n\n> <img x>\n\nplain\n\n---\n\n> **例** b\n\n\n> c\n\n**定理**\n\nd"
    out = texts(E.images_continued(md_lines(spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string")))).collect()
    assert {r.doc_id: r.text for r in out} == {1: "> **证明** a\n> \n> <img x>\n> \nplain\n\n---\n\n> **例** b\n> \n> \n> c\n\n**定理**\n\nd", 2: ""}


@pytest.mark.parametrize(("line", "caption", "fault"), [
    ("> {}", "图 1 例 2.1", None), ("{}", "图 1 例 2.1", "outside"), ("> {}", "例 2.2", "other_item"), ("{}", "定理 2.1 的证明", "outside"), ("{}", "无", None), ("{}", "定理 1.1", "other_item"),
])
def test_figures_out_of_their_block(spark, line, caption, fault):
    image = '<img src="_extract/figure/a.png">'
    docs = spark.createDataFrame([(1, f"**定理 1.1** s\n---\n> **例 2.1** t\n{line.format(image)}\n> u"), (2, image)], "doc_id long, text string")
    rows = E.out_of_block(md_lines(docs), spark.createDataFrame([(1, "a.png", caption), (1, "b.png", "例 9.9"), (3, "a.png", "例 1")], "doc_id long, file string, caption string"))
    assert [tuple(r) for r in rows.collect()] == ([(1, 4, "a.png", fault)] if fault else [])
