"""Rounds of maths edits: what a round touches, few tables between rounds, tasks of bounded size."""

import random

from quirework.operators import braces, maths
from quirework.operators.braces import edited, settled, texts
from quirework.plans.lines import line_context, md_lines

SCHEMA = "doc_id long, text string"
BITS = ["$$", "> $$", "> > $$", "$$x+y$$", "> $$x$$", "$$a", "b$$", "> b$$", "\\$\\$", "> \\$\\$", "<div>", "</div>", ">   $$", "- (i) a", "(1) b", "（2）c", "> **定理** c", "> **定义**", "> t", ">", ">x", "", " ", "x", " > > $$", "  $$ ", "# h", "$$ $$", "$$$$"]


def _documents(spark, n=250):
    rng = random.Random(3)
    return spark.createDataFrame([(k, "\n".join(rng.choices(BITS, k=rng.randrange(1, 14)))) for k in range(n)], SCHEMA)


def test_a_round_is_what_the_rules_say(spark):
    """Flags of the round stand for the rules over the whole context, and ``touched`` for lines that differ."""
    lines = md_lines(_documents(spark)).repartition(3)
    ctx = maths.prepared(line_context(lines))
    flags = {n: maths.MATHS_LINES[n]() for n in ("div_blanks", "display_needs_blank", "escaped_from_quote", "list_gap", *braces._ALONE)}
    said = {(r.doc_id, r.line_no): r for r in ctx.select("doc_id", "line_no", "line", "t", "quoted_fence", *[f.alias(n) for n, f in flags.items()]).collect()}
    assert all(sum(bool(r[n]) for r in said.values()) for n in flags)
    want, touched = {}, set()
    for (doc, _), r in sorted(said.items()):
        blank = ">" if r.display_needs_blank and r.quoted_fence else ""
        above = r.display_needs_blank or r.list_gap or (r.div_blanks and r.t.startswith("<div"))
        changes = above or (r.div_blanks and r.t == "</div>") or any(r[n] for n in ("escaped_from_quote", *braces._ALONE))
        want.setdefault(doc, []).append((r.line, bool(above) * [blank], bool(changes)))
    got = {}
    for r in edited(lines).orderBy("doc_id", "line_no").collect():
        got.setdefault(r.doc_id, []).append(r.line)
        touched |= {r.doc_id} if r.touched else set()
    own = {r.doc_id: r.text.split("\n") for r in texts(lines).collect()}
    assert touched == {d for d in own if own[d] != got[d]} and 50 < len(touched) < len(own)
    for doc, rows in want.items():
        at = 0
        for line, above, changes in rows:
            assert got[doc][at : at + len(above)] == above
            at += len(above)
            if not changes:
                assert got[doc][at] == line
                at += 1
            else:
                break  # what comes after is told by the fixed points of tests/test_braces.py


def test_settled_equals_round_after_round(spark, monkeypatch):
    lines = md_lines(_documents(spark))
    out, rounds = settled(lines, edited)
    got, told = {r.doc_id: r.text for r in texts(out).collect()}, {r.doc_id: r.rounds for r in rounds.collect()}
    one, again = settled(lines, lambda x: edited(x).drop("touched"))
    assert got == {r.doc_id: r.text for r in texts(one).collect()}
    assert told == {r.doc_id: r.rounds for r in again.collect()} and max(told.values()) >= 2
    monkeypatch.setattr(braces, "TOGETHER", 1)
    assert got == {r.doc_id: r.text for r in texts(settled(lines, edited)[0]).collect()}


def test_documents_without_an_id_settle_too(spark):
    out, rounds = settled(md_lines(spark.createDataFrame([(None, "a\n$$x+y$$\nb"), (1, "c")], SCHEMA)), edited)
    assert {r.doc_id: r.text for r in texts(out).collect()} == {None: "a\n\n$$\nx+y\n$$\nb", 1: "c"}
    assert {r.doc_id: r.rounds for r in rounds.collect()} == {None: 2, 1: 0}


def test_two_rounds_are_one_table(spark, monkeypatch):
    labels, kept = [], braces.stored
    monkeypatch.setattr(braces, "stored", lambda rows, label: labels.append(label) or kept(rows, label))
    settled(md_lines(spark.createDataFrame([(1, "a\n$$x+y$$\nb")], SCHEMA)), edited)
    assert labels == ["round", "changed"]


def test_the_format_run_is_its_stages_then_rounds(spark, monkeypatch):
    """The stages' lines are written and dealt before the rounds; lines are those of stages run one by one."""
    from quirework.operators import quotes

    rng = random.Random(5)
    bits = [*BITS, "**例** a", "> **例**", "> **证明思路**：首先a其次 b", "---", "**定义** a", "## §1", "> **例**：a **证明**：c", "# a"]
    lines = md_lines(spark.createDataFrame([(k, "\n".join(rng.choices(bits, k=rng.randrange(1, 20)))) for k in range(80)], SCHEMA))
    want = lines
    for step in quotes.format_steps(True).values():
        want = braces.stored(step(want), "stage")
    want = {r.doc_id: r.text for r in texts(settled(want, edited)[0]).collect()}
    labels, kept = [], quotes.stored
    monkeypatch.setattr(quotes, "stored", lambda rows, label: labels.append(label) or kept(rows, label))
    assert {r.doc_id: r.text for r in texts(quotes.formatted(lines, number=True)).collect()} == want
    assert labels == ["formatted"]
