"""Worked examples: a good and a bad form of each rule, and what its rewriter makes of the bad one."""

import pytest

from quirework.operators import maths, rewriters, rules
from quirework.plans.lines import line_context


def table(spark, text, doc=1):
    return spark.createDataFrame([(doc, i + 1, x) for i, x in enumerate(text.split("\n"))], "doc_id long, line_no int, line string")


def found(spark, name, text):
    find = rules.RULES[name].find if name in rules.RULES else maths.MATHS_RULES[name]
    return sorted(r.line_no for r in find(line_context(table(spark, text))).collect())


def text_of(lines):
    return "\n".join(r.line for r in lines.orderBy("line_no").collect())


CASES = [
    ("quote_continuity", "> **证明**：a\n\n> b", [2]),
    ("quote_continuity", "> **证明**：a\n\n> **例1**：b\n\n---", []),
    ("quote_continuity", "> **证明**：a\n", []),
    ("nested_quote", "> > a\n> b", [1]),
    ("same_line_proof", "> **例1.1**：a **证明**：b", [1]),
    ("example_proof_gap", "> **例**\n\n> **证明**", [1]),
    ("example_proof_gap", "> **例**\n>\n> **证明**", []),
    ("example_proof_gap", "> **例**\n---\n\n> **证明**", []),
    ("numbered_example_proof_gap", "> **例1.1-2**\n\n> **证明**", [1]),
    ("struct_in_quote", "> **定理3.1**：a\n> **定理3.66的证明思路**：b", [1]),
    ("orphan_quote", "a\n>\nb\n\n> c\n>", [2]),
    ("stmt_in_quote", "**定理1.1-1**：a\n> （1）b\n> **证明**\n> $$", [2]),
    ("unlabeled_quote", "> a\n> b\n\n> **注**：c\n> d", [1, 2]),
    ("unlabeled_quote", ">\n> a", [2]),
    ("missing_quote", "**证明**：a\n## **证明**\n{脚注", [1, 3]),
    ("missing_separator", "**定理1**\na\n**定理2**\n---\n**定理3**\n## b\n**定理4**", [1]),
    ("dash_in_item", "**定理1**：\n**(1)** a\n\n---\n\n**(2)** b", [4]),
    ("dash_in_item", "> q\n---\n**(2)** b", []),
    ("proof_after_list", "    1. a\n> **证明**\n    2. b\n\n> **证明**", [1]),
    ("separator_blanks", "a\n---\nb\n\n---\n", [2, 2]),
    ("displaymath_gt", "$$\n> a\n$$\n> b\n$$\n> c", [2]),
    ("empty_quote_runs", "> **证明**\n>\n>\n> a\n>", [2]),
    ("ordinal_gaps", "(2) a\n(3) b\n(5) c", [1, 1]),
    ("ordinal_gaps", "(i) a\n(ii) b\n(iv) c", [1]),
    ("ordinal_gaps", "(1) a\n(2) b\n\n\n\n\n(4) c", []),
    ("dash_under_heading", "## a\n\n---\nb\n---", [3]),
    ("dash_before_proof", "**定理1**\na\n---\n> **证明**\n## b\n---\n> **证明**", [3]),
    ("item_as_heading", "### 定义1.1\n## §1\n## 2\n# a", [1, 3]),
    ("mojibake", "Ã©\né", [1]),
    ("bracket_display", "\\[x\\]\n$$", [1]),
    ("escaped_display", "\\$\\$\n> \\$\\$\n$$", [1, 2]),
    ("one_line_display", "$$x$$\n> $$x$$\n$$", [1, 2]),
    ("attached_display", "$$\\begin{x}\n\\end{x}$$\n$$\n> $$a", [1, 2, 4]),
    ("div_blanks", "a\n<div>\nb\n</div>\nc", [2, 4]),
    ("odd_dollars", "a $x$ b $\n\\$", [0]),
    ("maths_in_fence", "```\na → b\n```\n```\ncode\n```", [1]),
    ("raw_arrows", "a → b\n$a → b$\n```\n→\n```", [1]),
    ("naked_commands", "a \\mathrm x\n$\\mathrm x$\n$$\n\\mathrm\n$$", [1]),
    ("swallowed_prefix", "$- \\mu$ a\n$x$ b", [1]),
    ("equation_note", "$$\n（式 (1.2)）\n$$\n\n（式 (1.3)）\na\n（式 (1.4)）", [2, 5]),
    ("escaped_from_quote", "> a\n\n$$\nx\n$$", [3]),
    ("list_gap", "- (i) a\n(2) b\n- (i) c\n\n(3) d", [2]),
    ("unclosed_display", "$$\na\n$$\n$$\nb", [4]),
]


@pytest.mark.parametrize(("name", "text", "lines"), CASES)
def test_finds(spark, name, text, lines):
    assert found(spark, name, text) == lines


PAIRS = [
    ("strip_unlabeled", "a\n> quote\nb", "a\nquote\nb"),
    ("unwrap_struct", "> **定理1.1**：a\n> b\n>\n> c\n>", "**定理1.1**：a\n> b\n>\n> c\n"),
    ("unwrap_statement", "**定理1.1-1**：a\n> （1）b\n> c\n> **证明**\n> d", "**定理1.1-1**：a\n**(1)**b\nc\n> **证明**\n> d"),
    ("add_quote", "**证明**：a\nb", "> **证明**：a\nb"),
    ("quote_blanks", "> **证明**：a\n\n> b\n\n> **例2**", "> **证明**：a\n> \n> b\n\n> **例2**"),
    ("add_separators", "**定理1**\na\n**定理2**", "**定理1**\na\n---\n**定理2**"),
    ("drop_dash_in_item", "**定理1**\n**(1)** a\n---\n\n**(2)** b", "**定理1**\n**(1)** a\n**(2)** b"),
    ("list_blank", "    1. a\n> **证明**", "    1. a\n\n> **证明**"),
    ("separator_blanks_added", "a\n---\n---\nb", "a\n\n---\n\n---\n\nb"),
    ("display_unquoted", "$$\n>  a\n$$\n> b", "$$\n a\n$$\n> b"),
    ("single_empty_quote", "> **证明**\n>\n>\n>\n> a", "> **证明**\n>\n> a"),
    ("heading_separators", "## a\n---\n\n---\nb\n\n\n\nc", "## a\n\nb\n\nc"),
    ("display_without_blanks", "$$\n\na\n\n$$\n\nb", "$$\na\n$$\n\nb"),
    ("split_display", "$$ x $$\n> $$y$$", "$$\nx\n$$\n> $$\n> y\n> $$"),
    ("split_example_proof", "> **例1**：a **证明**：b", "> **例1**：a\n>\n> **证明**：b"),
    ("wrapping_display", "$$\n## a\n$$\n$$\nx+y\n$$\n$$\n中文\n$$", "## a\n$$\nx+y\n$$\n中文"),
    ("wrapping_display", "$$\n\\begin{x} $a$\n$$\n$$\nb", "$$\n\\begin{x} $a$\n$$\n$$\nb"),
    ("display_dedented", "  $$\n    x\n y\n  $$\n  z", "$$\n  x\ny\n$$\n  z"),
    ("example_proof_merged", "> **例1.1-1**\n\n$$\n> b\n> **证明**\n\nc", "> **例1.1-1**\n> $$\n> b\n> **证明**\n\nc"),
    ("examples_wrapped", "a\n**例1.1-1** b\n\nc\n\n---\nd", "a\n> **例1.1-1** b\n>\n> c\n\n---\nd"),
    ("proof_steps", "> **证明思路**：首先 a。其次 b\n> **证明思路**：先 a", "> **证明思路**：\n> 1. 首先 a。\n> 2. 其次 b\n> **证明思路**：先 a"),
    ("images_quoted", "> **例1**\n<img src=a>\n---\n![b](b)", "> **例1**\n> <img src=a>\n---\n![b](b)"),
    ("broken_commands", "a $$4pt] b", "a \\\\[4pt] b"),
]


@pytest.mark.parametrize(("name", "bad", "good"), PAIRS)
def test_rewrites(spark, name, bad, good):
    rewrite = rewriters.REWRITERS[name]
    once = rewrite(table(spark, bad))
    assert text_of(once) == good
    assert text_of(rewrite(once)) == good


def test_chain_leaves_nothing_that_it_repairs(spark):
    text = "**定理1.1-1**：a\n> （1）b\n**定理1.1-2**：c\n> **证明**：d\n\n> e\n---\nf\n    1. g\n> **证明**：h"
    lines = rewriters.repaired(table(spark, text))
    ctx = line_context(lines)
    for name in ("quote_continuity", "stmt_in_quote", "missing_separator", "dash_in_item", "proof_after_list", "separator_blanks"):
        assert rules.RULES[name].find(ctx).count() == 0, name


def test_registry_refuses_a_second_rule_of_a_name():
    with pytest.raises(ValueError, match="nested_quote"):
        rules.rule("X")(rules.RULES["nested_quote"].find)


def test_disabled_codes_are_not_run(spark):
    ctx = line_context(table(spark, "> > a\na\n---"))
    assert {r.code for r in rules.findings(ctx, ["L"]).collect()} == {"G", "H"}
