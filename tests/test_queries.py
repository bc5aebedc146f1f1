"""Every query with a DuckDB twin against that twin, at the smallest size."""

import re
from collections import Counter

import duckdb
import pandas as pd
import pytest

from quirework.functions import patterns as P
from quirework.operators import repairs, rewriters
from quirework.operators.braces import edited, settled
from quirework.plans.markup import BRACES, FIGURED, LAYOUT, REPAIRS, SCANS, STRUCTURE
from quirework.queries import _OF_LAYOUT, ORACLES, QUERIES, lines_of
from quirework.queries_repairs import _formulas

from .test_braces import walked
from .test_checks import plain_drift
from .test_embedding import plain_flex
from .test_plain_maths import plain as plain_maths
from .test_quotes import plain_leaks, plain_separators, plain_stage

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(frame):
    def text(x):
        if x is None or x is pd.NA or x != x:
            return "~"
        return repr(round(x, 6)) if isinstance(x, float) and x != int(x) else str(int(x)) if isinstance(x, float) else str(x)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(text, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_twin(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    spark.catalog.clearCache()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(_OF_LAYOUT))
def test_layout_rules_find_something(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def lines(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.doc_id, {})[r.line_no] = r.line
    return {d: [rows[k] for k in sorted(rows)] for d, rows in out.items()}


@pytest.mark.parametrize(("name", "table", "repair"), [("fix_chain_counts", STRUCTURE, rewriters.repaired), ("maths_chain_counts", REPAIRS, repairs.maths_repaired)])
def test_chain_counts_equal_plain_differences(spark, name, table, repair):
    """A chain's steps have twins of their own; its counts are those of the two texts as bags of lines."""
    source = lines_of(spark, SF, table)
    old, new = lines(source), lines(repair(source))
    want = {}
    for doc in old.keys() | new.keys():
        a, b = Counter(old.get(doc, [])), Counter(new.get(doc, []))
        want[doc] = (sum((a - b).values()), sum((b - a).values()))
    assert {r.doc_id: (r.removed, r.added) for r in QUERIES[name](spark, SF).collect()} == want and any(a for a, _ in want.values())


def test_proof_steps_equal_plain_version(spark):
    """Steps begin at a step word behind a break, or at a weak one behind a strong break."""
    head = re.compile(r"^>\s+\*\*证明(思路|梗概|概要)\*\*[:：]\s*(.*)$")
    mark = re.compile(rf"(?:(?<=^)|(?<=[:：；。\s]))(?:{P.STEP_WORDS})|(?:(?<=^)|(?<=[:：；。]))(?:{P.WEAK_STEP_WORDS})")
    want = {}
    for doc, text in lines(lines_of(spark, SF, LAYOUT)).items():
        out = []
        for line in text:
            found = head.match(line)
            starts = [m.start() for m in mark.finditer(found[2])] if found else []
            if len(starts) < 2:
                out.append(line)
                continue
            parts = [found[2][a:b] for a, b in zip([0, *starts] if starts[0] else starts, [*starts[1:], None] if not starts[0] else [*starts, None], strict=True)]
            out += [f"> **证明{found[1]}**：", *(f"> {i}. {p.strip()}" for i, p in enumerate([p for p in parts if p.strip()], 1))]
        want[doc] = out
    assert lines(QUERIES["fix_proof_steps"](spark, SF)) == want


def test_report_has_one_row_a_document_with_findings(spark):
    rows = QUERIES["gate_report"](spark, SF).collect()
    assert len({r.doc_id for r in rows}) == len(rows) and all(("FAIL" not in r.text) == r.passed for r in rows)


#: Queries without a twin: the lines that they rewrite, and a plain version over a document's lines.
PLAIN = {
    "fix_braces": (BRACES, lambda ls: walked("\n".join(ls)).split("\n")),
    "fix_plain_maths": (SCANS, plain_maths),
    "fix_quote_stage": (STRUCTURE, plain_stage),
    "fix_leaked_quotes": (STRUCTURE, plain_leaks),
    "fix_separators_between": (STRUCTURE, plain_separators),
    "fix_images_side_by_side": (FIGURED, plain_flex),
}


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_rewriter_without_twin_equals_plain_version(spark, name):
    table, plain = PLAIN[name]
    want = {doc: plain(text) for doc, text in lines(lines_of(spark, SF, table)).items()}
    got = lines(QUERIES[name](spark, SF))
    assert {d: ls for d, ls in want.items() if got.get(d, []) != ls} == {}


def test_formula_drift_equals_plain_version(spark):
    frames = [_formulas(spark, SF, summary) for summary in (True, False)]
    got = {(r.doc_id, r.id, r.source_id, r.missing, r.extra) for r in QUERIES["formula_drift"](spark, SF).collect()}
    by_doc = [{}, {}]
    for k, frame in enumerate(frames):
        for r in frame.collect():
            by_doc[k].setdefault(r.doc_id, []).append(tuple(r))
    some = sorted(by_doc[0], key=lambda d: len(by_doc[0][d]))[:150]  # a plain version looks at all pairs of a document
    want = {(d, i, j, " ".join(m), " ".join(e)) for doc in some for d, i, j, m, e in plain_drift(by_doc[0][doc], by_doc[1].get(doc, []))}
    assert {g for g in got if g[0] in set(some)} == want != set()


def test_fixed_points_stay(spark):
    """Lines that the maths edits have settled, and the whole format run's, change no more; the fired steps are those of the chain."""
    for name in ("fix_maths_fixpoint", "fix_formatted"):
        assert {r.rounds for r in settled(QUERIES[name](spark, SF), edited)[1].collect()} == {0}
    fired_ = {r.step: r.documents for r in QUERIES["maths_chain_fired"](spark, SF).collect()}
    assert fired_ and set(fired_) <= set(repairs.MATHS_STEPS)


def test_every_query_is_tested():
    elsewhere = {"fix_chain_counts", "maths_chain_counts", "fix_proof_steps", "greedy_assignment", "formula_drift", "fix_maths_fixpoint", "fix_formatted", "maths_chain_fired"}
    assert set(QUERIES) - set(ORACLES) == elsewhere | set(PLAIN)
