"""The gate's layers counted in one pass over whole documents, against the layers' own queries."""

import random

import pyarrow as pa
import pytest

from quirework import queries
from quirework.operators import items, one_pass, rules
from quirework.queries_repairs import _LAYERS, layers

SAID = [
    "$$", "$", "```", "`x`", "\\[", "\\]", "\\(a\\)", "\\alpha", "\\$", "> ", ">", "> > ", "**定理", "**证明**", "**例**", "**例 1.2**", "例", "例子", "证明", "注", "---", "##", "## §", " ", "    ", "1. ", "(1)", "(i)",
    "（2）", "（式 (1.2)）", "定义（", "引x理（", "见", "1.2-3", "2.1.4", "3.1-2", "12-3", "11 4", "1 . 2 . 3", "§1.2  ", "§ 3.1 x", "82.3", "2.2 abc", "## §2.3", "图", "到", "，", "、", "：", "a", "bc", "中文", "Example", "Theorem 1.2",
    "**(2)**", "{", "<div", "</div>", "→", "\\begin", "@>", "　", "\xa0", "- (a) ", "**3.**", "iv.", "x) y", "99999999999.1-2", "1.99999999999-3", "0001.02-003", "2.3.99999999999", "Ã©", "(1.2-3,", "（1.2-4）",
]
SCHEMA = "doc_id long, text string"


def texts(seed, n):
    rng = random.Random(seed)
    text = lambda: "\n".join("".join(rng.choice(SAID) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(60)))
    return [text() for _ in range(n)] + ["", "\n", None]


def rows_of(counts):
    return sorted(map(tuple, counts.select("doc_id", "layer", "rule", "severity", "n").collect()), key=str)


def own(spark, folder):
    return rows_of(rules.all_layers(**{code: _LAYERS[code](spark, folder) for code in one_pass.LAYERS}))


def test_counts_are_those_of_the_layers(spark, tmp_path):
    rows = [(i if i % 3 else 10**11 + i, text) for i, text in enumerate(texts(1, 300))]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(layers(spark, str(tmp_path), ["E", "F"]))
    assert got == own(spark, str(tmp_path)) and {r[1] for r in got} == set(one_pass.LAYERS)
    assert len({r[2] for r in got}) > 45


def test_rows_that_share_an_id(spark, tmp_path):
    """They, and rows without an id or with one that the pass can't take, are counted together, as before."""
    one, two, three, four, five = texts(2, 40)[:5]
    rows = [(1, one), (2, two), (2, None), (None, three), (-7, four), (3, five), (4, None), (5, ""), (6, "**9.9-9** a"), (6, "**9.8-8** b")]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(layers(spark, str(tmp_path), ["E", "F"]))
    assert got == own(spark, str(tmp_path)) and (6, "A", "missing", "blocks", 29) in got and (6, "A", "extra", "warns", 2) in got


def test_nothing_is_written_for_a_document_layer(spark, tmp_path, monkeypatch):
    """Neither lines nor items are cached or stored, and texts are not exchanged by document."""
    cores = spark.sparkContext.defaultParallelism
    spark.createDataFrame(list(enumerate(texts(3, 40))), SCHEMA).repartition(cores).write.parquet(f"{tmp_path}/documents.parquet")
    files, each = "spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.openCostInBytes")

    def refused(*_):
        raise AssertionError("the gate stored a table")

    for module in (queries, items):
        monkeypatch.setattr(module, "stored", refused)
    spark.conf.set(files, str(1 << 30))  # a task a file
    try:
        counts = layers(spark, str(tmp_path), ["E", "F"])
        assert counts.count() and "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(files, each)


@pytest.mark.parametrize("query", ["gate_summary", "gate_report"])
def test_queries_of_the_gate_read_counts_alone(spark, monkeypatch, query):
    """What they exchange is a row a document and rule: neither a line context nor items are made for them."""
    seen = []
    monkeypatch.setattr(queries, "line_context", lambda lines: seen.append("context"))
    monkeypatch.setattr(items, "stored", lambda rows, label: seen.append(label))
    rows = queries.QUERIES[query](spark, "/root/testdata/sf0.001")
    assert rows.count() and not seen


def test_slices_change_nothing(monkeypatch):
    said = texts(4, 120)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(said)), pa.int64()), pa.array(said, pa.string())], names=["doc_id", "text"])
    counted = lambda b: sorted(tuple(r.values()) for part in one_pass.count(b, one_pass.LAYERS) for r in part.to_pylist())
    whole = counted(batch)
    monkeypatch.setattr(one_pass, "SLICE", 200)
    assert counted(batch) == whole != []
    assert counted(batch.slice(50)) == [r for r in whole if r[0] >= 50]


def test_spaces_as_re2_reads_them():
    assert one_pass._compiled(r"[x\s]\s\S").search("x a") and not one_pass._compiled(r"a\sb").search("a\x0bb")
    assert not one_pass._compiled(r"\d").search("٣")
