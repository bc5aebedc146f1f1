"""Stores are written as files, read back and compared with what was written; streams run over arriving files."""

import json

import pytest
from pyspark.sql import functions as F

from quirework.operators import scans
from quirework.sources import stores
from quirework.streaming import incremental


@pytest.fixture
def book(tmp_path):
    folder = tmp_path / "book_a"
    folder.mkdir()
    flat = lambda x, y: [x, y, x + 9, y, x + 9, y + 5, x, y + 5]
    points = lambda x, y: [[x, y], [x + 9, y], [x + 9, y + 5], [x, y + 5]]
    pages = {
        1: {"page": 1, "formulas": [{"bbox": [1, 2, 3, 4], "cls": 0, "conf": 0.5, "latex": "x^2"}], "text": [{"poly": flat(5, 40), "text": " second ", "score": 0.9}, {"poly": points(5, 10), "text": "first", "score": None}, {"poly": flat(1, 40), "text": "third", "score": 1.0}, {"text": "  ", "score": 0.1}]},
        2: {"page": 2, "formulas": [], "text": [{"text": "no place", "score": 0.2}, {"poly": points(0, -3), "text": "above", "score": 0.2}]},
    }
    for n, page in pages.items():
        (folder / f"page_{n:03d}.json").write_text(json.dumps(page), "utf-8")
    (folder / "page_003.json").write_text("{ not json", "utf-8")
    return tmp_path


def test_pages_and_blocks(spark, book):
    scanned = stores.pages(spark, f"{book}/book_a/page_*.json")
    assert {(r.book, r.page) for r in scanned.collect()} == {("book_a", 1), ("book_a", 2), ("book_a", 3)}
    got = [(r.page, r.block, r.text, r.x, r.y) for r in stores.blocks(scanned).orderBy("page", "block").collect()]
    assert got == [(1, 1, "first", 5.0, 10.0), (1, 2, "second", 5.0, 40.0), (1, 3, "third", 1.0, 40.0), (2, 1, "above", 0.0, -3.0), (2, 2, "no place", 0.0, 0.0)]
    last = [r.text for r in stores.blocks(scanned, 1e9).where("page = 2").orderBy("block").collect()]
    assert last == ["above", "no place"]
    view = {r.page: (r.n_formulas, r.n_blocks, r.text, r.formulas) for r in scans.page_view(scanned).collect()}
    assert view[1] == (1, 4, "second\nfirst\nthird", ["x^2"]) and view[3][:3] == (0, 0, "")
    dump = {r.page: r.text for r in scans.raw_dump(stores.blocks(scanned)).collect()}
    assert dump[1] == "\n===== PAGE 1 =====\n\nfirst\nsecond\nthird\n"


def test_pages_are_written_and_reread(spark, book, tmp_path):
    scanned = stores.pages(spark, f"{book}/book_a/page_*.json").withColumn("text", F.transform("text", lambda b: F.struct(b["text"].alias("text"), b["score"].alias("score"))))
    stores.write_pages(scanned, f"{tmp_path}/out")
    stores.write_pages(scanned, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.book, r.page, len(r.text or [])) for r in back.collect()) == [("book_a", 1, 4), ("book_a", 2, 2), ("book_a", 3, 0)]


@pytest.mark.parametrize("shape", ["map", "chapters", "list"])
def test_chapter_map(spark, tmp_path, shape):
    rows = [{"num": 1, "start_page": 3, "end_page": 9}, {"ch": 2, "pdf_start": 10, "pdf_end": 20, "scheme": "two-level"}, {"num": "x", "start": 1, "end": 2}]
    whole = {"map": {"1": rows[0], "2": rows[1], "x": rows[2]}, "chapters": {"chapters": rows}, "list": rows}[shape]
    (tmp_path / "chapter_map.json").write_text(json.dumps(whole), "utf-8")
    got = sorted((r.ch, r.start, r.end, r.scheme) for r in stores.chapter_map(spark, f"{tmp_path}/chapter_map.json").collect())
    assert got == [(1, 3, 9, "three-level"), (2, 10, 20, "two-level")]


def test_ignore_lists(spark, tmp_path):
    (tmp_path / "ignore_ch1.json").write_text('["1.2.3", "1.2-4"]', "utf-8")
    (tmp_path / "ignore_ch12.json").write_text('{"12.1.1": "noise", "定理3.4": ""}', "utf-8")
    (tmp_path / "ignore_ch3.json").write_text("broken", "utf-8")
    (tmp_path / "ignore_fig_ch2.json").write_text('[" 2. 1 ", "2.3"]', "utf-8")
    got = {(r.ch, r.key, r.reason) for r in stores.ignored_keys(spark, f"{tmp_path}/ignore_ch*.json").collect()}
    assert got == {(1, "1.2-3", None), (1, "1.2-4", None), (12, "12.1-1", "noise"), (12, "定理3.4", "")}
    assert {(r.ch, r.label) for r in stores.ignored_figures(spark, f"{tmp_path}/ignore_fig_ch*.json").collect()} == {(2, "2.1"), (2, "2.3")}


def test_figure_stores(spark, tmp_path):
    (tmp_path / "figure_manual_ch4.json").write_text('{"4.1": {"page": 7, "bbox": [1, 2, 3, 4], "rotate": 90, "caption": "c"}, "4.2": {"page": 8}}', "utf-8")
    (tmp_path / "figure_embed_overrides.json").write_text('{"a.png": {"anchors": ["x", "y"], "is_proof": true}, "b.png": {}}', "utf-8")
    (tmp_path / "figure_index.json").write_text('[{"chapter": 1, "page": 2, "fig_idx": 0, "label": "1.1", "file": "f.png", "source": "detect"}, {"chapter": 1, "page": 3, "fig_idx": 0, "file": "g.png", "source": "manual"}]', "utf-8")
    (tmp_path / "empty.json").write_text("[]", "utf-8")
    manual = {(r.ch, r.label, r.page, tuple(r.bbox or ()), r.rotate, r.caption) for r in stores.manual_figures(spark, f"{tmp_path}/figure_manual_ch*.json").collect()}
    assert manual == {(4, "4.1", 7, (1, 2, 3, 4), 90, "c"), (4, "4.2", 8, (), None, None)}
    assert {(r.file, tuple(r.anchors), r.is_proof) for r in stores.embed_overrides(spark, f"{tmp_path}/figure_embed_overrides.json").collect()} == {("a.png", ("x", "y"), True), ("b.png", (), False)}
    index = stores.figure_rows(spark, f"{tmp_path}/figure_index.json")
    assert sorted((r.page, r.label, r.source) for r in index.collect()) == [(2, "1.1", "detect"), (3, None, "manual")]
    assert stores.figure_rows(spark, f"{tmp_path}/absent.json") is None
    assert stores.figure_rows(spark, f"{tmp_path}/empty.json").count() == 0
    rows = index.withColumnRenamed("chapter", "ch").select("ch", "page", "fig_idx", "label", "file", "source")
    stores.write_figures(rows, f"{tmp_path}/store")
    stores.write_figures(rows.withColumn("ch", F.lit(2)), f"{tmp_path}/store")
    stores.write_figures(rows.where("page = 2"), f"{tmp_path}/store")
    back = spark.read.schema("page int, fig_idx int, label string, file string, source string, ch int").json(f"{tmp_path}/store")
    assert sorted((r.ch, r.page) for r in back.collect()) == [(1, 2), (2, 2), (2, 3)]


def test_markdown_files(spark, tmp_path):
    for name, text in {"第3章_a.md": "a\n\nb", "Chapter12_x.md": "c\n", "第3章_a_1.md": "d"}.items():
        (tmp_path / name).write_text(text, "utf-8")
    files = stores.markdown(spark, f"{tmp_path}/*.md").withColumn("ch", stores.chapter_of("file"))
    assert {(r.file, r.text, r.ch) for r in files.collect()} == {("第3章_a.md", "a\n\nb", 3), ("Chapter12_x.md", "c\n", 12), ("第3章_a_1.md", "d", None)}
    from quirework.plans.lines import md_lines

    stores.write_lines(md_lines(files.select(F.col("file").alias("doc_id"), "text")), f"{tmp_path}/out", 4)
    assert {(r.doc_id, r.text) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {("第3章_a.md", "a\n\nb\n"), ("Chapter12_x.md", "c\n"), ("第3章_a_1.md", "d\n")}


def test_stream_resumes_and_repeats_nothing(spark, tmp_path):
    """Pages arrive in two lots; each run takes what is new, in batches of two files, and a batch run again replaces itself."""
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    sizes = []
    write = incremental.append_once(out)

    def batch(rows, number):
        sizes.append(rows.select("page").distinct().count())
        write(rows, number)

    lots = ((1, 2, 3), (5, 6))
    for lot in lots:
        for page in lot:
            spark.createDataFrame([(1, page)], "book int, page int").coalesce(1).write.mode("append").parquet(source)
        stream = incremental.arriving(spark, source, "book int, page int", files=2)
        incremental.run_available(stream, batch, f"{tmp_path}/checkpoint")
    assert sorted(r.page for r in spark.read.parquet(out).select("page").collect()) == [1, 2, 3, 5, 6]
    assert max(sizes) <= 2 and sum(sizes) == 5
    write(spark.createDataFrame([(1, 5), (1, 6)], "book int, page int"), len(sizes) - 1)
    assert spark.read.parquet(out).count() == 5
    done = spark.read.parquet(out).select("book", "page")
    chapters = spark.createDataFrame([(1, 1, 1, 3), (1, 2, 4, 6), (1, 3, 7, 9)], "book int, ch int, start int, end int")
    assert [r.ch for r in incremental.ready(chapters, done).collect()] == [1]
    assert sorted(r.ch for r in incremental.progressed(chapters, done).collect()) == [1, 2]
