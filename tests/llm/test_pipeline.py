"""Each stage of the pipeline on the smallest tables, against its operator's brute-force version or its own rule."""

import random

import pytest

import corpus_pipeline
from quirework.llm import bpe, quality

from .test_decontam import brute as leaks
from .test_jaccard_join import brute as groups
from .test_substring_dedup import brute as repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijk", k=rng.randrange(2, 8)))
    lines = [" ".join(word() for _ in range(60)) for _ in range(4)]
    items = [(i, " ".join(word() for _ in range(14))) for i in range(5)]
    docs, labels = [], []
    for d in range(160):
        if d % 8 == 7:
            text = docs[-3][1]
            text = text if d % 16 == 7 else text + " tail"
        else:
            parts = [" ".join(word() for _ in range(rng.randrange(20, 90)))]
            if rng.random() < 0.3:
                parts.append(rng.choice(lines))
            if rng.random() < 0.2:
                parts[0] += " " + rng.choice(items)[1]
            text = "\n".join(parts)
        bad = d % 4 == 1
        if bad:
            text = " ".join(w + "%%%" for w in text.split())
        docs.append((d, text, "en", "s", len(text)))
        labels.append((d, int(not bad), 0))
    docs += [(900, None, None, None, None), (901, "", "en", "s", 0)]
    path = tmp_path_factory.mktemp("tables")
    for name, rows, schema in (("documents", docs, SCHEMA), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path), items


def test_stages(spark, tables):
    path, items = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = corpus_pipeline.keep(stage(spark, docs, path), "test")
        got = {r.doc_id: r for r in out.collect()}
        if k == 0:
            score = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))).collect()}
            assert set(got) == {d for d, s in score.items() if s >= quality.LEAST}
            assert all(d >= 900 or d % 4 != 1 or d % 8 == 7 for d in got)
        elif k == 1:
            assert set(got) == {d for d, (_, low, _) in groups(before).items() if low == d}
        elif k == 2:
            spans = repeats(before)
            assert spans and set(got) == {d for d, _ in before}
            for d, text in before:
                gone = sum(e - s for x, s, e, _, _ in spans if x == d)
                assert got[d].text == text if not gone else len(got[d].text) <= len(text) - gone
                assert got[d].n_chars == (None if got[d].text is None else len(got[d].text))
        elif k == 3:
            hit = leaks(before, items)
            assert set(got) == {d for d, _ in before if not hit[d][1]} and any(h[1] for h in hit.values())
        else:
            with open(corpus_pipeline.vocabulary_path(), encoding="utf-8") as f:
                own = bpe.Bpe(f.read())
            assert {d: list(r.ids) for d, r in got.items()} == {d: own.encode(t or "") for d, t in before}
        assert k == 4 or out.columns == columns
        docs = out
    assert {r.doc_id for r in corpus_pipeline.run(spark, path).select("doc_id").collect()} == set(got)


def test_odd_rows_and_empty_documents(spark, tables, tmp_path):
    """Null ids, a text of a megabyte, repeated ids, and extra columns of clashing names pass; no documents give no rows."""
    path, _ = tables
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    long = " ".join(f"word{i}x" for i in range(120_000))
    odd = spark.createDataFrame([(None, "abc def gha bcd", "en", "s", 15), (None, None, None, None, None), (5000, long, "en", "s", len(long)), (5001, "dead beef cage fade", "en", "s", 19), (5001, "dead beef cage fade", "en", "s", 19)], SCHEMA)
    wide = docs.unionByName(odd).selectExpr("*", "1 as _doc", "'k' as kept", "2 as component_id", "3 as matches")
    wide.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert len([d for d, _ in rows if d == 5000]) == 1 and len([d for d, _ in rows if d is None]) == 2
    assert dict(rows)[5000] > 120_000 and len([d for d, _ in rows if d == 5001]) in (0, 2)
    wide.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
