import hashlib
import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quirework.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as f:
    OWN = bpe.Bpe(f.read())


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=200))
def test_any_text_as_the_library_does(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


def test_special_tokens_and_long_runs():
    rng = random.Random(6)
    texts = ["<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>", "a<|endoftext", " " * 50, "x" * 5000, "".join(rng.choices("abcdefgh", k=3000)), "don't  stop\n\n \t", " 　x", "1234567", "é" * 300]
    for text in texts:
        assert OWN.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_cut_bytes_decode_as_the_library_does():
    ids = LIBRARY.encode("né日本", add_special_tokens=False).ids
    for lo in range(len(ids)):
        for hi in range(lo + 1, len(ids) + 1):
            assert OWN.decode(ids[lo:hi]) == LIBRARY.decode(ids[lo:hi], skip_special_tokens=False)


def test_table(spark):
    rows = [(1, "one two"), (2, None), (3, ""), (None, "x"), (1, "one two"), (4, "long " * 40_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids")
    got = bpe.decode(bpe.encode(frame, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.text, list(r.ids)) for r in got) == sorted((str(d), t or "", LIBRARY.encode(t or "", add_special_tokens=False).ids) for d, t in rows)
    both = bpe.round_trip(frame.repartition(3), PATH).collect()
    assert sorted((str(r.doc_id), r.text, list(r.ids)) for r in both) == sorted((str(r.doc_id), r.text, list(r.ids)) for r in got)
    assert bpe.encode(frame.limit(0), PATH).count() == bpe.round_trip(frame.limit(0), PATH).count() == 0


def test_forgetting_pieces_changes_nothing(monkeypatch):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdeé", k=rng.randrange(1, 9))) for _ in range(50)) for _ in range(30)]
    monkeypatch.setattr(bpe, "PIECES_KEPT", 7)
    ids, ends = OWN.encode_all(texts)
    assert OWN.decode_all(ids, ends) == texts
    for text, lo, hi in zip(texts, [0, *ends[:-1]], ends, strict=True):
        assert ids[lo:hi].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_query_digests(spark):
    from quirework.llm.queries import op5_bpe

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op5_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    for doc, text in docs:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert got[doc] == (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False)))
