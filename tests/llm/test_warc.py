import base64
import hashlib
from urllib.parse import unquote

import pytest

from quirework.llm import warc

SCHEMA = "page_id long, url string, html string"
ROWS = [(3, "http://a/é?x=1 2", "same"), (1, "http://b", "same"), (2, None, "other é"), (5, "u", None), (4, "u", ""), (9, "u", "big" * 500_000), (7, "u", "big" * 500_000), (8, "u", "big" * 400_000), (None, "u", "same")]


def expected(rows, least=0):
    rows = [(p, (h or "").encode()) for p, _, h in rows if p is not None]
    out = {}
    for page, body in rows:
        first = min(p for p, b in rows if b == body)
        kind = "revisit" if len(body) >= least and first < page else "response"
        out[page] = (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), kind, first if kind == "revisit" else None)
    return out


def got(chunks):
    rows = warc.read_table(chunks).select(warc.page_of("record_id").alias("page"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("first")).collect()
    return {r.page: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumn("record", warc.F.lit("clash")).repartition(3)
    assert got(warc.chunk_table(pages, least)) == expected(ROWS, least)


def test_chunks_are_a_warc_file(spark):
    chunks = warc.chunk_table(spark.createDataFrame(ROWS, SCHEMA)).orderBy("record", "chunk").collect()
    data = b"".join(bytes(r.data) for r in chunks)
    assert max(len(r.data) for r in chunks) <= warc.CHUNK + 1000
    at, kinds = 0, []
    while at < len(data):  # by the format alone
        head = data[at : data.index(b"\r\n\r\n", at)].decode()
        fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
        at += len(head.encode()) + 4 + int(fields["Content-Length"])
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4
        kinds.append(fields["WARC-Type"])
    assert sorted(kinds) == sorted(["response"] * 6 + ["revisit"] * 2) or len(kinds) == 8


def test_damage_is_noticed(spark):
    chunks = warc.chunk_table(spark.createDataFrame(ROWS, SCHEMA))
    rows = [tuple(r) for r in chunks.collect()]
    big = next(i for i, r in enumerate(rows) if r[2] > 1 and r[1] == 1)
    bad = list(rows)
    bad[big] = (*bad[big][:3], b"x" + bytes(bad[big][3])[1:], bad[big][4])
    for broken in (bad, rows[:big] + rows[big + 1 :]):
        with pytest.raises(Exception, match="damaged|cut short|out of order"):
            warc.read_table(spark.createDataFrame(broken, chunks.schema)).collect()


def test_empty_and_repeated(spark):
    pages = spark.createDataFrame(ROWS[:1] * 2, SCHEMA)
    assert warc.read_table(warc.chunk_table(pages)).count() == 2
    assert warc.read_table(warc.chunk_table(pages.limit(0))).count() == 0


def test_long_url_without_stored_payload(spark):
    """A head beyond a chunk on a revisit, a null and an empty html, and in front of a payload of its own."""
    url = "data:text/html," + "é" * 2_000_000
    rows = [(1, "u", "same"), (2, url, "same"), (3, url, None), (4, url, ""), (5, url, "own"), (6, url, "big" * 500_000)]
    for least in (0, 5):
        chunks = warc.chunk_table(spark.createDataFrame(rows, SCHEMA), least)
        assert got(chunks) == expected(rows, least)
        targets = {r.record_id: r.target for r in warc.read_table(chunks).collect()}
        assert {unquote(targets[f"urn:page:{p}"]) for p in range(2, 7)} == {url}


def test_extra_columns_of_any_name(spark):
    names = ["sha", "first", "record", "chunk", "data", "payload", "digest", "record_id"]
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumns({n: warc.F.lit(f"x{k}") for k, n in enumerate(names)})
    assert got(warc.chunk_table(pages)) == expected(ROWS)
