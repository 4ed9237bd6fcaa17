import duckdb
import pytest
import zstandard

from visitmart.llm import warc
from visitmart.llm.queries import oracle_sql


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h{i % 3}.example/{i}", f"<p>page {i % 40}</p>" * (1 + i % 7), "x", "y") for i in range(300)]
    rows += [(1000, None, None, "x", "y"), (1001, "u\r\nX: y", "", "x", "y"), (5, "http://again", "<p>page 5</p>" * 6, "x", "y"), (None, "n", "no id", "x", "y"), (None, "n", "<p>page 3</p>" * 4, "x", "y"), (1002, "é", "ü" * 400_000, "x", "y")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string, first string")


def test_equals_sql(pages, tmp_path):
    pages.write.parquet(f"{tmp_path}/p")
    c = duckdb.connect()
    c.sql(f"create view pages as from '{tmp_path}/p/*.parquet' where page_id is not null")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = c.sql(f"select {', '.join(columns)} from ({oracle_sql()['op8_warc']})").fetchall()
    for most in (10**6, 0):
        got = warc.archive_digests(pages.where("page_id is not null"), frame_bytes=4000, bundle_bytes=20_000, max_broadcast=most).select(*columns).collect()
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)


def test_rows_without_ids_and_empty_tables(pages):
    got = [r for r in warc.archive_digests(pages).collect() if r["page_id"] is None]
    assert sorted((r["record_type"], r["refers_to"]) for r in got) == [("response", None), ("revisit", 3)]
    assert warc.archive_digests(pages.limit(0)).count() == 0
    assert warc.archive_digests(pages, min_revisit_bytes=10**9).where("record_type = 'revisit'").count() == 0


def test_bundles_are_plain_zstandard_and_seekable(pages):
    bundles = warc.archive(pages, frame_bytes=4000, bundle_bytes=20_000)
    rows = bundles.collect()
    assert len({r["bundle"] for r in rows}) == len(rows)
    n = 0
    for r in rows:
        data = zstandard.ZstdDecompressor().stream_reader(r["content"], read_across_frames=True).read()
        frames = warc.seek_table(r["content"])
        assert sum(plain for _, _, plain in frames) == len(data)
        starts = [sum(p for _, _, p in frames[:k]) for k in range(len(frames))]
        at = 0
        for x in r["records"]:
            headers, block, end = warc.parse(data, at)
            assert headers["WARC-Record-ID"] == x["record_id"] and at == starts[x["frame"]] + x["offset"]
            assert headers["WARC-Block-Digest"] == f"sha1:{warc.digest(block)}"
            at = end
            n += 1
        assert at == len(data)
    assert n == pages.count()
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.fetch(bundles, [0, 7, 1002]).collect()}
    assert got == {0: "<p>page 0</p>", 7: "<p>page 7</p>", 1002: "ü" * 400_000}
