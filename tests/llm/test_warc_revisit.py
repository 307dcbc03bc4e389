import base64
import gzip
import hashlib

import pytest

from rowsentry.llm import warc_revisit

PAGES = [(1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>two</p>"), (5, "http://a/5\r\nX: y", "<p>one</p>"), (3, None, None),
         (4, "http://a/4", ""), (9, "http://a/9", "é" * 40_000 + "\r\n\r\nWARC/1.1"), (7, "http://a/7", "<p>one</p>"), (None, "http://a/0", "<p>two</p>")]


def expected(min_bytes=0):
    out = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "")]
        first = max(same, key=lambda p: (p is not None, p or 0))
        revisit = len(data) >= min_bytes and page != first
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_archives_give_back_what_they_hold(spark, tmp_path, min_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumnRenamed("page_id", "digest")
    resolved = warc_revisit.resolve(pages, page_id="digest", min_bytes=min_bytes)
    manifest = warc_revisit.write_archives(resolved, str(tmp_path / "w"), file_bytes=300)
    rows = warc_revisit.read_archives(spark, manifest).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str) == expected(min_bytes)
    html = {p: (h or "") for p, _, h in PAGES}
    assert all(bytes(r["payload"]).decode() == html[r["page_id"]] for r in rows if r["record_type"] == "response")
    assert all(r["payload"] is None for r in rows if r["record_type"] == "revisit")
    assert len({r["record_id"] for r in rows}) == len(PAGES)
    assert manifest.agg({"records": "sum"}).first()[0] == len(PAGES) and manifest.count() > 1


def test_rows_that_repeat_an_id_are_one_record_each(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x")] * 3 + [(0, "u", "x")] * 2, "page_id long, url string, html string")
    rows = warc_revisit.read_archives(spark, warc_revisit.write_archives(warc_revisit.resolve(pages), str(tmp_path / "w"))).collect()
    assert sorted((r["page_id"], r["record_type"]) for r in rows) == [(0, "revisit")] * 2 + [(1, "response")] * 3


def test_empty_table(spark, tmp_path):
    manifest = warc_revisit.write_archives(warc_revisit.resolve(spark.createDataFrame([], "page_id long, url string, html string")), str(tmp_path / "w"))
    assert manifest.count() == 0 and warc_revisit.read_archives(spark, manifest).count() == 0


def test_a_broken_archive_raises(tmp_path):
    row = {"page_id": 1, "url": "u", "payload": b"abc", "digest": hashlib.sha1(b"abc").hexdigest(), "revisit": False, "refers_to": None, "refers_url": None}
    data = warc_revisit.record(row, "2024-01-01T00:00:00Z")
    for bad, what in ((data.replace(b"abc", b"abd"), "differ"), (data[:-3], "within a record")):
        path = tmp_path / "bad.gz"
        path.write_bytes(gzip.compress(bad))
        with open(path, "rb") as f, pytest.raises(ValueError, match=what):
            list(warc_revisit.records(f))
