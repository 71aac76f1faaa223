import hashlib

import pytest

from ledgerlens.llm import warc

BIG = "<p>" + "same text " * 20 + "</p>"


def _expected(rows):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 100 and page is not None and first[html] != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[html] if revisit else None))
    return out


def test_round_trip_with_odd_pages_and_rolling(spark, tmp_path):
    rows = [(9, "u", BIG), (2, None, BIG), (None, "u\r\nX: y", BIG), (3, "v", None), (4, "w", ""), (4, "w", ""),
            (5, "x", "short"), (6, "y", "short"), (7, "z", "é" * 70), (8, "z", "é" * 70), (10, "q", "<p>\r\n\r\n</p>" * 30000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS kind", "3 AS first")
    manifest = warc.write_archive(pages, str(tmp_path / "a"), roll_bytes=500)
    got = warc.read_archive(manifest, str(tmp_path / "a")).collect()
    key = lambda r: tuple((v is None, v or 0) for v in r[:2]) + r[2:4]
    mine = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key)
    assert mine == sorted(_expected(rows), key=key)
    assert {bytes(r.payload).decode() for r in got if r.page_id == 10} == {rows[-1][2]}
    assert manifest.count() > 1 and not list((tmp_path / "a").glob(".part*"))
    again = warc.write_archive(pages, str(tmp_path / "b"), roll_bytes=500)
    assert {r.sha256 for r in again.collect()} == {r.sha256 for r in manifest.collect()}


def test_damage_is_found(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", BIG)], "page_id long, url string, html string")
    manifest = warc.write_archive(pages, str(tmp_path / "a"))
    next((tmp_path / "a").glob("*.warc.gz")).write_bytes(b"no archive")
    with pytest.raises(Exception, match="not the file of the manifest"):
        warc.read_archive(manifest, str(tmp_path / "a")).collect()


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
