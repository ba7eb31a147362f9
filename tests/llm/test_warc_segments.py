import base64
import hashlib

import pytest

from lectern.llm import warc_segments as W
from lectern.session import scratch_path

BIG = "".join(f"<p>Zeile {i} äöü 日本</p>" for i in range(4000))
PAGES = [
    (1, "http://a.example/x", "<p>one</p>"), (2, "http://a.example/y", BIG), (3, "http://b.example/", "<p>one</p>"),
    (4, None, ""), (5, "http://c.example/ space", None), (6, "http://a.example/z", BIG), (7, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"),
    (8, "u", "\r\n\r\n0\r\n\r\n"), (9, "u", "<p>nine</p>"), (9, "u", "<p>nine</p>"), (None, "u", "no id"),
]


@pytest.fixture(scope="module")
def archive(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS value", "1 AS record")
    path = scratch_path(spark, "warc-test")
    W.write_archives(pages, path, segment_bytes=10_000, chunk_bytes=777)
    return pages, path


def test_round_trip_and_roles(spark, archive):
    records = W.read_records(spark, archive[1])
    assert records.filter("error IS NOT NULL").count() == 0
    rows = sorted(W.page_records(records).collect(), key=lambda r: (r["page_id"] is None, r["page_id"]))
    expected = []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        last = max(same, default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = page is not None and page != last
        expected.append((page, len(payload), digest, "revisit" if revisit else "response", last if revisit else None))
    assert [tuple(r) for r in rows] == sorted(expected, key=lambda r: (r[0] is None, r[0]))
    payloads = {r["record_id"]: bytes(r["payload"]) for r in records.filter("warc_type = 'response'").collect()}
    assert payloads["<urn:lectern:page:6:0>"] == BIG.encode()


def test_archives_hold_segments_of_valid_records(spark, archive):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(archive[1]).filter("length > 0").collect()
    headers = [h for f in files for h, _ in W.parse_archive(W.unpacked(bytes(f["content"])))]
    kinds = [h["warc-type"] for h in headers]
    assert kinds.count("continuation") > 5 and kinds.count("revisit") == 3
    assert len({h["warc-record-id"] for h in headers}) == len(headers)
    last = [h for h in headers if "warc-segment-total-length" in h]
    assert len(last) == 1 and last[0]["warc-segment-origin-id"] == "<urn:lectern:page:6:0>"


def test_smaller_payloads_are_all_responses(spark, archive):
    path = scratch_path(spark, "warc-test")
    W.write_archives(archive[0], path, smallest=100, segment_bytes=10_000)
    rows = W.page_records(W.read_records(spark, path, payloads=False)).collect()
    assert {r["page_id"] for r in rows if r["record_type"] == "revisit"} == {2}


@pytest.mark.parametrize("damage", ["missing", "length"])
def test_damaged_segments_are_reported(spark, damage):
    block = W.HTTP_HEAD.encode() + W.chunked(b"y" * 900, 100)
    parts = [block[i:i + 300] for i in range(0, len(block), 300)]
    out = b""
    for n, part in enumerate(parts, 1):
        if damage == "missing" and n == 2:
            continue
        name = "<urn:o>" if n == 1 else f"<urn:o:{n}>"
        lines = [W.VERSION, f"WARC-Type: {'response' if n == 1 else 'continuation'}", f"WARC-Record-ID: {name}", f"WARC-Segment-Number: {n}"]
        lines += ["WARC-Segment-Origin-ID: <urn:o>"] * (n > 1)
        lines += [f"WARC-Segment-Total-Length: {len(block) + (damage == 'length')}"] * (n == len(parts))
        out += ("\r\n".join([*lines, f"Content-Length: {len(part)}"]) + "\r\n\r\n").encode() + part + b"\r\n\r\n"
    path = scratch_path(spark, "warc-test")
    spark.createDataFrame([(out.decode(),)], "value string").coalesce(1).write.option("lineSep", "\r\n").text(path)
    rows = W.read_records(spark, path).collect()
    assert len(rows) == 1 and rows[0]["payload"] is None and ("segments" in rows[0]["error"])


def test_chunked_framing():
    for body in (b"", b"a", b"0\r\n\r\n" * 50, bytes(range(256)) * 40):
        assert W.dechunked(W.chunked(body, 100)) == body
    assert W.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nabc", b"3\r\nabcd\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            W.dechunked(broken)


def test_no_pages(spark, archive):
    path = scratch_path(spark, "warc-test")
    W.write_archives(archive[0].limit(0), path)
    assert W.page_records(W.read_records(spark, path)).count() == 0
