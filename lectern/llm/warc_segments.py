"""WARC archives: writing with revisits, segments and chunked transfer framing; reading with segment reassembly.

Writing: each page becomes an HTTP response record; of equal payloads the largest page id is the response and the others
are revisits. A block over ``segment_bytes`` is cut into a first record and continuation records that name their origin,
their segment number and, on the last, the total length. Archives are plain files written by Spark's text writer, whose
line separator is the blank lines that end a WARC record.

Reading: archives are parsed by their length headers; records that stand alone are decoded at once, segments are grouped
by the identifier of their origin, put in the order of their numbers, checked against the total length, and then decoded
from chunked framing.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import stored

SEGMENT_BYTES = 32 << 10
HTTP_CHUNK_BYTES = 8 << 10
ARCHIVE_BYTES = 16 << 20
SMALLEST_REVISIT = 0

#: The names that WARC 1.1 and HTTP 1.1 prescribe.
VERSION = "WARC/1.1"
END_OF_RECORD = "\r\n\r\n"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

RECORD = ("record_id string, origin_id string, segment int, total_length long, warc_type string, target_uri string, "
          "refers_to string, payload_digest string, block binary, payload binary, payload_bytes long, "
          "computed_digest string, error string")


def payload_digest(payload: Column) -> Column:
    """SHA-1 of a binary column in bare upper-case base32."""
    hexadecimal = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexadecimal, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), BASE32_DIGITS, BASE32)


def chunked(payload: bytes, size: int = HTTP_CHUNK_BYTES) -> bytes:
    """A payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at:at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over. Raises ValueError if it is cut short."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:line].split(b";")[0].strip(), 16)
        if not size:
            return b"".join(parts)
        if line + 4 + size > len(body) or body[line + 2 + size:line + 4 + size] != b"\r\n":
            raise ValueError("chunk cut short")
        parts.append(body[line + 2:line + 2 + size])
        at = line + 4 + size


def http_payload(block: bytes) -> bytes:
    """Body of an HTTP message, transfer framing decoded."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("HTTP head not ended")
    lines = [line.partition(b":") for line in head.split(b"\r\n")[1:]]
    framing = {name.strip().lower(): value.strip().lower() for name, _, value in lines}
    return dechunked(body) if b"chunked" in framing.get(b"transfer-encoding", b"") else body


def plan_roles(pages: DataFrame, id_col: str, html_col: str, smallest: int) -> DataFrame:
    """Per (page id, digest): the response its payload belongs to, and how many rows share both.

    Only ids and digests are shuffled; rows of one payload are counted before they meet.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    keyed = pages.select(F.col(id_col).alias("_id"), payload_digest(payload).alias("_digest"), F.octet_length(payload).alias("_bytes"))
    rows = keyed.groupBy("_id", "_digest").agg(F.count("*").alias("_rows"), F.max("_bytes").alias("_bytes"))
    last = rows.groupBy("_digest").agg(F.max("_id").alias("_last"))
    return rows.join(last, "_digest").select(
        F.col("_id").alias("_role_id"), F.col("_digest").alias("_role_digest"), "_rows",
        F.when(F.col("_bytes") >= smallest, F.col("_last")).otherwise(F.col("_id")).alias("_response"))


def record_id(page: Column, copy: Column) -> Column:
    return F.concat(F.lit("<urn:lectern:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), copy.cast("string"), F.lit(">"))


def records_of(pages: DataFrame, id_col: str, url_col: str, html_col: str, smallest: int, segment_bytes: int,
               chunk_bytes: int) -> DataFrame:
    """``value``: one WARC record a row, without the blank lines at its end."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    slim = pages.select(F.col(id_col).alias("_id"), F.coalesce(F.col(url_col), F.lit("")).alias("_url"), payload.alias("_payload"),
                        payload_digest(payload).alias("_digest"))
    roles = plan_roles(pages, id_col, html_col, smallest)
    same = slim["_id"].eqNullSafe(roles["_role_id"]) & (slim["_digest"] == roles["_role_digest"])
    planned = slim.join(roles, same, "left").select(
        record_id(F.col("_id"), F.when(F.col("_rows") > 1, F.monotonically_increasing_id()).otherwise(F.lit(0))).alias("record"),
        F.when(~F.col("_response").eqNullSafe(F.col("_id")), record_id(F.col("_response"), F.lit(0))).alias("refers_to"),
        F.col("_url").alias("url"), F.col("_digest").alias("digest"), F.col("_payload").alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def record(kind: str, name: str, extra: list[str], block: bytes) -> bytes:
            lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", "WARC-Date: 2024-01-01T00:00:00Z",
                     *extra, f"Content-Length: {len(block)}"]
            return ("\r\n".join(lines) + "\r\n\r\n").encode() + block

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                values: list[bytes] = []
                columns = [c.to_pylist() for c in batch.slice(at, 256).columns]
                for name, refers, url, digest, payload in zip(*columns, strict=True):
                    uri = "".join(url.split())
                    about = [f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}",
                             "Content-Type: application/http; msgtype=response"]
                    if refers is not None:
                        about += [f"WARC-Refers-To: {refers}", f"WARC-Profile: {IDENTICAL_PAYLOAD}"]
                        values.append(record("revisit", name, about, HTTP_HEAD.encode()))
                        continue
                    block = HTTP_HEAD.encode() + chunked(payload, chunk_bytes)
                    if len(block) <= segment_bytes:
                        values.append(record("response", name, about, block))
                        continue
                    values.append(record("response", name, [*about, "WARC-Segment-Number: 1"], block[:segment_bytes]))
                    for n, start in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
                        extra = [f"WARC-Target-URI: {uri}", f"WARC-Segment-Origin-ID: {name}", f"WARC-Segment-Number: {n}"]
                        if start + segment_bytes >= len(block):
                            extra.append(f"WARC-Segment-Total-Length: {len(block)}")
                        values.append(record("continuation", f"{name[:-1]}:{n}>", extra, block[start:start + segment_bytes]))
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])

    return planned.mapInArrow(run, "value binary").select(F.col("value").cast("string"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   smallest: int = SMALLEST_REVISIT, segment_bytes: int = SEGMENT_BYTES,
                   chunk_bytes: int = HTTP_CHUNK_BYTES, archive_bytes: int = ARCHIVE_BYTES,
                   compression: str = "gzip") -> None:
    """Writes the pages as WARC files below ``path``, each of about ``archive_bytes`` before compression.

    Rows with one id and one payload are records of their own, with ids of their own. A null payload is empty, a null
    url an empty one, a null page id an empty name. An empty table writes no record. White space in a url is left out.
    """
    records = records_of(pages, id_col, url_col, html_col, smallest, segment_bytes, chunk_bytes)
    per_file = max(1, archive_bytes // (segment_bytes + 1024))
    (records.write.option("lineSep", END_OF_RECORD).option("compression", compression)
     .option("maxRecordsPerFile", max(per_file, 2_000)).text(path))


def unpacked(content: bytes) -> bytes:
    """An archive's bytes, decompressed if it is gzip (of one member or many)."""
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an archive, by its Content-Length."""
    at = 0
    while at < len(content):
        while content[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(content):
            return
        end = content.find(b"\r\n\r\n", at)
        if end < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(headers["content-length"])
        block = content[end + 4:end + 4 + size]
        if len(block) < size:
            raise ValueError(f"record at byte {at} is cut short")
        yield headers, block
        at = end + 4 + size


def _bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _decoded(block: bytes) -> tuple[bytes | None, str | None]:
    try:
        return http_payload(block), None
    except ValueError as problem:
        return None, str(problem)


def _rows(records: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(),
             pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.string()]
    names = [part.split()[0] for part in RECORD.split(", ")]
    columns = list(zip(*records, strict=True)) if records else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Logical records of all archives below ``path``, segments joined: ids, type, digests, payload and ``error``.

    A record whose segments are incomplete, overlap or miss the stated length, or whose framing is broken, has a null
    payload and says why in ``error``. With ``payloads=False`` only lengths and digests are kept. One archive is one
    row while it is parsed, so archives should stay in the size that ``write_archives`` gives them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter("length > 0").select("content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found: list[tuple] = []
                size = 0
                for headers, block in parse_archive(unpacked(content.as_py())):
                    kind = headers.get("warc-type", "")
                    number = int(headers.get("warc-segment-number", 0))
                    name = headers.get("warc-record-id")
                    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    payload = error = None
                    if kind == "response" and not number:
                        payload, error = _decoded(block)
                    total = headers.get("warc-segment-total-length")
                    found.append((
                        name, headers.get("warc-segment-origin-id") or name, number, int(total) if total else None, kind,
                        headers.get("warc-target-uri"), headers.get("warc-refers-to"), digest, block if number else None,
                        payload if payloads else None, None if payload is None else len(payload),
                        None if payload is None else _bare_digest(payload), error))
                    size += len(block)
                    if size > 4 << 20:
                        yield _rows(found)
                        found, size = [], 0
                yield _rows(found)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done: list[tuple] = []
            for row in batch.to_pylist():
                parts = row["parts"]
                first = parts[0]
                payload = error = None
                total = max((p["total_length"] for p in parts if p["total_length"] is not None), default=None)
                block = b"".join(p["block"] or b"" for p in parts)
                if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                    error = "segments missing or repeated"
                elif total is None or total != len(block):
                    error = f"segments have {len(block)} bytes, not {total}"
                else:
                    payload, error = _decoded(block)
                done.append((
                    first["record_id"], row["origin_id"], 0, total, first["warc_type"], first["target_uri"], first["refers_to"],
                    first["payload_digest"], None, payload if payloads else None, None if payload is None else len(payload),
                    None if payload is None else _bare_digest(payload), error))
            yield _rows(done)

    parsed = stored(files.mapInArrow(parse, RECORD), "warc-records")
    alone = parsed.filter("segment = 0").drop("block", "segment")
    part = F.struct("segment", "record_id", "total_length", "warc_type", "target_uri", "refers_to", "payload_digest", "block")
    grouped = parsed.filter("segment > 0").groupBy("origin_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return alone.unionByName(grouped.mapInArrow(join, RECORD).drop("block", "segment"))


def page_records(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Per record of ``write_archives``: ``page_id``, length and digest of its full payload, type and ``refers_to``.

    A revisit has the length that its response's payload has.
    """
    number = F.regexp_extract(F.col("record_id"), r"^<urn:lectern:page:(.*):\d+>$", 1)
    target = F.regexp_extract(F.col("refers_to"), r"^<urn:lectern:page:(.*):\d+>$", 1)
    named = records.select(
        F.nullif(number, F.lit("")).cast(id_type).alias("page_id"), F.col("warc_type").alias("record_type"),
        F.nullif(target, F.lit("")).cast(id_type).alias("refers_to"), "payload_digest", "payload_bytes", "computed_digest", "error")
    lengths = named.filter("record_type = 'response'").groupBy(F.col("computed_digest").alias("_digest")).agg(
        F.max("payload_bytes").alias("_bytes"))
    revisits = named.filter("record_type = 'revisit'").join(lengths, F.col("payload_digest") == F.col("_digest"), "left")
    direct = named.filter("record_type = 'response'").select(
        "page_id", "payload_bytes", F.col("computed_digest").alias("payload_digest"), "record_type", "refers_to")
    return direct.unionAll(revisits.select(
        "page_id", F.col("_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))
