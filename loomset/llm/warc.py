r"""WARC archives: written as plain files, read back record by record, continuation segments reassembled.

Writing. Each row becomes a record whose block is an HTTP response with a chunked body. Of rows with equal payloads of at
least `least` bytes the one with the smallest id is a response and the others are revisits of it; smaller payloads are all
responses. A block of more than `segment` bytes is cut into a first record and continuation records (WARC-Segment-Number,
WARC-Segment-Origin-ID, and WARC-Segment-Total-Length on the last). Each record is a gzip member of its own, so that readers can
seek. Files go through Spark's own text writer, one member to a row: a member's last byte is the high byte of its length, 0
for any record below 16 MB, and that byte is the writer's line end. A file holds members of about ARCHIVE bytes at most.

Reading. Files are parsed once, in mapInArrow, and what was read is written before it is used. Records of one segment are finished
there; only segments of longer records are shuffled: grouped by the identifier of the origin, put in order of segment number,
and checked for gaps and for total length. The HTTP header is then split off and the chunked framing decoded. A record that
fails a check has status `broken: why` instead of a payload, and is not dropped; so has what follows the last whole record of a
torn file.

Scale: payloads are hashed in the JVM; smallest ids are summed before the shuffle, and equi-joins are left to AQE to split,
so a payload that a third of the pages share is not gathered anywhere. One record's segments meet in one task, as its
payload is one value anyway.

Nulls and edge cases: a null payload is empty. A row with a null id is a response and is never revisited. Rows equal in id
and payload are all responses if theirs is the smallest id (and then no revisit has WARC-Refers-To, as it could mean any of
them). A null url leaves out WARC-Target-URI. An empty table gives no records. Only id, url and html are read, so further
columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm.common import groups
from loomset.scratch import new_path, stash

CRLF = b"\r\n"
SEGMENT, CHUNK, ARCHIVE = 32 << 10, 8 << 10, 64 << 20


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    out = []
    for i in range(0, len(body), size):
        part = body[i : i + size]
        out += [b"%x" % len(part), CRLF, part, CRLF]
    return b"".join([*out, b"0", CRLF, CRLF])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped. ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            raise ValueError("chunk size is cut off")
        n = int(body[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        at = end + 2 + n
        if body[at : at + 2] != CRLF:
            raise ValueError("chunk is cut off")
        out.append(body[end + 2 : at])
        at += 2


def _header(kind: str, record: str, length: int, **more: str | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record}>", "WARC-Date: 2024-01-01T00:00:00Z", f"Content-Length: {length}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in more.items() if v is not None]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def _one_line(url: str | None) -> str | None:
    return None if url is None else "".join(c if c not in "\r\n" else "%0D" if c == "\r" else "%0A" for c in url)


def _name(uid: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, uid)}"


def _member(record: bytes) -> bytes:
    """The record and its end as a gzip member without its last byte, which is 0."""
    c = zlib.compressobj(wbits=31)
    return (c.compress(record) + c.compress(CRLF + CRLF) + c.flush())[:-1]


def _records(segment: int):
    def of(row: dict) -> Iterator[bytes]:
        name = _name(row["uid"])
        page = None if row["id"] is None else str(row["id"])
        payload = row["html"] or b""
        own = {"WARC_Target_URI": _one_line(row["url"]), "X_Page_Id": page, "WARC_Payload_Digest": f"sha1:{base32_sha1(payload)}"}
        if row["first"] is not None:
            refers = f"<{_name(row['first_uid'])}>" if row["first_uid"] else None
            yield _header("revisit", name, 0, **own, WARC_Refers_To=refers, X_Refers_To_Page_Id=str(row["first"]), WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
            return
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
        if len(block) <= segment:
            yield _header("response", name, len(block), **own, Content_Type="application/http;msgtype=response") + block
            return
        for k, at in enumerate(range(0, len(block), segment)):
            part = block[at : at + segment]
            if not k:
                yield _header("response", name, len(part), **own, WARC_Segment_Number="1") + part
                continue
            total = str(len(block)) if at + segment >= len(block) else None
            yield _header("continuation", _name(f"{name}#{k}"), len(part), WARC_Segment_Number=str(k + 1), WARC_Segment_Origin_ID=f"<{name}>", WARC_Segment_Total_Length=total) + part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                out = [_member(r) for row in batch.slice(i, 256).to_pylist() for r in of(row)]
                yield pa.record_batch([pa.array(out, pa.binary())], ["value"])

    return run


def write_warc(pages: DataFrame, path: str, least: int = 0, segment: int = SEGMENT, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One record for each row (more where it is segmented) as files of WARC 1.1 in gzip members under path. segment: below 16 MB."""
    if not 0 < segment < 1 << 24:
        raise ValueError("segment must be below 16 MB")
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    known = rows.where(f"id is not null and octet_length(html) >= {least}").groupBy("sha", "id").agg(F.count("*").alias("n"))
    low = known.groupBy("sha").agg(F.min(F.struct("id", "n")).alias("low"), F.sum("n").alias("n")).where("n > 1").select(F.col("sha").alias("key"), "low")
    rows = rows.join(low, F.col("sha") == F.col("key"), "left").withColumn("first", F.when(F.col("id") > F.col("low.id"), F.col("low.id")))
    # a name that a revisit can tell if its row has no equal, else one that no other row has
    plain = F.concat_ws(":", F.col("id").cast("string"), "sha")
    own = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("-")), "sha", F.monotonically_increasing_id().cast("string"))
    alone = (F.col("id") == F.col("low.id")) & (F.col("low.n") == 1) | F.col("low").isNull() & F.col("id").isNotNull() & (F.octet_length("html") >= least)
    rows = rows.withColumn("uid", F.when(alone, plain).otherwise(own)).withColumn("first_uid", F.when(F.col("low.n") == 1, F.concat_ws(":", F.col("first").cast("string"), "sha")))
    records = rows.select("id", "uid", "url", "html", "first", "first_uid").mapInArrow(_records(segment), "value binary").select(F.col("value").cast("string"))
    records.write.option("lineSep", "\x00").option("maxRecordsPerFile", max(1, ARCHIVE // (segment + 4096))).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an uncompressed archive. ValueError where it is torn."""
    at, n = 0, len(data)
    while at < n:
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC header at byte {at}")
        fields = {}
        for line in data[at:end].decode(errors="replace").split("\r\n")[1:]:
            k, _, v = line.partition(":")
            fields[k.strip().lower()] = v.strip()
        if not {"content-length", "warc-record-id", "warc-type"} <= set(fields) or not fields["content-length"].isdecimal():
            raise ValueError(f"a header lacks its fields at byte {at}")
        size = int(fields["content-length"])
        if end + 4 + size > n:
            raise ValueError(f"record is cut off at byte {at}")
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size
        while data.startswith(CRLF, at):
            at += 2


def members(content: bytes, step: int = 1 << 15) -> Iterator[bytes]:
    """The gzip members of an archive, uncompressed one by one; plain content as it is. ValueError where it is torn."""
    at = 0
    while at < len(content):
        if content[at : at + 2] != b"\x1f\x8b":
            yield content[at:]
            return
        d, out = zlib.decompressobj(31), []
        while not d.eof and at < len(content):
            part = content[at : at + step]
            try:
                out.append(d.decompress(part))
            except zlib.error as e:
                raise ValueError(f"gzip member is broken: {e}") from e
            at += len(part) - len(d.unused_data)
        if not d.eof:
            raise ValueError("gzip member is cut off")
        yield b"".join(out)


RECORD = "record string, kind string, page_id long, refers_to long, url string, digest string, status string, payload binary, payload_bytes long, payload_digest string"
PARSED = f"{RECORD}, number int, origin string, total long, block binary"
_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    cols = [x.split() for x in schema.split(", ")]
    return pa.record_batch([pa.array([r.get(n) for r in rows], _TYPES[t]) for n, t in cols], [n for n, _ in cols])


def _int(x: str | None) -> int | None:
    return int(x) if x is not None and x.removeprefix("-").isdecimal() else None


def _rows(content: bytes, keep: bool) -> Iterator[dict]:
    try:
        for data in members(content):
            for h, block in parse(data):
                record, number = h["warc-record-id"], _int(h.get("warc-segment-number"))
                row = {"record": record, "kind": h["warc-type"], "page_id": _int(h.get("x-page-id")), "refers_to": _int(h.get("x-refers-to-page-id")), "url": h.get("warc-target-uri"), "digest": h.get("warc-payload-digest")}
                if number is None and row["kind"] != "continuation":
                    yield _finished(row, block, "ok", keep)
                else:
                    yield row | {"number": number or 0, "origin": h.get("warc-segment-origin-id") or record, "total": _int(h.get("warc-segment-total-length")), "block": block}
    except ValueError as e:
        yield {"status": f"broken: {e}", "kind": "torn"}


def _parsed(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in _rows(content.as_py(), keep):
                    rows.append(row)
                    size += 256 + len(row.get("block") or row.get("payload") or b"")
                    if size > 4 << 20:
                        yield _batch(rows, PARSED)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, PARSED)

    return run


def assembled(parts: list[dict]) -> tuple[bytes | None, str]:
    """The block that segments make up, and ok or what is wrong."""
    parts = sorted(parts, key=lambda r: r["number"])
    if [r["number"] for r in parts] != list(range(1, len(parts) + 1)):
        return None, "broken: segments are missing or doubled"
    if (total := parts[-1]["total"]) is None:
        return None, "broken: no total length"
    block = b"".join(r["block"] for r in parts)
    return (block, "ok") if len(block) == total else (None, "broken: total length differs")


def payload_of(block: bytes) -> tuple[bytes | None, str]:
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None, "broken: no end of the HTTP header"
    if any(line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(CRLF)):
        try:
            return unchunked(body), "ok"
        except ValueError as e:
            return None, f"broken: {e}"
    return body, "ok"


def _finished(row: dict, block: bytes | None, status: str, keep: bool) -> dict:
    """row with status, and the payload's size and digest; with the payload if it is to be kept."""
    row = row | {"status": status}
    if row["kind"] == "revisit" or status != "ok":
        return row
    payload, row["status"] = payload_of(block)
    if payload is not None:
        digest = base32_sha1(payload)
        if row["digest"] and row["digest"] != f"sha1:{digest}":
            return row | {"status": "broken: digest differs"}
        row |= {"payload": payload if keep else None, "payload_bytes": len(payload), "payload_digest": digest}
    return row


def _joined(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["origin"]):
            parts = g.to_pylist()
            block, status = assembled(parts)
            first = next((r for r in parts if r["number"] == 1), {"kind": "response", "digest": None})
            yield _batch([_finished(first | {"record": parts[0]["origin"]}, block, status, keep)], RECORD)

    return run


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row for each record, whole: record, kind, page_id, refers_to, url, digest, status, payload (null for revisits, and
    if it is not asked for), payload_bytes, payload_digest. What is torn has kind `torn`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    rows = stash(files.mapInArrow(_parsed(payload), PARSED), "warc-records")
    names = [x.split()[0] for x in RECORD.split(", ")]
    parts = rows.where("origin is not null").repartition("origin").sortWithinPartitions("origin", "number")
    return rows.where("origin is null").select(*names).union(parts.mapInArrow(_joined(payload), RECORD))


def page_records(pages: DataFrame, least: int = 0, segment: int = SEGMENT) -> DataFrame:
    """Writes pages (page_id, url, html) as archives in the shared folder, reads these back, and tells of each page:
    page_id, payload_bytes, payload_digest, record_type, refers_to. A broken record has null bytes and digest."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_warc(pages, path, least, segment)
    return described(stash(read_warc(spark, path, payload=False), "warc-pages"))


def described(records: DataFrame) -> DataFrame:
    """The size and digest of each record's payload, a revisit's being those of the response that it refers to."""
    rows = records.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to", "digest")
    told = rows.where("record_type = 'response' and payload_digest is not null").groupBy(F.col("payload_digest").alias("d")).agg(F.max("payload_bytes").alias("b"))
    out = rows.withColumn("key", F.when(F.col("record_type") == "revisit", F.substring_index("digest", ":", -1))).join(told, F.col("key") == F.col("d"), "left")
    return out.select("page_id", F.coalesce("payload_bytes", "b").alias("payload_bytes"), F.coalesce("payload_digest", "d").alias("payload_digest"), "record_type", "refers_to")
