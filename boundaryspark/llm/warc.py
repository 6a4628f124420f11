"""WARC archives: records written by Spark's text writer, read back by a salvage reader.

Writing: a record ends with an empty line twice, which is the writer's line separator, so any store that
Spark can write to holds valid archives.  Of records with equal payloads of at least `revisit_bytes`, the
one of the largest page id is a response and the others revisit it; smaller payloads are all responses.

Reading: plain archives and gzip members.  A record whose version line, header, length, closing lines or
payload digest fails is quarantined: the reader searches for the next valid member or version line, goes
on there, and logs the gap as a row of type `gap` with offset, length and reason.  A failed record whose
length still leads to a proper end is skipped whole, so that no record inside its payload is taken for one.

Edge cases: null html is an empty payload; a null url leaves the target out; a null page id is less than
any other; rows of the same id and payload are of the same type; no rows give no archive and no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boundaryspark.llm.common import broadcast_if_counted, table
from boundaryspark.llm.registry import query
from boundaryspark.runtime import materialize, scratch_path

REVISIT_BYTES = 1000
FILE_BYTES = 16 * 1024 * 1024
SLICE = 16 * 1024
END = b"\r\n\r\n"
VERSION = re.compile(rb"WARC/\d\.\d\r?\n")
HEADER_END = re.compile(rb"\r\n\r\n|\nWARC/\d\.\d\r?\n")
MEMBER = b"\x1f\x8b\x08"
RECORD_SCHEMA = ("file string, offset long, length long, record_type string, target_uri string, "
                 "headers map<string,string>, payload binary, note string")


class Record(NamedTuple):
    offset: int
    length: int
    kind: str
    headers: dict[str, str]
    payload: bytes
    note: str


def write_pages(pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z",
                revisit_bytes: int = REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write a record per row of (page_id, url, html)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1("html"), "bytes": F.octet_length("html").cast("long")})
    groups = rows.where(F.col("bytes") >= revisit_bytes).groupBy("digest").agg(
        F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    groups = broadcast_if_counted(materialize(groups, "payloads"))
    mean = rows.agg(F.avg("bytes")).first()[0] or 0
    joined = rows.join(groups, "digest", "left").withColumn(
        "revisit", F.coalesce((F.col("bytes") >= revisit_bytes) & F.col("last").isNotNull()
                              & ~F.col("page_id").eqNullSafe(F.col("last")), F.lit(False)))
    http = F.concat_ws("\r\n", F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
                       F.concat(F.lit("Content-Length: "), "bytes"), F.lit(""), F.lit(""))
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html")))
    record = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:sha1:"), F.sha1(F.concat_ws(" ", "page_id", "digest", "url")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\r\n]", "%0A")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"), F.concat(F.lit("Page-Id: "), "page_id"),
        F.concat(F.lit("Payload-Length: "), "bytes"),
        F.when(F.col("revisit"), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(F.col("revisit"), F.concat(F.lit("Refers-To-Page-Id: "), "last")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("_block")), F.lit(""), F.col("_block"))
    (joined.withColumn("_block", block).select(record.alias("value")).write.option("lineSep", "\r\n\r\n")
     .option("maxRecordsPerFile", max(1, int(file_bytes // (mean + 600)))).text(path))


def _header(data: bytes, at: int) -> tuple[dict[str, str], int] | None:
    """Fields and the place of the block of the record at `at`, if its header is whole."""
    version = VERSION.match(data, at)
    # a header of any length goes to the next empty line; a version line before that starts another record
    found = HEADER_END.search(data, version.end() - 2) if version else None
    if not found or found[0] != END:
        return None
    end, fields = found.start(), {}
    for line in data[version.end():end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    return fields, end + 4


def _digest_holds(value: str | None, content: bytes) -> bool:
    name, _, given = (value or "").partition(":")
    if name.lower() not in ("sha1", "sha256", "md5"):
        return True
    found = hashlib.new(name.lower(), content)
    return given.lower() == found.hexdigest() or given == base64.b32encode(found.digest()).decode()


def _plain(data: bytes, at: int) -> tuple[Record | None, int, str]:
    """The record at `at`, the place to go on, and what failed."""
    head = _header(data, at)
    if head is None:
        return None, at + 1, "header"
    fields, start = head
    end = start + int(fields["content-length"])
    if data[end:end + 4] != END:
        return None, at + 1, "length"
    after = end + 4
    block, kind = data[start:end], fields["warc-type"]
    payload = block.partition(END)[2] if fields.get("content-type", "").startswith("application/http") else block
    framed = after == len(data) or VERSION.match(data, after) or data.startswith(MEMBER, after)
    if not _digest_holds(fields.get("warc-block-digest"), block) or (
            kind != "revisit" and not _digest_holds(fields.get("warc-payload-digest"), payload)):
        return None, after if framed else at + 1, "digest"
    return Record(at, after - at, kind, fields, payload, ""), after, ""


def _next_start(data: bytes, at: int) -> int:
    """The next place at or after `at` where a member or a version line with a whole header begins."""
    while at < len(data):
        version = VERSION.search(data, at)
        member = data.find(MEMBER, at)
        place = min(version.start() if version else len(data), member if member >= 0 else len(data))
        if place == len(data):
            break
        if version and place == version.start():
            if _header(data, place):
                return place
        else:
            try:
                if zlib.decompressobj(31).decompress(data[place:place + 4096], 16).startswith(b"WARC/"):
                    return place
            except zlib.error:
                pass
        at = place + 1
    return len(data)


def _member(data: bytes, at: int) -> tuple[bytes, int] | None:
    """Content and end of the gzip member at `at`, fed in slices so that the rest of the file is not copied; None if it is cut off."""
    unzip, content, view = zlib.decompressobj(31), [], memoryview(data)
    while not unzip.eof and at < len(data):
        content.append(unzip.decompress(view[at:at + SLICE]))
        at += SLICE
    return (b"".join(content), min(at, len(data)) - len(unzip.unused_data)) if unzip.eof else None


def read_archive(data: bytes) -> Iterator[Record]:
    """All sound records of an archive in order, and a record of kind `gap` for each quarantined stretch."""
    at, gap, why = 0, -1, ""
    while at < len(data):
        found: list[Record] = []
        if data.startswith(MEMBER, at):
            onward, reason = at + 1, "truncated member"
            try:
                member = _member(data, at)
                if member:
                    found = [r._replace(offset=at, length=member[1] - at) for r in read_archive(member[0])]
                    onward = member[1] if found else onward
            except zlib.error:
                reason = "member"
        else:
            record, onward, reason = _plain(data, at)
            found = [record] if record else []
        if found:
            if gap >= 0:
                yield Record(gap, at - gap, "gap", {}, b"", why)
                gap = -1
            yield from found
            at = onward
        else:
            if gap < 0:
                gap, why = at, reason
            at = _next_start(data, onward)
    if gap >= 0:
        yield Record(gap, len(data) - gap, "gap", {}, b"", why)


def read_archives(spark: SparkSession, path: str, batch_bytes: int = 4 * 1024 * 1024) -> DataFrame:
    """Records and gaps of all archive files below `path`; one task reads a file at a time."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, size = [], 0
                for r in read_archive(content.as_py() or b""):
                    rows.append((name.as_py(), r.offset, r.length, r.kind, r.headers.get("warc-target-uri"),
                                 list(r.headers.items()), r.payload, r.note))
                    size += r.length
                    if size >= batch_bytes:
                        yield packed(rows)
                        rows, size = [], 0
                if rows:
                    yield packed(rows)

    def packed(rows):
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()),
                 pa.binary(), pa.string()]
        names = ["file", "offset", "length", "record_type", "target_uri", "headers", "payload", "note"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)
    return files.mapInArrow(run, RECORD_SCHEMA)


OP10_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY 1 HAVING count(*) > 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN g.last IS NOT NULL AND p.page_id IS DISTINCT FROM g.last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN g.last IS NOT NULL AND p.page_id IS DISTINCT FROM g.last THEN g.last END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""


@query("op10_warc", OP10_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_pages(table(spark, sf_dir, "pages"), path)
    gap = F.raise_error(F.concat(F.lit("gap in an archive just written: "), F.col("file"), F.lit(" at "), F.col("offset").cast("string"),
                                 F.lit(", "), F.col("note")))
    records = read_archives(spark, path).where(F.when(F.col("record_type") == "gap", gap.cast("boolean")).otherwise(True))
    field = lambda name: F.col("headers")[name]
    response = F.col("record_type") == "response"
    return records.select(
        field("page-id").cast("long").alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(field("payload-length").cast("long")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.substring_index(field("warc-payload-digest"), ":", -1)).alias("payload_digest"),
        "record_type", field("refers-to-page-id").cast("long").alias("refers_to"))
