"""Conversion of legacy ARC archives into WARC.

An ARC file begins with a version block, whose own header line starts with
``filedesc:`` and whose text names the version and the fields of the header lines that
follow; each record is a header line, then as many bytes as the line's last field
declares.  Version 1 lines have five fields, version 2 lines ten.  The converter reads
records by those lengths alone and makes for each the WARC headers an equivalent
capture would have: a record id derived from the capture and its place in the archives
(so that a second conversion of them gives the same, and no two records share one), the
date in ISO form, the block's type and the digests.  Captures with equal payloads become
one response and revisits of it.

Archives are written with Spark's text writer, an archive a row and a row a file,
compressed as gzip; they are read whole as binary files, so their size is bounded by
``ARCHIVE_BYTES`` and one record.  A conversion reads the archives twice: what the first
pass finds out about each capture, its digest above all, meets the archives themselves
again by their number, so that payloads go through a shuffle only as the compressed
archive that holds them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import discard, shared_dir, stored, write

#: Bytes of one archive, about: it is closed by the record that reaches them.
ARCHIVE_BYTES = 16_000_000
#: Fixed by the format.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_END = "\r\n\r\n"
PAGE, FIRST = "X-Page-Id", "WARC-X-Refers-To-Page-Id"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public name space of URLs


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ARC


def arc_record(url: Column, page_id: Column, payload: Column, date: str, version: int) -> Column:
    """An ARC record with an HTTP response of ``payload`` (binary) as its content."""
    address = F.regexp_replace(F.coalesce(url, F.lit("about:blank")), r"[\x00-\x20\x7F]", "_")
    page = F.coalesce(page_id.cast("string"), F.lit("-"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{PAGE}: "), page, F.lit("\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    content = F.concat(http.cast("binary"), payload)
    middle = "text/html" if version == 1 else "text/html 200 - - 0 pages.arc"
    line = F.concat(address, F.lit(f" 0.0.0.0 {date} {middle} "), F.octet_length(content).cast("string"), F.lit("\n"))
    return F.concat(line.cast("binary"), content)


def version_block(date: str, version: int) -> bytes:
    text = f"{version} 0 sluice\n{FIELDS[version]}\n\n"
    middle = "text/plain" if version == 1 else "text/plain 200 - - 0 pages.arc"
    return f"filedesc://pages.arc 0.0.0.0 {date} {middle} {len(text)}\n{text}".encode()


def _write_archives(archives: DataFrame, path: str, end: str) -> None:
    """A file for each row of ``archives`` (archive binary), which lacks its last ``end``."""
    options = {"lineSep": end, "compression": "gzip", "maxRecordsPerFile": "1", "zlib.compress.level": "BEST_SPEED"}
    write(archives.select(F.col("archive").cast("string")).write.format("text").options(**options), path)


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000", version: int = 1) -> None:
    """Write ``pages`` (page_id, url, html) as ARC files; null html is empty."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(arc_record(F.col("url"), F.col("page_id"), payload, date, version).alias("record"))

    def archives(batches):
        held, size = [version_block(date, version)], 0
        for pdf in batches:
            for record in pdf["record"]:
                held.append(record)
                size += len(record)
                if size >= ARCHIVE_BYTES:
                    yield pd.DataFrame({"archive": [b"\n".join(held)]})
                    held, size = [version_block(date, version)], 0
        if size:
            yield pd.DataFrame({"archive": [b"\n".join(held)]})

    _write_archives(rows.mapInPandas(archives, "archive binary"), path, "\n")


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """(header fields, content, place) of each capture; the version block tells the
    fields of the lines.  Raises ValueError where a line or length doesn't hold."""
    at, names = 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError("an ARC header line has no end")
        values = data[at:end].decode("utf-8", "replace").split(" ")
        length = int(values[-1])
        content = data[end + 1 : end + 1 + length]
        if len(content) < length:
            raise ValueError("an ARC record is shorter than it declares")
        if names is None:
            if not values[0].startswith("filedesc:"):
                raise ValueError("an ARC file begins with its version block")
            version, fields = content.decode().split("\n")[:2]
            names = fields.split(" ")
            if FIELDS.get(int(version.split(" ")[0]), "").lower() != fields.lower():
                raise ValueError(f"ARC version {version} with fields {fields}")
        else:
            if len(values) != len(names):
                raise ValueError(f"an ARC header line has {len(values)} fields")
            yield dict(zip((n.lower() for n in names), values, strict=True)), content, at
        at = end + 1 + length
        while data[at : at + 1] == b"\n":
            at += 1


def _http(content: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """An HTTP message's head with its blank line, its headers by lower-case name, and
    its body."""
    head, mark, body = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return head + mark, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, body


def _unzipped(content: bytes) -> bytes:
    """All members of a gzip file."""
    out = []
    while content:
        d = zlib.decompressobj(31)
        out.append(d.decompress(content))
        content = d.unused_data
    return b"".join(out)


def _page(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(file, content): the number of each archive at ``path``, of its task and then in it,
    and its bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    part, more = (F.regexp_extract("path", pattern, 1).try_cast("long") for pattern in (r"part-(\d+)[^/]*$", r"part-[^/]*-c(\d+)[^/]*$"))
    return files.select((part * 1_000_000 + F.coalesce(more, F.lit(0))).alias("file"), "content")


def _arc_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for file, content in zip(pdf["file"], pdf["content"], strict=True):
            rows = []
            for fields, block, at in parse_arc(_unzipped(content)):
                _, headers, body = _http(block)
                rows.append((file, at, _page(headers.get(PAGE.lower())), fields["url"], fields["archive-date"], base32_sha1(body), len(body)))
            out = pd.DataFrame(rows, columns=["file", "at", "page_id", "url", "date", "digest", "size"])
            yield out.astype({"page_id": "Int64"})


def captures(spark: SparkSession, path: str) -> DataFrame:
    """The captures of the ARC files at ``path``: file, at (the place in it), page_id, url,
    date, digest and size of the payload."""
    return _files(spark, path).mapInPandas(_arc_partition, "file long, at long, page_id long, url string, date string, digest string, size long")


# WARC


def record_id(url: str, date: str, file: int, at: int) -> str:
    """The same id for the same capture of the same archives in every run."""
    return uuid.uuid5(_NAMES, f"{file} {at} {date} {url}").urn


def _iso(date: str) -> str:
    """An ARC date of up to 14 digits, the missing ones at their least."""
    return datetime.strptime(date + "19960101000000"[len(date) :], "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block


def _warc_of(file: int, content: bytes, digests: list[str], first_of: dict[int, dict]) -> bytes:
    """One WARC archive of an ARC archive: ``digests`` of its captures in their order, and
    for those that are revisits, by place, their first capture."""
    info = b"software: sluice\r\nformat: WARC file version 1.1\r\n"
    records = [warc_record("warcinfo", [("WARC-Record-ID", f"<{uuid.uuid5(_NAMES, f'info {file}').urn}>"), ("WARC-Date", _iso("")), ("Content-Type", "application/warc-fields")], info)]
    for (fields, block, at), digest in zip(parse_arc(content), digests, strict=True):
        url, date, first = fields["url"], fields["archive-date"], first_of.get(at)
        headers = [
            ("WARC-Record-ID", f"<{record_id(url, date, file, at)}>"), ("WARC-Date", _iso(date)), ("WARC-Target-URI", url), ("WARC-IP-Address", fields["ip-address"]),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
        ]
        if first is not None:
            block = _http(block)[0]
            headers += [
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Truncated", "length"),
                ("WARC-Refers-To", f"<{record_id(first['url'], first['date'], first['file'], first['at'])}>"), ("WARC-Refers-To-Target-URI", first["url"]), ("WARC-Refers-To-Date", _iso(first["date"])), (FIRST, "-" if first["page_id"] is None else str(first["page_id"])),
            ]
        headers.append(("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"))
        records.append(warc_record("response" if first is None else "revisit", headers, block))
    return WARC_END.encode().join(records)


def _convert_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            file, content, rows = (batch.column(c)[row].as_py() for c in ("file", "content", "rows"))
            first_of = {r["at"]: r["first"] for r in rows if r["first"] is not None}
            yield pa.RecordBatch.from_pydict({"archive": [_warc_of(file, _unzipped(content), [r["digest"] for r in rows], first_of)]})


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = 0) -> None:
    """Write the captures at ``arc_path`` as WARC files, one for each archive.  Of captures
    with equal payloads of at least ``least`` bytes the one with the smallest page id (null
    ids last, then by place in the archives) is a response, the others are revisits of it.
    """
    slim = stored(captures(spark, arc_path))
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "file", "at", "url", "date")
    first = slim.where(F.col("size") >= least).groupBy("digest", "size").agg(F.min(order).alias("first"))
    found = slim.select("file", "at", "digest", "size").join(first, ["digest", "size"], "left")
    other = (F.col("first.file") != F.col("file")) | (F.col("first.at") != F.col("at"))
    # an archive's captures are as bounded as the archive
    by_file = found.select("file", F.struct("at", "digest", F.when(other, F.col("first")).alias("first")).alias("row")).groupBy("file").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    archives = _files(spark, arc_path).join(by_file, "file").mapInArrow(_convert_partition, "archive binary")
    _write_archives(archives, warc_path, WARC_END)
    discard(slim)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record, by its declared length."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(headers["content-length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) < length:
            raise ValueError("a WARC record is shorter than it declares")
        yield headers, block
        at = end + 4 + length
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record does not end where it declares")
        at += 4


def _warc_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for content in pdf["content"]:
            rows = []
            for headers, block in parse_warc(_unzipped(content)):
                kind = headers["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                _, http, body = _http(block)
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response" and base32_sha1(body) != digest:
                    raise ValueError(f"the payload of {headers['warc-record-id']} does not have its digest")
                size = len(body) if kind == "response" else int(http["content-length"])
                rows.append((_page(http.get(PAGE.lower())), size, digest, kind, _page(headers.get(FIRST.lower())), headers["warc-record-id"], headers["warc-target-uri"], headers["warc-date"]))
            out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url", "date"])
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The response and revisit records of the WARC files at ``path``."""
    return _files(spark, path).select("content").mapInPandas(_warc_partition, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string, date string")


def archive_pages(pages: DataFrame, least: int = 0, version: int = 1) -> DataFrame:
    """``pages`` (page_id, url, html) through ARC and WARC files in the shared folder and
    back: page_id, payload_bytes, payload_digest, record_type and refers_to.

    Null html is empty, a null url is written as about:blank, and blanks in a url as
    underscores.  Repeated rows each have their record, all but the first a revisit;
    a null page_id comes back as null.  No rows give no rows, further columns are left
    out, and a very long page closes its archive.
    """
    spark = pages.sparkSession
    arc, warc = shared_dir(spark), shared_dir(spark)
    write_arc(pages, arc, version=version)
    convert(spark, arc, warc, least)
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
