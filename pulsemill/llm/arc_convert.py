"""Legacy ARC archives to WARC.

An ARC file is a version block followed by records: one header line whose fields depend on
the version, then as many bytes as it declares, then a newline. A converted record gets
what WARC wants and ARC lacks: an identifier, an ISO timestamp, a type and digests.

Archives are gzip files in the shared folder. Each is put together in a task up to a bound
of bytes and written by Spark's text writer as one row, one file; so a lost task is simply
run again, and any file system that Spark knows will do.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm.common import saved, small_batches
from pulsemill.session import scratch_path

ARCHIVE_BYTES = 8 << 20  # an archive ends with the record that reaches this
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
         "Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_CRLF = b"\r\n"


def digest(payload: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str  # 14 digits
    content_type: str
    block: bytes  # as archived: response head and payload
    version: str
    offset: int


class ArcError(ValueError):
    """An archive that doesn't follow its own header."""


def write_arc(records: list[tuple[str, str, str, str, bytes]], version: str, name: str) -> bytes:
    """An ARC file of records (url, ip, date, content type, block)."""
    about = f"{version} 0 pulsemill\n{ARC_FIELDS[version]}\n".encode()
    out = [_arc_record(version, f"filedesc://{name}", "0.0.0.0", "20240101000000", "text/plain", about, name)]
    for url, ip, date, kind, block in records:
        out.append(_arc_record(version, url, ip, date, kind, block, name))
    return b"".join(out)


def _arc_record(version, url, ip, date, kind, block, name) -> bytes:
    if version == "1":
        head = f"{url} {ip} {date} {kind} {len(block)}\n"
    else:
        head = f"{url} {ip} {date} {kind} 200 {digest(block)} - 0 {name} {len(block)}\n"
    return head.encode() + block + b"\n"


def read_arc(data: bytes, with_about: bool = False) -> Iterator[ArcRecord]:
    """Records after the version block, by the field list that the block declares.

    With ``with_about`` the version block comes first, as a record at offset 0.

    The last field is the length, so a line is split from both ends; a URL with spaces
    stays whole. A line of the other version's shape is an error, as is a declared length
    beyond the end of the file. Blank lines between records are passed over.
    """
    at, version, names = 0, None, []
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)].rstrip(b"\r")
        if not line:
            at += 1 if end < 0 else end + 1 - at
            continue
        width = len(names) or 5
        fields = line.decode("utf-8", "replace").rsplit(" ", width - 1)
        if len(fields) != width and version is None:
            fields = line.decode("utf-8", "replace").rsplit(" ", len(ARC_FIELDS["2"].split()) - 1)
        if len(fields) < 5 or not fields[-1].isdigit():
            raise ArcError(f"no header line at {at}: {line[:80]!r}")
        length = int(fields[-1])
        start = end + 1
        if end < 0 or start + length > len(data):
            raise ArcError(f"{length} bytes declared at {at}, {len(data) - start} left")
        block = data[start:start + length]
        if version is None:
            if not line.startswith(b"filedesc:"):
                raise ArcError("no version block")
            about = block.decode("utf-8", "replace").split("\n")
            version, names = about[0].split(" ")[0], about[1].split(" ")
            if version not in ARC_FIELDS or names != ARC_FIELDS[version].split(" "):
                raise ArcError(f"unknown version {about[:2]}")
            if with_about:
                # a file's name has no spaces, and the line as many fields as either version has
                yield ArcRecord(*line.decode("utf-8", "replace").split(" ")[:4], block, version, at)
        else:
            named = dict(zip(names, fields, strict=True))
            yield ArcRecord(
                named["URL"], named["IP-address"], named["Archive-date"], named["Content-type"],
                block, version, at)
        at = start + length


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers (lower-case names), the head's bytes and the payload of a response."""
    head, gap, payload = block.partition(_CRLF * 2)
    if not gap:
        return {}, b"", block
    pairs = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}, head + gap, payload


def iso_date(date: str) -> str:
    """A 14-digit date as WARC writes it; missing digits are the earliest possible."""
    digits = "".join(c for c in date if c.isdigit())[:14]
    digits += "00000101000000"[len(digits):]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def record_id(record: ArcRecord, archive: str) -> str:
    """Of no other record, and the same for every conversion of the same archive file."""
    place = f"{archive.rsplit('/', 1)[-1]}|{record.offset}"
    name = f"{place}|{record.url}|{record.date}|{digest(record.block)}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    """One WARC record without the two line ends that close it."""
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (as written) and block of every record, by declared lengths."""
    at = 0
    while at < len(data):
        while data[at:at + 2] == _CRLF:
            at += 2
        if at >= len(data):
            return
        gap = data.find(_CRLF * 2, at)
        if gap < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at {at}")
        pairs = (x.partition(":") for x in data[at:gap].decode("utf-8", "replace").split("\r\n")[1:])
        fields = {k.strip(): v.strip() for k, _, v in pairs}
        start = gap + 4
        length = int(fields["Content-Length"])
        if start + length > len(data):
            raise ValueError(f"{length} bytes declared at {at}, {len(data) - start} left")
        yield fields, data[start:start + length]
        at = start + length


def unzipped(data: bytes) -> bytes:
    """All members of a gzip file; other bytes as they are."""
    if data[:2] != b"\x1f\x8b":
        return data
    parts = []
    while data[:2] == b"\x1f\x8b":
        one = zlib.decompressobj(31)
        parts.append(one.decompress(data))
        data = one.unused_data
    return b"".join(parts)


def _written(archives: DataFrame, path: str, line_end: str) -> str:
    """One gzip file per row of text."""
    (archives.write.option("lineSep", line_end).option("compression", "gzip")
     .option("maxRecordsPerFile", 1).option("zlib.compress.level", "BEST_SPEED").text(path))
    return path


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def write_arcs(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Pages as ARC archives of both versions in turn; null html is empty, null url is ``-``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, n = [], 0, 0
        for batch in batches:
            for page, url, text in zip(
                    batch.column("page").to_pylist(), batch.column("url").to_pylist(),
                    batch.column("html").to_pylist(), strict=True):
                payload = (text or "").encode()
                head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        f"Content-Length: {len(payload)}\r\nX-Page-Id: {page}\r\n\r\n").encode()
                clean = "".join(c if c > " " else "%20" for c in url or "-")
                waiting.append((clean, "192.0.2.1", "20240101120000", "text/html", head + payload))
                size += len(head) + len(payload)
                if size >= archive_bytes:
                    yield _one(waiting, n)
                    waiting, size, n = [], 0, n + 1
        if waiting:
            yield _one(waiting, n)

    def _one(records, n) -> pa.RecordBatch:
        # the writer ends the row, and so the last record, with its newline
        arc = write_arc(records, "12"[n % 2], f"part-{n}.arc")[:-1].decode()
        return pa.RecordBatch.from_arrays([pa.array([arc], pa.string())], ["value"])

    rows = pages.select(F.coalesce(F.col("page_id").cast("string"), F.lit("-")).alias("page"), "url", "html")
    return _written(rows.mapInArrow(pack, "value string"), path, "\n")


_KEYS = ("archive string, offset long, page string, payload_digest string, payload_bytes long, "
         "url string, date string, record_id string")
_BLOCKS = ", ip string, head string, payload string, kind string, info_id string"


def _arc_rows(with_block: bool):
    """Converted records of ARC files, with or without their blocks.

    With blocks, the version block of a file leads it, as a record of kind ``warcinfo``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, size, info = [], 0, None
                for r in read_arc(unzipped(data.as_py()), with_block):
                    name = record_id(r, path)
                    if with_block and info is None:
                        info = name
                        rows.append(_about(r, path, name))
                        continue
                    headers, head, payload = split_http(r.block)
                    row = {"archive": path, "offset": r.offset, "page": headers.get("x-page-id", "-"),
                           "payload_digest": digest(payload), "payload_bytes": len(payload),
                           "url": r.url, "date": iso_date(r.date), "record_id": name}
                    if with_block:
                        row |= {"ip": r.ip, "head": head.decode(), "payload": payload.decode(),
                                "kind": "response", "info_id": info}
                        size += len(r.block)
                    rows.append(row)
                    if size > 2 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _schema(with_block))
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _schema(with_block))

    return run


def _about(r: ArcRecord, path: str, name: str) -> dict:
    """What WARC says of a file, from an ARC file's version block."""
    lines = [line for line in r.block.decode("utf-8", "replace").split("\n") if line]
    fields = {"software": "pulsemill", "format": "WARC File Format 1.0", "isPartOf": r.url.removeprefix("filedesc://"),
              "description": f"converted from an ARC file of version {r.version}", "arc-version-line": lines[0],
              "arc-fields": lines[1]}
    return {"archive": path, "offset": r.offset, "page": "-", "payload_digest": "", "payload_bytes": 0, "url": r.url,
            "date": iso_date(r.date), "record_id": name, "ip": r.ip, "head": "".join(f"{k}: {v}\r\n" for k, v in fields.items()),
            "payload": "", "kind": "warcinfo", "info_id": name}


def _schema(with_block: bool) -> pa.Schema:
    longs = ("offset", "payload_bytes")
    names = [x.split()[0] for x in (_KEYS + (_BLOCKS if with_block else "")).split(", ")]
    return pa.schema([(n, pa.int64() if n in longs else pa.string()) for n in names])


def convert(spark: SparkSession, arcs: str, path: str, least_bytes: int = 0,
            archive_bytes: int = ARCHIVE_BYTES) -> str:
    """ARC archives to WARC archives; equal payloads become one response and revisits.

    Of records with equal payloads of at least ``least_bytes`` bytes, those of the smallest
    page are responses, the others revisits of it; smaller ones are all responses. The page
    is the X-Page-Id of the archived response; without one (``-``) a record counts last.
    Repeats of one page with one payload are all responses if theirs is the smallest page;
    revisits then name the one with the least identifier. Each ARC file's version block
    becomes a warcinfo record, which the file's records name.
    """
    small_batches(spark)
    files = _files(spark, arcs)
    found = saved(files.mapInArrow(_arc_rows(False), _KEYS), "arc_records")
    number = F.expr("try_cast(page as bigint)")
    origin = F.struct(number.alias("first"), "record_id", "url", "date")
    groups = found.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(
        F.min(F.when(number.isNotNull(), origin)).alias("origin"), F.count("*").alias("n"),
    ).where("n > 1 and origin is not null")
    revisits = saved(
        found.join(groups, ["payload_digest", "payload_bytes"])
        .where(~number.eqNullSafe(F.col("origin.first"))).select("archive", "offset", "origin"), "revisits")
    blocks = files.mapInArrow(_arc_rows(True), _KEYS + _BLOCKS)
    # joined by place in the archives: few revisits are broadcast, many are shuffled
    rows = blocks.join(revisits, ["archive", "offset"], "left")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                waiting.append(_warc_of(r))
                size += len(waiting[-1])
                if size >= archive_bytes:
                    yield _one(waiting)
                    waiting, size = [], 0
        if waiting:
            yield _one(waiting)

    def _one(records: list[bytes]) -> pa.RecordBatch:
        text = (_CRLF * 2).join(records).decode()
        return pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["value"])

    columns = ["page", "payload_digest", "payload_bytes", "url", "date", "ip", "record_id", "head", "payload", "kind",
               "info_id", "origin"]
    return _written(rows.select(*columns).mapInArrow(pack, "value string"), path, "\r\n\r\n")


def _warc_of(r: dict) -> bytes:
    """A converted record: warcinfo, response, or revisit with the response's head only."""
    head, payload = r["head"].encode(), r["payload"].encode()
    if r["kind"] == "warcinfo":
        return warc_record({
            "WARC-Type": "warcinfo", "WARC-Record-ID": r["record_id"], "WARC-Date": r["date"],
            "WARC-Filename": r["url"].removeprefix("filedesc://"), "WARC-Block-Digest": f"sha1:{digest(head)}",
            "Content-Type": "application/warc-fields"}, head)
    first = r["origin"]
    revisit = first is not None
    block = head if revisit else head + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": r["record_id"],
        "WARC-Date": r["date"],
        "WARC-Target-URI": r["url"],
        "WARC-Warcinfo-ID": r["info_id"],
        "WARC-IP-Address": r["ip"],
        "WARC-Payload-Digest": f"sha1:{r['payload_digest']}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http; msgtype=response",
        "Page-Id": r["page"],
        "Payload-Length": str(r["payload_bytes"]),
    }
    if revisit:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": first["record_id"],
                   "WARC-Refers-To-Target-URI": first["url"], "WARC-Refers-To-Date": first["date"],
                   "Refers-To-Page-Id": str(first["first"])}
    return warc_record(fields, block)


_READ = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
         "record_id string, warc_date string, target_uri string, refers_to_record string, warcinfo_id string")


def read_warcs(spark: SparkSession, path: str) -> DataFrame:
    """Rows (page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, ...).

    Block digests are checked while reading; of a response the payload's too. Warcinfo
    records are checked and give no row.
    """
    small_batches(spark)
    names = [x.split()[0] for x in _READ.split(", ")]
    longs = ("page_id", "payload_bytes", "refers_to")
    schema = pa.schema([(n, pa.int64() if n in longs else pa.string()) for n in names])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                out = []
                for fields, block in read_warc(unzipped(data.as_py())):
                    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
                        raise ValueError(f"damaged block of {fields['WARC-Record-ID']}")
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    own, n = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["Payload-Length"])
                    if kind == "response":
                        payload = split_http(block)[2]
                        if (digest(payload), len(payload)) != (own, n):
                            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
                    page, first = fields["Page-Id"], fields.get("Refers-To-Page-Id")
                    out.append((
                        None if page == "-" else int(page), n, own, kind, None if first is None else int(first),
                        fields["WARC-Record-ID"], fields["WARC-Date"], fields["WARC-Target-URI"],
                        fields.get("WARC-Refers-To"), fields["WARC-Warcinfo-ID"]))
                columns = list(zip(*out, strict=True)) if out else [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return _files(spark, path).mapInArrow(rows, _READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages to ARC, ARC to WARC, and what the WARC archives say.

    Empty tables give no rows. A null html is an empty payload; a null page_id stays null.
    Other columns are left out.
    """
    spark = pages.sparkSession
    small_batches(spark)
    arcs = write_arcs(pages, scratch_path(spark, "arc"))
    return read_warcs(spark, convert(spark, arcs, scratch_path(spark, "warc")))
