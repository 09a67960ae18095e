"""Legacy archives (ARC) and their conversion to WARC.

An ARC file starts with a version block, whose text names the version and the fields of
the header lines, and goes on with records: one header line, the declared number of
bytes, one line feed. Version 1 lines have five fields, version 2 lines ten. The
converter reads lines and lengths as declared, and writes for each document a WARC
record with an identifier derived from its content, the ISO form of its 14-digit date,
its type and digests.

Tasks build whole files of about FILE_BYTES and Spark's text writer stores each row as
one compressed file, so files are committed like those of any Spark job and read back
whole. Which records repeat a payload is decided over digests alone; the payloads never
move between tasks, only compressed files meet their file's list of revisits.

Defined cases: null html is an empty payload. Null or blank addresses become
``about:blank``; white space and control characters in them are percent-encoded. A null
page_id is written as an empty header and read back as null, after all others in order.
Rows that repeat a page_id are records of their own; records alike in everything share
their identifier. An empty table gives an empty result. Other columns than page_id, url and
html are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import python_workers, stored
from ledgerlake.session import work_folder

FILE_BYTES = 4 * 1024 * 1024
#: Payloads below this many bytes are always stored in full.
LEAST_REVISIT = 100
#: The pages carry no time of capture; the archive gives them this one.
CAPTURED = "20260101000000"
# The header fields that each version of the format defines.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset"
    " Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LAST = 2**63 - 1  # stands for a null page_id where the smallest is looked for


def version_block(version: int) -> bytes:
    """The block an ARC file of a version starts with."""
    body = f"{version} 0 ledgerlake\n{FIELDS[version]}\n".encode()
    line = f"filedesc://pages.arc 0.0.0.0 {CAPTURED} text/plain {len(body)}\n"
    return line.encode() + body + b"\n"


def arc_record(version: int, page_id: int | None, url: str | None, html: str | None) -> bytes:
    payload = (html or "").encode("utf-8", "surrogatepass")
    address = re.sub(
        r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", (url or "").strip()
    ) or "about:blank"
    page = "" if page_id is None else page_id
    block = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"X-Page-Id: {page}\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode() + payload
    fields = [address, "0.0.0.0", CAPTURED, "text/html"]
    if version == 2:
        fields += ["200", hashlib.md5(block).hexdigest(), "-", "0", "pages.arc"]
    return f"{' '.join(fields)} {len(block)}\n".encode() + block + b"\n"


@dataclass(frozen=True)
class ArcRecord:
    url: str
    date: str
    block: bytes


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of one ARC file, by the fields of its version and their declared lengths.

    A line or length that does not hold raises.
    """
    names: list[str] = []
    at = 0
    while at < len(data):
        if data[at] == 0x0A:  # the line feed between records
            at += 1
            continue
        end = data.index(b"\n", at)
        line, begin = data[at:end].decode("utf-8"), end + 1
        if not names and line.startswith("filedesc://"):  # the file's first line; later a url
            at = begin + int(line.rsplit(" ", 1)[1])
            names = FIELDS[int(data[begin:at].split(b" ", 1)[0])].split(" ")
            continue
        values = line.split(" ")
        if not names or len(values) != len(names):
            raise ValueError(f"{len(values)} header fields where {len(names)} are defined")
        of = dict(zip(names, values, strict=True))
        at = begin + int(of["Archive-length"])
        if at > len(data):
            raise ValueError(f"{of['Archive-length']} bytes declared, {len(data) - begin} there")
        yield ArcRecord(of["URL"], of["Archive-date"], data[begin:at])


def http_parts(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers of an HTTP response by lower-case name, the head itself, and the body."""
    head, gap, body = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}, head + gap, body


def iso_date(date: str) -> str:
    """``20260101000000`` as ``2026-01-01T00:00:00Z``."""
    return re.sub(r"^(....)(..)(..)(..)(..)(..)$", r"\1-\2-\3T\4:\5:\6Z", date)


def record_id(record: ArcRecord) -> str:
    name = f"{record.url} {record.date} {hashlib.sha256(record.block).hexdigest()}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def warc_record(record: ArcRecord, revisits: str | None = None) -> bytes:
    """The WARC record of a document; as a revisit it keeps the HTTP head only."""
    _, head, body = http_parts(record.block)
    block = head if revisits else record.block
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisits else 'response'}",
        f"WARC-Record-ID: {record_id(record)}",
        f"WARC-Date: {iso_date(record.date)}",
        f"WARC-Target-URI: {record.url}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(body).hexdigest()}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisits:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {revisits}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def warc_info() -> bytes:
    body = b"software: ledgerlake\r\nformat: WARC File Format 1.1\r\n"
    head = (
        "WARC/1.1\r\nWARC-Type: warcinfo\r\n"
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, CAPTURED)}>\r\n"
        f"WARC-Date: {iso_date(CAPTURED)}\r\nContent-Type: application/warc-fields\r\n"
        f"Content-Length: {len(body)}\r\n\r\n"
    )
    return head.encode() + body + b"\r\n\r\n"


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of every record, by declared lengths."""
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
        at = end + 4 + int(headers["content-length"])
        if at > len(data):
            raise ValueError("a record is longer than its file")
        yield headers, data[end + 4 : at]


def _write_files(files: DataFrame, path: str) -> None:
    """Store each row of a binary column as one compressed file."""
    (
        files.select(F.col("content").cast("string"))
        .write.option("maxRecordsPerFile", 1)
        .option("compression", "gzip")
        .text(path)
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _grouped(records: Iterable[bytes], opening: bytes) -> Iterator[bytes]:
    """Whole files of about FILE_BYTES, each with its opening."""
    parts, size = [opening], 0
    for record in records:
        parts.append(record)
        size += len(record)
        if size >= FILE_BYTES:
            yield b"".join(parts)
            parts, size = [opening], 0
    if size:
        yield b"".join(parts)


def _as_files(rows: DataFrame, records: Callable, opening: bytes) -> DataFrame:
    def build(batches):
        each = (record for batch in batches for record in records(batch))
        for content in _grouped(each, opening):
            yield pa.RecordBatch.from_pydict({"content": pa.array([content], pa.binary())})

    return rows.mapInArrow(build, "content binary")


def write_arc(pages: DataFrame, path: str, version: int) -> None:
    """Store pages as ARC files of one version below a folder."""
    python_workers(pages.sparkSession)

    def records(batch):
        for row in batch.to_pylist():
            yield arc_record(version, row["page_id"], row["url"], row["html"])

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    _write_files(_as_files(rows, records, version_block(version)), path)


FOUND = "path string, place int, page_id long, record_id string, payload_bytes long, digest string"


def captures(files: DataFrame) -> DataFrame:
    """Per record of the ARC files: where it stands, its page, identifier and payload digest."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for place, record in enumerate(read_arc(gzip.decompress(row["content"]))):
                    headers, _, body = http_parts(record.block)
                    page = headers["x-page-id"]
                    out.append(
                        {
                            "path": row["path"],
                            "place": place,
                            "page_id": int(page) if page else None,
                            "record_id": record_id(record),
                            "payload_bytes": len(body),
                            "digest": hashlib.sha256(body).hexdigest(),
                        }
                    )
                schema = pa.schema(
                    [
                        ("path", pa.string()),
                        ("place", pa.int32()),
                        ("page_id", pa.int64()),
                        ("record_id", pa.string()),
                        ("payload_bytes", pa.int64()),
                        ("digest", pa.string()),
                    ]
                )
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return files.mapInArrow(read, FOUND)


def revisit_lists(found: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Per ARC file the places of its revisits and the identifiers they refer to.

    Of records with equal payloads the one of the smallest page_id is the response. The
    firsts are stored, so that Spark splits the join where one payload is very common.
    A list has no more entries than its file has records.
    """
    large = found.where(F.col("payload_bytes") >= least).withColumn(
        "page", F.coalesce("page_id", F.lit(LAST))
    )
    first = stored(
        large.groupBy(F.col("digest").alias("same"))
        .agg(
            F.min(F.struct("page", "path", "place", "record_id")).alias("first"),
            F.count("*").alias("copies"),
        )
        .where("copies > 1")
        .select("same", "first.*")
        .select(
            "same",
            F.col("path").alias("first_path"),
            F.col("place").alias("first_place"),
            F.col("record_id").alias("refers"),
        ),
        "arc-firsts",
    )
    again = large.join(first, F.col("digest") == F.col("same")).where(
        (F.col("path") != F.col("first_path")) | (F.col("place") != F.col("first_place"))
    )
    return again.groupBy("path").agg(
        F.collect_list(F.struct("place", "refers")).alias("revisits")
    )


def convert(files: DataFrame, revisits: DataFrame, path: str) -> None:
    """Write the WARC files of ARC files below a folder."""
    lists = stored(revisits, "arc-revisits").withColumnRenamed("path", "of_path")
    rows = files.join(lists, F.col("path") == F.col("of_path"), "left").select(
        "content", "revisits"
    )

    def records(batch):
        for row in batch.to_pylist():
            refers = {r["place"]: r["refers"] for r in row["revisits"] or ()}
            for place, record in enumerate(read_arc(gzip.decompress(row["content"]))):
                yield warc_record(record, refers.get(place))

    _write_files(_as_files(rows, records, warc_info()), path)


READ = (
    "page_id long, record_id string, record_type string, refers string, "
    "payload_bytes long, payload_digest string, url string, date string"
)


def read_records(files: DataFrame) -> DataFrame:
    """Per response and revisit of WARC files: its page and headers.

    The payload of a response is digested again and must be what its header says.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("record_id", pa.string()),
            ("record_type", pa.string()),
            ("refers", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("url", pa.string()),
            ("date", pa.string()),
        ]
    )

    def row(headers, block):
        http, _, body = http_parts(block)
        digest = headers["warc-payload-digest"].removeprefix("sha256:")
        kind, size = headers["warc-type"], int(http["content-length"])
        if kind == "response" and (
            len(body) != size or hashlib.sha256(body).hexdigest() != digest
        ):
            raise ValueError(f"payload of {headers['warc-record-id']} is damaged")
        page = http["x-page-id"]
        return {
            "page_id": int(page) if page else None,
            "record_id": headers["warc-record-id"],
            "record_type": kind,
            "refers": headers.get("warc-refers-to"),
            "payload_bytes": size,
            "payload_digest": digest,
            "url": headers["warc-target-uri"],
            "date": headers["warc-date"],
        }

    def read(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                out = [
                    row(headers, block)
                    for headers, block in read_warc(gzip.decompress(content))
                    if headers["warc-type"] != "warcinfo"
                ]
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return files.mapInArrow(read, READ)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Pages through both versions of ARC into WARC and back.

    Returns per page: page_id, payload_bytes, payload_digest, record_type, refers_to (the
    page_id of the response a revisit refers to), url and date.
    """
    spark = pages.sparkSession
    arc, warc = work_folder(spark, "arc"), work_folder(spark, "warc")
    odd = F.coalesce(F.col("page_id").cast("long") % 2 != 0, F.lit(False))
    write_arc(pages.where(~odd), f"{arc}/version=1", 1)
    write_arc(pages.where(odd), f"{arc}/version=2", 2)
    files = _files(spark, arc)
    found = stored(captures(files), "arc-records")
    convert(files, revisit_lists(found), warc)
    back = stored(read_records(_files(spark, warc)), "warc-records")
    responses = stored(
        back.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("response_id"))
        .agg(F.min("page_id").alias("refers_to")),
        "warc-responses",
    )
    return back.join(
        responses,
        (F.col("refers") == F.col("response_id")) & (F.col("record_type") == "revisit"),
        "left",
    ).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "date"
    )
