"""Legacy archives to WARC: ARC records of both versions are parsed by their header lines and declared lengths, and WARC
identifiers, timestamps, types and digests are made from them.

Archives are written by Spark's text writer with the record end as its line separator, gzipped, so that they go to
any file system that Spark writes to; they are read back line by line, without holding a file in memory, and records are
put together by their declared lengths.
"""

import base64
import hashlib
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import shared_dir, small_batches

#: Fields of an ARC record's header line, by version of the format.
ARC_FIELDS = {
    1: ("url", "ip", "date", "content_type", "length"),
    2: ("url", "ip", "date", "content_type", "result_code", "checksum", "location", "offset", "filename", "length"),
}
#: How an ARC file's version block spells those fields.
ARC_NAMES = {"url": "URL", "ip": "IP-address", "date": "Archive-date", "content_type": "Content-type", "result_code": "Result-code", "checksum": "Checksum", "location": "Location", "offset": "Offset", "filename": "Filename", "length": "Archive-length"}
#: The archive date of pages that have none.
ARC_DATE = "20240101000000"


def arc_record(version: int, url: str | None, payload: bytes, date: str = ARC_DATE, name: str = "pages.arc", offset: int = 0) -> bytes:
    """A record of a legacy archive: header line, newline, payload, newline."""
    safe = quote(url or "-", safe="!#$%&'()*+,/:;=?@[]~-._") or "-"
    head = {"url": safe, "ip": "0.0.0.0", "date": date, "content_type": "text/html", "result_code": "200", "checksum": hashlib.md5(payload).hexdigest(), "location": "-", "offset": str(offset), "filename": name, "length": str(len(payload))}
    return " ".join(head[f] for f in ARC_FIELDS[version]).encode() + b"\n" + payload + b"\n"


def arc_file(version: int, rows: list[tuple[str | None, bytes]], name: str = "pages.arc") -> bytes:
    """A legacy archive of (url, payload) rows: the version block, which tells the version and the fields of its header lines, and a record each."""
    block = f"{version} 0 tidewatch\n{' '.join(ARC_NAMES[f] for f in ARC_FIELDS[version])}\n".encode()
    parts, size = [arc_record(version, f"filedesc://{name}", block, name=name).replace(b" text/html ", b" text/plain ", 1)], 0
    for url, payload in rows:
        size += len(parts[-1])
        parts.append(arc_record(version, url, payload, name=name, offset=size))
    return b"".join(parts)


def arc_records(data: bytes):
    """(header fields, payload) of the records of a legacy archive; which fields a header line has is told by the version block."""
    head, block, at = parse_arc(data)
    if not head["url"].startswith("filedesc://"):
        raise ValueError("an ARC file begins with its version block")
    first, _, rest = block.decode().partition("\n")
    keys = {name: key for key, name in ARC_NAMES.items()}
    fields = tuple(keys.get(x, x) for x in rest.split("\n", 1)[0].split(" "))
    if fields != ARC_FIELDS.get(int(first.split(" ", 1)[0])):
        raise ValueError(f"not a known version of ARC: {first}")
    while at < len(data):
        head, payload, at = parse_arc(data, at, fields)
        yield head, payload


def parse_arc(data: bytes, at: int = 0, fields: tuple[str, ...] | None = None) -> tuple[dict, bytes, int]:
    """Header fields, payload and end of the record at `at`; the payload's end is in its declared length. Without fields, those of
    the version whose number of them fits."""
    end = data.index(b"\n", at)
    parts = data[at:end].decode("utf-8", "replace").split(" ")
    fields = fields or next((f for f in ARC_FIELDS.values() if len(f) == len(parts)), ())
    if len(fields) != len(parts):
        raise ValueError(f"not an ARC header line: {parts[:3]}")
    head = dict(zip(fields, parts, strict=True))
    start, stop = end + 1, end + 1 + int(head["length"])
    if stop > len(data) or data[stop : stop + 1] != b"\n":
        raise ValueError("an ARC record is not as long as it declares")
    return head, data[start:stop], stop + 1


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def to_warc(head: dict, payload: bytes, page_id: int | None, refers_to: int | None) -> bytes:
    """The WARC record of an ARC record, without the two line ends that follow it; refers_to makes it a revisit, whose block is empty."""
    digest, d = digest32(payload), head["date"].ljust(14, "0")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Target-URI: {head['url']}", f"WARC-Date: {d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z", f"WARC-IP-Address: {head['ip']}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}", f"X-Page-Id: {'' if page_id is None else page_id}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    block = payload if refers_to is None else b""
    lines += [f"Content-Type: {head['content_type']}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _convert(batches):
    """(page_id, url, html, first) to WARC records, by way of a legacy archive of either version for each batch."""
    for n, b in enumerate(batches):
        pages, urls, texts, firsts = (b.column(c).to_pylist() for c in ("page_id", "url", "html", "first"))
        legacy = arc_file(1 + n % 2, [(u, (t or "").encode()) for u, t in zip(urls, texts, strict=True)])
        out = [to_warc(head, payload, page, None if first == page else first) for (head, payload), page, first in zip(arc_records(legacy), pages, firsts, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in out], pa.string())], names=["value"])


def _records(lines):
    """(headers, block) of each record out of an archive's lines; the block ends where its declared length says."""
    head: dict[str, str] | None = None
    block, need = [], 0
    for line in lines:
        raw = line.encode()
        if need:
            block.append(raw + b"\n")
            need -= len(raw) + 1
            if need < 0:
                raise ValueError("a WARC record is not as long as it declares")
            if not need:
                data = b"".join(block)
                if data[-4:] != b"\r\n\r\n":
                    raise ValueError("a WARC record is not as long as it declares")
                yield head, data[:-4]
                head, block = None, []
        elif head is None:
            if line != "WARC/1.1\r":
                raise ValueError(f"not the start of a WARC record: {line[:40]!r}")
            head = {}
        elif line == "\r":
            need = int(head["content-length"]) + 4
        else:
            name, _, value = line.rstrip("\r").partition(": ")
            head[name.lower()] = value
    if head is not None:
        raise ValueError("a WARC record is cut off")


def _read(batches):
    def lines():
        for b in batches:
            yield from b.column(0).to_pylist()

    def table(rows):
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    rows = []
    for head, block in _records(lines()):
        kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and digest32(block) != digest:
            raise ValueError(f"the payload of {head['warc-record-id']} is not that of its digest")
        number = lambda x: int(x) if x else None
        rows.append((number(head["x-page-id"]), head["warc-target-uri"], len(block) if kind == "response" else int(head["x-payload-length"]), digest, kind, number(head.get("x-refers-to-page"))))
        if len(rows) == 2000:
            yield table(rows)
            rows = []
    if rows:
        yield table(rows)


def write_archives(pages: DataFrame, path: str, revisit_min: int = 0) -> None:
    """Writes gzipped WARC files to `path`, a record for each row of pages (page_id, url, html).

    Of equal payloads of at least revisit_min bytes, the one with the smallest page_id is the response, others revisit it.
    A null html is an empty payload; rows with a null page_id are responses of their own; rows that share page_id and
    payload are responses each; other columns are ignored; an empty table writes no record.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    # which record each page refers to: found on digests, so that payloads move once, by their unique page_id
    digests = rows.select("page_id", F.sha1(F.encode("html", "UTF-8")).alias("digest"), F.octet_length("html").alias("size")).where(F.col("page_id").isNotNull() & (F.col("size") >= revisit_min))
    first = digests.groupBy("digest", "size").agg(F.min("page_id").alias("first"))
    decided = digests.join(first, ["digest", "size"]).where("first < page_id").select("page_id", "digest", "first").distinct()
    keyed = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8"))).join(decided, ["page_id", "digest"], "left")
    records = keyed.select("page_id", "url", "html", F.coalesce("first", "page_id").alias("first")).mapInArrow(_convert, "value string")
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files: page_id, url, payload_bytes, payload_digest, record_type, refers_to. A payload that doesn't
    match its digest or a record of another length than declared is an error."""
    small_batches(spark)
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return spark.read.option("lineSep", "\n").text(path).mapInArrow(_read, schema)


def archived(pages: DataFrame, revisit_min: int = 0) -> DataFrame:
    """Writes the archives to the shared folder and reads them back: a row for each row of pages."""
    path = f"{shared_dir(pages.sparkSession)}/tidewatch/{uuid.uuid4().hex}.warc"
    write_archives(pages, path, revisit_min)
    return read_archives(pages.sparkSession, path)
