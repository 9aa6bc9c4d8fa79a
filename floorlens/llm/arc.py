"""Legacy ARC archives and their conversion to WARC.

An ARC archive starts with a version block whose second line names the version; it fixes how many fields a
record's header line has. The last field is the declared length of the content that follows. Conversion
parses by these lengths and synthesises what WARC wants and ARC lacks: record ids (name-based UUIDs, so a
task that runs again gives the same), ISO timestamps, record types and digests. Of records with equal
payloads of at least ``DEDUP_BYTES`` the one with the smallest page id stays a response, others become
revisits that carry the HTTP head only.

Archives are files of about ``ARCHIVE_BYTES`` in the shared folder, written and read by Spark, so a lost task
is simply run again. A record longer than that has an archive of its own.

Defined cases: a null page counts as empty; a null URL is written as ``about:blank`` and blanks in URLs are
percent-coded; rows with the smallest page id of their payload are all responses, also if repeated; a
null page id is never the smallest one unless all are null; an empty table gives empty archives and no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens.session import pin, shared_folder

ARCHIVE_BYTES = 16 << 20
DEDUP_BYTES = 100
CRAWLED = "19990101000000"
#: Field names of a record's header line by version: fixed values of the format.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _grouped(records: Iterator[bytes], opening: bytes, limit: int) -> Iterator[pa.RecordBatch]:
    """Archives of joined records, each one row of text."""
    held, size = [], 0
    for record in records:
        if held and size + len(record) > limit:
            yield pa.RecordBatch.from_arrays([pa.array([opening + b"".join(held)]).cast(pa.string())], ["archive"])
            held, size = [], 0
        held.append(record)
        size += len(record)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([opening + b"".join(held)]).cast(pa.string())], ["archive"])


def _stored(archives: DataFrame, suffix: str) -> DataFrame:
    """Write one compressed file per archive; back come ``path`` and ``content`` of all files."""
    path = f"{shared_folder(archives.sparkSession)}/{suffix}-{uuid.uuid4().hex}"
    archives.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    return archives.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")


def arc_record(version: int, url: str, head: bytes, payload: bytes) -> bytes:
    block = head + payload
    values = {
        "URL": re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) or "about:blank",
        "IP-address": "0.0.0.0", "Archive-date": CRAWLED, "Content-type": "text/html", "Result-code": "200",
        "Checksum": hashlib.md5(block).hexdigest(), "Location": "-", "Offset": "0", "Filename": "-",
        "Archive-length": str(len(block)),
    }
    return " ".join(values[f] for f in FIELDS[version].split()).encode() + b"\n" + block + b"\n"


def version_block(version: int) -> bytes:
    body = f"{version} 0 floorlens\n{FIELDS[version]}\n".encode()
    return f"filedesc://floorlens.arc 0.0.0.0 {CRAWLED} text/plain {len(body)}\n".encode() + body + b"\n"


def write_arc(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write each page as an HTTP response into ARC archives; every task alternates between both versions."""
    rows = pages.select(F.col(key).cast("string"), F.coalesce(url, F.lit("")), F.coalesce(F.col(html), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, batch in enumerate(batches):
            version = at % 2 + 1

            def records(batch: pa.RecordBatch = batch, version: int = version) -> Iterator[bytes]:
                for page, address, text in zip(*(c for c in batch.columns)):
                    payload = text.as_py().encode()
                    own = page.as_py()
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
                    head += f"X-Page-Id: {'' if own is None else own}\r\n\r\n"
                    yield arc_record(version, address.as_py(), head.encode(), payload)

            yield from _grouped(records(), version_block(version), limit)

    return _stored(rows.mapInArrow(run, "archive string"), "arc")


def read_arc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of each record of an ARC archive."""
    at, fields = 0, None
    while at < len(content):
        if content[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = content.index(b"\n", at)
        values = content[at:end].decode().split(" ")
        length = int(values[-1])
        block = content[end + 1 : end + 1 + length]
        if len(block) < length:
            raise ValueError("an ARC record is shorter than its declared length")
        if fields is None:
            fields = FIELDS[int(block.split(b" ", 1)[0])].split()
        else:
            if len(values) != len(fields):
                raise ValueError("an ARC header line does not have its version's fields")
            yield dict(zip(fields, values)), block
        at = end + 1 + length


def _head(block: bytes, name: str) -> str:
    found = re.search(rb"\r\n" + name.encode() + rb": ([^\r\n]*)", b"\r\n" + block)
    return found[1].decode() if found else ""


def parse_arc(archives: DataFrame, payloads: bool) -> DataFrame:
    """Per ARC record: page_id (text), url, date, HTTP head, digest and size of the payload; the payload if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in read_arc(zlib.decompress(content.as_py(), 31)):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    page = _head(head, "X-Page-Id")
                    row = (page or None, hashlib.sha256(payload).hexdigest(), len(payload))
                    if payloads:
                        row += (fields["URL"], fields["Archive-date"], fields["IP-address"], head + b"\r\n\r\n", payload)
                    rows.append(row)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = ["page_id", "digest", "size"] + ["url", "date", "ip", "head", "payload"] * payloads
    types = [pa.string(), pa.string(), pa.int64()] + [pa.string()] * 3 * payloads + [pa.binary()] * 2 * payloads
    schema = "page_id string, digest string, size long" + ", url string, date string, ip string, head binary, payload binary" * payloads
    return archives.mapInArrow(run, schema)


def record_id(page: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def warc_record(row: dict) -> bytes:
    """A response or revisit record; a revisit keeps the HTTP head and refers to its response."""
    d = row["date"]
    block = row["head"] + (row["payload"] if row["first"] is None else b"")
    head = {
        "WARC-Type": "response" if row["first"] is None else "revisit",
        "WARC-Record-ID": record_id(row["page_id"]),
        "WARC-Date": f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
        "WARC-Target-URI": row["url"],
        "WARC-IP-Address": row["ip"],
        "WARC-Payload-Digest": f"sha256:{row['digest']}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "X-Page-Id": row["page_id"] or "",
    }
    if row["first"] is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(row["first"]), "X-Refers-To-Page-Id": row["first"]}
    lines = "".join(f"{k}: {v}\r\n" for k, v in (head | {"Content-Length": len(block)}).items())
    return b"WARC/1.0\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def convert(archives: DataFrame, dedup_bytes: int = DEDUP_BYTES, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write WARC archives from ARC archives.

    Payloads met more than once are found from digests alone; the join that looks them up is left to
    Spark, which splits it where many records share a payload.
    """
    found = parse_arc(archives, payloads=False).where(F.col("size") >= dedup_bytes)
    firsts = pin(
        found.groupBy("digest").agg(F.min(F.col("page_id").cast("long")).alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL").select("digest", "first")
    )
    rows = parse_arc(archives, payloads=True).join(firsts, "digest", "left")
    later = (F.col("size") >= dedup_bytes) & ~F.col("page_id").cast("long").eqNullSafe(F.col("first"))
    rows = rows.withColumn("first", F.when(later, F.col("first").cast("string")))
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = (warc_record({n: v.as_py() for n, v in zip(names, row)}) for row in zip(*batch.columns))
            yield from _grouped(records, b"", limit)

    return _stored(rows.mapInArrow(run, "archive string"), "warc")


def read_warc(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Header and block of each record of a WARC archive."""
    at = 0
    while (at := content.find(b"WARC/1.0\r\n", at)) >= 0:
        end = content.index(b"\r\n\r\n", at)
        head = content[at:end]
        length = int(_head(head, "Content-Length"))
        yield head, content[end + 4 : end + 4 + length]
        at = end + 4 + length + 4


def parse_warc(archives: DataFrame) -> DataFrame:
    """Per WARC record: page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, url, date.

    The digest of a response is taken from its payload and must agree with its header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for head, block in read_warc(zlib.decompress(content.as_py(), 31)):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind, digest = _head(head, "WARC-Type"), _head(head, "WARC-Payload-Digest").partition(":")[2]
                    size = int(_head(http, "Content-Length"))
                    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                        raise ValueError("a WARC payload does not agree with its header")
                    page, refers = _head(head, "X-Page-Id"), _head(head, "X-Refers-To-Page-Id")
                    rows.append((
                        int(page) if page else None, size, digest, kind, int(refers) if refers else None,
                        _head(head, "WARC-Record-ID"), _head(head, "WARC-Target-URI"), _head(head, "WARC-Date"),
                    ))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url", "date"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return archives.mapInArrow(
        run,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string, date string",
    )
