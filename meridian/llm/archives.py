"""Legacy web archives (ARC) to WARC.

An ARC file begins with a version block, whose first line is like that of a record and whose body names the version and the
fields of the later header lines: five in version 1, ten in version 2. Each record is such a line, then as many bytes as the
line's last field says. The converter makes of each record what WARC wants besides: an identifier (a UUID of the archive's
name and the record's place, so a repeated run gives the same), a timestamp (ISO 8601), a type (response for HTTP, else
resource; revisit for a payload that another record has), and digests of block and payload (SHA-1 in base 32).

Which record of equal payloads stays is settled on narrow rows (digests, no payloads) that are aggregated before they are
exchanged. The records, payloads compressed, then meet that verdict in a join that Spark can split where one payload is
very common; where few payloads repeat, the verdicts are small, and Spark sends them to the records instead.

Archives are written by Spark's text writer, whose line separator is what stands between records, gzip over the whole
file; a cast binary column keeps any bytes. They are read as whole files by one task each, which decompresses as it goes.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import batched, durable

#: The header lines of both versions, and the profile of a revisit.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: A header line of each version. URLs and types of old crawls may have blanks, so the fields between decide.
_LINE = {
    1: re.compile(rb"(?P<url>.*) (?P<ip>\S+) (?P<date>\d{8,14}) (?P<mime>.*) (?P<length>\d+)"),
    2: re.compile(rb"(?P<url>.*) (?P<ip>\S+) (?P<date>\d{8,14}) (?P<mime>.*) (?P<status>\d+|-) \S+ \S+ (?:\d+|-) \S+ (?P<length>\d+)"),
}
_BLANK = re.compile(rb"[\x00-\x20\x7f]")
#: Bytes of records that one Arrow batch has, about.
_BATCH = 4 << 20


# ---- records of both kinds


def opened(content: bytes) -> io.BufferedIOBase:
    """The archive as a stream, decompressed as it is read; any number of gzip members."""
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def split_http(doc: bytes) -> tuple[bytes, bytes]:
    """Head, with the blank line that ends it, and body of an HTTP response; what isn't one has no head."""
    if not doc.startswith(b"HTTP/"):
        return b"", doc
    ends = [(at, at + len(gap)) for gap in (b"\r\n\r\n", b"\n\n") if (at := doc.find(gap)) >= 0]
    end = min(ends)[1] if ends else len(doc)
    return doc[:end], doc[end:]


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("latin-1").strip() if found else None


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class Broken(Exception):
    """An archive that can't be read on; said in a row of its own."""


def _line(stream) -> bytes:
    """The next line that isn't blank, without its end; nothing at the end of the file."""
    while line := stream.readline():
        if line.strip(b"\r\n"):
            return line.rstrip(b"\r\n")
    return b""


def _body(stream, length: int) -> bytes:
    body = stream.read(length)
    if len(body) < length:
        raise Broken(f"{length} bytes declared, {len(body)} left")
    return body


def arc_records(content: bytes) -> Iterator[dict]:
    """The records of one ARC file: place, url, ip, date, mime and doc. Broken ends it."""
    stream = opened(content)
    first = _line(stream)
    if not first:
        return
    # the version block's own line is of version 1 or 2, whatever its body says of later ones
    for head in _LINE.values():
        if first.startswith(b"filedesc:") and (m := head.fullmatch(first)):
            said = re.match(rb"\s*(\d+)", _body(stream, int(m["length"])))
            break
    else:
        raise Broken("no version block")
    if not said or int(said[1]) not in _LINE:
        raise Broken("a version that is neither 1 nor 2")
    made, pattern, place = m["date"], _LINE[int(said[1])], 0
    while line := _line(stream):
        m = pattern.fullmatch(line)
        if not m:
            raise Broken(f"record {place} has no header line of version {int(said[1])}")
        yield {"place": place, "made": made} | {k: m[k] for k in ("url", "ip", "date", "mime")} | {"doc": _body(stream, int(m["length"]))}
        place += 1


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields, by lower-case name, and block of each record of one WARC file. Broken ends it."""
    stream = opened(content)
    while line := _line(stream):
        if not line.startswith(b"WARC/"):
            raise Broken("a record doesn't begin with its version")
        fields, name = {}, ""
        while line := stream.readline().rstrip(b"\r\n"):
            if line[:1] in b" \t" and name:
                fields[name] += " " + line.strip().decode()
                continue
            name, _, value = line.decode("utf-8", "replace").partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
        if not fields.get("content-length", "").isdigit():
            raise Broken("a record without its length")
        yield fields, _body(stream, int(fields["content-length"]))


_BAD = (Broken, OSError, EOFError, zlib.error, UnicodeDecodeError)


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a thousand or about _BATCH bytes."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, bytes))
        if size > _BATCH or len(out) == 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _files(spark: SparkSession, folder: str, parse, columns: str) -> DataFrame:
    """The rows that parse(name, content) gives for each file of the folder; where it breaks off, a last row with its fault."""

    def rows(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                name = path.rpartition("/")[2]
                try:
                    yield from parse(name, content.as_py())
                except _BAD as error:
                    yield {"archive": name, "fault": str(error) or type(error).__name__}

    @batched
    def run(batches):
        yield from _batches(rows(batches), _schema(columns))

    return spark.read.format("binaryFile").load(folder).select("path", "content").mapInArrow(run, columns)


def _write(records: DataFrame, folder: str, between: str) -> None:
    """records(value binary), each followed by what stands between, in one gzip file for each partition; speed goes before size."""
    lines = records.select(F.col("value").cast("string").alias("value"))
    lines.write.options(compression="gzip", lineSep=between, **{"zlib.compress.level": "BEST_SPEED"}).text(folder)


# ---- ARC


def _framed(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    """One ARC file of a task's captures: its version block, then a record for each. Tasks take turns with the versions."""
    part = TaskContext.get().partitionId()
    version = 1 + part % 2
    body = f"{version} 0 crawl\n{FIELDS[version]}\n".encode()
    name = f"part-{part:05d}.arc"
    fields = f"filedesc://{name} 0.0.0.0 {date} text/plain " + ("" if version == 1 else f"200 - - 0 {name} ")
    start = f"{fields}{len(body)}\n".encode() + body
    offset = 0

    def records():
        nonlocal offset
        yield {"value": start}
        offset += len(start) + 1
        for batch in batches:
            for url, ip, mime, doc in zip(*(batch.column(c).to_pylist() for c in ("url", "ip", "mime", "doc"))):
                url = _BLANK.sub(lambda m: b"%%%02X" % m[0][0], (url or "-").encode())
                more = b"" if version == 1 else f" 200 - - {offset} {name}".encode()
                row = b"%s %s %s %s%s %d\n%s" % (url, ip.encode(), date.encode(), mime.encode(), more, len(doc), doc)
                yield {"value": row}
                offset += len(row) + 1

    yield from _batches(records(), pa.schema([("value", pa.binary())]))


def write_arc(captures: DataFrame, folder: str, date: str) -> None:
    """captures(url, ip, mime, doc binary) as ARC files, one for each partition, of versions 1 and 2 by turns."""
    records = captures.select("url", "ip", "mime", "doc").mapInArrow(batched(lambda batches: _framed(batches, date)), "value binary")
    _write(records, folder, "\n")


_ARC = "archive string, fault string, record_id string, url string, ip string, date string, mime string, page_id long, n_bytes long, payload_digest string, payload_key binary"


def _schema(columns: str) -> pa.Schema:
    return pa.schema([(k, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[v]) for k, v in (c.split() for c in columns.split(", "))])



def timestamp(digits: bytes) -> str:
    """WARC's form of an ARC date of 8 to 14 digits; missing ones are the earliest."""
    d = digits.decode() + "00000101000000"[len(digits) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def read_arc(spark: SparkSession, folder: str, with_doc: bool) -> DataFrame:
    """The records of the ARC files in the folder; with_doc adds `doc`, compressed.

    page_id is the whole number in the X-Page-Id field of the HTTP head, null where there is none. A file that is cut
    off, has a bad header line or is no ARC file gives the records before the fault, then a row that has only the file's name and the fault.
    """

    def parse(name, content):
        zip_ = zstandard.ZstdCompressor(level=3)
        for r in arc_records(content):
            head, payload = split_http(r["doc"])
            page = http_field(head, "X-Page-Id")
            row = {
                "archive": name,
                "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{r['place']}')}>",
                "url": r["url"].decode("utf-8", "replace"),
                "ip": r["ip"].decode("latin-1"),
                "date": timestamp(r["date"]),
                "mime": r["mime"].decode("latin-1"),
                "page_id": int(page) if page and re.fullmatch(r"-?\d{1,18}", page) else None,
                "n_bytes": len(payload),
                "payload_digest": sha1(payload),
                "payload_key": hashlib.sha256(payload).digest(),
            }
            yield row | ({"doc": zip_.compress(r["doc"])} if with_doc else {})

    return _files(spark, folder, parse, _ARC + ", doc binary" * with_doc)


# ---- WARC


def firsts(records: DataFrame, least_bytes: int) -> DataFrame:
    """(payload_key, first) of each payload of least_bytes or more that several records have; first has the least page_id.

    A null page_id counts as larger than all others, and ties go to the least record_id.
    """
    entry = F.struct(F.col("page_id").isNull().alias("late"), "page_id", "record_id", "url", "date")
    groups = records.filter((F.col("n_bytes") >= least_bytes) & F.col("fault").isNull()).groupBy("payload_key")
    return groups.agg(F.min(entry).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("payload_key", "first")


def _converted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One WARC file of a task's records: warcinfo, then a record for each."""
    part = TaskContext.get().partitionId()

    def record(fields: list[tuple[str, str | None]], block: bytes) -> dict:
        lines = [f"{k}: {v}" for k, v in fields if v is not None]
        head = "\r\n".join(["WARC/1.1", *lines, f"WARC-Block-Digest: sha1:{sha1(block)}", f"Content-Length: {len(block)}", "", ""])
        return {"value": head.encode() + block}

    def records():
        info, unzip = None, zstandard.ZstdDecompressor()
        for batch in batches:
            for r in batch.to_pylist():
                if info is None:
                    info = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'warcinfo {part} {r['record_id']}')}>"
                    said = b"software: meridian\r\nformat: WARC File Format 1.1\r\n"
                    yield record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", info), ("WARC-Date", r["date"]), ("Content-Type", "application/warc-fields")], said)
                doc = unzip.decompress(r["doc"])
                head, _ = split_http(doc)
                first = r["first"]
                again = first is not None and first["record_id"] != r["record_id"]
                kind = "revisit" if again else "response" if head else "resource"
                yield record(
                    [
                        ("WARC-Type", kind),
                        ("WARC-Record-ID", r["record_id"]),
                        ("WARC-Date", r["date"]),
                        ("WARC-Target-URI", r["url"]),
                        ("WARC-IP-Address", None if r["ip"] == "0.0.0.0" else r["ip"]),
                        ("WARC-Warcinfo-ID", info),
                        ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}"),
                        ("WARC-Identified-Payload-Type", r["mime"] if head else None),
                        ("WARC-Profile", REVISIT if again else None),
                        ("WARC-Refers-To", first["record_id"] if again else None),
                        ("WARC-Refers-To-Target-URI", first["url"] if again else None),
                        ("WARC-Refers-To-Date", first["date"] if again else None),
                        ("Content-Type", "application/http; msgtype=response" if head else r["mime"]),
                    ],
                    head if again else doc,
                )

    yield from _batches(records(), pa.schema([("value", pa.binary())]))


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, least_bytes: int = 0) -> None:
    """Writes a WARC file for each part of the ARC files' records. Faults are not written; read_arc has them."""
    known = durable(firsts(read_arc(spark, arc_folder, False), least_bytes))
    records = read_arc(spark, arc_folder, True).filter("fault IS NULL")
    told = records.join(known, "payload_key", "left").mapInArrow(batched(_converted), "value binary")
    _write(told, warc_folder, "\r\n\r\n")


_WARC = "archive string, fault string, record_id string, record_type string, url string, date string, refers_to string, page_id long, payload_bytes long, payload_digest string, intact boolean"


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the WARC files in the folder but warcinfo; faults as in read_arc.

    A payload's size and digest are taken from its bytes, those of a revisit from its HTTP head and its WARC-Payload-Digest. `intact` says
    whether the digests that the record declares are those of its bytes.
    """

    def parse(name, content):
        for fields, block in warc_records(content):
            kind = fields.get("warc-type")
            if kind == "warcinfo":
                continue
            head, payload = split_http(block)
            said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
            again, page = kind == "revisit", http_field(head, "X-Page-Id")
            n = http_field(head, "Content-Length")
            yield {
                "archive": name,
                "record_id": fields.get("warc-record-id"),
                "record_type": kind,
                "url": fields.get("warc-target-uri"),
                "date": fields.get("warc-date"),
                "refers_to": fields.get("warc-refers-to"),
                "page_id": int(page) if page and re.fullmatch(r"-?\d{1,18}", page) else None,
                "payload_bytes": len(payload) if not again else int(n) if n and n.isdigit() else None,
                "payload_digest": said if again else sha1(payload),
                "intact": fields.get("warc-block-digest", "").removeprefix("sha1:") == sha1(block) and (again or said == sha1(payload)),
            }

    return _files(spark, folder, parse, _WARC)


# ---- pages


def http_response(page_id: Column, html: Column) -> Column:
    """The bytes of an HTTP response with the page's id in a field of its own; a null id has none."""
    payload = F.coalesce(html.cast("binary"), F.lit(b""))
    length = F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string"))
    said = F.concat(F.lit("X-Page-Id: "), page_id.cast("string"))
    head = F.concat_ws("\r\n", F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), length, said, F.lit(""), F.lit(""))
    return F.concat(head.cast("binary"), payload)


def pages_archived(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "20240101000000") -> DataFrame:
    """pages(page_id, url, html) as ARC files, these converted to WARC, and those read back, in folder/arc and folder/warc.

    A row for each page: (page_id, payload_bytes, payload_digest, record_type, refers_to). A null html is an empty payload and a null
    url is `-`; a null page_id stays one and comes after all others. Repeated rows are records of their own: one is the
    response and the rest revisit it. An empty table gives an empty result. Other columns are not looked at.
    """
    spark = pages.sparkSession
    captures = pages.select("url", F.lit("0.0.0.0").alias("ip"), F.lit("text/html").alias("mime"), http_response(F.col("page_id"), F.col("html")).alias("doc"))
    write_arc(captures, f"{folder}/arc", date)
    convert(spark, f"{folder}/arc", f"{folder}/warc", least_bytes)
    records = durable(read_warc(spark, f"{folder}/warc"))
    broken = records.filter("fault IS NOT NULL OR NOT intact").limit(1).collect()
    if broken:
        raise ValueError(f"an archive can't be read back: {broken[0].asDict()}")
    columns = "page_id", "payload_bytes", "payload_digest", "record_type"
    revisits, others = records.filter("record_type = 'revisit'"), records.filter("record_type <> 'revisit'")
    targets = others.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("target"))
    found = revisits.join(targets, "refers_to").select(*columns, F.col("target").alias("refers_to"))
    return others.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(found)
