"""ARC to WARC conversion, and WARC files that Spark writes and reads back.

``read_arc`` parses legacy ARC archives: the version block names the version
(1: five header fields, 2: ten), each record's header line declares its length,
and the block is cut by that length alone, so a payload may hold anything.
``convert`` synthesises WARC records from them: a record id (a name-based UUID
of the archive, offset, URI and date), the date as a timestamp, the type and
block and payload digests.  Records with an equal payload become one response
and revisits of it.  ``write_warc`` writes WARC files through Spark's text
writer (a record ends in CR LF CR LF, which is the line separator), and
``read_warc`` reads them again with the binary file source, record by record.

Files hold about ``SEGMENT_BYTES`` of records, so a task holds no more than that
at once, however many records there are.

Edge cases: a NULL payload is empty; an empty payload has a digest like any
other; a URL's white space and control characters are percent-encoded, and a
NULL URL becomes ``urn:none``; repeated rows are separate records; a record
without a page id takes part with NULL, smaller than every id; rows that tie on
the largest id of a group are all responses; an empty table gives no rows; other
columns, and their names, are not used.  A header line that does not hold (too few
fields, no date or length, an end beyond the archive, an unknown version) ends neither the archive
nor the job: the bytes up to the next header that does are one record of kind
``damaged`` with the reason, and go to the WARC file as they are.  Without a version block a
header's own number of fields names the version.  Spaces in a content type are kept; bytes that
are no UTF-8 are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import HOT_ROWS, as_bytes, met, written
from pulsegrid.session import scratch_path

SEGMENT_BYTES = 16 << 20
#: Groups of equal payloads (about 100 bytes each) that may be broadcast; beyond, only those with very many rows are.
BROADCAST_GROUPS = 500_000

# The header fields of both versions.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}


def digest32(data: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:none"


def arc_segment(name: str, version: int, date: str, records: list[tuple[str, bytes]]) -> bytes:
    """One ARC archive: its version block, then (url, HTTP block) records."""
    fields = " ".join(FIELDS[version])
    head = f"{version} 0 pulsegrid\n{fields}\n".encode()

    def line(url: str, mime: str, code: str, offset: int, n: int) -> bytes:
        extra = "" if version == 1 else f" {code} - - {offset} {name}"
        return f"{url} 0.0.0.0 {date} {mime}{extra} {n}\n".encode()

    parts = [line(f"filedesc://{name}", "text/plain", "200", 0, len(head)), head, b"\n"]
    at = sum(map(len, parts))
    for url, block in records:
        own = [line(url, "text/html", "200", at, len(block)), block, b"\n"]
        at += sum(map(len, own))
        parts += own
    return b"".join(parts)


def pages_to_arc(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "20200101000000") -> DataFrame:
    """(archive, data): pages as ARC archives of about SEGMENT_BYTES, versions 1 and 2 in turn.

    The HTTP block of a record carries the page id in a header of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, size, n = [], 0, 0
        task = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            nonlocal held, size, n
            n += 1
            name = f"pages-{task:06d}-{n:05d}.arc"
            data = arc_segment(name, 1 + n % 2, date, held)
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary())], ["archive", "data"])

        for batch in batches:
            for i, u, body in zip(batch.column("key").to_pylist(), batch.column("url").to_pylist(), as_bytes(batch.column("body")), strict=True):
                named = b"" if i is None else b"X-Page-Id: %d\r\n" % i
                held.append((arc_url(u), b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%sContent-Length: %d\r\n\r\n%s" % (named, len(body), body)))
                size += len(body) + 300
                if size >= SEGMENT_BYTES:
                    yield flush()
        if held:
            yield flush()

    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(payload).alias("body"))
    return rows.mapInArrow(run, "archive string, data binary")


def header_text(raw: bytes) -> str:
    return re.sub("[\udc80-\udcff]", lambda m: f"%{ord(m[0]) - 0xDC00:02X}", raw.decode("utf-8", "surrogateescape"))


def arc_header(data: bytes, at: int, fields: list[str] | None) -> dict | str:
    """The header line at ``at`` with its block's ``start`` and ``end``, or the reason why it does not hold."""
    stop = data.find(b"\n", at)
    if stop < 0:
        return "the header line has no end"
    parts = data[at:stop].rstrip(b"\r").split(b" ")
    names = fields or next((f for f in FIELDS.values() if len(f) == len(parts)), None)
    if names is None or len(parts) < len(names):
        return f"{len(parts)} header fields"
    # Fields beyond the version's are spaces in the content type.
    mime = names.index("Content-type")
    beyond = len(parts) - len(names)
    parts[mime: mime + beyond + 1] = [b" ".join(parts[mime: mime + beyond + 1])]
    head = dict(zip(names, parts, strict=True))
    if not re.fullmatch(rb"[0-9]{4,14}", head["Archive-date"]):
        return "no date"
    if not re.fullmatch(rb"[0-9]{1,18}", head["Archive-length"]):
        return "no length"
    end = stop + 1 + int(head["Archive-length"])
    if end > len(data):
        return f"{end - stop - 1} bytes declared, {len(data) - stop - 1} left"
    return {**{k: header_text(v) for k, v in head.items()}, "start": stop + 1, "end": end}


_HEADER_LINE = re.compile(rb"(?m)^[^ \r\n]+(?: [^ \r\n]+){3,20} [0-9]{1,18}\r?$")


def next_header(data: bytes, after: int, fields: list[str] | None) -> int:
    """Where the next header line that holds begins, its block followed by a line's or the archive's end."""
    line = data.find(b"\n", after)
    for m in _HEADER_LINE.finditer(data, line + 1) if line >= 0 else ():
        head = arc_header(data, m.start(), fields)
        if not isinstance(head, str) and data[head["end"]: head["end"] + 1] in (b"", b"\r", b"\n"):
            return m.start()
    return len(data)


def arc_records(data: bytes) -> Iterator[dict]:
    """The records of one ARC archive; a stretch without a header that holds is one record with an ``error``."""
    at, fields = 0, None
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        head = arc_header(data, at, fields)
        if not isinstance(head, str) and fields is None and head["URL"].startswith("filedesc:"):
            version = re.match(rb"[0-9]{1,9}", data[head["start"]: head["end"]])
            fields = FIELDS.get(int(version[0])) if version else None
            if fields is None:
                head = "unknown version"
        if isinstance(head, str):
            stop = next_header(data, at, fields)
            yield {"offset": at, "url": None, "ip": None, "date": "", "mime": "application/octet-stream", "block": data[at:stop], "error": head}
            at = stop
            continue
        yield {"offset": at, "url": head["URL"], "ip": head["IP-address"], "date": head["Archive-date"], "mime": head["Content-type"],
               "block": data[head["start"]: head["end"]], "error": None}
        at = head["end"]


def warc_date(date: str) -> str:
    """A 14-digit (or shorter) ARC date as a WARC timestamp."""
    d = (date + "00000101000000"[len(date):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """(head with its empty line, payload) of an HTTP block."""
    head, sep, payload = block.partition(b"\r\n\r\n")
    return head + sep, payload


def _page(head: bytes) -> int | None:
    """The page id among HTTP headers; None if there is none or it is no number."""
    found = re.search(rb"(?im)^X-Page-Id:[ \t]*(-?[0-9]{1,19})[ \t]*\r?$", head)
    return int(found[1]) if found and -(1 << 63) <= int(found[1]) < 1 << 63 else None


RECORDS = "archive string, record_id string, url string, ip string, warc_date string, mime string, kind string, page_id bigint, payload_digest string, payload_bytes bigint, error string, block binary"


def read_arc(archives: DataFrame) -> DataFrame:
    """Records of (archive, data) rows, with what WARC needs of them; ``kind``: http, filedesc, resource or damaged (``error`` has the reason)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in RECORDS.split(", ")]
        schema = pa.schema([(n, pa.binary() if n == "block" else pa.int64() if n in ("page_id", "payload_bytes") else pa.string()) for n in names])
        for batch in batches:
            for archive, data in zip(batch.column("archive").to_pylist(), as_bytes(batch.column("data")), strict=True):
                rows, size = [], 0
                for r in arc_records(data):
                    http = r["error"] is None and r["block"].startswith(b"HTTP/")
                    head, payload = http_parts(r["block"]) if http else (b"", r["block"])
                    url = r["url"] if r["error"] is None else f"urn:arc:{archive}:{r['offset']}"
                    kind = "damaged" if r["error"] else "filedesc" if url.startswith("filedesc:") else "http" if http else "resource"
                    rows.append({
                        "archive": archive, "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}|{r['offset']}|{url}|{r['date']}')}",
                        "url": url, "ip": r["ip"], "warc_date": warc_date(r["date"]), "mime": r["mime"],
                        "kind": kind, "page_id": _page(head), "payload_digest": digest32(payload), "payload_bytes": len(payload),
                        "error": r["error"], "block": r["block"]})
                    size += len(r["block"])
                    if size > SEGMENT_BYTES // 4:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select("archive", "data").mapInArrow(run, RECORDS)


def with_revisits(records: DataFrame, least: int = 0) -> DataFrame:
    """Records with ``record_type`` and ``refers_to_id``: of equal payloads of at least ``least`` bytes the largest page id responds.

    Few groups of equal payloads are broadcast to the records.  Else ids and digests alone
    meet the groups, and what they decide is put back by the record's own columns, so
    records of one payload are never brought together.
    """
    digest = ["payload_digest", "payload_bytes"]
    http = records.where((F.col("kind") == "http") & (F.col("payload_bytes") >= least))
    groups = http.groupBy(*digest).agg(F.count(F.lit(1)).alias("held"), F.max(F.struct("page_id", "record_id")).alias("top"))
    groups = written(groups.where("held > 1").select(*digest, "held", F.col("top.page_id").alias("top_page"), F.col("top.record_id").alias("top_id")), "warc-groups")
    again = (F.col("kind") == "http") & F.col("top_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top_page"))
    if groups.count() <= BROADCAST_GROUPS:
        joined = records.join(F.broadcast(groups.drop("held")), digest, "left").withColumn("refers_to_id", F.when(again, F.col("top_id"))).drop("top_page", "top_id")
    else:
        own = ["record_id", *digest, "page_id"]
        ids = http.select(*own, "kind").distinct()
        decided = met(ids, groups, digest, BROADCAST_GROUPS, HOT_ROWS).where(again).select(*[F.col(c).alias(f"_{c}") for c in own], F.col("top_id").alias("refers_to_id"))
        same = F.lit(True)
        for c in own:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        joined = records.join(decided, same & (F.col("kind") == "http"), "left").drop(*[f"_{c}" for c in own])
    kind = (F.when(F.col("kind") == "filedesc", "warcinfo").when(F.col("kind") != "http", "resource")
            .when(F.col("refers_to_id").isNotNull(), "revisit").otherwise("response"))
    return joined.withColumn("record_type", kind)


def warc_record(r: dict) -> bytes:
    """One WARC record without its closing CR LF CR LF."""
    block = http_parts(r["block"])[0] if r["record_type"] == "revisit" else r["block"]
    head = [
        "WARC/1.0", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: <{r['record_id']}>", f"WARC-Date: {r['warc_date']}",
        f"WARC-Target-URI: {r['url']}" if r["record_type"] != "warcinfo" else f"WARC-Filename: {r['archive']}",
        f"WARC-Payload-Digest: sha1:{r['payload_digest']}", f"WARC-Block-Digest: sha1:{digest32(block)}"]
    if r["record_type"] in ("response", "revisit"):
        head.append(f"WARC-IP-Address: {r['ip']}")
    if r["record_type"] == "revisit":
        head += [f"WARC-Refers-To: <{r['refers_to_id']}>", f"X-Payload-Length: {r['payload_bytes']}", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    http = r["record_type"] in ("response", "revisit")
    head += [f"Content-Type: {'application/http; msgtype=response' if http else r['mime']}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block


def write_warc(records: DataFrame, path: str) -> None:
    """Gzip-compressed WARC files of about SEGMENT_BYTES before compression, below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.append(warc_record(batch.slice(i, 1).to_pylist()[0]))
                size += len(held[-1])
                if size >= SEGMENT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(held)], pa.binary())], ["value"])

    # A binary row is written byte for byte; one row is one file.
    rows = records.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    rows.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", 1).text(path)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a plain WARC file."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        n = int(head["content-length"])
        block = data[stop + 4: stop + 4 + n]
        if len(block) != n or data[stop + 4 + n: stop + 8 + n] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} does not end where it declares")
        yield head, block
        at = stop + 8 + n


def read_warc(spark, path: str) -> DataFrame:
    """(record_type, record_id, refers_to_id, url, page_id, payload_bytes, payload_digest) of the HTTP records below ``path``.

    A response's payload is measured and hashed again; one whose digest does not
    hold raises.  A revisit's come from its own headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in as_bytes(batch.column("content")):
                rows = []
                for head, block in warc_records(zlib.decompress(data, 47)):
                    kind = head["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, payload = http_parts(block)
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and digest32(payload) != digest:
                        raise ValueError(f"payload digest of {head['warc-record-id']} does not hold")
                    rows.append((kind, head["warc-record-id"].strip("<>"), head.get("warc-refers-to", "").strip("<>") or None, head["warc-target-uri"],
                                 _page(http), len(payload) if kind == "response" else int(head["x-payload-length"]), digest))
                if rows:
                    kinds = [pa.string()] * 4 + [pa.int64()] * 2 + [pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "record_type string, record_id string, refers_to_id string, url string, page_id bigint, payload_bytes bigint, payload_digest string"
    names = [f.split(" ")[0] for f in schema.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, schema)


def convert(archives: DataFrame, path: str, least: int = 0) -> None:
    """ARC archives (archive, data) to WARC files below ``path``."""
    write_warc(with_revisits(read_arc(archives), least), path)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages through ARC, WARC files in the shared folder, and back: one row per page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    convert(pages_to_arc(pages), path, least)
    if not spark.read.format("binaryFile").load(path).select("path").head(1):
        rows = spark.createDataFrame([], "record_type string, record_id string, refers_to_id string, url string, page_id bigint, payload_bytes bigint, payload_digest string")
    else:
        rows = written(read_warc(spark, path), "warc-rows")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
    first = rows.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    named = rows.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    revisits = rows.where("record_type = 'revisit'")
    held = revisits.groupBy("refers_to_id").agg(F.count(F.lit(1)).alias("held"))
    referred = written(held.join(named.dropDuplicates(["refers_to_id"]), "refers_to_id", "left"), "warc-referred")
    return first.select(*cols).union(met(revisits, referred, ["refers_to_id"], BROADCAST_GROUPS, HOT_ROWS).select(*cols))
