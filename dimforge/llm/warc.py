"""WARC archives: a writer with revisit records and a salvage reader.

Writer: one record per page, each a gzip member of its own.  Pages with equal
payloads (SHA-1 and length) become one ``response`` (the largest page id) and
``revisit`` records that refer to it and carry only the HTTP headers.  Tasks
write files of about ``file_bytes``; names are unique per attempt and the
manifest, written through Spark, says which files count.

Reader: works through a file member by member (gzip) or record by record
(plain).  Every record is checked: gzip checksum, version line, header block,
length, closing blank lines, payload digest of responses.  After a failed
check the reader searches for the next gzip member or version line that
passes all checks, goes on there, and logs the bytes between as a quarantined
gap.  A member that holds several records loses only the damaged ones: it is
decompressed up to the damage, and the search goes on at the version lines of
its content.

Defined results: a NULL payload is empty; repeated rows with the largest id
are all responses; if every id of a group is NULL all are responses; control
characters in URLs are percent-encoded; an empty table gives no files; an
empty file has neither records nor gaps.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.storage import materialize, scratch, ship_package, write_bytes
from dimforge.operators.joins import broadcast_if_small

FILE_BYTES = 16_000_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_CHUNK = 1 << 16


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def build_record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uri(page_id)}",
            f"WARC-Target-URI: {target}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_uri(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _record_at(data, pos: int):
    """The checked record at ``pos``: (fields, end) or None."""
    head_end = data.find(b"\r\n\r\n", pos)
    if not _VERSION.match(data, pos) or head_end < 0:
        return None
    fields = {}
    for line in data[pos:head_end].split(b"\r\n")[1:]:
        k, sep, v = line.partition(b":")
        if not sep:
            return None
        fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    start = head_end + 4
    end = start + int(fields["content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        return None
    block = bytes(data[start:end])
    http, sep, payload = block.partition(b"\r\n\r\n")
    if not fields.get("content-type", "").startswith("application/http"):
        http, payload = b"", block
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if fields["warc-type"] == "response" and digest and digest != base32_sha1(payload):
        return None
    declared = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    fields["payload"], fields["digest"] = payload, digest
    fields["payload_bytes"] = int(declared[1]) if declared else len(payload)
    return fields, end + 4


def _member_at(data, pos: int):
    """The gzip member at ``pos``: (content, end); of a damaged or cut one what
    can be decompressed before the damage, and None as its end."""
    d = zlib.decompressobj(31)
    out, at = [], pos
    while not d.eof and at < len(data):
        before = d.copy()
        try:
            out.append(d.decompress(data[at:at + _CHUNK]))
        except zlib.error:
            for i in range(at, min(at + _CHUNK, len(data))):           # up to the damaged byte
                try:
                    out.append(before.decompress(data[i:i + 1]))
                except zlib.error:
                    break
            return b"".join(out), None
        at += _CHUNK
    return b"".join(out), min(at, len(data)) - len(d.unused_data) if d.eof else None


def _records_in(content):
    """Sound records of a stream, which follow each other or a version line, as
    (offset, fields), and the gaps between them as (start, end)."""
    found, gaps, pos = [], [], 0
    while pos < len(content):
        one, at = _record_at(content, pos), pos
        while one is None:
            m = _VERSION.search(content, at + 1)
            if m is None:
                gaps.append((pos, len(content)))
                return found, gaps
            at = m.start()
            one = _record_at(content, at)
        if at > pos:
            gaps.append((pos, at))
        found.append((at, one[0]))
        pos = one[1]
    return found, gaps


def _unit_at(data, pos: int):
    """What is sound of the member or plain record at ``pos``: records with
    their offsets inside it, gaps inside it, and where it ends (None if a member
    is damaged).  None if nothing is."""
    if data[pos:pos + 3] != b"\x1f\x8b\x08":
        one = _record_at(data, pos)
        return one and ([(0, one[0])], [], one[1])
    content, end = _member_at(data, pos)
    found, gaps = _records_in(content)
    if end is not None and not content:
        return [], [], end
    if end is None and found and (not gaps or gaps[-1][1] < len(content)):
        # only the member's checksum could vouch for headers up to its end
        gaps.append((found.pop()[0], len(content)))
    return (found, gaps, end) if found else None


def salvage(data: bytes):
    """All sound records of a file as (offset, fields), and the quarantined
    gaps.  A gap is (start, end) in the file; within a member of which records
    were recovered it is (start, end, inner start, inner end): the member, and
    the bytes of its content.  ``fields["inner"]`` is a record's offset in the
    content of its member."""
    records, gaps, pos = [], [], 0

    def take(at, found, inside, end):
        for inner, fields in found:
            fields["inner"] = inner
            records.append((at, fields))
        gaps.extend((at, end, a, b) for a, b in inside)

    damaged = None                                     # a member without an end, and what is sound of it
    while pos < len(data):
        unit, at = _unit_at(data, pos) if damaged is None else None, pos
        while unit is None:
            m = _START.search(data, at + 1)
            if m is None:
                break
            at = m.start()
            unit = _unit_at(data, at)
        stop = at if unit else len(data)
        if damaged is not None:
            found, inside, held = damaged
            take(pos, found, inside or [(held, held)], stop)
            damaged = None
        elif stop > pos:
            gaps.append((pos, stop))
        if unit is None:
            break
        found, inside, end = unit
        if end is None:
            held = max((b for _, b in inside), default=0)
            damaged, pos = (found, inside, held), at
        else:
            take(at, found, inside, end)
            pos = end
    return records, gaps


def mark_revisits(pages: DataFrame, *, key: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """``pages`` plus ``revisit`` and ``refers_to``.  Only digests that occur
    more than once are joined back (by broadcast if their count is proven
    small), so payloads are not shuffled for the others."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    marked = pages.withColumn("_sha", F.sha1(body)).withColumn("_len", F.octet_length(body))
    groups = (marked.where(F.col("_len") >= min_bytes).groupBy("_sha", "_len")
                    .agg(F.count(F.lit(1)).alias("_n"), F.max(key).alias("_largest")).where("_n > 1")
                    .select(F.col("_sha").alias("_gs"), F.col("_len").alias("_gl"), "_largest"))
    groups = broadcast_if_small(materialize(groups, "warc-groups"))
    joined = marked.join(groups, (F.col("_sha") == F.col("_gs")) & (F.col("_len") == F.col("_gl")), "left")
    revisit = F.col("_largest").isNotNull() & ~F.col(key).eqNullSafe(F.col("_largest"))
    return joined.select(*pages.columns, revisit.alias("revisit"), F.when(revisit, F.col("_largest")).alias("refers_to"))


def write_warc(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html",
               min_bytes: int = 0, file_bytes: int = FILE_BYTES, compress: bool = True) -> DataFrame:
    """Write the archives; returns their manifest ``name, path, n_records``."""
    spark = pages.sparkSession
    ship_package(spark)
    folder = scratch(spark, "warc")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(payload).cast("binary").alias("payload"))
    rows = mark_revisits(rows, key="key", payload="payload", min_bytes=min_bytes)

    def task(batches):
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            name = write_bytes(folder, f"part-{part:06d}-{seq:04d}", b"".join(held)).rsplit("/", 1)[1]
            return pa.RecordBatch.from_pydict({"name": [name], "path": [f"{folder}/{name}"], "n_records": [len(held)]})

        for batch in batches:
            cols = [batch.column(c) for c in ("key", "url", "payload", "revisit", "refers_to")]
            for k, u, p, r, ref in zip(*cols):
                record = build_record(k.as_py(), u.as_py(), p.as_py() or b"", ref.as_py(), r.as_py())
                held.append(gzip_member(record) if compress else record)
                size += len(held[-1])
                if size >= file_bytes:
                    yield flush()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield flush()

    return materialize(rows.mapInArrow(task, "name string, path string, n_records long"), "warc-manifest")


RECORD = ("file string, offset long, gap_end long, record_type string, record_id string, refers_to string, "
          "target_uri string, payload_bytes long, payload_digest string, inner_offset long, inner_end long")


def read_warc(files: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """Salvage-read ``(path, content)`` rows (Spark's ``binaryFile`` source):
    one row per record, and one row of type ``quarantined`` per gap (``offset``
    to ``gap_end``; inside a member also ``inner_offset`` to ``inner_end`` of its
    content)."""
    ship_package(files.sparkSession)
    schema = RECORD + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def task(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                records, gaps = salvage(content.as_py() or b"")
                rows = [(path, at, None, r["warc-type"], r.get("warc-record-id"), r.get("warc-refers-to"),
                         r.get("warc-target-uri"), r["payload_bytes"], r["digest"], r["inner"], None, r["payload"])
                        for at, r in records]
                for a, b, *inner in gaps:
                    c, d = inner or (None, None)
                    size = d - c if inner else b - a
                    rows.append((path, a, b, "quarantined", None, None, None, size, None, c, d, None))
                kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.int64(), pa.int64(),
                         pa.binary()]
                columns = [pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return files.select("path", "content").mapInArrow(task, schema)


def open_archives(manifest: DataFrame) -> DataFrame | None:
    """The manifest's files as ``(path, content)`` rows; None if there are none."""
    first = manifest.first()
    if first is None:
        return None
    files = manifest.sparkSession.read.format("binaryFile").load(first["path"].rsplit("/", 1)[0])
    counted = broadcast_if_small(manifest.select("name"))
    return (files.select("path", "content", F.element_at(F.split("path", "/"), -1).alias("name"))
                 .join(counted, "name", "left_semi").select("path", "content"))
