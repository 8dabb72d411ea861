"""WARC archives: a deduplicating writer and a salvage reader.

Writer. Every row becomes one gzip member holding one WARC/1.1 record. Of the
rows with equal payloads (at least ``min_revisit_bytes`` long), the one with
the largest id is a response; the others are revisits without a body that
refer to it. Equal payloads are found by their SHA-1 digest and length; a
frequent payload is counted map-side, and its rows may be split over tasks.
Each task attempt writes its own archives (rolled at ``max_archive_bytes``) to a
shared folder; the result lists those of the attempts that succeeded, so a
lost task is simply run again and what it left is never read.

Reader. Archives are read by offset, with one record (or gzip member) and a
read-ahead of fixed size in memory. A plain record's end is looked at before
its block is read, so a wrong Content-Length neither fills memory nor makes
the reader pass over the archive again. A record must pass its checks: the gzip checksum, the version line, Content-Length, the
block digest. After a failed check the reader looks for the next place where
a gzip member decompresses to a version line (or, in plain archives, for the
next version line), goes on there, and logs the bytes in between as a
quarantined gap. A member of several records is read like a plain archive; its
records and gaps all have the offsets of the member.

Defined cases. A NULL payload is empty. Rows that share the largest id of
their payload are all responses; a NULL id counts as smaller than any other,
and if a payload has no other ids, all its rows are responses. An empty table
writes no archive and reads back as an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from itertools import chain

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.common import utf8
from ontime.session import checkpoint_dir, cut_lineage

VERSION = b"WARC/1.1"
_ANY_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_GZIP = b"\x1f\x8b\x08"
_PACKED_START = re.compile(re.escape(_GZIP) + rb"|WARC/1\.[01]\r\n")
_END = b"\r\n\r\n"
_READ = 1 << 16
_STEP = 1 << 14
_URN = "urn:ontime:page:"
_EPOCH = "1970-01-01T00:00:00Z"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _open_fs(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


# ---- records ----

def record_bytes(kind: str, record_id: str, target: str, payload: bytes, digest: str, length: int, refers: str | None) -> bytes:
    """One uncompressed WARC record; a revisit has an empty block."""
    block = payload if kind == "response" else b""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", _EPOCH),
            ("WARC-Target-URI", re.sub(r"[\r\n\x00]", "", target)),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
            ("X-Payload-Length", str(length)), ("Content-Type", "text/html; charset=utf-8"),
            ("Content-Length", str(len(block)))]
    if refers is not None:
        head += [("WARC-Refers-To", f"<{refers}>"),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    lines = b"".join(f"{k}: {v}\r\n".encode("utf-8", "replace") for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = 1) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


class BadRecord(Exception):
    """A failed check; the message is the reason that the log gives."""


class _Archive:
    """Bytes of a seekable file by absolute offset, read ahead in steps of ``_READ``."""

    def __init__(self, file):
        self.file, self.at, self.data = file, 0, b""
        self.size = file.seek(0, io.SEEK_END)

    def _fetch(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        parts, left = [], n
        while left and (part := self.file.read(left)):
            parts.append(part)
            left -= len(part)
        return parts[0] if len(parts) == 1 else b"".join(parts)

    def read(self, at: int, n: int) -> bytes:
        """``n`` bytes from ``at``, or what is left of them."""
        n = max(0, min(n, self.size - at))
        skip = at - self.at
        if skip < 0 or skip + n > len(self.data):
            if n >= _READ:
                return self._fetch(at, n)
            self.at, self.data, skip = at, self._fetch(at, min(_READ, self.size - at)), 0
        return self.data[skip:skip + n]


def _header_lines(archive: _Archive, at: int) -> tuple[list[bytes], int]:
    """Header lines from ``at`` and the offset after the empty line; reading ends at the first line that is none."""
    lines, data, first = [], bytearray(), 0
    while True:
        end = data.find(b"\r\n", first)
        while end < 0:
            more = archive.read(at + len(data), _STEP)
            if not more:
                raise BadRecord("unfinished header")
            seen = max(first, len(data) - 1)
            data += more
            end = data.find(b"\r\n", seen)
        if end == first:
            return lines, at + end + 2
        lines.append(bytes(data[first:end]))
        if b":" not in lines[-1]:
            raise BadRecord("bad header line")
        first = end + 2


def _record_at(archive: _Archive, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers (lower-case names), block and total size of the record at an offset."""
    m = _ANY_VERSION.match(archive.read(at, 10))
    if not m:
        raise BadRecord("no version line")
    lines, start = _header_lines(archive, at + m.end())
    headers = {}
    for line in lines:
        name, _, value = line.partition(b":")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise BadRecord("no Content-Length")
    if not all(headers.get(name) for name in ("warc-record-id", "warc-type", "warc-date")):
        raise BadRecord("mandatory header missing")
    size = int(length) if len(length) < 19 else archive.size
    # the end is looked at before the block, so that a wrong length costs no reading
    if start + size + 4 > archive.size or (size >= _READ and archive.read(start + size, 4) != _END):
        raise BadRecord("truncated record")
    block = archive.read(start, size + 4)
    if block[size:] != _END:
        raise BadRecord("truncated record")
    block = block[:size]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != base32_sha1(block):
        raise BadRecord("block digest differs")
    return headers, block, start + size + 4 - at


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers (lower-case names), block and total size of the record at the start of ``data``."""
    return _record_at(_Archive(io.BytesIO(data)), 0)


# ---- salvage ----

def _member(archive: _Archive, at: int, probe: bool = False) -> tuple[bytes, int]:
    """The decompressed gzip member at an offset and its size; with ``probe``, only its first bytes."""
    z, out, fed = zlib.decompressobj(31), [], at
    try:
        while not z.eof:
            chunk = archive.read(fed, _STEP)
            if not chunk:
                raise BadRecord("truncated member")
            fed += len(chunk)
            out.append(z.decompress(chunk, 64 if probe else 0))
            if probe and sum(map(len, out)) >= 10:
                break
    except zlib.error as e:
        raise BadRecord("gzip checksum or data") from e
    return b"".join(out), fed - len(z.unused_data) - at


def _next_start(archive: _Archive, at: int, packed: bool = True) -> int:
    """The next place after an offset where a record may start, or the end."""
    starts = _PACKED_START if packed else _ANY_VERSION
    while True:
        at += 1
        data = archive.read(at, _READ)
        for m in starts.finditer(data):
            if m.group() != _GZIP:
                return at + m.start()
            try:
                if _ANY_VERSION.match(_member(archive, at + m.start(), probe=True)[0]):
                    return at + m.start()
            except BadRecord:
                pass
        if at + len(data) >= archive.size:
            return archive.size
        at += len(data) - 12  # a start may straddle two reads


def _records_of(raw: bytes):
    """Records and gaps of the bytes of a member that is not one whole record; fails if no record is whole."""
    items, head, first = salvage(io.BytesIO(raw), packed=False), [], None
    for first in items:
        if first[0] == "record":
            break
        head.append(first)
    if first is None or first[0] == "gap":
        raise BadRecord(head[0][3] if head else "no version line")
    return chain(head, [first], items)


def salvage(file, packed: bool = True):
    """Yield ("record", offset, end, headers, block) and ("gap", offset, end, reason, None) of one seekable archive.

    Offsets are those of the file; every byte belongs to one record or gap, or to one member whose records and
    gaps share its offsets. Without ``packed`` the file holds no gzip members.
    """
    archive, at, gap, reason = _Archive(file), 0, None, ""
    while at < archive.size:
        several = None
        try:
            if packed and archive.read(at, 2) == _GZIP[:2]:
                raw, size = _member(archive, at)
                try:
                    headers, block, used = parse_record(raw)
                except BadRecord:
                    used = -1
                if used != len(raw):
                    several = _records_of(raw)
            else:
                headers, block, size = _record_at(archive, at)
        except BadRecord as e:
            if gap is None:
                gap, reason = at, str(e)
            at = _next_start(archive, at, packed)
            continue
        if gap is not None:
            yield ("gap", gap, at, reason, None)
            gap = None
        start, at = at, at + size
        if several is None:
            yield ("record", start, at, headers, block)
        else:
            yield from ((kind, start, at, what, body) for kind, _, _, what, body in several)
    if gap is not None:
        yield ("gap", gap, at, reason, None)


# ---- Spark ----

def revisit_plan(pages: DataFrame, id_col: str, payload_col: str, min_revisit_bytes: int = 0) -> DataFrame:
    """Every row with _payload, _digest (SHA-1, binary), _bytes and _winner (the id of the response; NULL: it is one itself)."""
    rows = pages.withColumn("_payload", F.coalesce(utf8(payload_col), F.lit(b"")))
    rows = rows.withColumn("_digest", F.unhex(F.sha1("_payload"))).withColumn("_bytes", F.length("_payload").cast("bigint"))
    winners = (rows.where(F.col("_bytes") >= min_revisit_bytes).groupBy("_digest", "_bytes")
               .agg(F.max(id_col).alias("_winner"), F.count("*").alias("_copies")).where("_copies > 1").drop("_copies"))
    return (rows.join(winners, ["_digest", "_bytes"], "left")
            .withColumn("_winner", F.when(F.col(id_col).eqNullSafe(F.col("_winner")), None).otherwise(F.col("_winner"))))


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_revisit_bytes: int = 0, max_archive_bytes: int = 64 << 20) -> DataFrame:
    """Write all rows to ``folder`` (a URI that every executor can reach).

    Returns the complete archives (path, bytes, records); they exist when this returns.
    """
    plan = revisit_plan(pages, id_col, payload_col, min_revisit_bytes)

    def write(batches):
        fs, root = _open_fs(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        number, size, count, out, done = 0, 0, 0, None, []

        def finish():
            out.close()
            done.append((f"{folder}/{name}-{number:04d}.warc.gz", size, count))

        for batch in batches:
            for page, url, payload, digest, length, winner in zip(*(c.to_pylist() for c in batch.columns)):
                kind, digest = "response" if winner is None else "revisit", base64.b32encode(digest).decode()
                record = record_bytes(kind, f"{_URN}{'' if page is None else page}:{digest}", url or "", payload, digest,
                                      length, None if winner is None else f"{_URN}{winner}:{digest}")
                member = gzip_member(record)
                if out is not None and size + len(member) > max_archive_bytes:
                    finish()
                    out, number = None, number + 1
                if out is None:
                    out, size, count = fs.open_output_stream(f"{root}/{name}-{number:04d}.warc.gz", compression=None), 0, 0
                out.write(member)
                size, count = size + len(member), count + 1
        if out is not None:
            finish()
        paths, sizes, counts = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64()),
                                          pa.array(counts, pa.int64())], ["path", "bytes", "records"])

    fs, root = _open_fs(folder)
    fs.create_dir(root, recursive=True)
    rows = plan.select(F.col(id_col).cast("bigint"), url_col, F.when(F.col("_winner").isNull(), F.col("_payload")).otherwise(F.lit(b"")),
                       "_digest", "_bytes", F.col("_winner").cast("bigint"))
    return cut_lineage(rows.mapInArrow(write, "path string, bytes bigint, records bigint"))


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """The archives (path) that lie in a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select("path")


_ROW = [("path", pa.string()), ("offset", pa.int64()), ("end", pa.int64()), ("gap", pa.string()), ("record_id", pa.string()),
        ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())]


def read_warc(archives: DataFrame, batch_bytes: int = 16 << 20) -> DataFrame:
    """Records and quarantined gaps of a table of archives (path); ``gap`` is the reason, NULL for records."""
    def read(batches):
        rows, size = [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(_ROW)],
                                              [n for n, _ in _ROW])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = _open_fs(path)
                with fs.open_input_file(at) as stream:
                    for kind, start, end, what, block in salvage(stream):
                        if kind == "gap":
                            rows.append((path, start, end, what, *[None] * 7))
                        else:
                            digest, length = what.get("warc-payload-digest", ""), what.get("x-payload-length", "")
                            rows.append((path, start, end, None, what.get("warc-record-id"), what.get("warc-type"),
                                         what.get("warc-target-uri"), digest.removeprefix("sha1:") or None,
                                         int(length) if length.isdigit() else len(block), what.get("warc-refers-to"), block))
                            size += len(block) + 500
                        if size > batch_bytes:
                            yield flush()
                            rows, size = [], 0
        yield flush()

    types = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary"}
    return archives.select("path").mapInArrow(read, ", ".join(f"{n} {types[t]}" for n, t in _ROW))


def page_of(record_id):
    """Column: the page id in a record id of :func:`write_warc`."""
    return F.regexp_extract(record_id, rf"<{_URN}(-?\d+):", 1).try_cast("bigint")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
