"""WARC archives: a writer with revisit records, and a reader that salvages damaged archives.

The writer makes one gzip member per record. Of records with the same payload of at least
``LEAST_REVISIT`` bytes the one with the smallest page id holds it; the others refer to it. Tasks
write their own files under names that depend on the task's number only, first under a temporary
name; a task that runs again replaces its own files, so lost executors leave nothing twice.

The reader takes any archive as it is, compressed or not. Each record is checked: the member's
checksum, version line, lengths, block digest. After a failed check it searches for the next valid
member or version line, goes on from there, and logs the bytes in between as a quarantined gap. That
search goes on inside a member: a damaged record costs no other, and of a member that is damaged or cut off
the records that can be inflated whole and fit their digests are kept. An archive is one row of Spark's
binary reader, which ends at 2 GiB; the writer closes them far below.

Null payloads are empty, null urls have no target. Null page ids neither hold for nor refer to
others; rows that share the smallest id of a payload are all responses.
"""

import hashlib
import os
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from .common import bounded

LEAST_REVISIT = 100
# Archives are closed at this size; the reader holds one at a time.
ARCHIVE_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC, _VERSION = b"\x1f\x8b\x08", b"WARC/1."


def with_revisits(pages):
    """``page_id, url, payload, digest, refers_to`` of each page; ``refers_to`` is null for responses."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    read = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    holders = read.filter((F.octet_length("payload") >= LEAST_REVISIT) & F.col("page_id").isNotNull()).groupBy(
        "digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return read.join(bounded(holders), "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("page_id") != F.col("_first"), F.col("_first")).alias("refers_to"))


def _record(page_id, url, payload, digest, refers_to):
    """One record as bytes."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _member(data):
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(folder, most):
    def write(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        written, out, done = 0, None, []

        def close():
            out.close()
            store.move(temporary, f"{base}/part-{part:06d}-{len(done):04d}.warc.gz")
            done.append(written)

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if out is None:
                    temporary, written = f"{base}/_{uuid.uuid4().hex}.tmp", 0
                    out = store.open_output_stream(temporary)
                member = _member(_record(*row))
                out.write(member)
                written += len(member)
                if written >= most:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([len(done)], pa.int64()), pa.array([sum(done)], pa.int64())],
                                         names=["archives", "bytes"])

    return write


def write_warc(pages, folder, archive_bytes=ARCHIVE_BYTES):
    """Write all pages as compressed archives below a shared ``folder``; returns (archives, bytes).

    ``folder`` is a path or URI that every executor can open.
    """
    folder = folder if re.match(r"[a-z0-9+.-]+:", folder) else f"file://{os.path.abspath(folder)}"
    folder = re.sub(r"^file:/+", "file:///", folder)
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    rows = with_revisits(pages).sortWithinPartitions("page_id", "digest", "url")
    done = rows.mapInArrow(_writer(folder, archive_bytes), "archives long, bytes long")
    return tuple(done.agg(F.coalesce(F.sum("archives"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first())


# Reading

_WHOLE_PARTS = {"warc", "id", "uri", "ip"}


def _header_name(name):
    """Header names have no case; this is how they are usually written."""
    return "-".join(p.upper() if p.lower() in _WHOLE_PARTS else p.capitalize() for p in name.strip().split("-"))


def _parsed(data, at, checked=False):
    """The record that starts at ``at`` in plain bytes: ``(headers, block, end)``; ValueError if damaged.

    With ``checked`` a record without a digest does not count, as where the member's own check failed.
    """
    if data[at:at + len(_VERSION)] != _VERSION:
        raise ValueError("no version line")
    split = data.find(b"\r\n\r\n", at)
    if split < 0:
        raise ValueError("headers do not end")
    lines = data[at:split].decode("utf-8", "replace").split("\r\n")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("malformed header")
        headers[_header_name(name)] = value.strip()
    length = headers.get("Content-Length", "")
    if not (length.isascii() and length.isdigit()):
        raise ValueError("no length")
    start = split + 4
    end = start + int(length)
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError("record does not end where its length says")
    block = data[start:end]
    digest = headers.get("WARC-Block-Digest", "")
    known = digest.lower().startswith("sha256:")
    if known and digest[7:].lower() != hashlib.sha256(block).hexdigest():
        raise ValueError("block digest differs")
    if checked and not known:
        raise ValueError("record without a digest in a damaged member")
    return headers, block, end + 4


def _inflated(data, at):
    """The gzip member at ``at``: ``(bytes, end, error)``; of a damaged one what can be inflated, and no end."""
    unpacker, parts, step = zlib.decompressobj(31), [], at
    try:
        # Members end early, so input is handed over in steps; small ones, as a damaged step yields nothing.
        while not unpacker.eof:
            if step >= len(data):
                return b"".join(parts), None, "member is cut off"
            parts.append(unpacker.decompress(data[step:step + 4096]))
            step += 4096
    except zlib.error:
        # Once more byte by byte, up to the damage.
        again = zlib.decompressobj(31)
        parts = []
        try:
            for i in range(at, min(step + 4096, len(data))):
                parts.append(again.decompress(data[i:i + 1]))
        except zlib.error:
            pass
        return b"".join(parts), None, "member is damaged"
    return b"".join(parts), min(step, len(data)) - len(unpacker.unused_data), None


def _within(plain, checked):
    """Records and gaps inside a member's bytes: ``(headers, block)`` or ``(None, reason)``."""
    at, bad, out = 0, None, []
    while at < len(plain):
        try:
            headers, block, end = _parsed(plain, at, checked)
        except ValueError as error:
            if bad is None:
                bad = (at, str(error))
            following = plain.find(_VERSION, at + 1)
            at = len(plain) if following < 0 else following
            continue
        if bad is not None:
            out.append((None, f"bytes {bad[0]} to {at} of a member: {bad[1]}"))
            bad = None
        out.append((headers, block))
        at = end
    if bad is not None:
        out.append((None, f"bytes {bad[0]} to {at} of a member: {bad[1]}"))
    return out


def _at(data, at):
    """What is at ``at``: ``(records and gaps, end, error)``; ValueError if nothing there is a record."""
    if data[at:at + len(_MAGIC)] == _MAGIC:
        plain, end, error = _inflated(data, at)
        parts = _within(plain, error is not None)
        if not any(headers is not None for headers, _ in parts):
            raise ValueError(error or (parts[0][1] if parts else "empty member"))
        if error is not None:
            # What follows the last record is part of the gap that the damage makes.
            while parts[-1][0] is None:
                parts.pop()
        return parts, end, error
    headers, block, end = _parsed(data, at)
    return [(headers, block)], end, None


def salvage(data):
    """Yield ``(offset, end, reason, headers, block)``: records (reason None) and gaps (no headers).

    Records of one member share its offset. So does a gap inside it; that of a member which is damaged
    or cut off runs on to the next valid member or version line.
    """
    at, bad, reason = 0, None, None
    while at < len(data):
        try:
            parts, end, error = _at(data, at)
        except ValueError as failed:
            parts, end, error = [], None, str(failed)
        if parts and bad is not None:
            yield bad, at, reason, None, None
            bad = None
        for headers, content in parts:
            if headers is None:
                yield at, len(data) if end is None else end, content, None, None
            else:
                yield at, len(data) if end is None else end, None, headers, content
        if error is None:
            at = end
            continue
        if bad is None:
            bad, reason = at, error
        following = [p for p in (data.find(_MAGIC, at + 1), data.find(_VERSION, at + 1)) if p >= 0]
        at = min(following, default=len(data))
    if bad is not None:
        yield bad, len(data), reason, None, None


_SCHEMA = "archive string, offset long, length long, reason string, headers map<string,string>, http string, payload binary"


def _reader(batches):
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.binary()]
    names = [c.split()[0] for c in _SCHEMA.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows, held = [], 0
            for at, end, reason, headers, block in salvage(content.as_py()):
                http, payload = None, None
                if headers is not None:
                    head, found, payload = block.partition(b"\r\n\r\n")
                    http, payload = (head.decode("latin-1"), payload) if found else (None, block)
                rows.append((path, at, end - at, reason, None if headers is None else list(headers.items()), http, payload))
                held += len(block or b"")
                if held > 4 << 20:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_warc(spark, folder, glob="*.{warc,warc.gz}"):
    """Records and gaps of all archives in a folder.

    ``archive, offset, length, reason, headers, http, payload``; a row with a ``reason`` is a
    quarantined gap, and has neither headers nor payload.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", "content").mapInArrow(_reader, _SCHEMA)


def page_records(records, page_id_type="bigint"):
    """Of read records: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    def named(header):
        return F.regexp_extract(F.col("headers")[header], "^<urn:page:(.*)>$", 1)

    revisit = F.col("headers")["WARC-Type"] == "revisit"
    told = F.regexp_extract("http", r"(?i)\r\nContent-Length: ([0-9]+)", 1).cast("long")
    digest = F.regexp_replace(F.col("headers")["WARC-Payload-Digest"], "^sha256:", "")
    return records.filter("reason is null").select(
        F.nullif(named("WARC-Record-ID"), F.lit("")).cast(page_id_type).alias("page_id"),
        F.when(revisit, told).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(revisit, digest).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        F.col("headers")["WARC-Type"].alias("record_type"),
        F.nullif(named("WARC-Refers-To"), F.lit("")).cast(page_id_type).alias("refers_to"),
    )


def quarantined(records):
    """The gap log of read archives: ``archive, offset, length, reason``."""
    return records.filter("reason is not null").select("archive", "offset", "length", "reason")
