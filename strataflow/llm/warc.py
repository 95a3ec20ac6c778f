"""WARC archives: written by tasks, read back by byte ranges.

Every record is a gzip member of its own. A reading task owns the records that start inside its byte range: it scans
for the gzip magic, takes a candidate as a member only if it decodes to a WARC header, and reads the last record past
the end of the range. So archives of any size are read in parallel without an index.

Files are opened with `pyarrow.fs`, by the URI of the shared folder, on the executors.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.batches import lean, tidy
from strataflow.session import run_dir, stage

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads below this are always stored, even if another record has the same.
LEAST_REVISIT_BYTES = 1000
# A task rolls over to a new archive beyond this.
ARCHIVE_BYTES = 256 << 20
RANGE_BYTES = 16 << 20
BUFFER = 1 << 20
# Decoded bytes that one output batch gathers; a larger record is a batch of its own.
BATCH_BYTES = 4 << 20

RECORDS = pa.schema(
    [
        ("path", pa.string()),
        ("offset", pa.int64()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)
RECORDS_DDL = (
    "path string, offset long, record_id string, record_type string, target_uri string, refers_to string,"
    " payload_bytes long, payload_digest string, payload binary"
)


def with_revisits(pages: DataFrame, key: str, payload: str, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Per row: key, payload (null: empty), `payload_digest` (SHA-1, hex), `payload_bytes`, and `refers_to`.

    `refers_to` is the largest key with an equal payload of at least `least` bytes where that is another key, else
    null. Groups are reduced to (digest, largest key) before the join, which brings the few payloads that repeat to
    the rows; Spark splits a digest that holds many of them.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.withColumns({"__payload": body}).withColumns(
        {"payload_digest": F.sha1("__payload"), "payload_bytes": F.octet_length("__payload").cast("long")}
    )
    repeated = (
        rows.filter(F.col("payload_bytes") >= least)
        .groupBy(F.col("payload_digest").alias("__digest"), F.col("payload_bytes").alias("__bytes"))
        .agg(F.max(key).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .filter("__n > 1")
        .drop("__n")
    )
    same = (F.col("payload_digest") == F.col("__digest")) & (F.col("payload_bytes") == F.col("__bytes"))
    other = F.when(~F.col("__first").eqNullSafe(F.col(key)), F.col("__first"))
    return rows.join(repeated, same, "left").withColumn("refers_to", other)


def record(record_id: str, uri: str | None, date: str, digest: str, body: bytes, size: int, refers_to: str | None) -> bytes:
    """One compressed record: a response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to else http + body
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>"]
    lines += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), uri))
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def write_archives(
    pages: DataFrame,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    *,
    folder: str | None = None,
    date: str = "1970-01-01T00:00:00Z",
    least: int = LEAST_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one record per row below `folder` (default: the shared folder); returns the archives (path, size, records).

    Record ids are `urn:page:<key>`; a row without a key has a random one. Of rows with equal payloads of at least
    `least` bytes the one with the largest key is the response and the others revisit it; repeated rows with that key
    are all responses, and so are rows without a key that meet no keyed copy. A null payload is empty, a null URI has no
    header. An attempt of a task writes files of its own, and only those of the attempt that Spark took are in the
    returned list, so that lost executors and repeated attempts leave no record twice.
    """
    spark = pages.sparkSession
    base = folder or run_dir(spark, "warc")
    rows = with_revisits(pages.select(key, uri, payload), key, payload, least).select(
        F.col(key).cast("string").alias("key"),
        F.col(uri).alias("uri"),
        F.when(F.col("refers_to").isNull(), F.col("__payload")).alias("body"),
        "payload_digest",
        "payload_bytes",
        F.col("refers_to").cast("string").alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(base)
        done, out, path, size, count = [], None, "", 0, 0
        for batch in batches:
            for key, uri, body, digest, n, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path, size, count = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(path, compression=None)
                name = f"urn:page:{key}" if key is not None else f"urn:uuid:{uuid.uuid4()}"
                data = record(name, uri, date, digest, body or b"", n, refers and f"urn:page:{refers}")
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, count))
        columns = zip(*done, strict=True) if done else ([], [], [])
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["name", "size", "records"])

    written = lean(rows).mapInArrow(tidy(write), "name string, size long, records long")
    path = F.concat(F.lit(f"{base.rstrip('/')}/"), F.element_at(F.split("name", "/"), -1)).alias("path")
    return stage(written, "warc-list").select(path, "size", "records")


def member(file, size: int, at: int) -> tuple[bytes, int] | None:
    """The decoded record of the gzip member at `at` and the offset behind it, or None if there is no such record."""
    unpack, parts, seen, position = zlib.decompressobj(31), [], b"", at
    while not unpack.eof:
        if position >= size:
            return None
        file.seek(position)
        data = file.read(BUFFER if parts else 4096)
        if not data:
            return None  # the file is shorter than it was
        position += len(data)
        try:
            part = unpack.decompress(data)
        except zlib.error:
            return None
        parts.append(part)
        if len(seen) < 5:
            seen += part[:5]
            if not b"WARC/".startswith(seen[:5]):
                return None
    text = b"".join(parts)
    return (text, position - len(unpack.unused_data)) if b"\r\n\r\n" in text else None


def owned(file, size: int, start: int, end: int, whole: bool = False) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every record that starts in [start, end).

    With `whole` the file must be records from its first byte to its last: the range's records must follow each other,
    and where the last of them ends the file must end too, or another record start. So every byte is vouched for by
    the range in which the record before it starts.
    """
    expected = 0 if start == 0 else None
    for offset, content, after in _found(file, size, start, end):
        if whole and expected is not None and offset != expected:
            raise ValueError(f"bytes {expected} to {offset} of the archive are no record")
        yield offset, content
        expected = after
    if whole and expected is not None and expected < size and (expected < end or member(file, size, expected) is None):
        raise ValueError(f"no record starts at byte {expected} of {size} of the archive")


def _found(file, size: int, at: int, end: int) -> Iterator[tuple[int, bytes, int]]:
    """Offset, content and end of every record that starts in [at, end)."""
    while at < end:
        file.seek(at)
        window = file.read(min(BUFFER, end - at) + len(MAGIC) - 1)  # a magic may start at the range's last byte
        hit = window.find(MAGIC)
        if hit < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += hit
        if at >= end:
            return
        found = member(file, size, at)
        if found is None:
            at += 1
        else:
            yield at, *found
            at = found[1]


def parse(content: bytes) -> dict[str, object]:
    """Fields of one record. Lengths and digests of a response are of the payload it holds, a revisit's of its headers."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    block = rest[: int(fields.get("content-length", len(rest)))]
    http, _, body = block.partition(b"\r\n\r\n") if "application/http" in fields.get("content-type", "") else (b"", b"", block)
    revisit = fields.get("warc-type") == "revisit"
    told = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    digest = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
    return {
        "record_id": fields.get("warc-record-id", "").strip("<>"),
        "record_type": fields.get("warc-type"),
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        "payload_bytes": (int(told[1]) if told else None) if revisit else len(body),
        "payload_digest": digest if revisit else hashlib.sha1(body).hexdigest(),
        "payload": None if revisit else body,
    }


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES, *, whole: bool = False) -> DataFrame:
    """All records of the archives `files` (path, size), a task per byte range of `range_bytes`.

    Bytes that belong to no record are passed over, or with `whole` fail the job, as does an archive that is cut off or
    shorter than its size says; an empty archive or list gives no rows. A revisit has no payload: its length and digest
    are those its headers state. Other columns of `files` are not looked at.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))
    ranges = files.filter("size > 0").select("path", "size", F.explode(starts).alias("start"))
    spread = ranges.repartition(max(1, ranges.count()), "path", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as file:
                    for offset, content in owned(file, size, start, min(size, start + range_bytes), whole):
                        rows.append({"path": path, "offset": offset, **parse(content)})
                        held += len(content)
                        if held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, RECORDS)
                            rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, RECORDS)

    return spread.mapInArrow(tidy(read), RECORDS_DDL)
