"""WARC archives: writing, and the normaliser of archives that are one gzip stream as a whole.

``monolithic`` puts records into archives that are compressed as one stream each, as some crawlers leave them; such files
can only be read from their beginning. ``normalise`` inflates each file once, writes every record again as a gzip member of
its own, and in the same pass writes an index of the members' offsets and lengths beside them, a JSON line a record, so ``read_records`` can cut out any record
and inflate it alone.

Files are written by Spark's text writer, whose commit makes them whole or absent, to any file system Spark writes to. A
line is a stretch of bytes; the line separator is the zero byte that every gzip stream of less than 16 MiB ends with, and a
longer one is followed by an empty member, which ends so too. So the files are plain gzip.

Records with equal payloads of ``least`` bytes or more are stored once: the smallest id is the response, others revisit it.

Defined results: null payloads are empty; null urls are written as empty targets; rows without an id aren't written; rows
that share id and payload become records of their own; an empty table gives archives without records.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shared import shared_dir, with_first

#: Payload bytes of an archive; the record that passes it is the archive's last.
ARCHIVE_BYTES = 8 << 20
LEAST = 100
_END = b"\r\n"
_LINES = "kind string, archive string, line binary"
RECORD = "archive string, offset bigint, length bigint, page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def record(page_id: int, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response, or a revisit without its payload."""
    body = b"" if refers_to is not None else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id} {digest}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Target-URI: " + " ".join(url.split()),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-Id: {page_id}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/octet-stream",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(body)}")
    return _END.join(line.encode() for line in head) + _END * 2 + body + _END * 2


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Each record of an inflated archive: its headers, and the bytes of all of it."""
    at = 0
    while at < len(data):
        body = data.index(_END * 2, at) + 4
        found = headers(data[at : body - 4])
        end = body + int(found["Content-Length"]) + 4
        yield found, data[at:end]
        at = end


def inflated(data: bytes) -> bytes:
    """All members of a gzip file."""
    out = []
    while data:
        member = zlib.decompressobj(wbits=31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out)


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _closed(stream: bytes) -> bytes:
    """A gzip stream whose last byte is zero."""
    return stream if stream.endswith(b"\0") else stream + _gzip(b"")


def _files(lines: DataFrame, path: str) -> None:
    """Write rows (kind, archive, line), each as a file of its own: the line less the zero byte that the writer adds."""
    lines.selectExpr("kind", "archive", "CAST(substring(line, 1, octet_length(line) - 1) AS STRING) AS value").write.partitionBy(
        "kind", "archive"
    ).option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads compressed and with their digests, which is how they are shuffled."""
    for batch in batches:
        payloads = [x.as_py() for x in batch.column(2)]
        packed = pa.array([zlib.compress(x, 1) for x in payloads], pa.binary())
        digests = pa.array([hashlib.sha256(x).hexdigest() for x in payloads], pa.string())
        yield pa.record_batch([batch.column(0), batch.column(1), packed, digests], names=["page_id", "url", "packed", "digest"])


def monolithic(pages: DataFrame, path: str, id_col: str, url_col: str, payload_col: str, archive_bytes: int = ARCHIVE_BYTES, least: int = LEAST) -> None:
    """Write all rows as records of archives that are one gzip stream each."""
    rows = pages.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    )
    narrow = rows.where(F.octet_length("payload") >= least).select("page_id", F.sha2("payload", 256).alias("digest"))
    # The smaller part by far: pages whose payload an earlier page has.
    revisits = with_first(narrow, ["digest"], "page_id").where("first < page_id").select("page_id", "digest", "first").distinct()
    rows = rows.mapInArrow(_small, "page_id bigint, url string, packed binary, digest string")
    rows = rows.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "packed", "digest", "first")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, size, stream, out = TaskContext.get().partitionId(), 0, 0, None, []

        def finished() -> pa.RecordBatch:
            out.append(stream.flush())
            line = pa.array([_closed(b"".join(out))], pa.binary())
            return pa.record_batch([pa.array(["whole"]), pa.array([f"{task:06d}-{number:06d}"]), line], names=["kind", "archive", "line"])

        for batch in batches:
            for page_id, url, payload, digest, first in zip(*batch.columns, strict=True):
                if stream is None:
                    stream, size, out = zlib.compressobj(1, zlib.DEFLATED, 31), 0, []
                payload = zlib.decompress(payload.as_py())
                out.append(stream.compress(record(page_id.as_py(), url.as_py(), payload, digest.as_py(), first.as_py())))
                size += len(payload)
                if size >= archive_bytes:
                    yield finished()
                    stream, number = None, number + 1
        if stream is not None:
            yield finished()

    _files(rows.mapInArrow(archives, _LINES), path)


def _contents(spark, path: str, kind: str) -> DataFrame:
    """(archive, content) of the files of a kind below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    files = files.where(F.col("path").contains(f"/kind={kind}/"))
    return files.select(F.regexp_extract("path", "/archive=([^/]+)/", 1).alias("archive"), "content")


def normalise(spark, source: str, target: str) -> None:
    """Archives of ``source`` as archives of one member a record (kind=archives), and their indexes (kind=index)."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(*batch.columns, strict=True):
                offset, out, index = 0, [], []
                for head, whole in records(inflated(content.as_py())):
                    member = _gzip(whole)
                    entry = {"offset": offset, "length": len(member), "page_id": int(head["X-Page-Id"]), "type": head["WARC-Type"]}
                    index.append(json.dumps(entry | {"digest": head["WARC-Payload-Digest"]}))
                    out.append(member)
                    offset += len(member)
                lines = [_closed(b"".join(out)), "\n".join(index).encode() + b"\0"]
                kinds = pa.array(["archives", "index"])
                yield pa.record_batch([kinds, pa.array([archive.as_py()] * 2), pa.array(lines, pa.binary())], names=["kind", "archive", "line"])

    _files(_contents(spark, source, "whole").mapInArrow(members, _LINES), target)


def read_records(spark, target: str) -> DataFrame:
    """RECORD rows: every record cut out of its archive by the index and inflated alone; revisits have no payload."""
    index = _contents(spark, target, "index").withColumnRenamed("content", "index")
    joined = _contents(spark, target, "archives").join(index, "archive")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = "archive offset length page_id record_type refers_to payload_bytes payload_digest payload".split()
        for batch in batches:
            for archive, content, index in zip(*batch.columns, strict=True):
                content, rows = memoryview(content.as_buffer()), []
                for line in index.as_py().rstrip(b"\0").decode().split("\n"):
                    entry = json.loads(line)
                    a, n = entry["offset"], entry["length"]
                    head, whole = next(records(inflated(bytes(content[a : a + n]))))
                    refers, size = head.get("X-Refers-To-Page-Id"), int(head["X-Payload-Length"])
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    payload = None
                    if not refers:
                        payload = whole[whole.index(_END * 2) + 4 : -4]
                        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"record of page {head['X-Page-Id']} is damaged")
                    rows.append((archive.as_py(), a, n, int(head["X-Page-Id"]), head["WARC-Type"], int(refers) if refers else None, size, digest, payload))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return joined.select("archive", "content", "index").mapInArrow(cut, RECORD)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """The pages written as archives in the shared folder, normalised, and read back."""
    spark = pages.sparkSession
    place = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    monolithic(pages, f"{place}/whole", id_col, url_col, payload_col)
    normalise(spark, f"{place}/whole", f"{place}/normal")
    return read_records(spark, f"{place}/normal")
