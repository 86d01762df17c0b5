"""WARC archives: written as whole-file gzip streams, normalised to one gzip member per record, read back by offset.

``write_archives`` stores one record per page. Pages with equal payloads are told apart from the first by their digest:
the smallest page_id carries the payload, the others are revisit records with headers only. Every task writes its pages as
one monolithic gzip stream, as simple crawlers do. ``normalise`` inflates each such file once, front to back in bounded
blocks, writes every record as a member of its own, and a sidecar index (offset, length, page_id) beside it.
``read_archives`` seeks to the indexed members.

Archives lie below the shared scratch folder, reached by the file system its address names. A task writes to a name of
its own and renames it, and the name that counts travels in the manifest, so a repeated task never disturbs a
finished one. A null payload counts as empty. A page without an id keeps its record; of equal payloads the one with the
smallest non-null id is the response. Memory per task is one record and one block.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.llm.common import drop, join_back, prepare, store
from orefold.session import scratch_path

ROWS_PER_ARCHIVE = 4000
BLOCK = 1 << 20
RECORD_END = b"\r\n\r\n"
NO_ID = "none"

MANIFEST = "archive string, records long"
INDEX = "archive string, offset long, length long, page_id long"
RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, digest_matches boolean, archive string, offset long"
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if ":" in uri else (pafs.LocalFileSystem(), uri)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system in which Spark finds it, so that every executor means the same folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toString()


def _number(value) -> str:
    return NO_ID if value is None else str(value)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record. The block is the HTTP header, followed by the payload unless it revisits another page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{_number(page_id)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(3, "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda found: quote(found[0]), url))
    if refers_to is not None:
        lines.insert(2, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.insert(3, f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + RECORD_END


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """WARC headers, HTTP header and body of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {name.lower(): value for name, value in (line.split(": ", 1) for line in lines)}
    block = rest[: int(headers["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    return headers, http, body


def _page(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if value == NO_ID else int(value)


def resolved(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, bytes and the page that each repeats (null for responses).

    Digests and ids are stored and resolved by themselves: a digest shared by a third of the pages is one row per map task when
    the responses are found, and a split partition when they are joined back. The html is never moved by its digest, only
    joined with the references by page_id, or not moved at all while these are few enough for Spark to broadcast.
    """
    body = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    known = store(body.select("page_id", "digest"), "page-digests")
    repeats = (
        known.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("page_id").alias("response_id"))
        .filter("copies > 1 AND response_id IS NOT NULL")
        .select("digest", "response_id")
    )
    other = (F.col("page_id") != F.col("response_id")) | F.col("page_id").isNull()
    met = join_back(known, repeats, ["digest"], "repeated-payloads").filter(other)
    references = store(met.select("page_id", "digest", "response_id").distinct(), "references")
    drop(known)
    its = references.select(F.col("page_id").alias("its_id"), F.col("digest").alias("its_digest"), "response_id")
    same = F.col("page_id").eqNullSafe(F.col("its_id")) & (F.col("digest") == F.col("its_digest"))
    return body.join(its, same, "left").select("page_id", "url", "html", "digest", F.col("response_id").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page's record into monolithic gzip archives; returns the stored manifest (archive, records).

    Of several rows with the smallest page_id of a payload each is a response: they are the same page.
    """
    prepare(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, out = [], None
        system, root = file_system(folder)
        system.create_dir(root)

        def finish() -> None:
            stream.write(deflate.flush())
            stream.close()
            system.move(f"{root}/{name}.part", f"{root}/{name}")
            archives.append((f"{folder}/{name}", count))

        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for page_id, url, html, digest, refers_to in zip(*columns):
                if out is None:
                    name, count = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    stream = out = system.open_output_stream(f"{root}/{name}.part", compression=None)
                    deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
                raw = record(
                    page_id.as_py(),
                    url.as_py(),
                    html.as_py().encode(),
                    base64.b32encode(digest.as_py()).decode(),
                    refers_to.as_py(),
                )
                stream.write(deflate.compress(raw))
                count += 1
                if count == ROWS_PER_ARCHIVE:
                    finish()
                    out = None
        if out is not None:
            finish()
        paths, counts = [list(x) for x in zip(*archives)] or ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], ["archive", "records"])

    return store(resolved(pages).mapInArrow(write, MANIFEST), "warc-manifest")


def _records(stream, size: int = BLOCK) -> Iterator[bytes]:
    """Records of one gzip stream (or several joined), inflated once in blocks."""
    inflate, held, need = zlib.decompressobj(31), bytearray(), None
    while True:
        block = stream.read(size)
        if not block:
            break
        while block:
            held += inflate.decompress(block)
            block = b""
            if inflate.eof:
                block, inflate = inflate.unused_data, zlib.decompressobj(31)
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                head = bytes(held[:end]).lower()
                at = head.index(b"\r\ncontent-length: ") + 18
                need = end + 4 + int(head[at:].split(b"\r\n", 1)[0]) + len(RECORD_END)
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError(f"{len(held)} bytes after the last whole record")


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """Rewrite every archive with one gzip member per record and a sidecar index; returns the stored index."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        system.create_dir(root)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                source, path = file_system(archive)
                name, index, offset = f"members-{uuid.uuid4().hex}.warc.gz", [], 0
                with (
                    source.open_input_stream(path, compression=None) as stream,
                    system.open_output_stream(f"{root}/{name}.part", compression=None) as out,
                ):
                    for raw in _records(stream):
                        deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = deflate.compress(raw) + deflate.flush()
                        out.write(member)
                        headers, _, _ = parse(raw)
                        index.append((offset, len(member), _page(headers["warc-record-id"])))
                        offset += len(member)
                with system.open_output_stream(f"{root}/{name}.idx") as sidecar:
                    sidecar.write("".join(f"{a}\t{b}\t{_number(c)}\n" for a, b, c in index).encode())
                system.move(f"{root}/{name}.part", f"{root}/{name}")
                offsets, lengths, ids = zip(*index)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{folder}/{name}"] * len(index), pa.string()),
                        pa.array(offsets, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(ids, pa.int64()),
                    ],
                    ["archive", "offset", "length", "page_id"],
                )

    return store(_by_archive(manifest).mapInArrow(rewrite, INDEX), "warc-index")


def _by_archive(rows: DataFrame) -> DataFrame:
    """Whole archives per task, in the number of partitions that the session asks for: the rows are few, their files not."""
    wanted = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(wanted, "archive")


def read_archives(index: DataFrame) -> DataFrame:
    """Read the indexed members back: headers, sizes, and whether the payload matches its digest (null for revisits)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, path, stream = [], None, None
            for archive, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if archive != path:
                    if stream is not None:
                        stream.close()
                    system, local = file_system(archive)
                    stream, path = system.open_input_file(local), archive
                headers, http, body = parse(zlib.decompress(stream.read_at(length, offset), 31))
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                kind = headers["warc-type"]
                http_size = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
                rows.append(
                    {
                        "page_id": _page(headers["warc-record-id"]),
                        "payload_bytes": len(body) if kind == "response" else http_size,
                        "payload_digest": digest,
                        "record_type": kind,
                        "refers_to": _page(headers["warc-refers-to"]) if kind == "revisit" else None,
                        "url": headers.get("warc-target-uri"),
                        "digest_matches": sha1_base32(body) == digest if kind == "response" else None,
                        "archive": archive,
                        "offset": offset,
                    }
                )
            if stream is not None:
                stream.close()
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_SCHEMA)

    return _by_archive(index).sortWithinPartitions("archive", "offset").mapInArrow(read, RECORD)


_RECORD_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
        ("digest_matches", pa.bool_()),
        ("archive", pa.string()),
        ("offset", pa.int64()),
    ]
)


def sound(records: DataFrame) -> DataFrame:
    """The records; the job fails at a response whose recomputed digest isn't that of its header."""
    damaged = F.concat(F.lit("damaged payload in "), F.col("archive"), F.lit(" at "), F.col("offset").cast("string"))
    return records.filter(F.when(~F.col("digest_matches"), F.raise_error(damaged).cast("boolean")).otherwise(True))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back; raises if a record was lost or a payload no longer has its digest."""
    root = qualified(pages.sparkSession, scratch_path(pages.sparkSession, "warc"))
    manifest = write_archives(pages, f"{root}/monolithic")
    written = manifest.agg(F.sum("records")).first()[0] or 0
    index = normalise(manifest, f"{root}/members")
    if index.count() != written:
        raise ValueError(f"{index.count()} of {written} records were normalised")
    system, path = file_system(f"{root}/monolithic")
    if written:
        system.delete_dir(path)
    return sound(read_archives(index))
