"""WARC archives: a record per page, written and read back as a table of chunks."""

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

from corposcope.llm.common import scratch_path, written

CHUNK = 1 << 20
CRLF = b"\r\n"


def filesystem(where: str):
    """(file system, path) of a URI for pyarrow; s3a and s3n are s3 there."""
    from pyarrow import fs

    uri = re.sub(r"^s3[an]:", "s3:", where)
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri)) if re.match(r"^\w+:", uri) else (fs.LocalFileSystem(), uri)


def bare_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def with_kinds(pages: DataFrame, least: int = 0, id_col: str = "page_id", body_col: str = "html") -> DataFrame:
    """Adds payload (binary), payload_bytes, sha1, record_type and refers_to.

    Columns of the caller with these names, or named first or sha256, are replaced or dropped. Null bodies are empty
    payloads; rows without an id are responses. Of equal payloads (SHA-1, SHA-256 and length agree) of at least `least` bytes the
    smallest id is the response, the others are revisits of it. Digests are counted in partial aggregates; only those
    that occur twice or more are joined back, from a written table, so a payload that a third of the rows share can be split.
    """
    rows = pages.withColumn("payload", F.encode(F.coalesce(F.col(body_col), F.lit("")), "utf-8"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1("payload"))
    key = ["sha1", "payload_bytes", "sha256"]
    rows = rows.withColumn("sha256", F.sha2("payload", 256))
    first = written(rows.where(F.col("payload_bytes") >= least).groupBy(*key).agg(F.min(id_col).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "payloads")
    out = rows.join(first, key, "left")
    again = F.col("first").isNotNull() & (F.col("first") != F.col(id_col))
    return out.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn("refers_to", F.when(again, F.col("first"))).drop("first", "sha256")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", chunk: int = CHUNK) -> DataFrame:
    """Writes the rows of with_kinds() as gzipped WARC files, one a partition; returns (path, records, bytes).

    Payloads are handed to the writer as chunk rows (record, chunk number, bytes), each cut from the payload when it is
    its turn. The JVM holds the row that it reads, a Python worker an Arrow batch of chunks (bounded by Spark's
    arrow.maxBytesPerBatch, and a chunk at least), never a whole payload.
    A file is named by its task attempt; only the files that the returned table names are complete, so a lost
    executor or a repeated attempt leaves no record twice. Null URLs are written as urn:page:<id>,
    and control characters and spaces are taken out of URLs.
    """
    size = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0)
    numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(size / chunk).cast("int") - 1))
    piece = F.when(size > 0, F.substring("payload", F.col("chunk") * chunk + 1, F.lit(chunk))).otherwise(F.lit(b""))
    url = F.coalesce(F.regexp_replace(F.col(url_col), r"[\x00-\x20\x7f]", ""), F.concat(F.lit("urn:page:"), F.col(id_col).cast("string")))
    rows = pages.select("*", F.explode(numbers).alias("chunk")).select(
        F.col(id_col).cast("string").alias("id"), url.alias("url"), "record_type", F.col("refers_to").cast("string").alias("refers_to"), "payload_bytes", F.unhex("sha1").alias("sha1"), "chunk", piece.alias("data")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, root = filesystem(folder)
        path, out, records, gz = f"{root}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", None, 0, None
        total = 0
        for batch in batches:
            columns = [batch.column(k) for k in range(batch.num_columns)]
            for row in zip(*columns, strict=True):
                ident, url, kind, refers, size, sha1, number, data = (x.as_py() for x in row)
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(path)
                if number == 0:
                    if gz is not None:
                        out.write(gz.compress(CRLF + CRLF) + gz.flush())
                    gz, records = zlib.compressobj(6, zlib.DEFLATED, 31), records + 1
                    out.write(gz.compress(head(ident, url, kind, refers, size, bare_sha1(sha1))))
                if data:
                    out.write(gz.compress(data))
        if out is not None:
            out.write(gz.compress(CRLF + CRLF) + gz.flush())
            total = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path.removeprefix(root + "/")], "records": [records], "bytes": [total]})

    return written(rows.mapInArrow(run, "path string, records long, bytes long"), "archives")


def head(ident: str, url: str, kind: str, refers: str | None, size: int, digest: str) -> bytes:
    """WARC and HTTP headers of a record. The payload's full length goes along, for a revisit has no payload."""
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % size, b"", b""])
    fields = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{ident}>", "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {size}"]
    if kind == "revisit":
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (size if kind == 'response' else 0)}", "", ""]
    return "\r\n".join(fields).encode() + http


class Inflated:
    """Bytes of a gzip file of many members, read a block at a time."""

    def __init__(self, stream, block: int = 256 << 10) -> None:
        self.stream, self.block, self.member, self.held, self.raw = stream, block, zlib.decompressobj(31), bytearray(), b""

    def more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.stream.read(self.block)
                if not self.raw:
                    return False
            if self.member.eof:
                self.member = zlib.decompressobj(31)
            data = self.member.decompress(self.raw, self.block)
            self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if data:
                self.held += data
                return True

    def line_block(self) -> bytes | None:
        """Up to and with the next empty line; None at the end."""
        while (at := self.held.find(b"\r\n\r\n")) < 0:
            if not self.more():
                return None
        out = bytes(self.held[: at + 4])
        del self.held[: at + 4]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def records(stream, chunk: int = CHUNK) -> Iterator[tuple]:
    """(record id, type, refers to, url, declared digest, payload length, chunk, last, bytes so far, digest so far, data) of each chunk."""
    source = Inflated(stream)
    while (block := source.line_block()) is not None:
        fields = dict(x.split(": ", 1) for x in block.decode().split("\r\n")[1:] if x)
        http = source.line_block() or b""
        rest = int(fields["Content-Length"]) - len(http)
        sha, seen, number = hashlib.sha1(), 0, 0
        while True:
            data = source.take(min(chunk, rest - seen))
            if len(data) < min(chunk, rest - seen):
                raise ValueError(f"{fields['WARC-Record-ID']} ends early")
            sha.update(data)
            seen += len(data)
            yield (fields["WARC-Record-ID"], fields["WARC-Type"], fields.get("WARC-Refers-To"), fields["WARC-Target-URI"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"]), number, seen == rest, seen, bare_sha1(sha.digest()), data)
            number += 1
            if seen == rest:
                break
        if source.take(4) != CRLF + CRLF:
            raise ValueError(f"{fields['WARC-Record-ID']} has no end")


CHUNK_TABLE = "record_id string, record_type string, refers_to string, url string, declared_digest string, payload_length long, chunk int, last boolean, bytes_so_far long, digest_so_far string, data binary"


def read_archives(archives: DataFrame, folder: str, chunk: int = CHUNK, files_per_task: int = 1) -> DataFrame:
    """The chunk table of the archives that write_archives() returned: rows of record id and chunk number, each with
    the bytes and the SHA-1 of the payload so far. A worker holds one chunk, or as many small ones, and one block of a file."""
    names = [x.strip().split(" ")[0] for x in CHUNK_TABLE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                held: list[tuple] = []
                size = 0
                with fs.open_input_stream(f"{root}/{name}") as stream:
                    for row in records(stream, chunk):
                        held.append(row)
                        size += len(row[-1]) + 200
                        if size > chunk:
                            yield to_batch(held)
                            held, size = [], 0
                if held:
                    yield to_batch(held)

    def to_batch(held: list[tuple]) -> pa.RecordBatch:
        types = [pa.string()] * 5 + [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

    paths = archives.select("path").repartition(max(1, archives.count() // files_per_task), "path")
    return paths.mapInArrow(run, CHUNK_TABLE)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, as read back from the archives; a page_id that is no integer comes back as null."""
    from corposcope.llm.common import table

    folder = scratch_path(spark, "warc")
    pages = with_kinds(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    chunks = read_archives(write_archives(pages, folder), folder)
    # the last chunk of a record has the digest of all of it; a revisit has the one it was written with
    number = F.regexp_extract("record_id", "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    revisit = F.col("record_type") == "revisit"
    return chunks.where("last").select(
        number.alias("page_id"),
        F.when(revisit, F.col("payload_length")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        "record_type",
        F.regexp_extract("refers_to", "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long").alias("refers_to"),
    )
