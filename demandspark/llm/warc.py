"""WARC archives: a writer with revisit records and a sequential reader.

Every record is a gzip member of its own. The reader decompresses step by step,
frames records by their Content-Length and verifies their digests; it holds one
record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import map_rows, shared_dir, stage, table

CHUNK = 1 << 16
ARCHIVE_BYTES = 64 << 20
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CAPTURED = "2024-01-01T00:00:00Z"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{key}')}>"


def member(headers: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    raw = f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def page_record(key: object, url: str | None, payload: bytes, first: object) -> bytes:
    """Response record of a page, or revisit record if an earlier page has the payload."""
    block = HTTP_HEAD + payload if key == first else HTTP_HEAD
    headers = {
        "WARC-Type": "response" if key == first else "revisit", "WARC-Record-ID": record_id(key), "WARC-Date": CAPTURED,
        "WARC-Target-URI": " ".join((url or "").split()) or f"urn:page:{key}", "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{sha1_base32(payload)}", "WARC-Block-Digest": f"sha1:{sha1_base32(block)}", "X-Page-ID": str(key)}
    if key != first:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(first), "X-Refers-To-Page-ID": str(first)}
    return member(headers, block)


class RecordStream:
    """Decompressed bytes of an archive, member after member."""

    def __init__(self, source: BinaryIO) -> None:
        self.source, self.raw, self.out, self.at = source, b"", bytearray(), 0
        self.zip = None

    def _more(self) -> bool:
        """Decompress one step; false at the end of the archive."""
        if not self.raw:
            self.raw = self.source.read(CHUNK)
            if not self.raw:
                if self.zip is not None:
                    raise ValueError("the archive ends inside a gzip member")
                return False
        if self.zip is None:
            self.zip = zlib.decompressobj(31)
        self.out += self.zip.decompress(self.raw, CHUNK)
        self.raw = self.zip.unconsumed_tail or self.zip.unused_data
        if self.zip.eof:
            self.zip = None
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; none at the end."""
        seen = self.at
        while (found := self.out.find(mark, max(self.at, seen - len(mark)))) < 0:
            seen = len(self.out)
            if not self._more():
                if bytes(self.out[self.at:]).strip():
                    raise ValueError("the archive ends inside a record head")
                return None
        return self._take(found + len(mark) - self.at)

    def exactly(self, n: int) -> bytes:
        while len(self.out) - self.at < n:
            if not self._more():
                raise ValueError("the archive ends inside a record block")
        return self._take(n)

    def _take(self, n: int) -> bytes:
        data = bytes(self.out[self.at:self.at + n])
        self.at += n
        if self.at > CHUNK:
            del self.out[:self.at]
            self.at = 0
        return data


def read_records(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, block digest verified."""
    stream = RecordStream(source)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        version, *lines = head.decode("utf-8").strip().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}
        block = stream.exactly(int(headers["content-length"]))
        if stream.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        want = headers.get("warc-block-digest")
        if want and want != f"sha1:{sha1_base32(block)}":
            raise ValueError(f"block digest of {headers.get('warc-record-id')} differs")
        yield headers, block


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page under ``path``; returns the written list of archives (path, records, bytes).

    ``pages`` has page_id, url, html; other columns are ignored, null html is an
    empty payload. Of pages with equal payloads the one with the smallest page_id is
    the response. A null page_id comes after all others; page_id identifies a page,
    so rows that repeat it are all written, as responses if it is their payload's
    first. File names hold the task attempt, and the list is written once by Spark,
    so files of failed attempts are never read.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    base = pages.select("page_id", "url", html.alias("_payload")).withColumn("_digest", F.sha1("_payload"))
    firsts = base.groupBy("_digest").agg(F.min("page_id").alias("_first"))
    rows = base.join(firsts, "_digest")
    path = path if "://" in path or path.startswith("file:") else os.path.abspath(path)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        task = TaskContext.get()
        store, top = fs.FileSystem.from_uri(path)
        store.create_dir(top, recursive=True)
        out, name, records, size, k = None, "", 0, 0, 0
        for key, url, payload, first in rows:
            if out is None:
                name = f"{top}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{k:04d}.warc.gz"
                out, records, size, k = store.open_output_stream(name, compression=None), 0, 0, k + 1
            data = page_record(key, url, payload, first)
            out.write(data)
            records, size = records + 1, size + len(data)
            if size >= archive_bytes:
                out.close()
                yield name, records, size
                out = None
        if out is not None:
            out.close()
            yield name, records, size

    return stage(map_rows(rows, ["page_id", "url", "_payload", "_first"], "path string, records bigint, bytes bigint", run))


def read_archives(archives: DataFrame, path: str) -> DataFrame:
    """Records of the listed archives: page_id, record_id, record_type, payload, payload_bytes, payload_digest, refers_to.

    A response's payload digest is computed from its payload and must be the stated
    one. The payload of a revisit stands in the record it refers to, so its size is
    null here; :func:`resolve` fills it.
    """
    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        store, _ = fs.FileSystem.from_uri(path)
        for (name,) in rows:
            with store.open_input_stream(name, compression=None) as source:
                for headers, block in read_records(source):
                    kind, stated = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
                    payload = None
                    if kind == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        if sha1_base32(payload) != stated:
                            raise ValueError(f"payload digest of {headers['warc-record-id']} differs")
                    page, refers = headers["x-page-id"], headers.get("x-refers-to-page-id")
                    yield (None if page == "None" else int(page), headers["warc-record-id"], kind, payload,
                           None if payload is None else len(payload), stated, None if refers is None else int(refers))

    n = archives.count()
    spread = archives.select("path").repartition(max(1, n)) if n else archives.select("path")
    return map_rows(spread, ["path"], "page_id bigint, record_id string, record_type string, payload binary, "
                    "payload_bytes bigint, payload_digest string, refers_to bigint", run)


def resolve(records: DataFrame) -> DataFrame:
    """Payload sizes of revisits from the responses with the same payload digest."""
    known = records.where("record_type = 'response'").select("payload_digest", "payload_bytes").distinct()
    return records.drop("payload_bytes").join(known, "payload_digest")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    archives = write_archives(table(spark, sf_dir, "pages"), path)
    records = stage(read_archives(archives, path).drop("payload"))
    return resolve(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

