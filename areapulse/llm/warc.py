"""WARC archives: one gzip member per record, payloads that repeat stored as revisits.

A page whose payload equals that of a page with a smaller id becomes a
``revisit`` record that names the other; all others are ``response`` records.
The reader goes through an archive front to back in small blocks: it inflates
member after member, takes each record's block by its ``Content-Length``, and
checks block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from areapulse.llm.common import Emitter, give_back, open_folder, rows_of
from areapulse.session import new_folder, stage

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:page:"
END = b"\r\n\r\n"

MANIFEST = "path string, records long, bytes long"
ROWS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
READ_BYTES = 1 << 18


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in value)


def headers_of(first: str, fields: dict[str, object]) -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in fields.items() if v is not None)]).encode() + END


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit keeps the response's HTTP headers, whose Content-Length is the full payload's, and no payload."""
    http = headers_of("HTTP/1.1 200 OK", {"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)})
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{RECORD_URN}{'' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else plain(url),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "WARC-Refers-To": None if refers_to is None else f"<{RECORD_URN}{refers_to}>",
        "WARC-Profile": None if refers_to is None else REVISIT_PROFILE,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    return headers_of(VERSION, fields) + block + END


def member(data: bytes, level: int = 6) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


class MemberStream:
    """The inflated bytes of concatenated gzip members, member by member, read in blocks."""

    def __init__(self, stream):
        self.stream, self.rest, self.buffer, self.inflate = stream, b"", bytearray(), None

    def _more(self) -> bool:
        """Inflate a little more of the current member; False at its end."""
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail
        if not data:
            data, self.rest = self.rest or self.stream.read(READ_BYTES), b""
        if not data:
            raise ValueError("archive ends inside a gzip member")
        self.buffer += self.inflate.decompress(data, READ_BYTES)
        if self.inflate.eof:
            self.rest = self.inflate.unused_data
        return True

    def finish(self) -> None:
        """Read the member's end, which holds its checksum; nothing else may be left."""
        while not self.inflate.eof:
            self._more()
        if self.buffer:
            raise ValueError("bytes after the end of a record")

    def next_member(self) -> bool:
        """Go to the next member; False at the end of the archive."""
        self.rest = self.rest or self.stream.read(READ_BYTES)
        self.inflate = zlib.decompressobj(31)
        return bool(self.rest)

    def until(self, mark: bytes) -> bytes:
        while (at := self.buffer.find(mark)) < 0:
            if not self._more():
                raise ValueError("record headers do not end")
        return self.take(at + len(mark))[:at]

    def take(self, size: int) -> bytes:
        while len(self.buffer) < size:
            if not self._more():
                raise ValueError("record is shorter than its Content-Length")
        out = bytes(self.buffer[:size])
        del self.buffer[:size]
        return out


def parse_headers(data: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = data.decode().split("\r\n")
    return first, {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def read_archive(stream) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """WARC headers, HTTP headers and payload of each record; ValueError where lengths or digests do not hold."""
    members = MemberStream(stream)
    while members.next_member():
        version, fields = parse_headers(members.until(END))
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        block = members.take(int(fields["content-length"]))
        if members.take(len(END)) != END:
            raise ValueError("record does not end after its Content-Length")
        members.finish()
        if fields.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
            raise ValueError("block digest differs")
        head, _, payload = block.partition(END)
        if fields["warc-type"] == "response" and fields["warc-payload-digest"] != f"sha1:{digest(payload)}":
            raise ValueError("payload digest differs")
        yield fields, parse_headers(head)[1], payload


def page_of(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(RECORD_URN)
    return int(number) if number else None


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id`` and ``refers_to`` of the pages that repeat the payload of a page with a smaller id.

    Payloads below ``least_bytes`` are never revisits. Equal payloads are met by
    their SHA-1, counted before they are shuffled. Rows of the smallest id are
    all responses; a NULL id refers to a known one, but never answers.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    keyed = stage(
        pages.sparkSession,
        pages.select("page_id", F.sha1(payload).alias("_sha1"), F.length(payload).alias("_bytes")).where(F.col("_bytes") >= least_bytes),
        "page_digests",
    )
    first = stage(pages.sparkSession, keyed.groupBy("_sha1").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_n")).where("_n > 1"), "payloads")
    return keyed.join(first, "_sha1").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(
        "page_id", "_sha1", "refers_to"
    ).distinct()


def write_archives(pages: DataFrame, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write one archive per task and return the stored manifest.

    The payload is ``html`` in UTF-8, empty for NULL; a NULL ``url`` leaves its
    header out. An empty table has no archives. Archives of unfinished tasks are never in the manifest.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    schema = spark.createDataFrame([], MANIFEST).schema
    rows = pages.select("page_id", "url", "html", F.sha1(F.encode(F.coalesce("html", F.lit("")), "utf-8")).alias("_sha1"))
    other = revisits(pages, least_bytes).withColumnsRenamed({"page_id": "_page", "_sha1": "_other"})
    marked = rows.join(other, rows["page_id"].eqNullSafe(other["_page"]) & (rows["_sha1"] == other["_other"]), "left")

    def write(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = Emitter(to_arrow_schema(schema))
        found = rows_of(batches, "page_id", "url", "html", "refers_to")
        if (row := next(found, None)) is not None:
            files, inner = open_folder(folder)
            files.create_dir(inner, recursive=True)
            name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
            records = size = 0
            with files.open_output_stream(f"{inner}/{name}", compression=None) as archive:
                while row is not None:
                    page_id, url, html, refers_to = row
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    archive.write(data := member(record(page_id, url, payload, refers_to, date), level))
                    records, size = records + 1, size + len(data)
                    row = next(found, None)
            out.add(name, records, size)
        yield out.take()
        give_back()

    picked = marked.select("page_id", "url", "html", "refers_to")
    return stage(spark, picked.mapInArrow(write, schema), "warc_manifest").withColumn("folder", F.lit(folder))


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record; the payload of a revisit is NULL, its size and digest are those of the response.

    Without ``payloads`` these are read and checked, but stay in the tasks. A
    record is held in memory as a whole, so the longest payload bounds a task. No
    archives give no rows.
    """
    spark = manifest.sparkSession
    files = manifest.select("folder", "path").repartition(max(1, manifest.count()), "path")
    schema = spark.createDataFrame([], ROWS if payloads else ROWS.removesuffix(", payload binary")).schema

    def read(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = Emitter(to_arrow_schema(schema))
        for folder, path in rows_of(batches, "folder", "path"):
            store, inner = open_folder(folder)
            with store.open_input_stream(f"{inner}/{path}", compression=None) as stream:
                for fields, http, payload in read_archive(stream):
                    kind = fields["warc-type"]
                    row = [
                        page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), int(http["content-length"]),
                        fields["warc-payload-digest"].removeprefix("sha1:"), kind, page_of(fields.get("warc-refers-to")),
                    ]
                    if payloads:
                        row.append(payload if kind == "response" else None)
                    out.add(*row, weight=len(payload) if payloads else 0)
                    if out.full:
                        yield out.take()
        yield out.take()
        give_back()

    return files.mapInArrow(read, schema)
