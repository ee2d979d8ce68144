"""Length-delimited binary records with masked checksums and a separate offset index.

A record is: 8 bytes length of the body, 4 bytes masked CRC-32 of those 8 bytes,
the body, 4 bytes masked CRC-32 of the body; all numbers little-endian. Masking
rotates a checksum and adds a constant, so that a checksum of data that holds
checksums stays useful. The body is a serialised token sequence: a flag byte,
8 bytes document id, 1 byte width of an id (2 or 4), and the ids. The index file
beside each data file has 8 bytes per record, its offset, and last the file size,
so that a reader can pick records in any order.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from areapulse.llm.common import Emitter, open_folder, rows_of
from areapulse.llm.tokens import VOCABULARY, text_encoder
from areapulse.session import new_folder, stage

MASK_DELTA = 0xA282EAD8
MANIFEST = "part long, path string, index_path string, records long, tokens long, bytes long"
ROWS = "doc_id long, start long, n_tokens long, ids binary"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    length = struct.pack("<Q", len(body))
    return b"".join((length, struct.pack("<I", masked_crc(length)), body, struct.pack("<I", masked_crc(body))))


def read_frame(stream) -> bytes | None:
    """The next body of an open file, or None at its end; ValueError for damaged data."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked_crc(head[:8]):
        raise ValueError("damaged record length")
    size = struct.unpack("<Q", head[:8])[0]
    body, check = stream.read(size), stream.read(4)
    if len(body) < size or len(check) < 4 or struct.unpack("<I", check)[0] != masked_crc(body):
        raise ValueError("damaged record body")
    return body


def serialise(doc_id: int | None, ids: bytes) -> bytes:
    """``ids`` are little-endian unsigned 32-bit; stored in half of that where all are below 65,536."""
    numbers = np.frombuffer(ids, dtype="<u4")
    width = 4 if len(numbers) and int(numbers.max()) > 0xFFFF else 2
    return struct.pack("<BqB", doc_id is not None, doc_id or 0, width) + (ids if width == 4 else numbers.astype("<u2").tobytes())


def deserialise(body: bytes) -> tuple[int | None, bytes]:
    known, doc_id, width = struct.unpack_from("<BqB", body)
    ids = np.frombuffer(body, dtype=f"<u{width}", offset=10)
    return doc_id if known else None, ids.astype("<u4").tobytes()


def write_records(docs: DataFrame, name: str = "token_records", end_id: int = 0, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write the ids of all texts, in ascending ``doc_id`` order, and return the stored manifest of files.

    Ranges of ``doc_id`` go to tasks, one data file and one index file each.
    Rows of one ``doc_id`` may be spread over neighbouring ranges by their text;
    NULL ids come first. NULL and empty texts have the end id alone. Files carry a
    random name and only those of finished tasks get into the manifest, so a
    repeated or lost task leaves nothing that is read.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, name)
    end = np.asarray([end_id], dtype="<u4").tobytes()
    schema = spark.createDataFrame([], MANIFEST).schema
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def write(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = Emitter(to_arrow_schema(schema))
        rows = rows_of(batches, "doc_id", "text")
        if (row := next(rows, None)) is not None:
            files, inner = open_folder(folder)
            files.create_dir(inner, recursive=True)
            part, key = TaskContext.get().partitionId(), uuid.uuid4().hex
            path, index_path = f"{inner}/{part:06d}-{key}.records", f"{inner}/{part:06d}-{key}.index"
            encoder, offsets, at, tokens = text_encoder(vocabulary), [], 0, 0
            with files.open_output_stream(path, compression=None) as data:
                while row is not None:
                    ids = encoder.encode(row[1]) + end
                    offsets.append(at)
                    at += data.write(record := frame(serialise(row[0], ids))) or len(record)
                    tokens += len(ids) // 4
                    row = next(rows, None)
            with files.open_output_stream(index_path, compression=None) as index:
                index.write(np.asarray([*offsets, at], dtype="<u8").tobytes())
            out.add(part, path.rpartition("/")[2], index_path.rpartition("/")[2], len(offsets), tokens, at)
        yield out.take()

    manifest = stage(spark, ranged.mapInArrow(write, schema), f"{name}_manifest")
    return manifest.withColumn("folder", F.lit(folder))


def stored_records(folder: str, path: str) -> Iterator[tuple[int | None, bytes]]:
    """All records of one data file, in order, each checked."""
    files, inner = open_folder(folder)
    with files.open_input_stream(f"{inner}/{path}", buffer_size=1 << 20) as stream:
        while (body := read_frame(stream)) is not None:
            yield deserialise(body)


def record_at(folder: str, path: str, index_path: str, number: int) -> tuple[int | None, bytes]:
    """One record through the offset index, as a shuffled reader takes them."""
    files, inner = open_folder(folder)
    with files.open_input_file(f"{inner}/{index_path}") as index:
        index.seek(8 * number)
        offset = struct.unpack("<Q", index.read(8))[0]
    with files.open_input_file(f"{inner}/{path}") as data:
        data.seek(offset)
        return deserialise(read_frame(data))


def read_records(manifest: DataFrame) -> DataFrame:
    """Every record of the manifest's files: ``doc_id``, ``start`` (ids of all records before it), ``n_tokens``, ``ids``.

    One file is one task's work. Files are listed in the order of their parts,
    which is the order of their ids.
    """
    spark = manifest.sparkSession
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    files = listed.repartition(max(1, manifest.count()), "part").select("folder", "path", "start")
    schema = spark.createDataFrame([], ROWS).schema

    def read(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = Emitter(to_arrow_schema(schema))
        for folder, path, start in rows_of(batches, "folder", "path", "start"):
            for doc_id, ids in stored_records(folder, path):
                out.add(doc_id, start, len(ids) // 4, ids, weight=len(ids))
                start += len(ids) // 4
                if out.full:
                    yield out.take()
        yield out.take()

    return files.mapInArrow(read, schema)
