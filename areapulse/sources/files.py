"""Scanning raw CSV drops: file lists, delimiters, headers."""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from areapulse.session import stage

BOM = "\ufeff"
SAMPLE_BYTES = 2048
#: A first record that goes on for longer has a quote that is never closed.
LONGEST_HEADER = 1 << 20
FILES_PER_TASK = 64
#: Schemes of paths that tasks open by themselves.
OPENED = ("file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")


def list_files(spark: SparkSession, directories: list[str], pattern: str, recursive: bool = False) -> DataFrame:
    """Readable path, identifying path, modification second and size of matching files.

    Only the listing is read, never the content. Missing directories are skipped.
    """
    found = []
    for directory in directories:
        reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        try:
            listed = reader.option("recursiveFileLookup", str(recursive).lower()).load(directory)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found.append(listed.select(
            F.col("path").alias("read_path"),
            F.col("_metadata.file_path").alias("path"),
            F.unix_timestamp("_metadata.file_modification_time").alias("mtime"),
            F.col("_metadata.file_size").alias("size"),
        ))
    if not found:
        return spark.createDataFrame([], "read_path string, path string, mtime bigint, size bigint")
    return reduce(DataFrame.unionByName, found)


def collect_files(
    spark: SparkSession, directories: list[str], patterns: list[str], recursive: bool = False
) -> list[str]:
    """Matching paths, sorted within each directory and pattern."""
    paths = []
    for directory in directories:
        for pattern in patterns:
            rows = list_files(spark, [directory], pattern, recursive).select("read_path").orderBy("read_path")
            paths += [row["read_path"] for row in rows.toLocalIterator()]
    return paths


def open_stream(uri: str):
    """A file of shared storage for reading, from its path as Spark names it."""
    from urllib.parse import unquote, urlsplit

    scheme = urlsplit(uri).scheme
    if scheme in ("", "file"):
        return pafs.LocalFileSystem().open_input_stream(unquote(urlsplit(uri).path) if scheme else uri, compression=None)
    files, path = pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return files.open_input_stream(path, compression=None)


def has_first_record(data: bytes) -> bool:
    """Whether a line ends outside quotes."""
    quotes = 0
    for line in data.splitlines(keepends=True):
        quotes += line.count(b'"')
        if quotes % 2 == 0 and line.endswith((b"\n", b"\r")):
            return True
    return False


def head_of(stream) -> str:
    """The first ``SAMPLE_BYTES`` of a file, or as much more as a longer first record takes, without a byte order mark."""
    data = stream.read(SAMPLE_BYTES)
    while not has_first_record(data):
        more = stream.read(SAMPLE_BYTES)
        # a quote that is never closed is no quoted field
        if not more or len(data) >= LONGEST_HEADER:
            break
        data += more
    return data.decode("utf-8", "ignore").removeprefix(BOM)


def heads(listed: DataFrame) -> DataFrame:
    """``path`` and ``head``, the start of every listed file, read in the tasks: 2 KB a file.

    Schemes that only Spark's readers know are read by these, up to the first
    block of a file.
    """
    spark = listed.sparkSession
    scheme = F.regexp_extract("read_path", r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    known = stage(spark, listed.select("path", "read_path", scheme.isin("", *OPENED).alias("_opened")), "listed_files")

    def read(batches):
        for batch in batches:
            texts = []
            for uri in batch.column("read_path").to_pylist():
                with open_stream(uri) as stream:
                    texts.append(head_of(stream))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(texts, pa.string())], names=["path", "head"])

    count = known.where("_opened").count()
    opened = known.where("_opened").select("path", "read_path").repartition(max(1, -(-count // FILES_PER_TASK)), "path")
    found = opened.mapInArrow(read, "path string, head string")
    others = [r["read_path"] for r in known.where("not _opened").select("read_path").toLocalIterator()]
    if others:
        rows = spark.read.text(others).select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"), "value"
        )
        lines = rows.where(F.col("_start") == 0).groupBy("path").agg(F.first("value").alias("head"))
        found = found.union(lines.select("path", F.regexp_replace("head", f"^{BOM}", "")))
    return found


def detect_delimiter(lines: list[str]) -> str:
    """Delimiter of a text sample; a bar, else a comma, when it is not clear."""
    sample = "\n".join(lines)[:SAMPLE_BYTES]
    if not sample:
        return ","
    try:
        return csv.Sniffer().sniff(sample, delimiters=",|;\t").delimiter
    except csv.Error:
        return "|" if "|" in sample else ","


@dataclass(frozen=True)
class Layout:
    """A delimiter and header; ``lines`` that the header takes are more than one where a quoted name holds a line break."""

    sep: str
    columns: tuple[str, ...]
    lines: int


def layout_of(head: str) -> Layout | None:
    """The layout of a file that starts with ``head``; None if it has no first record."""
    whole = head.splitlines(keepends=True)
    if not "".join(whole[:1]).strip():
        return None
    # the last line may be cut off
    sample = whole[:-1] if len(whole) > 1 and len(head.encode()) >= SAMPLE_BYTES else whole
    sep = detect_delimiter([line.rstrip("\r\n") for line in sample])
    reader = csv.reader(io.StringIO(head, newline=""), delimiter=sep)
    columns = next(reader, [])
    if reader.line_num > 1 and not head.count('"') > 1:
        columns, lines = next(csv.reader(whole[:1], delimiter=sep)), 1
    else:
        lines = reader.line_num
    return Layout(sep, tuple(c.strip() for c in columns), lines)


def layouts(listed: DataFrame) -> DataFrame:
    """One row per listed file that has a header, with its ``sep``, ``columns`` and header ``lines``; made from 2 KB of each."""
    schema = "path string, sep string, columns array<string>, lines int"

    def parse(batches):
        for batch in batches:
            found = [(p, layout_of(h)) for p, h in zip(batch.column("path").to_pylist(), batch.column("head").to_pylist(), strict=True)]
            found = [(p, x) for p, x in found if x]
            yield pa.RecordBatch.from_arrays([
                pa.array([p for p, _ in found], pa.string()), pa.array([x.sep for _, x in found], pa.string()),
                pa.array([list(x.columns) for _, x in found], pa.list_(pa.string())), pa.array([x.lines for _, x in found], pa.int32()),
            ], names=["path", "sep", "columns", "lines"])

    return stage(listed.sparkSession, heads(listed).mapInArrow(parse, schema), "file_layouts")


def listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``read_path`` and identifying ``path`` of single files, without their content."""
    found = spark.read.format("binaryFile").load(paths)
    return found.select(F.col("path").alias("read_path"), F.col("_metadata.file_path").alias("path"))


def read_layouts(listed: DataFrame) -> list[tuple[DataFrame, list[str]]]:
    """The listed files as text columns with ``source_file``: a frame per layout and the files it reads.

    Every layout is read by its own delimiter and header, and checked against the
    header of each of its files. Spark's reader takes the names of the files from
    the driver.
    """
    spark = listed.sparkSession
    by_layout: dict[tuple, list[str]] = {}
    for row in layouts(listed).orderBy("path").toLocalIterator():
        by_layout.setdefault((row["sep"], tuple(row["columns"]), row["lines"] > 1), []).append(row["path"])
    frames = []
    for (sep, _, broken), files in by_layout.items():
        reader = spark.read.option("header", True).option("enforceSchema", False).option("sep", sep).option("multiLine", broken)
        df = reader.csv(files)
        df = df.select("*", F.col("_metadata.file_path").alias("source_file"))
        frames.append((df.toDF(*[c.removeprefix(BOM).strip() for c in df.columns]), files))
    return frames


def read_csv(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame:
    """All files as text columns, read by name, with ``source_file`` naming the file of a row.

    Files may differ in delimiter, order of columns and columns; one that a file
    lacks is NULL. Files without a first line have no rows.
    """
    if not paths:
        raise FileNotFoundError("no CSV files to read")
    frames = read_layouts(listing(spark, paths))
    df = concat([frame for frame, _ in frames]) if frames else spark.createDataFrame([], "source_file string")
    return df.select(*columns, "source_file") if columns else df


def read_directory(spark: SparkSession, directory: str, pattern: str = "*.csv", recursive: bool = False) -> DataFrame:
    paths = collect_files(spark, [directory], [pattern], recursive)
    if not paths:
        raise FileNotFoundError(f"no files like {pattern} in {directory}")
    return read_csv(spark, paths)


def concat(frames: list[DataFrame]) -> DataFrame:
    """Frames under one another, by name; a column a frame lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
