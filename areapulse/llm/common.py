"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Words are runs of anything but the six ASCII white space characters, which is what ``bytes.split`` separates by.
WORDS = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\v\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; NULL for a NULL key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def lower_ascii(text: str) -> bytes:
    """UTF-8 with A-Z in lower case; other letters stay as they are."""
    return text.encode("utf-8", "surrogatepass").lower()


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder in shared storage, and the path inside it."""
    return pafs.FileSystem.from_uri(uri)


def rows_of(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of the named columns, a slice at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield from zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns), strict=True)


_held: dict = {}


def hold_one(key, make: Callable):
    """What ``make`` gives, kept by a Python worker until another key is asked for.

    Workers are used again from stage to stage; they keep the large tables of one
    operator at a time.
    """
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def give_back() -> None:
    """Return memory that Arrow has freed but not given back; at the end of a task, as its worker lives on."""
    pa.default_memory_pool().release_unused()


def let_go() -> None:
    """Give back memory, that of tables which earlier operators left with the worker too; for tasks that hold none themselves."""
    _held.clear()
    give_back()


class Emitter:
    """Collects output rows and hands them on as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, rows: int = 8192, weight: int = 8 << 20):
        self.schema, self.most_rows, self.most_weight = schema, rows, weight
        self.clear()

    def clear(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.weight = 0

    def add(self, *values, weight: int = 0) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.weight += weight

    def extend(self, *columns: list, weight: int = 0) -> None:
        """Rows, given by their columns."""
        for column, values in zip(self.columns, columns, strict=True):
            column.extend(values)
        self.weight += weight

    @property
    def full(self) -> bool:
        return len(self.columns[0]) >= self.most_rows or self.weight >= self.most_weight

    def take(self) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)]
        self.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def map_rows(df: DataFrame, columns: list[str], schema: str, each: Callable[..., Iterator[tuple]], weight=None) -> DataFrame:
    """Apply a generator to every row; its tuples become rows of ``schema``.

    Only ``columns`` are sent to Python. ``weight`` gives the bytes of a tuple,
    so that batches of long values stay small.
    """
    out = df.select(*[F.col(f"`{c}`") for c in columns]).sparkSession.createDataFrame([], schema).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        emitter = Emitter(to_arrow_schema(out))
        for row in rows_of(batches, *columns):
            for made in each(*row):
                emitter.add(*made, weight=weight(made) if weight else 0)
                if emitter.full:
                    yield emitter.take()
        yield emitter.take()
        give_back()

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, out)
