"""Versioned tables of named parts on a shared file system.

A version is a small file that names a folder for every part of every table. It
is written aside and renamed into place, which is its publication: readers take
the newest version there is, and folders that a version names never change. A new
version names new folders for the parts that changed and the old ones for the
rest, so an update writes what it touches, a run that dies before the rename
leaves nothing that is read, and a reader that began with an older version goes on.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import PySparkRuntimeError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

PART = "_part"


class ConcurrentPublication(RuntimeError):
    """Another writer published first; the update has to be made again from the newer version."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    #: Folder of each part of each table, below the root.
    parts: dict[str, dict[str, str]] = field(default_factory=dict)

    def folders(self, table: str, parts: list[str] | None = None) -> list[str]:
        held = self.parts.get(table, {})
        return sorted(held.values() if parts is None else [held[p] for p in parts if p in held])


class VersionedTables:
    """Tables below one root. Parts are months, buckets of a key, or whatever an update can be told by; few against the rows."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    @property
    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """Published versions, in order."""
        files, folder = self._files, self._path("versions")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int | None = None) -> Version:
        """A published version, the newest by default; an empty one before the first."""
        if number is None:
            number = max(self.numbers(), default=0)
        if not number:
            return Version()
        stream = self._files.open(self._path(f"versions/{number:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(number, json.loads(text))

    def read(self, table: str, schema: StructType, version: Version | None = None, parts: list[str] | None = None) -> DataFrame:
        """The rows of a table, of the named parts only if there are some named; only their folders are listed and read."""
        folders = (version or self.version()).folders(table, parts)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def write(self, table: str, rows: DataFrame, part: str) -> dict[str, str]:
        """Write rows, whose column ``part`` names their part, into new folders; the folder of each part."""
        name = f"data/{table}-{uuid.uuid4().hex}"
        rows.withColumn(PART, F.col(part).cast("string")).write.partitionBy(PART).parquet(f"{self.root}/{name}")
        statuses = self._files.listStatus(self._path(name))
        made = [s.getPath().getName() for s in statuses if s.isDirectory()]
        return {m.split("=", 1)[1]: f"{name}/{m}" for m in made if m.startswith(f"{PART}=")}

    def publish(self, base: Version, changes: dict[str, dict[str, str | None]]) -> Version:
        """Name new folders (``None``: no rows any more) for parts of ``base``; fails if that is not the newest version any more."""
        parts = {table: dict(held) for table, held in base.parts.items()}
        for table, changed in changes.items():
            held = parts.setdefault(table, {})
            for part, folder in changed.items():
                if folder is None:
                    held.pop(part, None)
                else:
                    held[part] = folder
        version, files = Version(base.number + 1, parts), self._files
        files.mkdirs(self._path("versions"))
        aside, target = self._path(f"versions/.{uuid.uuid4().hex}"), self._path(f"versions/{version.number:012d}.json")
        stream = files.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
        finally:
            stream.close()
        # the number may be taken between a look and the rename, which then does not replace it
        if files.exists(target) or not files.rename(aside, target):
            files.delete(aside, False)
            raise ConcurrentPublication(f"version {version.number} of {self.root} exists")
        return version

    def forget(self, keep: int = 2) -> int:
        """Delete versions but the newest ``keep``, and folders that only they name; the number of folders.

        Readers of forgotten versions, and updates that are under way, must have ended.
        """
        if keep < 1:
            raise PySparkRuntimeError("at least one version has to be kept")
        numbers, files = self.numbers(), self._files
        kept = {f for n in numbers[-keep:] for held in self.version(n).parts.values() for f in held.values()}
        old = {f for n in numbers[:-keep] for held in self.version(n).parts.values() for f in held.values()} - kept
        for folder in old:
            files.delete(self._path(folder), True)
        for number in numbers[:-keep]:
            files.delete(self._path(f"versions/{number:012d}.json"), False)
        return len(old)
