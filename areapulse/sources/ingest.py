"""Incremental ingest of raw files, in batches or from a stream, into delta folders with a commit log.

Each run reads only files the log does not know by (source, path, mtime, size).
They are parsed once, by the layout of each file, into a columnar copy that the
fact rows and places are made from. A run writes its fact rows to a folder of its own and appends to the log last, so a
run that dies half-way leaves rows that nobody reads. The state of the fact
tables is the sum over the committed rows; because those keep the file they came
from, a changed file can either add to or replace its earlier version. ``refresh``
keeps that sum stored by month, in versions, and rewrites only months that changed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from areapulse.operators.domains import FILE_PATTERNS
from areapulse.operators.normalize import NORMALISERS
from areapulse.schemas import (
    ACTIVITY_KEY, DEMOGRAPHICS_KEY, DIM_SPATIAL, GOLD_ACTIVITY, GOLD_DEMOGRAPHICS, INGEST_LOG, MEASURES,
)
from areapulse.session import stage
from areapulse.sources.files import concat, list_files, read_layouts
from areapulse.sources.upserts import fill_spatial
from areapulse.sources.versions import Version, VersionedTables

FILE_KEY = ["source", "path", "mtime", "size"]
PAIR = ["batch_id", "source_file"]
PAIRS = StructType().add("batch_id", "string").add("source_file", "string")
#: Key and measures of the fact tables that a refresh keeps added up.
FACTS = {"activity": (GOLD_ACTIVITY, ACTIVITY_KEY, MEASURES), "demographics": (GOLD_DEMOGRAPHICS, DEMOGRAPHICS_KEY, ["value"])}


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class IngestStore:
    """Delta folders and log below one root on a shared file system."""

    spark: SparkSession
    root: str

    def log(self) -> DataFrame:
        return _read_or_empty(self.spark, f"{self.root}/log", INGEST_LOG)

    def new_files(self, source: str, directories: list[str], pattern: str) -> DataFrame:
        """Files of a source that the log does not hold with this time and size."""
        listed = list_files(self.spark, directories, pattern).withColumn("source", F.lit(source))
        return listed.select(*FILE_KEY, "read_path").join(self.log().select(*FILE_KEY), FILE_KEY, "left_anti")

    def ingest(self, source: str, directories: list[str], pattern: str | None = None, granularity: str = "month") -> int:
        """Normalise the new files of a source and commit them; the number of files."""
        return self.commit(source, self.new_files(source, directories, pattern or FILE_PATTERNS[source]), granularity)

    def commit(self, source: str, files: DataFrame, granularity: str = "month") -> int:
        """Normalise the listed files, append them to the log last, and return how many these are.

        Files without a header, or whose columns the source does not know, are
        left out and stay new; ``unreadable`` names them.
        """
        listed = stage(self.spark, files, "new_files")
        found = read_layouts(listed)
        frames = [(df, names) for df, names in found if not self._fault(source, df, granularity)]
        if not frames:
            return 0
        raw = stage(self.spark, concat([df for df, _ in frames]), f"raw_{source}")
        batch_id = f"{source}-{uuid.uuid4().hex}"
        self.write_delta(batch_id, NORMALISERS[source](raw, granularity, ("source_file",)))
        read = self.spark.createDataFrame([(name,) for _, names in frames for name in names], "source_file string")
        entries = listed.join(read, listed["path"] == read["source_file"], "left_semi").select(*FILE_KEY)
        entries = stage(self.spark, entries.withColumns({"batch_id": F.lit(batch_id), "ingested_at": F.current_timestamp()}), "log_entries")
        entries.write.mode("append").parquet(f"{self.root}/log")
        return entries.count()

    def unreadable(self, source: str, directories: list[str], pattern: str | None = None, granularity: str = "month") -> DataFrame:
        """``path`` and ``reason`` of the new files that an ingest leaves out."""
        listed = stage(self.spark, self.new_files(source, directories, pattern or FILE_PATTERNS[source]), "new_files")
        found = read_layouts(listed)
        faults = [(name, self._fault(source, df, granularity)) for df, names in found for name in names]
        known = self.spark.createDataFrame(faults, "path string, reason string")
        return listed.select("path").join(known, "path", "left").select(
            "path", F.when(F.col("reason").isNull(), "no header").otherwise(F.col("reason")).alias("reason")
        ).where(F.col("reason") != "")

    def _fault(self, source: str, df: DataFrame, granularity: str) -> str:
        """Why the source cannot read a layout, from analysing its plan; empty if it can."""
        try:
            parts = NORMALISERS[source](df, granularity, ("source_file",))
            assert parts.activity.columns
        except AnalysisException as error:
            return error.getCondition() or "unknown"
        return ""

    def ingest_all(self, directories: list[str], granularity: str = "month") -> dict[str, int]:
        return {source: self.ingest(source, directories, granularity=granularity) for source in NORMALISERS}

    def write_delta(self, batch_id: str, rows) -> None:
        """Write a batch; writing the same batch again replaces it."""
        rows = rows.stored(lambda sums: stage(self.spark, sums, "fact_sums"))
        parts = {"spatial": rows.spatial, "activity": rows.activity, "demographics": rows.demographics}
        for name, df in parts.items():
            if df is not None:
                df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def committed(self, replace: bool) -> DataFrame:
        """Committed (batch, file) pairs; with ``replace`` only the newest version of a file."""
        log = self.log()
        if replace:
            # The newest version of a file, in the newest batch that holds it.
            newest = Window.partitionBy("source", "path").orderBy(F.desc("mtime"), F.desc("ingested_at"), "batch_id")
        else:
            newest = Window.partitionBy(*FILE_KEY).orderBy(F.desc("ingested_at"), "batch_id")
        log = log.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") == 1)
        return log.select("batch_id", F.col("path").alias("source_file")).distinct()

    def _rows(self, name: str, schema, pairs: DataFrame) -> DataFrame:
        """Stored rows of the given (batch, file) pairs."""
        stored = _copy(schema).add("source_file", "string").add("batch_id", "string")
        return _read_or_empty(self.spark, f"{self.root}/{name}", stored).join(pairs, PAIR, "left_semi")

    def _state(self, replace: bool) -> VersionedTables:
        return VersionedTables(self.spark, f"{self.root}/state-{'newest' if replace else 'all'}")

    def _changes(self, replace: bool, version: Version) -> tuple[DataFrame, DataFrame]:
        """Committed pairs that a version of the state does not hold yet, and pairs it holds that no longer count."""
        current, held = self.committed(replace), self._state(replace).read("pairs", PAIRS, version)
        return current.join(held, PAIR, "left_anti"), held.join(current, PAIR, "left_anti")

    def refresh(self, replace: bool = False) -> int:
        """Bring the added-up state up to date with the log; the number of fact parts that were written.

        The state is stored by month. Rows that came are added to the stored sums of
        their months, months of rows that no longer count are added up anew, and the
        folders of all other months stay as they are. Both fact tables, and the pairs
        they hold, change with one publication; readers go on with what they opened.
        """
        state = self._state(replace)
        base = state.version()
        added, retired = (stage(self.spark, x, "pairs") for x in self._changes(replace, base))
        if not added.limit(1).count() and not retired.limit(1).count():
            return 0
        changes: dict[str, dict[str, str | None]] = {}
        for name, (schema, keys, measures) in FACTS.items():
            month = F.date_format("date", "yyyy-MM")
            came = stage(self.spark, self._rows(name, schema, added).withColumn("_month", month), f"added_{name}")
            gone = [r["_month"] for r in self._rows(name, schema, retired).select(month.alias("_month")).distinct().collect()]
            grown = sorted({r["_month"] for r in came.select("_month").distinct().collect()} - set(gone))
            stored = state.read(name, schema, base, grown).withColumn("_month", month)
            parts = [stored, came.where(F.col("_month").isin(grown)).select(*stored.columns)]
            if gone:
                again = self._rows(name, schema, self.committed(replace)).withColumn("_month", month)
                parts.append(again.where(F.col("_month").isin(gone)).select(*stored.columns))
            rows = reduce(DataFrame.unionByName, parts).groupBy(*keys, "_month").agg(*[F.sum(m).alias(m) for m in measures])
            written = state.write(name, rows.select(*schema.names, "_month").repartition("_month", "spatial_key"), "_month")
            changes[name] = {**dict.fromkeys(gone), **written}
        pairs = state.write("pairs", added.withColumn("_held", F.lit(uuid.uuid4().hex)), "_held")
        if retired.limit(1).count():
            kept = state.read("pairs", PAIRS, base).join(retired, PAIR, "left_anti").unionByName(added)
            pairs = {**dict.fromkeys(base.parts.get("pairs", {})), **state.write("pairs", kept.withColumn("_held", F.lit(uuid.uuid4().hex)), "_held")}
        state.publish(base, {**changes, "pairs": pairs})
        return sum(folder is not None for name in FACTS for folder in changes[name].values())

    def _facts(self, name: str, replace: bool) -> DataFrame:
        """Stored sums, with what came since the last refresh added; without a fitting state, the sum of all committed rows."""
        schema, keys, measures = FACTS[name]
        state = self._state(replace)
        version = state.version()
        sums = [F.sum(m).alias(m) for m in measures]
        if not version.number:
            return self._rows(name, schema, self.committed(replace)).groupBy(*keys).agg(*sums)
        added, retired = self._changes(replace, version)
        if retired.limit(1).count():
            return self._rows(name, schema, self.committed(replace)).groupBy(*keys).agg(*sums)
        stored = state.read(name, schema, version)
        if not added.limit(1).count():
            return stored
        return stored.unionByName(self._rows(name, schema, added).select(*schema.names)).groupBy(*keys).agg(*sums)

    def activity(self, replace: bool = False) -> DataFrame:
        return self._facts("activity", replace)

    def demographics(self, replace: bool = False) -> DataFrame:
        return self._facts("demographics", replace)

    def spatial(self) -> DataFrame:
        """The dimension: first known value per key and column over the committed batches."""
        stored = _copy(DIM_SPATIAL).add("batch_id", "string")
        current = self.committed(replace=False).select("batch_id")
        order = self.log().join(current, "batch_id", "left_semi").groupBy("batch_id").agg(F.min("ingested_at").alias("_at"))
        rows = _read_or_empty(self.spark, f"{self.root}/spatial", stored).join(order, "batch_id")
        names = [n for n in DIM_SPATIAL.names if n != "spatial_key"]
        place = F.struct("_at", "batch_id")
        return rows.groupBy("spatial_key").agg(
            *[F.min_by(n, F.when(F.col(n).isNotNull(), place)).alias(n) for n in names]
        )

    def compact(self, replace: bool = False) -> str:
        """Rewrite the committed rows as one batch, so that reads open few files.

        The log entry that names the new batch is written last; until then readers
        see the old batches. Earlier versions of changed files are kept or dropped
        for good, as ``replace`` says.
        """
        batch_id = f"compact-{uuid.uuid4().hex}"
        for name, (schema, _, _) in FACTS.items():
            rows = self._rows(name, schema, self.committed(replace)).drop("batch_id")
            rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")
        self.spatial().write.mode("overwrite").parquet(f"{self.root}/spatial/batch_id={batch_id}")
        entries = self.log().select(*FILE_KEY).distinct().withColumns(
            {"batch_id": F.lit(batch_id), "ingested_at": F.current_timestamp()}
        )
        entries.write.mode("append").parquet(f"{self.root}/log")
        return batch_id

    def merged_spatial(self, dim: DataFrame) -> DataFrame:
        return fill_spatial(dim, self.spatial())


def _copy(schema):
    return type(schema)(list(schema.fields))
