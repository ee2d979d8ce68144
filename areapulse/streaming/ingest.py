"""The same ingest as a file stream: every available file once, then stop.

The stream carries the list of files, not their rows, so that each file is read by
its own layout. A micro-batch goes through the store's commit: the log decides
which of its files are new. A batch that runs again after a failure, a second
stream, or a stream with a fresh checkpoint therefore neither repeats nor
replaces what is already there. A file stream looks at a path once: a file that
changed later is found by a batch ingest or by a stream with a fresh checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from areapulse.sources.ingest import FILE_KEY, IngestStore

LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(
    store: IngestStore, source: str, directory: str, pattern: str, checkpoint: str, granularity: str = "month", files_per_batch: int = 1000,
):
    """Start a run that commits the new files of a directory to the store and ends by itself."""
    listed = (
        store.spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(directory)
        .select(
            F.lit(source).alias("source"), F.col("_metadata.file_path").alias("path"),
            F.unix_timestamp("_metadata.file_modification_time").alias("mtime"), F.col("_metadata.file_size").alias("size"),
            F.col("path").alias("read_path"),
        )
    )

    def commit(batch: DataFrame, _: int) -> None:
        known = store.log().select(*FILE_KEY)
        store.commit(source, batch.join(known, FILE_KEY, "left_anti"), granularity)

    return (
        listed.writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
