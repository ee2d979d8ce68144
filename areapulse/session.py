"""Session helpers shared by the library, the tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app_name: str = "areapulse") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without the setting falls back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="areapulse-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created or deleted."""
    return f"{shared_dir(spark)}/areapulse/{name}-{uuid.uuid4().hex}"


_staged: dict[str, list[str]] = {}


def release(spark: SparkSession) -> int:
    """Delete the tables that :func:`stage` and others in an :func:`owned_folder` wrote for this application; the number of them.

    Frames that read them, and shared tables built from them, must not be used any
    more. Folders that a caller asked for by :func:`new_folder` stay.
    """
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def discard(df: DataFrame) -> None:
    """Delete the table that :func:`stage` wrote for ``df``, before :func:`release` does; nothing may read it any more."""
    spark = df.sparkSession
    paths = _staged.get(spark.sparkContext.applicationId, [])
    folders = {f.rpartition("/")[0].rpartition("/")[2] for f in df.inputFiles()}
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in [p for p in paths if p.rpartition("/")[2] in folders]:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
        paths.remove(name)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files go when the write that made them has ended, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def owned_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder that :func:`release` deletes."""
    path = new_folder(spark, name)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(spark: SparkSession, df: DataFrame, name: str, sort_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches of one plan need the same aggregated input, so
    that the input is not computed per branch and survives a lost executor.
    Sorting inside the partitions lets row-group statistics prune later reads
    without another shuffle.
    """
    path = owned_folder(spark, name)
    (df.sortWithinPartitions(*sort_by) if sort_by else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
