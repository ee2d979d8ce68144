"""Layered lake folders: ``root/layer/domain``, a folder per batch in it, partitioned by ``dt``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver")


def layer_path(root: str, layer: str, domain: str) -> str:
    if layer not in LAYERS:
        raise ValueError("layer must be one of: bronze, silver")
    return f"{root.rstrip('/')}/{layer}/{domain}"


def write_layer(df: DataFrame, root: str, layer: str, domain: str, file_format: str = "parquet", batch: str | None = None) -> str:
    """Add a batch of rows to a layer; any file system Spark can reach will do as root.

    A run that repeats a ``batch`` replaces what it wrote before; without a name
    every run is a batch of its own.

    The rebalance step brings the rows of a month together, so that a write does
    not leave a file per task and month, and splits a month that is too large for
    one task.
    """
    if file_format not in ("parquet", "csv"):
        raise ValueError("lake format must be parquet or csv")
    path = layer_path(root, layer, domain)
    writer = df.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").format(file_format)
    (writer.option("header", True) if file_format == "csv" else writer).save(f"{path}/batch_id={batch or uuid.uuid4().hex}")
    return path


def read_layer(spark: SparkSession, root: str, layer: str, domain: str, file_format: str = "parquet") -> DataFrame:
    reader = spark.read.format(file_format)
    return (reader.option("header", True) if file_format == "csv" else reader).load(layer_path(root, layer, domain)).drop("batch_id")
