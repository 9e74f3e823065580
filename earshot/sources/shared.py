"""Folders that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path under `spark.checkpoint.dir`, or, where a session has none, beside
    its tables. It is deleted when the driver's JVM ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/earshot-shared"
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)
