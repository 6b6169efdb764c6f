"""Folders of any file system that Spark reads: list, delete."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, folder: str, ending: str = "") -> list[str]:
    """Names in a folder that end so, in order; none if the folder isn't there."""
    fs, p = _at(spark, folder)
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.endswith(ending)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; a failure is logged, not raised: what was done before stays done."""
    fs, p = _at(spark, path)
    try:
        return bool(fs.delete(p, True))
    except Exception as e:  # noqa: BLE001  whatever the file system raises through the gateway
        log.warning("%s can't be deleted: %s", path, e)
        return False
