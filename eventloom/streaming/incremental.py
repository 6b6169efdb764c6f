"""The convert and filter stages over files as they arrive.

A checkpoint remembers which files were processed; its folder is named after the
settings, so a change of settings starts afresh.  `available_now` runs what is pending and ends.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean
from ..plans.manifest import fingerprint, short
from ..sources.ingest import parse_tsv, unzip_lines
from ..sources.specs import spec

_BINARY = T.StructType().add("path", T.StringType()).add("modificationTime", T.TimestampType()).add("length", T.LongType()).add("content", T.BinaryType())


def _checkpoint(folder: str, stage: str, **settings: object) -> str:
    return os.path.join(folder, f"{stage}-{short(fingerprint(stage=stage, **settings))}")


def _start(rows: DataFrame, out: str, checkpoint: str, compression: str, available_now: bool) -> StreamingQuery:
    w = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).option("compression", compression).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 minutes")).start()


def convert_stream(spark: SparkSession, raw: str, out: str, checkpoints: str, dataset: str, columns: list[str] | None = None, compression: str = "zstd", files_per_batch: int = 96, delete_source: bool = False, available_now: bool = True) -> StreamingQuery:
    """Zip archives to Parquet; each file once.  Rows carry the file and row that they come from."""
    r = spark.readStream.format("binaryFile").schema(_BINARY).option("pathGlobFilter", "*.zip").option("maxFilesPerTrigger", files_per_batch)
    if delete_source:
        r = r.option("cleanSource", "delete")
    rows = parse_tsv(unzip_lines(r.load(raw)), dataset, columns)
    return _start(rows, out, _checkpoint(checkpoints, "convert", dataset=dataset, columns=columns, compression=compression), compression, available_now)


def filter_stream(spark: SparkSession, converted: str, out: str, checkpoints: str, dataset: str, check: list[str], keep: list[str] | None = None, float32: list[str] | None = None, compression: str = "zstd", files_per_batch: int = 1000, available_now: bool = True) -> StreamingQuery:
    """Drop nulls, choose columns and narrow reals of Parquet files as they arrive."""
    schema = T.StructType([*spec(dataset).schema.fields, T.StructField("_src_file", T.StringType()), T.StructField("_src_row", T.LongType())])
    rows = clean(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(converted), check, keep, float32)
    if rows is None:
        raise ValueError("none of the columns to check exists")
    return _start(rows, out, _checkpoint(checkpoints, "filter", dataset=dataset, check=check, keep=keep, float32=float32, compression=compression), compression, available_now)


def mentions_of(stream: DataFrame, events: DataFrame, event_id: str = "GlobalEventID", mention_event: str = "GLOBALEVENTID") -> DataFrame:
    """Arriving mentions of a fixed set of events.  Mentions may name events of any age, so no watermark bounds the join: the events are static."""
    keys = events.select(F.col(event_id).alias("_k")).distinct()
    return stream.join(keys, stream[mention_event] == F.col("_k")).drop("_k")
