"""A stage's table on disk: runs that the manifest names, in folders by the period of the raw files.

    <folder>/table/part_run=R/part_first=YYYYMMDD/part_last=YYYYMMDD/   rows of quarter-hourly and daily files
    <folder>/historical/part_run=R/part_first=../part_last=../Year=../MonthYear=../   of monthly and yearly files, if kept apart
    <folder>/_manifest/

A window of days is a condition on partitions, so files outside of it are never opened.
Nothing is seen of a run until the manifest names it, and of an input's rows only those of
its last run; so a crash, or doing an input again, never repeats rows.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import delete, exists
from ..sources.ingest import write_hive
from ..sources.listing import file_name
from ..sources.periods import overlaps, period_columns
from ..sources.specs import spec
from .manifest import Manifest

RUN, FIRST, LAST = "part_run", "part_first", "part_last"
PARTS = ("table", "historical")


def _day(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


class Store:
    def __init__(self, spark: SparkSession, folder: str, dataset: str) -> None:
        self.spark, self.folder, self.grammar = spark, folder, spec(dataset).period
        self.manifest = Manifest(spark, os.path.join(folder, "_manifest"))

    def write(self, rows: DataFrame, run: str, part: str = "table", by: list[str] | None = None, compression: str = "zstd") -> None:
        """Rows with their `_src_file`, as one run's part; `by` are further keys to partition by."""
        first, last = period_columns(F.col("_src_file"), self.grammar)
        dated = rows.withColumn(FIRST, _day(first)).withColumn(LAST, _day(last))
        write_hive(dated, os.path.join(self.folder, part, f"{RUN}={run}"), by or [], compression, "append", [FIRST, LAST])

    def _scan(self, part: str) -> DataFrame | None:
        path = os.path.join(self.folder, part)
        if not exists(self.spark, path):
            return None
        # an empty run has no file from which to learn a schema
        df = self.spark.read.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet").parquet(path)
        return df.withColumn(RUN, F.col(RUN).cast("string")) if RUN in df.columns else None

    def part(self, part: str, start: str | None = None, end: str | None = None) -> DataFrame | None:
        """The rows of one part that count, with the columns of partitions; a window keeps what has no period."""
        df = self._scan(part)
        if df is None:
            return None
        day = lambda c: F.to_date(F.col(c).cast("string"), "yyyyMMdd")
        df = df.where(overlaps(day(FIRST), day(LAST), start, end, keep_undated=True))
        runs = self.manifest.latest().select(F.col("run").alias(RUN)).distinct()
        df = df.join(runs, RUN, "left_semi")
        old = self.manifest.superseded()
        if old.isEmpty():
            return df
        old = old.select(F.col("path").alias("_old"), F.col("run").alias("_run"))
        return df.join(old, (file_name(F.col("_src_file")) == F.col("_old")) & (F.col(RUN) == F.col("_run")), "left_anti")

    def read(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """All rows that count, of both parts; files whose period a window doesn't touch aren't opened."""
        found = [p.drop(RUN, FIRST, LAST) for p in (self.part(x, start, end) for x in PARTS) if p is not None]
        if not found:
            raise FileNotFoundError(f"no table in {self.folder}")
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more, allowMissingColumns=True)
        return out

    def delete_run(self, run: str) -> None:
        for part in PARTS:
            path = os.path.join(self.folder, part, f"{RUN}={run}")
            if exists(self.spark, path):
                delete(self.spark, path)
