"""Which inputs are done under which configuration, and by which run.

A stage's fingerprint names its settings.  The manifest is a table (path, stage,
fingerprint, run, source); pending inputs are those without a matching row.  Rows are added
when a run's output is whole, so what failed stays pending; a changed setting makes all
inputs pending again.  Readers take the rows of an input from the last run that names it.
"""

from __future__ import annotations

import hashlib
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

SCHEMA = "path string, stage string, fingerprint string, run string, source string"


def _written(v: object) -> str:
    if v is None:
        return "<none>"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_written(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, (list, tuple, set, frozenset)):
        return "[" + ",".join(sorted(str(x) for x in v)) + "]"
    return str(v)


def fingerprint(**fields: object) -> str:
    """`name=value` lines by name; lists in order of their values; None differs from nothing."""
    return "\n".join(f"{k}={_written(fields[k])}" for k in sorted(fields))


def short(print_: str) -> str:
    """A name for folders, such as a stream's checkpoint."""
    return hashlib.sha256(print_.encode()).hexdigest()[:16]


def new_run() -> str:
    """A name for a run; later ones sort behind earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


class Manifest:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], SCHEMA)

    def pending(self, inputs: DataFrame, stage: str, print_: str, force: bool = False) -> DataFrame:
        """Inputs (path, and source if they have one) to process."""
        return inputs if force else pending(inputs, self.table(), stage, print_)

    def mark(self, inputs: DataFrame, stage: str, print_: str, run: str | None = None) -> None:
        """Add rows for inputs (path, and source if they have one)."""
        source = F.col("source") if "source" in inputs.columns else F.lit(None).cast("string")
        rows = inputs.select("path", F.lit(stage).alias("stage"), F.lit(print_).alias("fingerprint"), F.lit(run).cast("string").alias("run"), source.alias("source"))
        rows.coalesce(1).write.mode("append").parquet(self.path)

    def latest(self) -> DataFrame:
        """(path, run): the run that holds each input's rows."""
        return self.table().where("run is not null").groupBy("path").agg(F.max("run").alias("run"))

    def superseded(self) -> DataFrame:
        """(path, run) of older runs over inputs that were processed again."""
        return self.table().where("run is not null").select("path", "run").distinct().join(self.latest(), ["path", "run"], "left_anti")


def pending(inputs: DataFrame, manifest: DataFrame, stage: str, print_: str) -> DataFrame:
    keys = ["path", *(["source"] if "source" in inputs.columns else [])]
    done = manifest.where((F.col("stage") == stage) & (F.col("fingerprint") == print_)).select(*keys)
    return inputs.join(done, keys, "left_anti")
