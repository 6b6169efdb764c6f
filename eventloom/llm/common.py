"""Helpers shared by the corpus operators: text cleaning, row keys, shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words and is stripped from lines: space and \t \n \v \f \r.
SPACE = " \t\n\x0b\x0c\r"
#: The same set as a Java and Python regex class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Arrow batches between the JVM and Python workers hold no more than this, or one row if it is longer.
ARROW_BYTES, ARROW_ROWS = 4 << 20, 2000

#: Spark's setting by which shuffle files go at the end of a query.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: dict[str, list[str]] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(c, _UPPER, _LOWER)


def words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text, in order; none for null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS + "+", -1))


def hash128(*cols: Column) -> list[Column]:
    """Two independent 64-bit hashes of the columns."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(0x5BD1E995), *cols)]


def row_key(doc_id: Column, text: Column) -> Column:
    """Identifies a row by its id and content, so that null or repeated ids still join back rightly.

    Rows equal in both get equal results, so sharing a key does no harm.
    """
    return F.struct(doc_id.cast("string").alias("i"), *(h.alias(n) for h, n in zip(hash128(text), "ab")))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one set here if unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="eventloom-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def materialize(df: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it again: it cuts the lineage and is computed once.

    `tasks` is how many tasks its measured size is worth, at most; more partitions are merged.
    """
    spark = df.sparkSession
    if tasks:
        df = df.coalesce(tasks)
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    was = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")  # the table is whole then, and the shuffles behind it are of no more use
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, was)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def small_arrow(spark: SparkSession) -> None:
    """Keep the session's Arrow batches small, so that memory of workers doesn't hang on how long texts are.

    Settings that are smaller already stay.
    """
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)):
        have = int(spark.conf.get(key).rstrip("bB"))
        if have <= 0 or have > most:
            spark.conf.set(key, str(most))


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


class Tables:
    """Tables of one operator's rounds: each is deleted as soon as no later round reads it.

    What is left when the operator returns is what its result still reads; `release` deletes that.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
        out = materialize(df, label, tasks)
        self.paths[id(out)] = (out, _written[self.spark.sparkContext.applicationId][-1])
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no result hangs on any more."""
        gone = [self.paths.pop(id(t))[1] for t in tables]
        _delete(self.spark, gone)
        left = _written[self.spark.sparkContext.applicationId]
        for p in gone:
            left.remove(p)

    def keep(self, *tables: DataFrame) -> None:
        """Delete all but these."""
        self.drop(*(t for t, _ in list(self.paths.values()) if not any(t is k for k in tables)))


def written(spark: SparkSession) -> list[str]:
    """Where the tables lie that operators have left, the last one last."""
    return list(_written.get(spark.sparkContext.applicationId, ()))


def release(spark: SparkSession, but: set[str] = frozenset()) -> int:
    """Delete the tables that operators have left, but for some; only when no DataFrame built on them is needed."""
    gone = [p for p in written(spark) if p not in but]
    _delete(spark, gone)
    _written[spark.sparkContext.applicationId] = [p for p in written(spark) if p in but]
    return len(gone)


def need(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns named by their place, and those names by the given ones.

    Spark resolves names without regard to case; named by place, no extra column can clash with another or
    with an operator's own.
    """
    names = [f"__el_c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names))


def others(at: dict[str, str], *results: str) -> dict[str, str]:
    """Columns (place by name) that stay beside an operator's results: results replace columns of their names, whatever the case."""
    taken = {r.lower() for r in results}
    return {name: place for name, place in at.items() if name.lower() not in taken}
