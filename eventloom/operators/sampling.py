"""Samples without replacement that a seed fixes, however rows are partitioned.

Rows are taken in the order of a hash of seed and id.  Top rows are found by partial
top-k in each task, overall or within groups, so no group is gathered anywhere.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranking import hash_key
from .predicate import compile_filter, referenced


def sample_rows(df: DataFrame, n: int, seed: int = 42, id_cols: tuple[str, ...] = ("GlobalEventID",), strict: bool = True) -> DataFrame:
    """n rows.  If strict, fewer rows than n raise (this counts them); else all are returned."""
    if n <= 0:
        return df.limit(0)
    if strict and (total := df.count()) < n:
        raise ValueError(f"{n} rows asked for, {total} there")
    return df.orderBy(hash_key(seed, *id_cols), *(F.col(f"`{c}`") for c in id_cols)).limit(n)


def _top(df: DataFrame, by: list[Column], n: int, seed: int, id_cols: tuple[str, ...]) -> DataFrame:
    if n <= 0:
        return df.limit(0)
    w = Window.partitionBy(*by).orderBy(hash_key(seed, *id_cols), *(F.col(f"`{c}`") for c in id_cols))
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def sample_daily(df: DataFrame, per_day: int = 10, seed: int = 42, date_col: str | Column = "Day", id_cols: tuple[str, ...] = ("GlobalEventID",), scope: str = "day", columns: list[str] | None = None) -> DataFrame:
    """Up to per_day rows for each day; rows without a day go.  With `columns`, only these and the date column, in the table's order.

    scope "file" takes as many for each day of each file; it needs a table read from files.
    A table without the column has no sample.
    """
    if scope not in ("day", "file"):
        raise ValueError("scope is day or file")
    if isinstance(date_col, str):
        name = date_col
        if name not in df.columns:
            return df.limit(0)
        date_col = F.col(f"`{name}`")
        named_date = {name}
    else:
        named_date = set()
    unknown = set(columns or ()) - set(df.columns)
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    kept = [F.col(f"`{c}`") for c in df.columns if not columns or c in columns or c in named_date]
    if scope == "day":
        return _top(df.where(date_col.isNotNull()), [date_col], per_day, seed, id_cols).select(*kept)
    file = F.col("_src_file") if "_src_file" in df.columns else F.col("_metadata.file_path")
    named = df.select("*", file.alias("_file")).where(date_col.isNotNull())
    return _top(named, [F.col("_file"), date_col], per_day, seed, id_cols).select(*kept)


def sample_stratified(df: DataFrame, by: str, n_per_group: int, seed: int = 42, id_cols: tuple[str, ...] = ("GlobalEventID",)) -> DataFrame:
    """Up to n rows for each value of a column; null is a value."""
    if by not in df.columns:
        raise ValueError(f"unknown column {by!r}")
    return _top(df, [F.col(f"`{by}`")], n_per_group, seed, id_cols)


class FilteredSampler:
    """Rows that pass a filter: all, some, or some of each group."""

    def __init__(self, df: DataFrame, filter_dict: dict | None = None, columns: list[str] | None = None, seed: int = 42, id_cols: tuple[str, ...] = ("GlobalEventID",)) -> None:
        missing = set(columns or ()) - set(df.columns)
        if missing:
            raise ValueError(f"unknown columns: {sorted(missing)}")
        where = compile_filter(filter_dict, df.schema)
        self.rows = df if where is None else df.where(where)
        self.seed, self.id_cols = seed, id_cols
        wanted = set(columns or df.columns) | set(referenced(filter_dict or {}))
        self.columns = [c for c in df.columns if c in wanted]

    def _out(self, df: DataFrame, *also: str) -> DataFrame:
        return df.select(*(F.col(f"`{c}`") for c in df.columns if c in self.columns or c in also))

    def all(self) -> DataFrame:
        return self._out(self.rows)

    def sample(self, n: int) -> DataFrame:
        return self._out(sample_rows(self.rows, n, self.seed, self.id_cols, strict=False))

    def stratified(self, by: str, n_per_group: int) -> DataFrame:
        return self._out(sample_stratified(self.rows, by, n_per_group, self.seed, self.id_cols), by)


class Rng:
    """Seeded draws on the driver."""

    def __init__(self, seed: int) -> None:
        self._rng = np.random.default_rng(seed)

    def choice(self, n: int, size: int, replace: bool = False) -> np.ndarray:
        return self._rng.choice(n, size=size, replace=replace)

    def multinomial(self, n: int, pvals: list[float]) -> np.ndarray:
        return self._rng.multinomial(n, pvals)

    def randint(self, low: int, high: int | None = None) -> int:
        """0 to low - 1, or low to high, both included."""
        return int(self._rng.integers(low) if high is None else self._rng.integers(low, high + 1))


class FileIndex:
    """Positions 0..total-1 over the rows of files in order of their names; a row of metadata for each file.

    Rows are those of Parquet files, or of a table that names each row's file and its place there.
    """

    def __init__(self, spark: SparkSession, *paths: str, table: DataFrame | None = None, place: tuple[str, str] = ("_src_file", "_src_row")) -> None:
        self.spark, self.place = spark, place if table is not None else None
        if table is None:
            self.df = spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(*paths)
        else:
            self.df = table
        name = F.col("_metadata.file_path") if table is None else F.col(f"`{place[0]}`")
        found = self.df.groupBy(name.alias("f")).count().orderBy("f").collect()
        self.files = [r.f for r in found]
        self.counts = [r["count"] for r in found]
        self.stops = np.cumsum(self.counts).tolist()
        self.starts = [b - n for b, n in zip(self.stops, self.counts)]
        self.total_rows = sum(self.counts)

    def lookup(self, g: int) -> tuple[int, int]:
        """(number of the file, row in it)."""
        if not 0 <= g < self.total_rows:
            raise IndexError(g)
        i = int(np.searchsorted(self.stops, g, side="right"))
        return i, g - self.starts[i]

    def group(self, positions: np.ndarray) -> dict[int, list[int]]:
        out: dict[int, list[int]] = {}
        for g in sorted(int(x) for x in positions):
            i, row = self.lookup(g)
            out.setdefault(i, []).append(row)
        return out

    def sample(self, n: int, seed: int = 42) -> DataFrame:
        """Exactly the rows at n positions drawn by numpy's generator, in order; n is bounded by the driver's memory."""
        if n > self.total_rows:
            raise ValueError(f"{n} rows asked for, {self.total_rows} there")
        drawn = np.sort(Rng(seed).choice(self.total_rows, n)) if n > 0 else np.zeros(0, dtype=np.int64)
        rows = [(self.files[i], r, g) for g in drawn.tolist() for i, r in [self.lookup(g)]]
        want = self.spark.createDataFrame(rows, "_f string, _r long, _g long")
        if self.place is None:
            have = self.df.select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_r"))
        else:  # rows may have been dropped since: they are numbered anew, within the files drawn from
            name, row = (F.col(f"`{c}`") for c in self.place)
            some = self.df.withColumn("_f", name).join(want.select("_f").distinct(), "_f", "left_semi")
            have = some.withColumn("_r", (F.row_number().over(Window.partitionBy("_f").orderBy(row)) - 1).cast("long"))
        return have.join(want, ["_f", "_r"]).orderBy("_g").drop("_f", "_r", "_g")


def locate(positions: DataFrame, index: DataFrame, bucket: int = 1 << 20) -> DataFrame:
    """(g, file, row) of positions (g) by an index (file, start, stop).

    An equi-join on numbers of buckets of positions: a file's range is listed under each bucket that it
    touches, so no position is held against all files.
    """
    spans = index.where("stop > start").withColumn("_b", F.explode(F.sequence(F.floor(F.col("start") / bucket), F.floor((F.col("stop") - 1) / bucket))))
    at = positions.withColumn("_b", F.floor(F.col("g") / bucket))
    return at.join(spans, "_b").where("g >= start and g < stop").select("g", "file", (F.col("g") - F.col("start")).alias("row"))


def file_offsets(counts: DataFrame) -> DataFrame:
    """(file, start, stop) from (file, n), by file in order: a row for each file, so one window over all is small."""
    w = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum("n").over(w)
    return counts.select("file", (stop - F.col("n")).alias("start"), stop.alias("stop"))
