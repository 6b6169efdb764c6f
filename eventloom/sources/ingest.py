"""Raw archives to typed Parquet."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import null_spelled, to_number
from .specs import DatasetSpec, spec

#: Lines that the zip reader passes on at once.
ZIP_BATCH = 5_000
CODECS = ("snappy", "gzip", "zstd", "lz4", "uncompressed")


def unzip_lines(files: DataFrame, errors: bool = False) -> DataFrame:
    """(_src_file, _src_row, value): lines of the members of zip files (path, content), read as a stream.

    One task holds one compressed file; its text goes by in batches.  A file that is no zip, or a
    broken one, fails the job; with `errors` it gives no line but one row that says why in
    a column `_error`, null in other rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content")):
                if errors and (why := _broken(content.as_py())):
                    yield _lines(path, 0, [None]).append_column("_error", pa.array([why]))
                    continue
                for batch in members(path, content):
                    yield batch.append_column("_error", pa.nulls(batch.num_rows, pa.string())) if errors else batch

    def members(path: str, content: pa.Scalar) -> Iterator[pa.RecordBatch]:
        with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
            row = 0
            for member in sorted(z.namelist()):
                if member.endswith("/"):
                    continue
                with z.open(member) as f:
                    lines: list[str] = []
                    for line in io.TextIOWrapper(f, "utf-8", errors="replace", newline="\n"):
                        lines.append(line.rstrip("\r\n"))
                        if len(lines) >= ZIP_BATCH:
                            yield _lines(path, row, lines)
                            row, lines = row + len(lines), []
                    if lines:
                        yield _lines(path, row, lines)
                        row += len(lines)

    return files.select("path", "content").mapInArrow(run, "_src_file string, _src_row long, value string" + (", _error string" if errors else ""))


def _broken(content: bytes) -> str | None:
    """Why an archive can't be read whole, if so; all its checksums are tried, so that no part of a broken file is taken."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            bad = z.testzip()
        return f"checksum of {bad} differs" if bad else None
    except (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, NotImplementedError) as e:
        return str(e) or type(e).__name__


def _lines(path: str, row: int, lines: list[str | None]) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(range(row, row + n), pa.int64()), pa.array(lines, pa.string())], names=["_src_file", "_src_row", "value"])


def read_zips(spark: SparkSession, *paths: str, errors: bool = False) -> DataFrame:
    return unzip_lines(spark.read.format("binaryFile").load(list(paths)).select("path", "content"), errors)


def parse_tsv(lines: DataFrame, dataset: str | DatasetSpec, keep: list[str] | None = None, line_col: str = "value") -> DataFrame:
    """Lines to the dataset's columns, typed; other columns of `lines` go along behind.

    Names go by position.  Empty lines go.  A short row is filled with null; a row with
    too many fields is skipped.  Numbers that aren't become null, as do the spellings of
    null.  The header line of a dataset that has one is skipped (row 0 if rows are
    numbered, else a line equal in its first field to the first column's name).  `keep` prunes columns; unknown names
    in it are ignored.  Fields in double quotes may hold tabs.
    """
    s = spec(dataset) if isinstance(dataset, str) else dataset
    wanted = [f for f in s.schema if keep is None or f.name in keep]
    raw = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(s.columns) + 1)])
    rest = [c for c in lines.columns if c != line_col]
    rows = lines.where(F.length(line_col) > 0)
    if s.header:
        first = F.col("_src_row") == 0 if "_src_row" in rest else F.lower(F.split_part(F.col(line_col), F.lit("\t"), F.lit(1))) == s.columns[0].lower()
        rows = rows.where(~first)
    # inlined, so that a line is parsed once: neither the filter nor the columns can take the parser with them
    record = F.from_csv(line_col, raw.simpleString()[7:-1].replace(":", " "), {"sep": "\t", "mode": "PERMISSIVE"})
    parsed = rows.select(F.inline(F.array(record)), *rest)
    parsed = parsed.where(F.col(f"c{len(s.columns)}").isNull())
    out = []
    for i, f in enumerate(s.schema):
        if f in wanted:
            c = F.col(f"c{i}")  # no spelling of null is a number
            out.append((null_spelled(c) if isinstance(f.dataType, T.StringType) else to_number(c, f.dataType.simpleString())).alias(f.name))
    return parsed.select(*out, *rest)


def check_arity(lines: DataFrame, dataset: str, line_col: str = "value") -> None:
    """Raise if the first line has more fields than the dataset: names would shift."""
    s, first = spec(dataset), lines.select(line_col).first()
    if first and len(first[0].split("\t")) > len(s.columns):
        raise ValueError(f"{dataset} has {len(s.columns)} columns, the first line {len(first[0].split(chr(9)))}")


def read_parquet_dir(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet files of folders or single files; other files are ignored.  Where files differ in columns, absent ones are null."""
    r = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", "true")
    return (r.schema(schema) if schema else r).parquet(*paths)


def read_drifting(spark: SparkSession, paths: list[str], target: T.StructType) -> DataFrame:
    """Files that disagree on a column's type: each group of equal schema is read on its own and cast to the target.

    Schemas are read from the files' footers by tasks; a schema and a list of paths for each come back.
    """

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for b in batches:
            kinds = [str(pq.read_schema(pa.BufferReader(c.as_py())).remove_metadata()) for c in b.column("content")]
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(kinds)], names=["path", "kind"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(paths)
    found = files.select("path", "content").mapInArrow(footers, "path string, kind string").groupBy("kind").agg(F.collect_list("path").alias("paths"))
    groups = {r.kind: r.paths for r in found.orderBy("kind").collect()}
    out = None
    for members in groups.values():
        df = spark.read.parquet(*members)
        have = set(df.columns)
        cols = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
        out = df.select(*cols) if out is None else out.unionByName(df.select(*cols))
    if out is None:
        raise ValueError("no files")
    return out


def write_flat(df: DataFrame, path: str, compression: str = "zstd", mode: str = "overwrite") -> None:
    _check_codec(compression)
    df.write.mode(mode).option("compression", compression).parquet(path)


def write_hive(df: DataFrame, path: str, by: list[str], compression: str = "zstd", mode: str = "overwrite", before: list[str] | None = None) -> None:
    """A folder for each key; rows with a null key go.  Keys are whole numbers, stand in the folders' names and are columns again when read.

    `before`: columns whose folders come first; these may be null.
    """
    _check_codec(compression)
    keyed = df.na.drop(subset=by) if by else df
    for c in by:
        keyed = keyed.withColumn(c, F.col(f"`{c}`").cast("bigint"))
    keyed = keyed.repartition(*(before or []), *by) if by else keyed
    keyed.write.mode(mode).option("compression", compression).partitionBy(*(before or []), *by).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A final result as one CSV file with a header."""
    df.coalesce(1).write.mode(mode).option("header", "true").csv(path)


def export(df: DataFrame, path: str, kind: str | None = None) -> str:
    """Write a result as Parquet or CSV; the kind overrides the path's ending.  Returns the path used."""
    stem, dot, ending = path.rpartition(".")
    known = ending if dot and ending in ("parquet", "csv") else None
    kind = kind or known or "parquet"
    if kind not in ("parquet", "csv"):
        raise ValueError("results are written as parquet or csv")
    path = f"{stem if known else path}.{kind}"
    write_csv(df, path) if kind == "csv" else write_flat(df, path)
    return path


def _check_codec(compression: str) -> None:
    if compression not in CODECS:
        raise ValueError(f"unknown codec {compression!r}; known: {CODECS}")
