"""The stages in batch form: convert and filter what the manifest says is pending."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import crossref
from ..operators.clean import clean, split_present
from ..sources.files import delete, list_names
from ..sources.ingest import check_arity, parse_tsv, read_zips
from ..sources.periods import PARSERS, file_kind, select_files, sort_files
from ..sources.specs import spec
from .manifest import Manifest, fingerprint, new_run
from .store import PARTS, RUN, Store

log = logging.getLogger(__name__)


@dataclass
class StageResult:
    processed: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    pending: list[str] = field(default_factory=list)  # of a dry run
    failed: list[str] = field(default_factory=list)  # inputs that can't be read; they stay pending
    rows_before: int = 0
    rows_after: int = 0


def warn_narrowing(stage: str, dataset: str, columns: list[str] | None, delete_source: bool, narrowing: list[str]) -> list[str]:
    """Warnings, logged and returned, of settings that lose what later stages or the user may need."""
    out = []
    if lost := crossref.pruned_keys(dataset, columns):
        out.append(f"{stage}: the columns kept of {dataset} lack {lost}, without which crossref can't join it")
    if delete_source and narrowing:
        out.append(f"{stage}: sources are deleted, and {', '.join(narrowing)} narrow the output: what they drop can't be had back without an earlier stage")
    for x in out:
        log.warning(x)
    return out


def _inputs(spark: SparkSession, rows: list[tuple[str, str | None]]) -> DataFrame:
    return spark.createDataFrame(rows, "path string, source string")


def _plan(spark: SparkSession, units: dict[str, str | None], dataset: str, manifest: Manifest, stage: str, print_: str, start: str | None, end: str | None, order: str, force: bool) -> tuple[list[str], list[str]]:
    """(pending inputs in order, inputs done before); units: the run that an input comes from, by its name."""
    parser = PARSERS[spec(dataset).period]
    names = sort_files(select_files(units, start, end, parser), order, parser)
    if not names or force:
        return names, []
    rows = _inputs(spark, [(n, units[n] or "") for n in names])
    todo = {r.path for r in manifest.pending(rows, stage, print_).collect()}
    return [n for n in names if n in todo], [n for n in names if n not in todo]


def convert(spark: SparkSession, raw: str, out: str, dataset: str, columns: list[str] | None = None, compression: str = "zstd", hive_by: dict[str, list[str]] | None = None, start_date: str | None = None, end_date: str | None = None, order: str = "asc", force: bool = False, dry_run: bool = False, delete_source: bool = False) -> StageResult:
    """Zip archives to Parquet: all pending files in one job.

    `hive_by` gives the keys for each kind of file (monthly, yearly) that goes to the historical part.
    A file that can't be read is reported as failed and stays pending; the others go on.
    """
    print_ = fingerprint(dataset=dataset, columns=columns, compression=compression, hive_by=hive_by)
    store = Store(spark, out, dataset)
    todo, done = _plan(spark, dict.fromkeys(list_names(spark, raw, ".zip")), dataset, store.manifest, "convert", print_, start_date, end_date, order, force)
    warn_narrowing("convert", dataset, columns, delete_source, ["columns"] if columns else [])
    if dry_run or not todo:
        return StageResult(skipped=done, pending=todo if dry_run else [])
    run, failed = new_run(), set()
    rules = hive_by or {}
    for kind in sorted({k if (k := file_kind(n)) in rules else "" for n in todo}):
        own = [os.path.join(raw, n) for n in todo if (file_kind(n) if file_kind(n) in rules else "") == kind]
        lines = read_zips(spark, *own, errors=True)
        check_arity(lines.where("_error is null"), dataset)
        seen = Observation()
        lines = lines.observe(seen, F.collect_set(F.when(F.col("_error").isNotNull(), F.col("_src_file"))).alias("failed"))
        rows = parse_tsv(lines.where("_error is null").drop("_error"), dataset, columns)
        store.write(rows, run, "historical" if kind else "table", rules.get(kind), compression)
        failed |= {os.path.basename(f) for f in seen.get["failed"]}
    good = [n for n in todo if n not in failed]
    for n in sorted(failed):
        log.error("%s can't be read as an archive", n)
    if good:
        store.manifest.mark(_inputs(spark, [(n, "") for n in good]), "convert", print_, run)
    if delete_source:
        for n in good:
            delete(spark, os.path.join(raw, n))
    return StageResult(processed=good, skipped=done, failed=sorted(failed))


def filter_files(spark: SparkSession, converted: str, out: str, dataset: str, check: list[str], keep: list[str] | None = None, float32: list[str] | None = None, compression: str = "zstd", hive_by: dict[str, list[str]] | None = None, start_date: str | None = None, end_date: str | None = None, order: str = "asc", force: bool = False, dry_run: bool = False, delete_source: bool = False) -> StageResult:
    """Clean what was converted of pending inputs in one job; row counts come from the same pass.  A row's place in the raw files stays.

    If no column to check exists nothing is written, marked or deleted, and the inputs are reported as
    skipped.  With `delete_source` a converted run goes once all its inputs have been filtered.
    """
    print_ = fingerprint(dataset=dataset, check=check, keep=keep, float32=float32, compression=compression, hive_by=hive_by)
    source, store = Store(spark, converted, dataset), Store(spark, out, dataset)
    units = {r.path: r.run for r in source.manifest.latest().collect()}  # a row for each raw file, as a listing has
    todo, done = _plan(spark, units, dataset, store.manifest, "filter", print_, start_date, end_date, order, force)
    narrowing = [n for n, v in (("check", check), ("keep", keep), ("float32", float32)) if v]
    warn_narrowing("filter", dataset, keep, delete_source, narrowing)
    if dry_run or not todo:
        return StageResult(skipped=done, pending=todo if dry_run else [])
    run, wanted = new_run(), _inputs(spark, [(n, units[n]) for n in todo])
    parts = {p: df for p in PARTS if (df := source.part(p)) is not None}
    if check and not any(split_present(df, check)[0] for df in parts.values()):
        return StageResult(skipped=[*done, *todo])
    counts = []
    for part, df in parts.items():
        own = df if len(todo) == len(units) else df.join(wanted, (F.regexp_extract("_src_file", "([^/]+)$", 1) == wanted["path"]) & (df[RUN] == wanted["source"]), "left_semi")
        by = reduce(lambda a, b: a + [c for c in b if c not in a], (hive_by or {}).values(), []) if part == "historical" else []
        result, before, after = _observed(own.drop(RUN, "part_first", "part_last"), check, [*keep, *crossref.PLACE, *by] if keep else keep, float32)
        store.write(result, run, part, by, compression)
        counts.append((before.get["n"], after.get["n"]))
    store.manifest.mark(wanted, "filter", print_, run)
    if delete_source:
        left = {units[n] for n in units if n not in {*todo, *done}}
        for r in {units[n] for n in todo} - left:
            source.delete_run(r)
    return StageResult(processed=todo, skipped=done, rows_before=sum(b for b, _ in counts), rows_after=sum(a for _, a in counts))


def _observed(rows: DataFrame, check: list[str], keep: list[str] | None, float32: list[str] | None):
    before, after = Observation(), Observation()
    seen = rows.observe(before, F.count(F.lit(1)).alias("n"))
    cleaned = clean(seen, check, keep, float32)
    return cleaned.observe(after, F.count(F.lit(1)).alias("n")), before, after
