"""Stage commands: scrape, convert, filter, sample, crossref, codes."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Sequence

from .operators import codes, crossref
from .operators.predicate import unrecognized_codes
from .operators.sampling import FileIndex, FilteredSampler, sample_daily
from .plans import config as configs
from .plans import stages
from .plans.store import Store
from .sources.ingest import export, read_parquet_dir
from .sources.listing import http_transport, list_remote, scrape
from .sources.periods import check_window
from .sources.specs import DATASETS, spec

log = logging.getLogger("eventloom")


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="eventloom", description=__doc__)
    p.add_argument("--config")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, dataset: bool = True, dates: bool = True) -> argparse.ArgumentParser:
        s = sub.add_parser(name)
        if dataset:
            s.add_argument("--dataset", choices=sorted(DATASETS), default="events")
        if dates:
            s.add_argument("--start-date")
            s.add_argument("--end-date")
        return s

    for name in ("scrape", "convert", "filter"):
        s = add(name)
        s.add_argument("--order", choices=("asc", "desc"), default="asc")
        loud = s.add_mutually_exclusive_group()
        loud.add_argument("--verbose", action="store_true")
        loud.add_argument("--quiet", "-q", action="store_true")
        s.add_argument("--force", action="store_true")
        s.add_argument("--dry-run", action="store_true")
        if name == "scrape":
            s.add_argument("--list", help="URL or path of an HTML index or of `size md5 url` lines (.txt); else that of the configuration")
        else:
            s.add_argument("--delete-source", action="store_true")
    s = add("sample")
    s.add_argument("--mode", choices=("indexed", "filtered", "daily"), default="indexed")
    s.add_argument("--source", choices=("filtered", "converted"), default="filtered")
    s.add_argument("-n", type=int, default=1000)
    s.add_argument("--seed", type=int, default=42)
    s.add_argument("--per-day", type=int, default=10)
    s.add_argument("--date-column")
    s.add_argument("--scope", choices=("day", "file"), default="day")
    s.add_argument("--filter")
    s.add_argument("--columns", nargs="*")
    s.add_argument("--stratify")
    s.add_argument("--n-per-group", type=int, default=10)
    s.add_argument("--out", default="sample.parquet")
    s.add_argument("--export-format", choices=("parquet", "csv"))
    s = add("crossref", dataset=False)
    s.add_argument("--events", required=True)
    s.add_argument("--gkg-version", choices=("v1", "v1-counts", "v2", "auto"), default="v2")
    s.add_argument("--source", choices=("filtered", "converted"), default="filtered")
    s.add_argument("--columns", nargs="*")
    s.add_argument("--on-duplicate-document", choices=crossref.RECORD_MODES, default="all")
    s.add_argument("--collapse-duplicate-mentions", action="store_true")
    s.add_argument("--out", default="crossref.parquet")
    s.add_argument("--export-format", choices=("parquet", "csv"))
    s = add("codes", dataset=False, dates=False)
    s.add_argument("column", nargs="?")
    s.add_argument("--search")
    return p


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("eventloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _sample(args: argparse.Namespace, cfg: dict) -> None:
    spark, ids = _spark(), spec(args.dataset).required[:1]
    block = json.loads(args.filter) if args.filter else None
    if args.mode == "filtered" and block and (args.start_date or args.end_date):
        log.warning("a window of days chooses files, a filter rows within them: both apply")
    df = Store(spark, configs.folder(cfg, args.dataset, args.source), args.dataset).read(args.start_date, args.end_date)
    if args.mode == "daily":
        out = sample_daily(df, args.per_day, args.seed, args.date_column or ("Day" if "Day" in df.columns else spec(args.dataset).numeric[0]), ids, args.scope, args.columns)
    elif args.mode == "indexed":
        out = FileIndex(spark, table=df).sample(args.n, args.seed)
        out = out.select(*(f"`{c}`" for c in args.columns)) if args.columns else out
    else:
        for column, value in unrecognized_codes(block or {}):
            log.warning("%r is no known code of %s", value, column)
        sampler = FilteredSampler(df, block, args.columns, args.seed, ids)
        out = sampler.stratified(args.stratify, args.n_per_group) if args.stratify else sampler.sample(args.n)
    print(export(out, args.out, args.export_format))


def _crossref(args: argparse.Namespace, cfg: dict) -> None:
    spark = _spark()
    windowed = bool(args.start_date or args.end_date)

    def table(dataset: str):
        store = Store(spark, configs.folder(cfg, dataset, args.source), dataset)
        crossref.warn_folder(store.manifest.latest().count(), dataset, windowed)
        return store.read(args.start_date, args.end_date)

    events = read_parquet_dir(spark, args.events)
    crossref.warn_events_input(events)
    since = {"v1": crossref.DIRECT_SINCE, "v1-counts": crossref.DIRECT_SINCE, "v2": crossref.BRIDGE_SINCE, "auto": crossref.DIRECT_SINCE}[args.gkg_version]
    if "DATEADDED" in events.columns:
        crossref.warn_coverage(events, "DATEADDED", since)
    options = {"on_duplicate_document": args.on_duplicate_document, "dedupe_mentions": args.collapse_duplicate_mentions}
    if args.gkg_version in ("v1", "v1-counts"):
        out = crossref.direct(events, table("gkg_v1" if args.gkg_version == "v1" else "gkg_v1_counts"), args.columns)
    elif args.gkg_version == "v2":
        out = crossref.two_hop(events, table("mentions"), table("gkg_v2"), args.columns, **options)
    elif args.columns:
        raise ValueError("columns can't be chosen with auto: the two generations have different ones")
    else:
        out = crossref.auto(events, table("gkg_v1"), table("mentions"), table("gkg_v2"), **options)
    print(export(out, args.out, args.export_format))


def _codes(args: argparse.Namespace) -> None:
    if not args.column:
        for family, (name, columns) in codes.list_families().items():
            print(f"{family}: {name} ({', '.join(columns)})")
        return
    for code, name in codes.list_codes(args.column, args.search):
        print(f"{code}\t{name}")


def run(args: argparse.Namespace) -> None:
    if args.command != "codes":
        check_window(args.start_date, args.end_date)
    if args.command == "codes" and not configs.given(args.config):
        return _codes(args)
    cfg = configs.load(args.config)
    if cfg["code_lists"]:
        codes.load_folder(cfg["code_lists"])
    if args.command == "codes":
        return _codes(args)
    if args.command == "sample":
        return _sample(args, cfg)
    if args.command == "crossref":
        return _crossref(args, cfg)
    folder = lambda stage: configs.folder(cfg, args.dataset, stage)
    window = {"start_date": args.start_date, "end_date": args.end_date, "order": args.order, "dry_run": args.dry_run, "force": args.force}
    d = args.dataset
    if args.command == "scrape":
        place = args.list or cfg["lists"][d]
        if not place:
            raise ValueError(f"where are the files of {d} listed? Give --list or set lists.{d}")
        listed = list_remote(d, place, cfg["timeout_s"])
        result = scrape(listed, folder("raw"), d, transport=http_transport(cfg["timeout_s"]), workers=cfg["workers"], retries=cfg["retries"], wait_s=cfg["retry_wait_s"], **window)
        log.info("scrape: %s", {k: len(v) for k, v in result.items()})
        for how, urls in result.items():
            for u in urls:
                log.debug("%s: %s", how, u)
        failed = result["failed"]
    else:
        hive_by = cfg["hive_by"] if cfg["historical"] else None
        more = {"delete_source": args.delete_source, "compression": cfg["compression"], "hive_by": hive_by, **window}
        if args.command == "convert":
            done = stages.convert(_spark(), folder("raw"), folder("converted"), d, cfg["converted_columns"][d], **more)
        else:
            done = stages.filter_files(_spark(), folder("converted"), folder("filtered"), d, cfg["columns_to_check"][d], cfg["output_columns"][d], cfg["float32_columns"][d], **more)
        log.info("%s: %d processed, %d skipped, %d pending, %d failed, rows %d to %d", args.command, len(done.processed), len(done.skipped), len(done.pending), len(done.failed), done.rows_before, done.rows_after)
        for how in ("processed", "skipped", "pending"):
            for name in getattr(done, how):
                log.debug("%s: %s", how, name)
        failed = done.failed
    if failed:
        raise ValueError(f"{args.command} ended with {len(failed)} failed files, the first: {failed[:5]}")


def main(argv: Sequence[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    level = logging.DEBUG if getattr(args, "verbose", False) else logging.WARNING if getattr(args, "quiet", False) else logging.INFO
    logging.basicConfig(format="%(levelname)s %(message)s", stream=sys.stderr)
    logging.getLogger("eventloom").setLevel(level)
    try:
        run(args)
    except KeyboardInterrupt:
        return 130
    except (ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
