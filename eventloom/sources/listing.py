"""Lists of files to fetch: HTML indexes, master lists, what is there already."""

from __future__ import annotations

import hashlib
import logging
import os
import re
import shutil
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .periods import PARSERS, select_files, sort_files
from .specs import spec

log = logging.getLogger(__name__)

#: More files than this deserve a warning before they are fetched.
LARGE_FETCH = 5_000

# What the files of each dataset are named.
FILE_PATTERNS = {
    "events": r"^([0-9]{8}\.export\.CSV\.zip|[0-9]{6}\.zip|[0-9]{4}\.zip)$",
    "gkg_v1": r"^[0-9]{8}\.gkg\.csv\.zip$",
    "gkg_v1_counts": r"^[0-9]{8}\.gkgcounts\.csv\.zip$",
    "gkg_v2": r"\.gkg\.csv\.zip$",
    "mentions": r"\.mentions\.CSV\.zip$",
}
#: Datasets that are listed on an HTML page; the others stand in a master file list.
HTML_LISTED = ("events", "gkg_v1", "gkg_v1_counts")


@dataclass(frozen=True)
class RemoteFile:
    url: str
    md5: str | None = None
    size: int | None = None


def wanted(url: str, dataset: str) -> bool:
    """Does a URL's file name belong to the dataset?"""
    return re.search(FILE_PATTERNS[spec(dataset).name], url.rsplit("/", 1)[-1]) is not None


def parse_html(page: str, base_url: str, dataset: str) -> list[RemoteFile]:
    """As `html_links`, of a page on the driver: one index page lists all files."""
    out = []
    for line in page.splitlines():
        if m := re.search(r"""(?i)href=["']?([^"' >]+)""", line):
            url = re.sub("(?i)^https://", "http://", urllib.parse.urljoin(base_url, m[1]))
            if wanted(url, dataset):
                md5 = re.search(r"(?i)MD5:?\s*([0-9a-f]{32})", line)
                out.append(RemoteFile(url, md5[1].lower() if md5 else None))
    return out


def parse_master(text: str, dataset: str) -> list[RemoteFile]:
    """As `master_list`, of a list on the driver."""
    parts = (line.split() for line in text.splitlines())
    return [RemoteFile(p[2], p[1].lower(), int(p[0]) if p[0].isdecimal() else None) for p in parts if len(p) == 3 and wanted(p[2], dataset)]


def get_text(url: str, timeout_s: float = 30.0) -> str:
    """The text at a URL (http, https, file) or path."""
    if "://" not in url:
        with open(url, encoding="utf-8") as f:
            return f.read()
    with urllib.request.urlopen(url, timeout=timeout_s) as r:  # noqa: S310  the user names the place
        return r.read().decode("utf-8", "replace")


def list_remote(dataset: str, url: str, timeout_s: float = 30.0) -> list[RemoteFile]:
    """A dataset's files from where they are listed: an HTML index for some datasets, a master list for the others.

    A place whose name ends in .txt is read as a master list for any dataset.
    """
    text = get_text(url, timeout_s)
    if dataset in HTML_LISTED and not url.endswith(".txt"):
        return parse_html(text, url, dataset)
    return parse_master(text, dataset)


def warn_large(files: list[RemoteFile], dataset: str) -> str | None:
    """A warning, logged and returned, before very many files are fetched."""
    if len(files) <= LARGE_FETCH:
        return None
    known = sum(f.size or 0 for f in files)
    message = f"{len(files)} files of {dataset} are to be fetched" + (f", {known / 1e9:.1f} GB" if known else "") + "; narrow the window if that isn't meant"
    log.warning(message)
    return message


def file_name(url: Column) -> Column:
    return F.regexp_extract(url, "([^/]+)$", 1)


def html_links(lines: DataFrame, base_url: str, dataset: str, line_col: str = "value") -> DataFrame:
    """(url, md5) of the wanted files of an HTML index, one line of HTML per row.

    Relative links are completed with the base; https becomes http; a checksum is taken from the same line.
    """
    href = F.regexp_extract(line_col, r"""(?i)href=["']?([^"' >]+)""", 1)
    url = F.regexp_replace(F.when(href.rlike("(?i)^https?://"), href).otherwise(F.concat(F.lit(base_url.rstrip("/") + "/"), F.regexp_replace(href, "^/+", ""))), "(?i)^https://", "http://")
    md5 = F.lower(F.regexp_extract(line_col, r"(?i)MD5:?\s*([0-9a-f]{32})", 1))
    out = lines.where(href != "").select(url.alias("url"), F.when(md5 != "", md5).alias("md5"))
    return out.where(file_name(F.col("url")).rlike(FILE_PATTERNS[spec(dataset).name]))


def master_list(lines: DataFrame, dataset: str, line_col: str = "value") -> DataFrame:
    """(url, md5, size) of a `size md5 url` list; malformed lines are skipped, a bad size is null."""
    parts = F.split(F.btrim(F.col(line_col), F.lit(" \t\r\n")), r"\s+")
    rows = lines.select(parts.alias("p")).where(F.size("p") == 3)
    size = F.when(F.get("p", 0).rlike("^[0-9]{1,18}$"), F.get("p", 0)).cast("bigint")
    out = rows.select(F.get("p", 2).alias("url"), F.lower(F.get("p", 1)).alias("md5"), size.alias("size"))
    return out.where(F.col("url").rlike(FILE_PATTERNS[spec(dataset).name]))


def fetch_plan(listed: DataFrame, present: DataFrame) -> DataFrame:
    """(url, action): fetch or skip, by whether a file of that name is there (present: name)."""
    have = present.select(F.col("name").alias("_n"), F.lit(True).alias("_have")).distinct()
    named = listed.withColumn("_f", file_name(F.col("url")))
    return named.join(have, named["_f"] == have["_n"], "left").select("url", F.when(F.col("_have"), "skip").otherwise("fetch").alias("action"))


def fetch_size(listed: DataFrame) -> DataFrame:
    """n_files, total bytes of known sizes, and whether to warn."""
    return listed.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("n_bytes"), (F.count("*") > LARGE_FETCH).alias("large"))


def bad_checksums(files: DataFrame, listed: DataFrame) -> DataFrame:
    """Fetched files (path, content: as Spark's binaryFile source gives them) whose MD5 isn't the listed one."""
    have = files.select(file_name(F.col("path")).alias("name"), F.md5("content").alias("found"))
    want = listed.where("md5 is not null").select(file_name(F.col("url")).alias("name"), F.lower("md5").alias("md5"))
    return have.join(want, "name").where("found <> md5")


Transport = Callable[[str, str], None]


def copy_local(url: str, target: str) -> None:
    """Transport for file: URLs and paths."""
    shutil.copyfile(url.removeprefix("file://"), target)


def http_transport(timeout_s: float = 30.0) -> Transport:
    """Transport for http and https, in pieces, so no file is held in memory; other places are copied."""

    def fetch(url: str, target: str) -> None:
        if not re.match("(?i)https?://", url):
            return copy_local(url, target)
        with urllib.request.urlopen(url, timeout=timeout_s) as r, open(target, "wb") as f:  # noqa: S310  the list names the place
            shutil.copyfileobj(r, f, 1 << 16)

    return fetch


def fetch_one(f: RemoteFile, folder: str, transport: Transport, retries: int = 3, wait_s: float = 0.0, force: bool = False) -> str:
    """success, skipped or failed; the file appears whole or not at all.  A file that is there is skipped, unless forced."""
    target = os.path.join(folder, os.path.basename(f.url))
    if os.path.exists(target) and not force:
        return "skipped"
    part = target + ".part"
    for attempt in range(retries):
        try:
            transport(f.url, part)
            if f.md5:
                with open(part, "rb") as g:
                    if hashlib.file_digest(g, "md5").hexdigest() != f.md5.lower():
                        raise OSError("checksum differs")
            os.replace(part, target)
            return "success"
        except OSError:
            if os.path.exists(part):
                os.remove(part)
            if attempt + 1 < retries:
                time.sleep(wait_s)
    return "failed"


def fetch_all(files: Iterable[RemoteFile], folder: str, transport: Transport = copy_local, workers: int = 8, retries: int = 3, wait_s: float = 0.0, force: bool = False) -> dict[str, list[str]]:
    """Fetch with a bounded pool of threads; returns the URLs by outcome."""
    files = list(files)
    os.makedirs(folder, exist_ok=True)
    out: dict[str, list[str]] = {"success": [], "skipped": [], "failed": []}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        for f, how in zip(files, pool.map(lambda f: fetch_one(f, folder, transport, retries, wait_s, force), files)):
            out[how].append(f.url)
    return out


def scrape(listed: Iterable[RemoteFile], folder: str, dataset: str, start_date: str | None = None, end_date: str | None = None, order: str = "asc", dry_run: bool = False, transport: Transport = copy_local, workers: int = 8, retries: int = 3, wait_s: float = 0.0, force: bool = False) -> dict[str, list[str]]:
    """Window, sort and fetch the dataset's files of a list; a dry run says what would be fetched or skipped."""
    parser = PARSERS[spec(dataset).period]
    by_url = {f.url: f for f in listed if wanted(f.url, dataset)}
    urls = sort_files(select_files(by_url, start_date, end_date, parser, keep_undated=False), order, parser)
    if dry_run:
        have = {u for u in urls if not force and os.path.exists(os.path.join(folder, os.path.basename(u)))}
        return {"success": [u for u in urls if u not in have], "skipped": [u for u in urls if u in have], "failed": []}
    files = [by_url[u] for u in urls]
    warn_large(files, dataset)
    return fetch_all(files, folder, transport, workers, retries, wait_s, force)
