"""Periods that file names stand for, as column expressions and for names on the driver.

Grammars: "events" knows daily (`YYYYMMDD.export...`), monthly (`YYYYMM`) and yearly
(`YYYY`) names; "daily" the first eight digits; "quarter" fourteen digits that are a valid
time.  A name outside its grammar, or an impossible date, has no period.
"""

from __future__ import annotations

import calendar
import os
import re
from collections.abc import Callable, Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Period = tuple[date | None, date | None]

_MARK = "_filtered.parquet"


def base_name(name: Column) -> Column:
    """File name without folders, and without the mark of a filtered file."""
    return F.regexp_replace(F.regexp_extract(name, "([^/]*)$", 1), r"_filtered\.parquet$", ".parquet")


def _day(digits: Column) -> Column:
    return F.try_to_timestamp(F.when(digits.rlike("^[0-9]{8}$"), digits), F.lit("yyyyMMdd")).cast("date")


def period_columns(name: Column, grammar: str) -> tuple[Column, Column]:
    """First and last day of a file's period, both null if it has none."""
    n = base_name(name)
    if grammar == "events":
        daily = _day(F.regexp_extract(n, r"^([0-9]{8})\.export\.(CSV\.zip|csv\.zip|CSV|csv|parquet)$", 1))
        month = _day(F.concat(F.regexp_extract(n, r"^([0-9]{6})\.(zip|csv|CSV|parquet)$", 1), F.lit("01")))
        year = _day(F.concat(F.regexp_extract(n, r"^([0-9]{4})\.(zip|csv|CSV|parquet)$", 1), F.lit("0101")))
        return F.coalesce(daily, month, year), F.coalesce(daily, F.last_day(month), F.last_day(F.add_months(year, 11)))
    if grammar == "quarter":
        digits = F.regexp_extract(n, "^([0-9]{14})", 1)
        day = F.try_to_timestamp(F.when(digits != "", digits), F.lit("yyyyMMddHHmmss")).cast("date")
    elif grammar == "daily":
        day = _day(F.regexp_extract(n, "^([0-9]{8})", 1))
    else:
        raise ValueError(f"unknown grammar {grammar!r}")
    return day, day


def file_type(name: Column) -> Column:
    """quarter_hourly, daily, monthly, yearly or unknown."""
    n = base_name(name)
    return (
        F.when(n.rlike("^[0-9]{14}[.]"), "quarter_hourly").when(n.rlike("^[0-9]{8}[.]"), "daily")
        .when(n.rlike("^[0-9]{6}[.]"), "monthly").when(n.rlike("^[0-9]{4}[.]"), "yearly").otherwise("unknown")
    )


_KINDS = {14: "quarter_hourly", 8: "daily", 6: "monthly", 4: "yearly"}


def file_kind(name: str) -> str:
    """As `file_type`, of a name on the driver."""
    return _KINDS.get(len(m[0]), "unknown") if (m := re.match("[0-9]+(?=[.])", os.path.basename(name))) else "unknown"


def overlaps(start: Column, end: Column, lo: str | None, hi: str | None, keep_undated: bool) -> Column:
    """Does a period touch the window lo..hi (ISO days, either open)?"""
    if lo is None and hi is None:
        return F.lit(True)
    hit = F.lit(True)
    if lo is not None:
        hit = hit & (end >= F.lit(lo).cast("date"))
    if hi is not None:
        hit = hit & (start <= F.lit(hi).cast("date"))
    return F.coalesce(hit, F.lit(keep_undated)) if keep_undated else F.coalesce(hit & start.isNotNull(), F.lit(False))


def order_by_period(files: DataFrame, start: str, name: str, order: str = "asc") -> DataFrame:
    """Sort by period start; names without one come last either way."""
    if order not in ("asc", "desc"):
        raise ValueError("order is asc or desc")
    c = F.col(start)
    return files.orderBy(c.asc_nulls_last() if order == "asc" else c.desc_nulls_last(), name)


# The same on the driver, for lists of names of at most some hundred thousand files.


def _span(digits: str) -> Period:
    try:
        if len(digits) == 14:
            d = datetime.strptime(digits, "%Y%m%d%H%M%S").date()
            return d, d
        y, m, d = int(digits[:4]), int(digits[4:6] or 1), int(digits[6:8] or 1)
        start = date(y, m, d)
        if len(digits) == 8:
            return start, start
        return start, date(y, m, calendar.monthrange(y, m)[1]) if len(digits) == 6 else date(y, 12, 31)
    except ValueError:
        return None, None


def _parser(pattern: str) -> Callable[[str], Period]:
    known = re.compile(pattern)

    def parse(name: str) -> Period:
        n = os.path.basename(name)
        if n.endswith(_MARK):
            n = n[: -len(_MARK)] + ".parquet"
        m = known.match(n)
        return _span(next(g for g in m.groups() if g)) if m else (None, None)

    return parse


parse_event_period = _parser(r"^([0-9]{8})\.export\.(?:CSV\.zip|csv\.zip|CSV|csv|parquet)$|^([0-9]{6}|[0-9]{4})\.(?:zip|csv|CSV|parquet)$")
parse_quarter_period = _parser(r"^([0-9]{14})")
parse_daily_period = _parser(r"^([0-9]{8})")
PARSERS = {"events": parse_event_period, "quarter": parse_quarter_period, "daily": parse_daily_period}


def check_window(lo: str | None, hi: str | None) -> tuple[date | None, date | None]:
    """ISO days as dates; raises if malformed or in the wrong order."""
    a, b = (date.fromisoformat(x) if x else None for x in (lo, hi))
    if a and b and a > b:
        raise ValueError(f"the window starts on {a}, after its end on {b}")
    return a, b


def select_files(names: Iterable[str], lo: str | None, hi: str | None, parser: Callable[[str], Period], keep_undated: bool = True) -> list[str]:
    """Names whose period touches the window; remote lists drop undated names, local ones keep them."""
    a, b = check_window(lo, hi)
    names = list(names)
    if a is None and b is None:
        return names
    out = []
    for n in names:
        start, end = parser(n)
        if start is None:
            if keep_undated:
                out.append(n)
        elif (a is None or end >= a) and (b is None or start <= b):
            out.append(n)
    return out


def sort_files(names: Iterable[str], order: str, parser: Callable[[str], Period]) -> list[str]:
    if order not in ("asc", "desc"):
        raise ValueError("order is asc or desc")
    dated = [(parser(n)[0], n) for n in names]
    known = sorted((x for x in dated if x[0]), key=lambda x: x[0], reverse=order == "desc")
    return [n for _, n in known] + [n for d, n in dated if d is None]
