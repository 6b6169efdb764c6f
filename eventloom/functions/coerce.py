"""Text to values: null spellings, numbers, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that stand for null in the raw files.
NULL_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def null_spelled(c: Column) -> Column:
    """Null for the spellings of null."""
    return F.when(~c.isin(*NULL_SPELLINGS), c)


def to_number(c: Column, kind: str = "double") -> Column:
    """A number, or null for anything else; whole numbers are cut from reals such as "3.0"."""
    t = F.btrim(c, F.lit(" \t\r\n"))
    # casts take some words and suffixes for numbers too; with these characters alone they take what NUMBER says
    value = F.when(F.translate(t, "0123456789+-.eE", "") == "", t)
    if kind == "bigint":
        return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))
    return value.try_cast(kind)


def day_number(c: Column) -> Column:
    """yyyymmdd as a whole number."""
    return F.date_format(c, "yyyyMMdd").cast("bigint")


def number_day(c: Column) -> Column:
    """A date from yyyymmdd; of 14-digit times, their day.  Impossible days are null."""
    s = F.substring(c.cast("string"), 1, 8)
    return F.try_to_timestamp(F.when(s.rlike("^[0-9]{8}$"), s), F.lit("yyyyMMdd")).cast("date")


def to_float32(c: Column) -> Column:
    return c.cast("float")


def changed_by_float32(c: Column) -> Column:
    return c.cast("float").cast("double") != c


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)
