"""Measures of how tables agree: equal columns, codes made of parts, repeated keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def group_counts(df: DataFrame, by: list[str]) -> DataFrame:
    """The keys and n, the rows of each."""
    return df.groupBy(*map(_q, by)).agg(F.count("*").alias("n"))


def equal_rate(df: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """n and n_same: rows, and those in which two columns hold the same value; for each group, if asked."""
    return df.groupBy(*map(_q, by or [])).agg(F.count("*").alias("n"), F.count_if(_q(a) == _q(b)).alias("n_same"))


def overlap_rate(df: DataFrame, a: str, b: str, present: Column, by: list[str] | None = None) -> DataFrame:
    """As `equal_rate`, with n_both: rows of which `present` says that both have a value."""
    return df.groupBy(*map(_q, by or [])).agg(F.count("*").alias("n"), F.count_if(_q(a) == _q(b)).alias("n_same"), F.count_if(present).alias("n_both"))


def concat_matches(df: DataFrame, whole: str, parts: list[str]) -> DataFrame:
    """n and n_whole: rows, and those whose code is its parts one after the other; a null part counts as empty."""
    joined = reduce(lambda x, y: F.concat(x, y), (F.coalesce(_q(p), F.lit("")) for p in parts))
    return df.agg(F.count("*").alias("n"), F.count_if(_q(whole) == joined).alias("n_whole"))


def repeated(df: DataFrame, keys: list[str], value: str | None = None) -> DataFrame:
    """The keys of more than one row, n rows of each, and whether they differ in a value."""
    more = [(F.min(_q(value)) != F.max(_q(value))).alias("differ")] if value else []
    return df.groupBy(*map(_q, keys)).agg(F.count("*").alias("n"), *more).where("n > 1")


def spread(counts: DataFrame, total: str, n: str = "n") -> DataFrame:
    """One row of a table of counts: how many keys there are, how many have several, and the most that one has."""
    return counts.agg(F.count("*").alias(total), F.count_if(_q(n) > 1).alias("n_several"), F.max(_q(n)).alias("most"))
