"""Cleaning: drop rows with nulls, choose columns, narrow reals."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import changed_by_float32, to_float32

log = logging.getLogger(__name__)


def split_present(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """(those of the columns that exist, those that don't)."""
    have = set(df.columns)
    return [c for c in columns if c in have], [c for c in columns if c not in have]


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame | None:
    """Rows without a null in any checked column.

    No columns to check keeps all rows.  Missing columns are left out with a warning;
    if all are missing there is no result.
    """
    if not columns:
        return df
    have, missing = split_present(df, columns)
    if missing:
        log.warning("columns to check that don't exist: %s", missing)
    return df.na.drop(subset=[f"`{c}`" for c in have]) if have else None


def project(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """The named columns that exist, in the given order; all if none are named."""
    return df if not columns else df.select(*(F.col(f"`{c}`") for c in split_present(df, columns)[0]))


def narrow(df: DataFrame, columns: list[str]) -> DataFrame:
    """Named real columns as 32-bit; others and whole numbers stay."""
    real = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*((to_float32(F.col(f"`{c}`")).alias(c) if c in columns and c in real else F.col(f"`{c}`")) for c in df.columns))


def narrowing_loss(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: n_rows and, for each column, how many values 32 bits would change."""
    return df.agg(F.count("*").alias("n_rows"), *(F.count_if(changed_by_float32(F.col(f"`{c}`"))).alias(f"changed_{c}") for c in columns))


def retention(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: n_before, n_after, n_removed, percent_kept of dropping nulls; one pass over the checked columns."""
    have, _ = split_present(df, columns)
    ok = F.lit(True)
    for c in have:
        ok = ok & F.col(f"`{c}`").isNotNull()
    n, kept = F.count("*"), F.count_if(ok)
    return df.agg(n.alias("n_before"), kept.alias("n_after"), (n - kept).alias("n_removed"), F.when(n > 0, F.round(100.0 * kept / n, 2)).otherwise(0.0).alias("percent_kept"))


def clean(df: DataFrame, check: list[str], keep: list[str] | None = None, float32: list[str] | None = None) -> DataFrame | None:
    """Drop nulls, then choose columns, then narrow; rows are judged on columns that may not be kept."""
    rows = drop_nulls(df, check)
    return None if rows is None else narrow(project(rows, keep), float32 or [])
