"""Seeded order of rows that doesn't hang on how they are partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(seed: int, *ids: str) -> Column:
    """A key to sort by: as good as random in the ids, the same everywhere for one seed."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(f"`{c}`").cast("string") for c in ids)))
