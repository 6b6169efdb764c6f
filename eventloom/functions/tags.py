"""Sets of tags written as delimited strings."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


_BLANK = " \t\r\n"


def tag_set(c: Column, delimiter: str = ";") -> Column:
    """Distinct tags without blanks around them; empty ones and null give none."""
    parts = F.split(F.btrim(F.coalesce(c, F.lit("")), F.lit(_BLANK)), f"[{_BLANK}]*{re.escape(delimiter)}[{_BLANK}]*")
    return F.array_remove(F.array_distinct(parts), "")


def missing_tags(of: Column, within: Column) -> Column:
    """Tags of the first set that the second lacks."""
    return F.array_except(of, within)
