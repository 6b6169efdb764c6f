"""The filter language: nested conditions to a Column.

A block is a dict.  A column name maps to a scalar (equality), a list (membership), a
pair (closed range) or {"op": ...}; the keys AND and OR hold blocks.  Siblings combine
by the connective of their block, AND at the top.  Empty blocks say nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .codes import is_recognized

CONNECTIVES = {"AND": and_, "OR": or_}
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _literal(field: T.StructField, value: Any) -> Column:
    """A literal that fits the column's type, or ValueError."""
    kind = field.dataType
    ok = (
        isinstance(value, bool) if isinstance(kind, T.BooleanType)
        else isinstance(value, (int, float)) and not isinstance(value, bool) if isinstance(kind, _NUMBERS)
        else isinstance(value, str) if isinstance(kind, T.StringType)
        else True
    )
    if not ok:
        raise ValueError(f"{field.name} is {kind.simpleString()}: {value!r} can't be compared with it")
    return F.lit(value)


def _among(c: Column, field: T.StructField, values: list) -> Column:
    known = [_literal(field, v) for v in values if v is not None]
    hit = c.isin(*known) if known else F.lit(False)
    return hit | c.isNull() if len(known) < len(values) else hit


def _condition(field: T.StructField, cond: Any) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(cond, list):
        return _among(c, field, cond)
    if isinstance(cond, tuple) and len(cond) == 2:
        return c.between(_literal(field, cond[0]), _literal(field, cond[1]))
    if isinstance(cond, dict):
        op = cond.get("op")
        if op == "equals":
            return c == _literal(field, cond["value"])
        if op == "in_list":
            return _among(c, field, list(cond["values"]))
        if op == "gt":
            return c > _literal(field, cond["value"])
        if op == "lt":
            return c < _literal(field, cond["value"])
        if op in ("between", "range"):
            return c.between(_literal(field, cond["min"]), _literal(field, cond["max"]))
    elif isinstance(cond, (str, int, float, bool)):
        return c == _literal(field, cond)
    raise ValueError(f"{field.name}: unknown condition {cond!r}")


def validate(block: Any, columns: set[str]) -> None:
    if not isinstance(block, dict):
        raise ValueError("a block of conditions must be a dict")
    for key, value in block.items():
        if key in CONNECTIVES:
            validate(value, columns)
        elif key not in columns:
            raise ValueError(f"unknown column {key!r}")


def referenced(block: dict) -> list[str]:
    """Columns that the conditions name, in order of first mention."""
    out: dict[str, None] = {}
    for key, value in block.items():
        out.update(dict.fromkeys(referenced(value) if key in CONNECTIVES else [key]))
    return list(out)


def compile_filter(block: dict | None, schema: T.StructType) -> Column | None:
    """The Column of a filter, None if it says nothing."""
    if not block:
        return None
    validate(block, set(schema.names))
    return _block(block, schema, "AND")


def _block(block: dict, schema: T.StructType, connective: str) -> Column | None:
    parts = [_block(v, schema, k) if k in CONNECTIVES else _condition(schema[k], v) for k, v in block.items()]
    parts = [p for p in parts if p is not None]
    return reduce(CONNECTIVES[connective], parts) if parts else None


def _strings(block: dict) -> Iterator[tuple[str, str]]:
    for key, value in block.items():
        if key in CONNECTIVES:
            yield from _strings(value)
            continue
        if isinstance(value, dict):
            value = value.get("value", value.get("values"))
        for v in value if isinstance(value, list) else [value]:
            if isinstance(v, str):
                yield key, v


def unrecognized_codes(block: dict) -> list[tuple[str, str]]:
    """(column, value) of equality and list conditions whose code its family doesn't know; for warnings only."""
    return [(c, v) for c, v in _strings(block) if is_recognized(c, v) is False]
