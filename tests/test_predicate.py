"""The filter language against a naive evaluator, on generated rows."""

import itertools
import random

import pytest

from eventloom.operators.predicate import compile_filter, referenced, unrecognized_codes
from eventloom.operators.sampling import FilteredSampler

SCHEMA = "id bigint, tier bigint, region string, partner string, score double, open boolean"
GEN = random.Random(20)
ROWS = [
    (i, GEN.choice([None, 1, 2, 3, 5, 8]), GEN.choice([None, "north", "south", "east", ""]), GEN.choice(["north", "west", None]), GEN.choice([None, -3.5, -1.0, 0.0, 0.25, 4.0]), GEN.choice([True, False, None]))
    for i in range(150)
]
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def holds(cond, value):
    """One condition on one value: True, False, or None for unknown, as SQL has it."""
    if isinstance(cond, list):
        return True if value is None and None in cond else False if not [c for c in cond if c is not None] else None if value is None else value in cond
    if value is None:
        return None
    if isinstance(cond, tuple):
        return cond[0] <= value <= cond[1]
    if not isinstance(cond, dict):
        return value == cond
    op = cond["op"]
    return {
        "equals": lambda: value == cond["value"], "in_list": lambda: value in cond["values"], "gt": lambda: value > cond["value"], "lt": lambda: value < cond["value"],
        "between": lambda: cond["min"] <= value <= cond["max"], "range": lambda: cond["min"] <= value <= cond["max"],
    }[op]()


def block_holds(block, row, connective="AND"):
    """A block on a row; None if it says nothing.  Unknown counts as neither."""
    found = []
    for k, v in block.items():
        x = block_holds(v, row, k) if k in ("AND", "OR") else holds(v, row[k])
        if x is not None or k not in ("AND", "OR"):
            found.append("unknown" if x is None else x)
    if not found:
        return None
    if connective == "AND":
        return False if False in found else "unknown" if "unknown" in found else True
    return True if True in found else "unknown" if "unknown" in found else False


LEAVES = [
    {"tier": 3}, {"tier": [1, 8]}, {"tier": []}, {"tier": [None, 5]}, {"tier": (2, 5)}, {"tier": {"op": "gt", "value": 2}}, {"tier": {"op": "lt", "value": 2}}, {"region": "north"},
    {"region": [None, "", "east"]}, {"region": {"op": "equals", "value": "south"}}, {"region": {"op": "in_list", "values": ["east", "nowhere"]}}, {"score": {"op": "between", "min": -1, "max": 0.25}},
    {"score": {"op": "range", "min": 0, "max": 9}}, {"score": -3.5}, {"open": True}, {"partner": "west", "open": False},
]


def nested(r, depth):
    """A random block: leaves with other columns side by side, and blocks within."""
    block = {}
    for leaf in r.sample(LEAVES, r.randrange(0, 4)):
        block.update(leaf)
    if depth:
        for k in r.sample(["AND", "OR"], r.randrange(0, 3)):
            block[k] = nested(r, depth - 1)
    return block


BLOCKS = [*LEAVES, {}, {"AND": {}}, {"OR": {"AND": {}}}, {"OR": {"region": "north", "partner": "north"}}, *(nested(random.Random(i), 3) for i in range(60))]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


def test_blocks(table):
    rows = [dict(zip(NAMES, r)) for r in ROWS]
    for block in BLOCKS:
        want = {r["id"] for r in rows if block_holds(block, r) in (True, None)}
        assert {r.id for r in FilteredSampler(table, block, id_cols=("id",)).all().select("id").collect()} == want, block


@pytest.mark.parametrize("block", [{"height": 1}, {"OR": [1]}, {"tier": "3"}, {"tier": False}, {"region": 4}, {"tier": {"op": "about", "value": 1}}, {"tier": [3, "3"]}, {"AND": {"OR": {"nope": 1}}}])
def test_rejected(table, block):
    with pytest.raises(ValueError):
        compile_filter(block, table.schema)


def test_filter_columns_come_along(table):
    assert FilteredSampler(table, {"score": [4.0]}, ["region"], id_cols=("id",)).all().columns == ["region", "score"]
    assert referenced({"q": 1, "OR": {"p": 2, "AND": {"q": 3, "o": 4}}}) == ["q", "p", "o"]


def test_pushdown(spark, tmp_path, table):
    table.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = FilteredSampler(df, {"tier": {"op": "gt", "value": 2}}, ["id"], id_cols=("id",)).all()._jdf.queryExecution().toString()
    assert "GreaterThan(tier,2)" in plan and "region" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_code_warnings():
    known = [{"Actor1CountryCode": c} for c in ("CAN", "nor", "EUR")] + [{"ActionGeo_CountryCode": c} for c in ("NO", "ks")] + [{"EventCode": c} for c in ("0211", "1246", "20", "203")]
    assert list(itertools.chain.from_iterable(map(unrecognized_codes, known))) == []
    block = {"ActionGeo_CountryCode": "NOR", "OR": {"EventCode": ["043", "9999", "X"], "tier": 1}}
    assert unrecognized_codes(block) == [("ActionGeo_CountryCode", "NOR"), ("EventCode", "9999"), ("EventCode", "X")]
