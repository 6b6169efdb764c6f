"""Near duplicates by HyperMinHash.

A sketch has REGISTERS buckets.  A shingle's hash picks a bucket and is kept there if it
is the least; of the least only the number of leading zeros and MANTISSA further bits
are stored, 16 bits in all.  Empty buckets borrow from full ones by a fixed order.
Bands of registers give candidate pairs; the share of equal registers, less the
collisions expected of so few bits, estimates the similarity and drops hopeless
pairs; the rest is decided on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Tables, ascii_lower, need, positional, small_arrow, words
from .components import components, joined_parts
from .pieces import small_batches

ROWS, BANDS = 5, 36
REGISTERS = ROWS * BANDS
MANTISSA = 10
#: A pair is dropped on its sketches only so many standard errors below the threshold.
ERRORS = 5
#: Rounds in which each class of a mixed group is compared with one more centre.
ROUNDS = 4
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingle_set(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; a shorter text is one shingle; no words, none."""
    h = word_hashes.view(np.uint64) if word_hashes.dtype == np.int64 else word_hashes
    n = min(size, len(h))
    if not n:
        return np.zeros(0, dtype=np.uint64)
    x = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        x = _mix(x * _M1 + h[k : len(h) - n + 1 + k])
    return np.unique(x)


def _borrow() -> np.ndarray:
    """For each try and bucket, the bucket to borrow from."""
    tries = np.arange(256, dtype=np.uint64)[:, None] * np.uint64(REGISTERS) + np.arange(REGISTERS, dtype=np.uint64)
    return (_mix(tries * _M1 + np.uint64(77)) % np.uint64(REGISTERS)).astype(np.int64)


_BORROW = _borrow()


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers (u16) of a shingle set that isn't empty."""
    x = _mix(shingles + _M1)
    bucket = (x % np.uint64(REGISTERS)).astype(np.int64)
    value = _mix(x ^ _M2)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, bucket, value)
    full = np.zeros(REGISTERS, dtype=bool)
    full[bucket] = True
    # leading zeros and the bits after the first one: that of a float is its exponent and mantissa
    f = np.maximum(least, np.uint64(1)).astype(np.float64)
    m, e = np.frexp(f)
    zeros = np.minimum(64 - e, 62).astype(np.uint16)
    reg = (zeros + np.uint16(1)) << np.uint16(MANTISSA) | ((m * 2 - 1) * (1 << MANTISSA)).astype(np.uint16)
    if not full.all():
        empty = np.nonzero(~full)[0]
        out = reg.copy()
        for tried in _BORROW:
            source = tried[empty]
            ok = full[source]
            out[empty[ok]] = reg[source[ok]]
            empty = empty[~ok]
            if not len(empty):
                break
        if len(empty):
            out[empty] = reg[np.nonzero(full)[0][0]]
        reg = out
    return reg


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each sketch (row)."""
    r = registers.reshape(-1, BANDS, ROWS).astype(np.uint64)
    x = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), r.shape[:2])
    for k in range(ROWS):
        x = _mix(x * _M1 + r[:, :, k])
    return x.view(np.int64)


def collision_rate(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that the registers of two disjoint sets of these sizes are equal.

    The least of a bucket with load n/REGISTERS falls in the cell of zeros z and mantissa t
    with a probability that the exponential law gives; equal cells of both are summed.
    """
    a, b = np.maximum(1, n) / REGISTERS, np.maximum(1, m) / REGISTERS
    z = np.arange(40)
    lo, hi = 2.0 ** -(z + 1), 2.0 ** -z
    pa_ = np.exp(-np.outer(a, lo)) - np.exp(-np.outer(a, hi))
    pb = np.exp(-np.outer(b, lo)) - np.exp(-np.outer(b, hi))
    return np.minimum(0.5, (pa_ * pb).sum(axis=1) / (1 << MANTISSA) + 1 / REGISTERS / np.maximum(1, np.minimum(n, m)))


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity of sketches (rows), corrected for collisions."""
    c = collision_rate(n, m)
    return np.clip(((x == y).mean(axis=1) - c) / (1 - c), 0, 1)


def _drawn(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How many different shingles the registers of two sets stand for: small sets fill few, and the others borrow."""
    return np.minimum(np.minimum(n, m), REGISTERS)


def _hashes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = ascii_lower(F.col(f"`{text_col}`").cast("string"))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(words(text), lambda w: F.xxhash64(w)).alias("h"))


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of an array<long> column as numpy views."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield values[a:b]


def signatures(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, s1, s2, reg): set size, two sums that name the set, sketch (null for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, rows=512):
            rows = []
            for h in _lists(b.column("h")):
                s = shingle_set(h, size)
                rows.append((len(s), s.sum(dtype=np.uint64), _mix(s ^ _M3).sum(dtype=np.uint64), sketch(s).tobytes() if len(s) else None))
            n, s1, s2, reg = zip(*rows)
            as_long = lambda v: pa.array(np.array(v, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), as_long(s1), as_long(s2), pa.array(reg, pa.binary())], names=["id", "n", "s1", "s2", "reg"])

    return _hashes(docs, id_col, text_col).mapInArrow(run, "id long, n long, s1 long, s2 long, reg binary")


def _bands(reps: DataFrame) -> DataFrame:
    """(key, id) for each band of each sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reg = np.frombuffer(b"".join(b.column("reg").to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
            keys = band_keys(reg).reshape(-1)
            ids = np.repeat(b.column("id").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], names=["key", "id"])

    return reps.select("id", "reg").mapInArrow(run, "key long, id long")


def _similar_enough(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, na, nb, ra, rb) whose sizes and estimate don't rule them out, as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = (b.column(c).to_numpy() for c in ("na", "nb"))
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
            error = np.sqrt(threshold * (1 - threshold) / _drawn(n, m))
            keep = pa.array(estimate(x, y, n, m) >= threshold - ERRORS * error) if len(n) else pa.array([], pa.bool_())
            yield b.select(["a", "b"]).filter(keep)

    percent = round(threshold * 100)
    sized = pairs.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    return sized.mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that reach the threshold on their full sets."""
    percent = round(threshold * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(_lists(b.column("sa")), _lists(b.column("sb"))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable by links), kept (it is its own).

    Words are what stands between ASCII white space, A-Z lower-cased; shingles are of
    `size` words.  Two documents are linked if their sets' intersection is at least the
    threshold of their union.  A text of fewer words is one shingle; a null or blank one has none
    and is linked with nothing.  Ids must be whole and not null to be linked: a row of
    null id is returned with a null component and kept.  Rows of one id share its component.
    Other columns play no part, whatever their names.  An empty table gives an empty one.  A very long
    text costs time and memory in proportion to its length, in the one task that holds it.

    Equal sets are one class from the start, so copies are never compared.  In each round a
    class is compared with one other: the likeliest centre among the bands where
    components still differ.  What differs after a few rounds is settled exactly: classes
    of different components that share a rare shingle, early enough in both to reach the threshold.
    Everything is a join or a sum by key; a round's tables are deleted with the next.
    """
    need(docs, id_col, text_col)
    small_arrow(docs.sparkSession)
    frame, at = positional(docs)
    docs, id_col, text_col = frame.select(at[id_col], at[text_col]), at[id_col], at[text_col]
    tables = Tables(docs.sparkSession)
    sig = tables.write(signatures(docs, size, id_col, text_col), "sketches")
    full = sig.where("n > 0 and id is not null")
    classes = full.groupBy("s1", "s2", "n").agg(F.min("id").alias("id"), F.min("reg").alias("reg"))
    reps = tables.write(classes.select("id", "n", "reg", "s1", "s2"), "classes")
    parts = _components(tables, docs, sig, reps, size, threshold, id_col, text_col)
    named = reps.join(parts, "id", "left").select("s1", "s2", "n", F.coalesce("component", "id").alias("_c"))
    out = sig.select("id", "n", "s1", "s2").join(named, ["s1", "s2", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.col("_c")))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _components(tables: Tables, docs: DataFrame, sig: DataFrame, reps: DataFrame, size: int, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """(id, component) of all classes with a link."""
    bands = _bands(reps)  # made twice, which is less than storing and reading it
    shared = bands.groupBy("key").agg(F.count("*").alias("g")).where("g > 1")
    found = tables.write(bands.join(shared, "key"), "groups")
    rows = found.count()  # all that follows is in proportion to it
    few, some = 4 + rows // 250_000, 8 + rows // 30_000
    # a class that meets many others in many bands is likely the source of a family
    weights = found.groupBy("id").agg(F.sum("g").cast("double").alias("w"))
    groups = tables.write(found.select("key", "id").join(weights, "id"), "weighted", few)
    tables.drop(found)
    members = groups.select("id").distinct()
    light = tables.write(reps.select("id", "n", "reg").join(members, "id"), "members", some)
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    sets = tables.write(_sets(own.join(members, "id", "left_semi"), size), "sets")

    def judged(pairs: DataFrame) -> DataFrame:
        a, b = (light.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("reg").alias(f"r{x}")) for x in "ab")
        likely = tables.write(_similar_enough(pairs.join(a, "a").join(b, "b"), threshold), "likely", some)
        sure = tables.write(_confirmed(likely, sets, threshold), "confirmed", some)
        tables.drop(likely)
        return sure

    centres = groups.groupBy("key").agg(F.max(F.struct("w", "id")).alias("c"))
    # one pair for each class: the weightiest centre of all its bands
    star = groups.join(centres, "key").groupBy("id").agg(F.max("c")["id"].alias("c")).where("id <> c")
    tested = tables.write(star.select(*_pair("id", "c")).distinct(), "pairs", few)
    links = judged(tested)
    parts = tables.write(components(links, tables=tables), "parts", few)
    for turn in range(1, ROUNDS + 1):
        labelled = groups.join(parts, "id", "left").select("key", "id", "w", F.coalesce("component", "id").alias("l"))
        mixed = labelled.groupBy("key").agg(F.min("l").alias("l1"), F.max("l").alias("l2")).where("l1 < l2").select("key")
        open_ = tables.write(labelled.join(mixed, "key"), "open", few)
        if turn == ROUNDS:
            break
        # the largest component of a group offers a centre to the others; a class takes the offer that most members back
        lot = F.col("w") * (F.lit(2.0) + F.pmod(F.xxhash64(F.lit(turn), F.col("id")), F.lit(1000)) / 1000)
        sized = open_.groupBy("key", "l").agg(F.count("*").alias("m"), F.max(F.struct(lot.alias("lot"), "id"))["id"].alias("c"))
        best = sized.groupBy("key").agg(F.max(F.struct("m", "l", "c")).alias("s")).select("key", "s.m", F.col("s.l").alias("lc"), "s.c")
        offers = open_.join(best, "key").where("l <> lc").groupBy("id", "c").agg(F.sum("m").alias("m"))
        offers = offers.select("id", "c", "m", *_pair("id", "c")).join(tested, ["a", "b"], "left_anti")
        chosen = offers.groupBy("id").agg(F.max(F.struct("m", "c"))["c"].alias("c"))
        pairs = tables.write(chosen.select(*_pair("id", "c")).distinct(), "pairs", few)
        more = judged(pairs)
        tested = tested.unionByName(pairs)
        if more.isEmpty():
            break
        tables.drop(open_)
        old, parts = parts, joined_parts(parts, more, tables, few)
        tables.drop(old)
    left = tables.write(open_.select("id", "l").distinct(), "left", few)
    tables.drop(open_, groups)
    across = _by_rare_shingles(tables, sets.join(_bits(light), "id"), left, threshold)
    more = judged(tables.write(across.join(tested, ["a", "b"], "left_anti"), "pairs", some))
    if not more.isEmpty():
        parts = joined_parts(parts, more, tables, few)
    tables.keep(sig, reps, parts)
    return parts


def _by_rare_shingles(tables: Tables, sets: DataFrame, left: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of the classes left (id, l) that differ in component and can reach the threshold.

    Two sets of similarity t share one of their rarest n - ceil(t n) + 1 shingles, in any
    order common to both; rare first keeps what all members have in common out of the keys.
    From the first shingle shared, what remains of the shorter rest must hold the intersection needed.
    """
    percent = round(threshold * 100)
    bits = [f"b{i}" for i in range(_LONGS)]
    shingles = sets.join(left, "id").select("id", "l", *bits, F.size("s").alias("n"), F.explode("s").alias("x"))
    df = shingles.groupBy("x").count()
    ranked = shingles.join(df, "x").groupBy("id", "l", "n", *bits).agg(F.array_sort(F.collect_list(F.struct("count", "x"))).alias("o"))
    prefix = ranked.select("id", "l", "n", *bits, F.posexplode(F.slice("o", 1, (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))).alias("p", "o"))
    keyed = tables.write(prefix.where("o.count > 1").select("id", "l", "n", "p", *bits, "o.x"), "prefixes")
    a, b = (keyed.select("x", F.col("id").alias(i), F.col("n").alias(f"n{i}"), F.col("l").alias(f"l{i}"), F.col("p").alias(f"p{i}"), *(F.col(c).alias(c + i) for c in bits)) for i in "ab")
    differ = " + ".join(f"bit_count({c}a ^ {c}b)" for c in bits)
    # half of the registers that differ have another lowest bit
    p = (1 - threshold) / 2
    most = f"{REGISTERS * p} + {ERRORS * REGISTERS * (p * (1 - p)) ** 0.5} / sqrt(least(na, nb, {REGISTERS}))"
    reach = f"{100 + percent} * least(na - pa, nb - pb) >= {percent} * (na + nb)"
    return a.join(b, "x").where(f"a < b and la <> lb and {reach} and {differ} <= {most}").select("a", "b").distinct()


_LONGS = -(-REGISTERS // 64)


def _bits(light: DataFrame) -> DataFrame:
    """(id, b0, b1, ...): one bit of each register, by which a join compares sketches as it goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reg = np.frombuffer(b"".join(b.column("reg").to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
            odd = np.zeros((len(reg), _LONGS * 64), dtype=np.uint8)
            odd[:, :REGISTERS] = _mix(reg.astype(np.uint64)) & np.uint64(1)
            packed = np.packbits(odd, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(np.ascontiguousarray(packed[:, i])) for i in range(_LONGS))], names=["id", *(f"b{i}" for i in range(_LONGS))])

    return light.select("id", "reg").mapInArrow(run, ", ".join(["id long", *(f"b{i} long" for i in range(_LONGS))]))


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(id, s): the shingle set of each document of docs (id, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, rows=256):
            sets = [shingle_set(h, size).view(np.int64) for h in _lists(b.column("h"))]
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))], names=["id", "s"])

    return _hashes(docs, "id", "t").mapInArrow(run, "id long, s array<long>")
