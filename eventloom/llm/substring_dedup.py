"""Long repeats by recompression.

Every text becomes a sequence of word symbols and is compressed in rounds.  A round
names pairs: a fixed random bit of each symbol says whether it may begin or end a pair,
and each pair gets a name.  Equal neighbours never pair, so runs stay runs, and chains of
symbols name them; giving whole runs a name would let what stands outside a window decide on more of its inside.  Names are hashes of what
they stand for, so all tasks agree on them without an exchange, and equal stretches of
text get equal symbols but for a few at their ends.  Runs of symbols that stand in more
than one place are found by counting names; the windows around them are then checked
word for word, by two 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Tables, hash128, need, positional, small_arrow
from .near_dedup import _mix
from .pieces import small_batches

#: Rounds of recompression.  A symbol of round r covers at most 2^r words, long runs apart.
ROUNDS = 3
#: Symbols in an anchor; fewer where so many don't fit into the interior of a window.
CHAIN = 3
_M = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_P = (np.uint64(0x9E3779B97F4A7C15 * 3 % 2**64 | 1), np.uint64(0xC2B2AE3D27D4EB4F))
#: Bytes of text whose words are hashed at once.
STRETCH = 1 << 18


def interior(window: int) -> int:
    """Words in the middle of a repeated window that are sure to be named alike wherever it stands.

    In each round the symbol at either end may join a neighbour outside; those of round
    r cover at most 2^(r-1) words before they do.
    """
    return window - 2 * ((1 << ROUNDS) - 1)


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """A number for each byte, and which bytes are white space."""
    space = np.zeros(256, dtype=bool)
    space[[ord(c) for c in SPACE]] = True
    return _mix(np.arange(256, dtype=np.uint64) * _M[0] + _M[1]), space


_BYTE, _SPACE = _byte_tables()


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts (bytes one after the other, from at[i] to at[i + 1]), and where each text's words begin among them."""
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(at), dtype=np.int64)
    solid = ~_SPACE[data]
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[0], edge[-1] = solid[0], solid[-1]
    np.not_equal(solid[1:], solid[:-1], out=edge[1:-1])
    inner = at[(at > 0) & (at < len(data))]
    both = inner[solid[inner] & solid[inner - 1]]  # one text's last word and the next one's first stand side by side
    ends = np.sort(np.concatenate([np.nonzero(edge)[0], np.unique(both), np.unique(both)]))
    first, last = ends[::2], ends[1::2]
    out = np.empty(len(first), dtype=np.uint64)
    i = 0
    while i < len(first):
        j = max(i + 1, int(np.searchsorted(last, first[i] + STRETCH, side="right")))
        start, stop = int(first[i]), int(last[j - 1])
        up, down = _powers(int(_P[1]), stop - start + 1)
        total = np.zeros(stop - start + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[start:stop]] * up[:-1], dtype=np.uint64, out=total[1:])
        a, b = first[i:j] - start, last[i:j] - start
        out[i:j] = _mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64) * _M[0])
        i = j
    return out, np.searchsorted(first, at, side="left")


def _words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """`word_hashes` of a column of strings without nulls."""
    wide = pa.types.is_large_string(column.type)
    at = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8)[at[0] : at[-1]] if held is not None and at[-1] > at[0] else np.zeros(0, dtype=np.uint8)
    return word_hashes(data, at - at[0])


def _rows(at: np.ndarray) -> np.ndarray:
    """The number of the text of each word."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))


def _pairs(sym: np.ndarray, start: np.ndarray, row: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name the pairs of one round: a symbol that may begin one followed by one that may end one, of the same text."""
    bit = (_mix(sym + np.uint64(int(_M[1]) * (2 * r + 1) % 2**64)) & np.uint64(1)).astype(bool)
    first = np.zeros(len(sym), dtype=bool)
    first[:-1] = bit[:-1] & ~bit[1:] & (row[:-1] == row[1:])
    named = sym.copy()
    at = np.nonzero(first)[0]
    named[at] = _mix(_mix(sym[at] * _M[0] + np.uint64(r + 1)) + sym[at + 1] * _M[1])
    keep = np.ones(len(sym), dtype=bool)
    keep[at + 1] = False
    return named[keep], start[keep], row[keep]


def recompress(hashes: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after all rounds, the first word of each, and its text; `at`: where each text's words begin, one text if not given."""
    row = _rows(np.array([0, len(hashes)]) if at is None else at)
    sym, start = _mix(hashes.view(np.uint64) + _M[0]), np.arange(len(hashes))
    for r in range(ROUNDS):
        sym, start, row = _pairs(sym, start, row, r)
    return sym, start, row


def anchors(hashes: np.ndarray, window: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, first words, ends) of the chosen chains of CHAIN symbols.

    From each symbol on, of the chains that lie within the interior's length the one of
    least name is chosen; if none does, the longest shorter chain from there that does.  A
    single symbol always fits, so any repeated window holds a chosen chain in both its places.
    """
    at = np.array([0, len(hashes)]) if at is None else at
    sym, start, row = recompress(hashes, at)
    none = np.zeros(0, dtype=np.int64)
    long_enough = (np.diff(at) >= window)[row]
    if not long_enough.any():
        return none.view(np.uint64), none, none
    size = interior(window)
    ends = np.append(start[1:], len(hashes))  # texts follow each other without a gap
    most = np.minimum(start + size, at[row + 1])  # no chain goes beyond this
    found = [_least_chains(sym, start, ends, most, long_enough)]
    # starts with a whole interior after them but no chain of CHAIN symbols in it
    fits = np.zeros(len(sym), dtype=bool)
    if len(sym) >= CHAIN:
        fits[: len(sym) - CHAIN + 1] = ends[CHAIN - 1 :] <= most[: len(sym) - CHAIN + 1]
    left = np.nonzero(~fits & (most == start + size) & long_enough)[0]
    for c in range(CHAIN - 1, 0, -1):
        if not len(left):
            break
        last = left + c - 1
        ok = (last < len(sym)) & (ends[np.minimum(last, len(sym) - 1)] <= most[left])
        i = left[ok]
        name = sym[i]
        for j in range(1, c):
            name = _mix(name * _M[0] + sym[i + j])
        found.append((_mix(name + np.uint64(c)), start[i], ends[i + c - 1]))
        left = left[~ok]
    return tuple(np.concatenate(x) for x in zip(*found))


def _least_chains(sym: np.ndarray, start: np.ndarray, ends: np.ndarray, most: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the chains of CHAIN symbols from each wanted symbol on that end by its `most` the one of least name."""
    k = len(sym) - CHAIN + 1
    none = np.zeros(0, dtype=np.int64)
    if k < 1:
        return none.view(np.uint64), none, none
    name = sym[:k]
    for j in range(1, CHAIN):
        name = _mix(name * _M[0] + sym[j : j + k])
    first, last = start[:k], ends[CHAIN - 1 :]
    width = np.searchsorted(last, most[:k], side="right") - np.arange(k)  # ends grow
    ok = np.nonzero((width > 0) & wanted[:k])[0]
    if not len(ok):
        return none.view(np.uint64), none, none
    # least name in ranges, by doubling
    level, steps = [np.arange(k)], int(width[ok].max()).bit_length()
    for s in range(steps - 1):
        half = 1 << s
        prev = level[-1]
        nxt = prev.copy()
        right = prev[half:]
        better = name[right] < name[prev[: len(right)]]
        nxt[: len(right)][better] = right[better]
        level.append(nxt)
    w = width[ok]
    p = np.floor(np.log2(w)).astype(np.int64)
    table = np.stack(level)
    x, y = table[p, ok], table[p, ok + w - (1 << p)]
    chosen = np.unique(np.where(name[y] < name[x], y, x))
    return name[chosen], first[chosen], last[chosen]


_powers_of: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(m: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of an odd number and of its inverse, modulo 2^64."""
    have = _powers_of.get(m)
    if have is None or len(have[0]) < n:
        size = max(1 << 12, 1 << n.bit_length())
        one = np.ones(1, dtype=np.uint64)
        have = tuple(np.concatenate([one, np.cumprod(np.full(size - 1, x, dtype=np.uint64))]) for x in (m, pow(m, -1, 2**64)))
        _powers_of[m] = have
    return have[0][:n], have[1][:n]


def _rolling(h: np.ndarray, window: int, m: int) -> np.ndarray:
    """The polynomial in m of each window of hashes, as a difference of running sums."""
    up, down = _powers(m, len(h))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_mix(h + np.uint64(m)) * up, dtype=np.uint64)])
    return _mix((total[window:] - total[:-window]) * down[: len(h) - window + 1])


def window_hashes(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each window of words: polynomials of the words' hashes, modulo 2^64."""
    h = hashes.view(np.uint64)
    return _rolling(h, window, int(_P[0])), _rolling(h, window, int(_P[1]))


def _among(row: np.ndarray, value: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which values are in the list of their row."""
    at = lists.offsets.to_numpy()
    have = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)[at[0] : at[-1]]
    key = lambda r, v: _mix(v + _mix(r.astype(np.uint64) * _M[1] + _M[0]))
    return np.isin(key(row, value), key(np.repeat(np.arange(len(lists)), np.diff(at)), have))


def _spread(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the ranges a to b."""
    mark = np.zeros(n + 1, dtype=np.int32)
    np.add.at(mark, a, 1)
    np.add.at(mark, b, -1)
    return np.cumsum(mark[:-1]) > 0


def candidates(hashes: np.ndarray, at: np.ndarray, repeated: pa.Array, window: int) -> np.ndarray:
    """Starts of the windows that hold a chain whose name is in their text's list of repeated ones whole."""
    names, first, ends = anchors(hashes, window, at)
    row = np.searchsorted(at, first, side="right") - 1
    hit = _among(row, names, repeated)
    row, first, ends = row[hit], first[hit], ends[hit]
    a, b = np.maximum(at[row], ends - window), np.minimum(at[row + 1] - window, first) + 1
    ok = a < b
    return np.nonzero(_spread(a[ok], b[ok], len(hashes)))[0]


def covered(hashes: np.ndarray, at: np.ndarray, repeated: pa.Array, window: int) -> np.ndarray:
    """Which words lie in a window whose first hash is in their text's list of repeated ones."""
    if len(hashes) < window:
        return np.zeros(len(hashes), dtype=bool)
    row = _rows(at)
    start = np.nonzero(row[: len(hashes) - window + 1] == row[window - 1 :])[0]  # windows of one text
    x = _rolling(hashes, window, int(_P[0]))[start]
    start = start[_among(row[start], x, repeated)]
    return _spread(start, start + window, len(hashes))


def _counted(ids: pa.Array, row: np.ndarray, cols: list[np.ndarray], extra: np.ndarray | None, names: list[str]) -> pa.RecordBatch | None:
    """One batch of (k, the columns, n): different rows of (row, first column), and how often they stand there, with each text's extra."""
    if not len(row):
        return None
    order = np.lexsort((cols[0], row))
    r, c = row[order], cols[0][order]
    new = np.append(True, (r[1:] != r[:-1]) | (c[1:] != c[:-1]))
    at = np.nonzero(new)[0]
    n = np.diff(np.append(at, len(r)))
    r = r[at]
    n = n if extra is None else n + extra[r]
    kept = [pa.array(x[order[at]].view(np.int64)) for x in cols]
    return pa.RecordBatch.from_arrays([ids.take(pa.array(r)), *kept, pa.array(n.astype(np.int32))], names=["k", *names, "n"])


def _anchor_rows(base: DataFrame, window: int) -> DataFrame:
    """(k, name, n): the names of each row's anchors and how often it has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, rows=512):
            h, at = _words_of(b.column("t"))
            name, first, _ = anchors(h, window, at)
            if (out := _counted(b.column("k"), np.searchsorted(at, first, side="right") - 1, [name], None, ["name"])) is not None:
                yield out

    return base.select("k", "t").mapInArrow(run, "k long, name long, n int")


def _window_rows(marked: DataFrame, window: int) -> DataFrame:
    """(k, h1, h2, n): hashes of the candidate windows of rows (k, t, names), with their counts, one more for texts with copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, rows=512):
            h, at = _words_of(b.column("t"))
            start = candidates(h, at, b.column("names"), window)
            if not len(start):
                continue
            x, y = window_hashes(h, window)
            copied = b.column("copied").to_numpy(zero_copy_only=False).astype(np.int64)
            if (out := _counted(b.column("k"), np.searchsorted(at, start, side="right") - 1, [x[start], y[start]], copied, ["h1", "h2"])) is not None:
                yield out

    return marked.select("k", "t", "names", F.col("copied").cast("int").alias("copied")).mapInArrow(run, "k long, h1 long, h2 long, n int")


def _kept_words(joined: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, n_removed, text): what stays of each text (id, t, hits, copied)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, rows=512):
            h, at = _words_of(b.column("t"))
            gone = covered(h, at, b.column("hits"), window)
            copied = b.column("copied").to_numpy(zero_copy_only=False)
            gone |= (copied & (np.diff(at) >= window))[_rows(at)]
            total = np.concatenate([[0], np.cumsum(gone)])
            removed = total[at[1:]] - total[at[:-1]]
            text: list[bytes] = []
            for i, t in enumerate(b.column("t")):
                own = t.as_buffer().to_pybytes().split()
                if removed[i]:
                    own = [w for w, g in zip(own, gone[at[i] : at[i + 1]].tolist()) if not g]
                text.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.diff(at)), pa.array(removed.astype(np.int64)), pa.array(text, pa.string())], names=["doc_id", "n_words", "n_removed", "text"])

    id_type = joined.schema["id"].dataType.simpleString()
    return joined.select("id", "t", "hits", "copied").mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, text string")


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, text (the kept words, joined by one space).

    A word goes if a window of `window` words that covers it has a word sequence that
    also starts anywhere else, in any row or the same one.  A null, empty or shorter text loses
    nothing; rows of equal text are repeats of each other, whatever their ids; null ids
    are allowed; an empty table stays empty; other columns play no part, whatever their names.  `window`
    must leave room for a symbol of any size in its interior.  A very long text costs time and
    memory in proportion to its length, in the one task that holds it.

    Rows are keyed by a hash of their text.  Should two texts share it, both are still
    judged by their own windows.  Windows of texts with exact copies are known to repeat and
    are counted once for the class.  Names and window hashes of one passage in many
    documents are summed on the map side, and joined by Spark, which splits hot keys.
    Each step's table is made once, and deleted when the next one is there.
    """
    need(docs, id_col, text_col)
    if interior(window) < 1 << ROUNDS:
        raise ValueError("the window is too short for this many rounds")
    small_arrow(docs.sparkSession)
    tables = Tables(docs.sparkSession)
    docs, at = positional(docs)
    text = F.coalesce(F.col(at[text_col]).cast("string"), F.lit(""))
    k, k2 = hash128(text)
    base = docs.select(F.col(at[id_col]).alias("id"), text.alias("t"), k.alias("k"))

    found = tables.write(_anchor_rows(base, window), "anchors")
    repeated = found.groupBy("name").agg(F.sum("n").alias("m")).where("m > 1").select("name")
    names = tables.write(found.join(repeated, "name", "left_semi").groupBy("k").agg(F.collect_set("name").alias("names")), "names")
    tables.drop(found)

    copies = docs.select(F.col(at[id_col]).alias("id"), k.alias("k"), k2.alias("k2")).groupBy("k").agg(F.count("*").alias("c"), F.min("id").alias("first"), F.min("k2").alias("x"), F.max("k2").alias("y"))
    copies = tables.write(copies.where("c > 1 and x = y").select("k", "first"), "copies")
    known = copies.select("k", "first", F.lit(True).alias("copied"))

    marks = names.join(known, "k", "left").select("k", "names", "first", F.coalesce("copied", F.lit(False)).alias("copied"))
    marked = base.join(marks, "k").where("not copied or first is null or id = first")
    windows = tables.write(_window_rows(marked, window), "windows")
    tables.drop(names)
    twice = tables.write(windows.groupBy("h1", "h2").agg(F.sum("n").alias("m")).where("m > 1").select("h1", "h2"), "twice")
    hits = tables.write(windows.join(known.select("k"), "k", "left_anti").join(twice, ["h1", "h2"], "left_semi").groupBy("k").agg(F.collect_set("h1").alias("hits")), "hits")
    tables.drop(windows, twice)
    joined = base.join(hits, "k", "left").join(known.select("k", "copied"), "k", "left")
    none = F.array().cast("array<bigint>")
    return _kept_words(joined.select("id", "t", F.coalesce("hits", none).alias("hits"), F.coalesce("copied", F.lit(False)).alias("copied")), window)
