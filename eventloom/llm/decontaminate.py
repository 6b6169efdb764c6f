"""Benchmark decontamination: every training passage asks a BM25 index of the test items.

The index is inverted, with the largest impact of each term in each block of items.
A passage is scored against an item only if the sum of its terms' largest impacts
reaches the threshold, first over all items, then over the item's block; so all items
above the threshold are found, and few are scored.  Blocks are ranges of items, alike for
all terms, and the blocks that stay alive are found for all terms and passages at once, as
vectors; that takes the place of WAND's pointers, which move term by term.  A hit counts if it covers the
item's question and answer word for word; a short answer may have a word changed.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, need, others, positional, small_arrow
from .pieces import small_batches

K1, B = 1.2, 0.75
#: Share of an item's own BM25 score that a passage must reach.
THRESHOLD = 0.6
#: Share of the n-grams of question and of answer that the passage must hold.
OVERLAP = 0.6
GRAM = 3
#: An answer of fewer words has too few n-grams for a share; its words are looked for where it should stand.
SHORT_ANSWER = 8
#: Share of a short answer's words that must stand there, and words that may have come between.
SHORT_OVERLAP, SHORT_SLACK = 0.5, 2
#: A passage is this many words; passages begin every PASSAGE / 2 words, and items are
#: indexed in parts of at most PASSAGE / 2 words, so each part lies whole in a passage.
#: Parts of longer items only find candidates: the whole item is held against the passages around.
PASSAGE = 128
BLOCK_ITEMS = 8
#: Up to this many entries the bounds of all terms in all blocks are also kept as one dense table.
DENSE_BOUNDS = 16_000_000
#: Characters of test items in one index; more are taken in several passes.
INDEX_CHARS = 32_000_000
_MARKS = "".join(c for c in map(chr, range(0x300, 0x10000)) if unicodedata.category(c).startswith("M"))
_WORD = re.compile(rf"[\w{_MARKS}]+")


def words(text: str) -> list[str]:
    """Lower-case runs of letters, marks and digits, whatever else stands around or between them."""
    return _WORD.findall(text.lower().replace("_", " "))


def _grams(w: list[str]) -> set[tuple[str, ...]]:
    n = min(GRAM, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def _held(w: list[str]) -> dict[int, set[tuple[str, ...]]]:
    """All n-grams of a passage, by n."""
    return {n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for n in range(1, GRAM + 1)}


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence is the answer, what precedes it the question; a single sentence is a question alone."""
    ends = [i + 1 for i, ch in enumerate(text) if ch in ".?!\n" and text[i + 1 :].strip()]
    cut = ends[-1] if ends else len(text)
    q, a = words(text[:cut]), words(text[cut:])
    return (q, a) if q else (a, [])


def _cuts(n: int) -> list[int]:
    """Where the parts of an item of n words begin, and its end: parts are of like size, none of a word or two."""
    parts = -(-n // (PASSAGE // 2))
    return [k * n // parts for k in range(parts + 1)] if n else []


def _short_share(q: list[str], a: list[str], passage: list[str]) -> float:
    """Share of a short answer's words that stand where the question's n-grams in the passage say the answer is.

    Its last word may have letters glued to it.
    """
    n = min(GRAM, len(q))
    place: dict[tuple[str, ...], list[int]] = {}
    for i in range(len(q) - n + 1):
        place.setdefault(tuple(q[i : i + n]), []).append(i)
    starts = {p + len(q) - i for p in range(len(passage) - n + 1) for i in place.get(tuple(passage[p : p + n]), ())}
    best = 0
    for s in starts:
        there, last = Counter(passage[s : s + len(a) + SHORT_SLACK]), s + len(a) - 1
        held = sum((there & Counter(a)).values())
        if last < len(passage) and passage[last] != a[-1] and passage[last].startswith(a[-1]) and not there[a[-1]]:
            held += 1
        best = max(best, held)
    return best / len(a)


class Index:
    """Inverted index of parts of test items, impacts scaled so that the own score of a part, and of an item, is 1."""

    def __init__(self, items: list[tuple[int, str]], counts: tuple[int, int, dict[str, int]] | None = None) -> None:
        """`counts`: parts, words in them, and parts by word, of all items if these are not all."""
        #: Items: id, question, answer, their n-grams, and for those of several parts the impacts of the item's words.
        self.items: list[tuple[int, list[str], list[str], set, set, dict[str, float] | None]] = []
        #: Parts: place in items, words of the item before and after the part.
        self.parts: list[tuple[int, int, int]] = []
        bags: list[Counter] = []
        for item, text in items:
            q, a = question_answer(text or "")
            whole = q + a
            cuts = _cuts(len(whole))
            for at, end in zip(cuts, cuts[1:]):
                self.parts.append((len(self.items), at, len(whole) - end))
                bags.append(Counter(whole[at:end]))
            self.items.append((item, q, a, _grams(q), _grams(a), {} if len(cuts) > 2 else None))
        order = sorted(range(len(bags)), key=lambda i: (sorted(bags[i], key=lambda w: (-bags[i][w], w))[:1], i))  # likeness within blocks
        self.parts, bags = [self.parts[i] for i in order], [bags[i] for i in order]
        df = Counter(w for b in bags for w in b)
        self.term = {w: i for i, w in enumerate(sorted(df))}
        n_parts, n_words = len(bags), sum(sum(b.values()) for b in bags)
        if counts is not None:
            n_parts, n_words, df = counts
        mean = n_words / max(1, n_parts)
        rows: list[list[tuple[int, float]]] = [[] for _ in self.term]

        def impacts(b: Counter) -> dict[str, float]:
            size = sum(b.values())
            own = {w: math.log(1 + (n_parts - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * size / mean)) for w, n in b.items()}
            total = sum(own.values())
            return {w: x / total for w, x in own.items()}

        for i, b in enumerate(bags):
            for w, x in impacts(b).items():
                rows[self.term[w]].append((i, x))
        for _, q, a, _, _, own in self.items:
            if own is not None:
                own.update(impacts(Counter(q + a)))
        self.start = np.cumsum([0, *map(len, rows)])
        self.item = np.array([i for r in rows for i, _ in r], dtype=np.int64)
        self.impact = np.array([x for r in rows for _, x in r])
        self.blocks = -(-len(bags) // BLOCK_ITEMS)
        # the last row of both tables is for words that no item has
        self.most = np.zeros(len(rows) + 1)
        bound: list[tuple[int, int, float]] = []
        for t, r in enumerate(rows):
            own_blocks: dict[int, float] = {}
            for i, x in r:
                own_blocks[i // BLOCK_ITEMS] = max(own_blocks.get(i // BLOCK_ITEMS, 0.0), x)
            self.most[t] = max(own_blocks.values())
            bound += [(t, k, x) for k, x in own_blocks.items()]
        self.block_start = np.searchsorted(np.array([t for t, _, _ in bound], dtype=np.int64), np.arange(len(rows) + 1))
        self.block = np.array([k for _, k, _ in bound], dtype=np.int64)
        self.block_most = np.array([x for _, _, x in bound])
        self.dense: np.ndarray | None = None
        if len(self.most) * self.blocks <= DENSE_BOUNDS:
            self.dense = np.zeros((len(self.most), self.blocks), dtype=np.float32)
            for t, k, x in bound:
                self.dense[t, k] = x

    @staticmethod
    def _postings(start: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Places of the postings of the terms."""
        n = start[terms + 1] - start[terms]
        return np.repeat(start[terms] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())

    def search(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """All parts whose score for these distinct terms is at least the threshold."""
        at = self._postings(self.block_start, terms)
        bounds = np.bincount(self.block[at], weights=self.block_most[at], minlength=self.blocks)
        alive = bounds >= threshold - 1e-9
        if not alive.any():
            return []
        at = self._postings(self.start, terms)
        at = at[alive[self.item[at] // BLOCK_ITEMS]]
        scores = np.bincount(self.item[at], weights=self.impact[at], minlength=len(self.parts))
        return [(int(i), float(scores[i])) for i in np.nonzero(scores >= threshold - 1e-9)[0]]

    def leaks(self, text: str, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[dict]:
        """Items that a text gives away: best score, and shares of question and answer found, by item in order."""
        if not self.term:
            return []
        w = words(text)
        get, other = self.term.get, len(self.most) - 1
        ids = np.fromiter((get(x, other) for x in w), dtype=np.int32, count=len(w))
        half = PASSAGE // 2
        n = max(1, -(-len(ids) // half) - 1)
        rows = np.full((n + 1) * half, other, dtype=np.int32)
        rows[: len(ids)] = ids
        rows = np.sort(np.lib.stride_tricks.sliding_window_view(rows, PASSAGE)[::half], axis=1)
        rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = other
        found: dict[int, dict] = {}
        seen: set[tuple[int, int, int]] = set()
        likely = np.nonzero(self.most[rows].sum(axis=1) >= threshold - 1e-9)[0]
        if self.dense is not None and len(likely):
            bounds = [self.dense[rows[part]].sum(axis=1).max(axis=1) for part in np.array_split(likely, -(-len(likely) // 64))]
            likely = likely[np.concatenate(bounds) >= threshold - 1e-4]
        for k in likely.tolist():
            terms = rows[k]
            hits = self.search(terms[terms != other], threshold)
            if not hits:
                continue
            near = w[k * half : k * half + PASSAGE]
            near_grams = _held(near)
            for i, score in hits:
                at, before, after = self.parts[i]
                item, q, a, q_grams, a_grams, impacts = self.items[at]
                own, held = near, near_grams
                if impacts is not None:
                    span = (at, max(0, k * half - before - half), k * half + PASSAGE + after + half)
                    if span in seen:
                        continue
                    seen.add(span)
                    own = w[span[1] : span[2]]
                    score = sum(impacts.get(x, 0.0) for x in set(own))
                    if score < threshold - 1e-9:
                        continue
                    held = _held(own)
                share = [len(g & held[len(next(iter(g)))]) / len(g) if g else 1.0 for g in (q_grams, a_grams)]
                enough = share[1] >= overlap
                if share[0] >= overlap and not enough and q and len(a) < SHORT_ANSWER:
                    short = _short_share(q, a, own)
                    enough, share[1] = short >= min(overlap, SHORT_OVERLAP), max(share[1], short)
                if share[0] >= overlap and enough:
                    best = found.setdefault(item, {"item_id": item, "score": 0.0, "question": 0.0, "answer": 0.0})
                    for name, v in zip(("score", "question", "answer"), (score, *share)):
                        best[name] = max(best[name], v)
        return [found[i] for i in sorted(found)]


_LEAK = T.StructType().add("item_id", T.LongType()).add("score", T.DoubleType()).add("question", T.DoubleType()).add("answer", T.DoubleType())
_ARROW_LEAK = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())]))


def find_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """Add `leaks`, array<struct(item_id, score, question, answer)>, to every row of docs; empty for clean rows.

    An input column of that name is replaced, in whatever case.  Null or empty texts leak nothing; very
    long ones are looked at passage by passage; repeated rows get equal results; items
    without words are never found; repeated items are found under each id; no items, no
    leaks.  Documents aren't shuffled.  The items go to every task as an index: their
    text is measured first, and beyond INDEX_CHARS characters (of all items, ids by hash)
    they are taken in several passes over the documents, each with an index of bounded size.
    What a word weighs is counted over all items, so the number of passes changes no result.
    """
    need(docs, text_col)
    need(items, item_col, item_text_col)
    own, place = positional(items)
    slim = own.select(F.col(place[item_col]).cast("long").alias("i"), F.col(place[item_text_col]).cast("string").alias("t")).where("i is not null and t is not null")
    size = slim.agg(F.sum(F.length("t"))).first()[0] or 0
    passes = -(-size // INDEX_CHARS) or 1
    small_arrow(docs.sparkSession)
    frame, at = positional(docs)
    rest = others(at, "leaks")
    if text_col not in rest:
        raise ValueError(f"the text column may not be named {text_col}")
    out = frame.select(*rest.values())
    schema = T.StructType([*out.schema.fields, T.StructField("leaks", T.ArrayType(_LEAK))])
    slim = slim.withColumn("pass", F.pmod(F.xxhash64("i"), F.lit(passes)))
    counted = materialize(slim.select("pass", "t").mapInArrow(_count_parts, "pass long, w string, n long").groupBy("pass", "w").agg(F.sum("n").alias("n")), "words") if passes > 1 else None
    for k in range(passes):
        counts = None
        if counted is not None:
            own = counted.where(F.col("pass") == k).select("w")
            totals = {r.w: int(r.n) for r in counted.join(own, "w", "left_semi").groupBy("w").agg(F.sum("n").alias("n")).collect()}
            whole = {r.w: int(r.n) for r in counted.where("w in (' parts', ' words')").groupBy("w").agg(F.sum("n").alias("n")).collect()}
            counts = (whole.get(" parts", 0), whole.get(" words", 0), totals)
        index = Index(sorted((r.i, r.t) for r in slim.where(F.col("pass") == k).select("i", "t").collect()), counts)
        out = out.mapInArrow(_scan(index, list(rest.values()), at[text_col], threshold, overlap), schema)
    return out.toDF(*rest, "leaks")


def _count_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pass, word, parts that have it); all parts and their words under two names that no word has."""
    for b in small_batches(batches, rows=512):
        n: Counter = Counter()
        for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            q, a = question_answer(t)
            whole = q + a
            cuts = _cuts(len(whole))
            n[k, " parts"] += max(0, len(cuts) - 1)
            n[k, " words"] += len(whole)
            n.update((k, w) for at, end in zip(cuts, cuts[1:]) for w in set(whole[at:end]))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in n], pa.int64()), pa.array([w for _, w in n], pa.string()), pa.array(list(n.values()), pa.int64())], names=["pass", "w", "n"])


def _scan(index: Index, rest: list[str], text_col: str, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, rows=512):
            got = [index.leaks(t, threshold, overlap) if t else [] for t in b.column(text_col).to_pylist()]
            if "leaks" in b.schema.names:
                got = [sorted((was or []) + new, key=lambda x: x["item_id"]) for was, new in zip(b.column("leaks").to_pylist(), got)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(got, _ARROW_LEAK)], names=[*rest, "leaks"])

    return run
