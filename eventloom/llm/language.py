"""Language identification as inference of a mixture.

A model holds, for each language, how likely each hashed letter trigram is.  For a
document, expectation-maximisation estimates the shares of the languages that its
trigrams were drawn from; the set of languages is the one of best penalised likelihood.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import need, others, positional, small_arrow
from .pieces import small_batches

#: Trigrams are hashed into this many buckets, whatever the corpus: the model's size is fixed for each language.
BUCKET_BITS = 15
#: A model of more languages than this is refused; at this bound it takes 128 MB.
MAX_LANGUAGES = 1000
#: Added to each bucket's count.
SMOOTHING = 0.5
ROUNDS, TOLERANCE = 30, 1e-4
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
#: Odd multipliers of the trigram hash; fixed values.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(i).isalpha() for i in range(0x10000)] + [True])
    return _letters


def trigram_counts(text: str) -> np.ndarray:
    """Counts by bucket of the trigrams around each letter; what isn't a letter counts as a space."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letter_table()[np.minimum(codes, 0x10000)]
    c = np.where(letter, codes, 32).astype(np.uint64)
    h = (c[:-2] * _MIX[0] + c[1:-1] * _MIX[1] + c[2:] * _MIX[2]) * _MIX[0] >> np.uint64(64 - BUCKET_BITS)
    return np.bincount(h[letter[1:-1]].astype(np.int64), minlength=1 << BUCKET_BITS)


@dataclass
class Model:
    languages: list[str]
    likelihood: np.ndarray  # languages x buckets

    def mixture(self, counts: np.ndarray) -> tuple[list[int], np.ndarray]:
        """The set of languages (their numbers) and their shares."""
        used = np.nonzero(counts)[0]
        n = counts[used].astype(np.float64)
        p = self.likelihood[:, used].astype(np.float64)
        single = np.log(p) @ n
        penalty = 0.5 * np.log(max(n.sum(), 2))
        best_value, best = single.max() - penalty, ([int(single.argmax())], np.ones(1))
        if len(p) == 1:
            return best
        shares, top = _em(p, n)
        if top - 2 * penalty <= best_value:  # no set of two or more can be better: top is the most any reaches
            return best
        order = np.argsort(-shares, kind="stable")
        for k in range(2, len(p) + 1):
            if top - k * penalty <= best_value:
                break
            chosen = np.sort(order[:k])
            own, value = _em(p[chosen], n)
            if value - k * penalty > best_value:
                best_value, best = value - k * penalty, ([int(i) for i in chosen], own)
        return best


def _em(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the rows of p that fit counts n best, and the log-likelihood."""
    shares, total = np.full(len(p), 1 / len(p)), n.sum()
    for _ in range(ROUNDS):
        mixed = shares @ p
        new = shares * (p @ (n / mixed)) / total
        moved = np.abs(new - shares).max()
        shares = new
        if moved < TOLERANCE:
            break
    return shares, float(np.log(shares @ p) @ n)


def held_out(doc_id: Column) -> Column:
    """One document in five, by the CRC of its id: never learned from.  A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from all rows with text and language.  Each task sums its counts before the shuffle.

    Only one row per language comes to the driver, one after the other, each of 2^BUCKET_BITS
    counts at most.  Without any such row the model has no language.
    """
    need(docs, text_col, lang_col)
    small_arrow(docs.sparkSession)
    frame, at = positional(docs)
    rows = frame.select(F.col(at[lang_col]).cast("string").alias("g"), F.col(at[text_col]).cast("string").alias("t")).where("g is not null and t is not null")
    if rows.select("g").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in small_batches(batches, rows=512):
            for g, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                c = trigram_counts(t)
                sums[g] = sums[g] + c if g in sums else c
        for g, c in sums.items():
            used = np.nonzero(c)[0]
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(c[used].astype(np.int64))], names=["g", "bucket", "n"])

    counts = rows.mapInArrow(count, "g string, bucket int, n long").groupBy("g", "bucket").agg(F.sum("n").alias("n")).groupBy("g").agg(F.collect_list(F.struct("bucket", "n")).alias("c"))
    found: dict[str, np.ndarray] = {}
    for r in counts.select("g", F.col("c.bucket").alias("b"), F.col("c.n").alias("n")).toLocalIterator():  # a row for each language
        found[r.g] = np.full(1 << BUCKET_BITS, SMOOTHING)
        found[r.g][np.array(r.b)] += np.array(r.n)
    languages = sorted(found)
    table = np.stack([found[g] for g in languages]) if languages else np.zeros((0, 1 << BUCKET_BITS))
    return Model(languages, (table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add lang_pred, score (its share), languages and shares (of the chosen set) to every row.

    Input columns of these names are replaced, in whatever case.  A null text, one without a letter, or a
    model without languages gives "und", score 0 and an empty set.  A text's time and memory are
    in proportion to its length; repeated rows get equal results; an empty table stays empty.  Ties go to the first
    name in order.  Nothing but the text is looked at.
    """
    need(docs, text_col)
    small_arrow(docs.sparkSession)
    new = ["lang_pred", "score", "languages", "shares"]
    frame, at = positional(docs)
    rest = others(at, *new)
    if text_col not in rest:
        raise ValueError(f"the text column may not be named {text_col}")
    base = frame.select(*rest.values())
    schema = T.StructType(list(base.schema.fields))
    for n, kind in zip(new, (T.StringType(), T.DoubleType(), T.ArrayType(T.StringType()), T.ArrayType(T.DoubleType()))):
        schema = schema.add(n, kind)

    def predict(text: str | None) -> tuple[str, float, list[str], list[float]]:
        if not text or not model.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, [], []
        counts = trigram_counts(text)
        if not counts.any():
            return UNKNOWN, 0.0, [], []
        chosen, shares = model.mixture(counts)
        top = int(shares.argmax())
        return model.languages[chosen[top]], float(min(1.0, shares[top])), [model.languages[i] for i in chosen], shares.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, rows=512):
            got = [predict(t) for t in b.column(at[text_col]).to_pylist()]
            kinds = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest.values()), *(pa.array([g[i] for g in got], k) for i, k in enumerate(kinds))], names=[*rest.values(), *new])

    return base.mapInArrow(run, schema).toDF(*rest, *new)
