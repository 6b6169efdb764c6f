"""SentencePiece BPE by a table of last tokens.

For every prefix of a text the BPE encoding ends in one certain token.  The table of
these tokens is filled from left to right: an automaton gives the pieces that end at a
place, and the right one is the piece that BPE keeps apart from the last token before
it.  The ids are then read off backwards.  Time is linear in the text, however long its
words are; the usual merge loop isn't needed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import need, others, positional, small_arrow
from .pieces import PieceCache, id_lists, small_batches

_MARK = "▁"
#: Pairs of tokens whose compatibility a worker remembers.
_PAIRS = 250_000


def merge_loop(symbols: list[str], rank: dict[str, float]) -> list[str]:
    """BPE as defined: merge the adjacent pair of best rank, the leftmost of equals, until none is known."""
    n = len(symbols)
    text, left, right = list(symbols), list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[float, int, int, str]] = []

    def offer(i: int, j: int) -> None:
        if i >= 0 and j >= 0 and (r := rank.get(whole := text[i] + text[j])) is not None:
            heapq.heappush(heap, (r, i, j, whole))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, i, j, whole = heapq.heappop(heap)
        if not text[i] or not text[j] or right[i] != j or text[i] + text[j] != whole:
            continue
        text[i], text[j] = whole, ""
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        offer(left[i], i)
        offer(i, right[i])
    return [t for t in text if t]


class PieceBpe:
    """Encoder of a BPE model with byte fallback and identity normalisation."""

    def __init__(self, model_path: str) -> None:
        import ahocorasick
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb2

        model = pb2.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        if spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback and identity normalisation are supported")
        self.processor = SentencePieceProcessor(model_file=model_path)
        self.dummy = norm.add_dummy_prefix
        plain = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type in (1, 4, 5)}
        if any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.byte = {model.pieces[i].piece: i for i in range(len(model.pieces)) if model.pieces[i].type == 6}
        self.byte_ids = [self.byte[f"<0x{b:02X}>"] for b in range(256)]
        self.id_of = {p: i for p, (i, _) in plain.items()}
        self.piece_of = {i: p for p, i in self.id_of.items()}
        self.rank = {p: -s for p, (_, s) in plain.items()}
        #: Pieces of several marks alone share one rank; they merge last, as a run apart from the rest.
        runs = {p for p in plain if len(p) > 1 and not p.strip(_MARK)}
        if any(_MARK in p[1:] for p in plain if p not in runs):
            raise ValueError("pieces with a space inside are not supported")
        body = {p: r for p, r in self.rank.items() if p not in runs}
        if runs and max((r for p, r in body.items() if len(p) > 1), default=0) >= min(self.rank[p] for p in runs):
            raise ValueError("runs of spaces must have the lowest rank")
        if len({r for p, r in body.items() if len(p) > 1}) != sum(len(p) > 1 for p in body):
            raise ValueError("ranks must differ")
        self.body = body
        self.run_rank = {p: self.rank[p] for p in runs}
        self.automaton = ahocorasick.Automaton()
        for p in body:
            if len(p) == 1 or merge_loop(list(p), body) == [p]:
                self.automaton.add_word(p, (self.id_of[p], len(p)))
        self.automaton.make_automaton()
        self.known = {p for p in body if len(p) == 1}
        self.pairs: dict[int, bool] = {}

    def apart(self, a: int, b: int) -> bool:
        """Does BPE, on the text of a followed by that of b, end in just these two tokens?"""
        key = a * 1_000_003 + b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= _PAIRS:
                self.pairs.clear()
            x, y = self.piece_of[a], self.piece_of[b]
            got = self.pairs[key] = merge_loop(list(x + y), self.body) == [x, y]
        return got

    def table(self, s: str) -> list[int]:
        """The last token of each prefix of s, whose characters are all known."""
        last = [-1] * len(s)
        known = self.pairs.get
        for end, (token, n) in self.automaton.iter(s):
            if last[end] < 0:
                before = end - n
                if before < 0:
                    last[end] = token
                    continue
                fits = known(last[before] * 1_000_003 + token)
                if self.apart(last[before], token) if fits is None else fits:
                    last[end] = token
        return last

    def known_part(self, s: str) -> list[int]:
        last, at, out, piece_of = self.table(s), len(s) - 1, [], self.piece_of
        while at >= 0:
            out.append(last[at])
            at -= len(piece_of[last[at]])
        return out[::-1]

    def segment(self, s: str) -> list[int]:
        """Ids of marks followed by text without marks."""
        rest = s.lstrip(_MARK)
        marks = len(s) - len(rest)
        head = _MARK if marks else ""
        ids: list[int] = []
        part = head
        if self.known.issuperset(rest):
            part, rest = s[-len(rest) - 1 :] if marks else rest, ""
        for ch in rest:
            if ch in self.known:
                part += ch
                continue
            if part:
                ids += self.known_part(part)
                part = ""
            ids += [self.byte_ids[b] for b in ch.encode("utf-8", "surrogatepass")]
        if part:
            ids += self.known_part(part)
        if marks > 1:
            alone = bool(ids) and ids[0] == self.id_of[_MARK]
            run = merge_loop([_MARK] * (marks - 1 + alone), self.run_rank)
            ids = [self.id_of[p] for p in run] + ids[alone:]
        return ids

    def pieces(self, text: str) -> list[str]:
        """Cut a text before each mark that follows other text: no token reaches across."""
        if not text:
            return []
        t = text.replace(_MARK, " ")
        parts = t.split(" ")
        if not self.dummy:
            raise ValueError("models without a dummy prefix are not supported")
        if "" not in parts:
            return parts
        out, marks = [], 1
        for p in parts:
            if p:
                out.append(p if marks == 1 else _MARK * marks + p)
                marks = 1
            else:
                marks += 1
        if marks > 1:
            out.append(_MARK * (marks - 1) if marks > 2 else _MARK)
        return out

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        return [np.array(self.segment(p if p[0] == _MARK else _MARK + p), dtype="<i4").tobytes() for p in pieces]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.encode_pieces(self.pieces(text))), dtype="<i4").tolist()


_encoders: dict[str, tuple[PieceBpe, PieceCache]] = {}


def _encoder(path: str) -> tuple[PieceBpe, PieceCache]:
    if path not in _encoders:
        bpe = PieceBpe(path)
        _encoders[path] = bpe, PieceCache(bpe.encode_pieces)
    return _encoders[path]


def encode_decode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """Add `ids` (array<int>, as the model's encoder without begin or end ids) and `decoded` (of these ids) to every row.

    Input columns of these names are replaced, in whatever case.  A null or empty text has no ids and
    decodes to "".  Time is linear in a text's length, however long it or its words are.  Rows are handled one by one: repeated rows get equal results, an
    empty table stays empty.  The model file must be at `model_path` on each executor.
    """
    need(docs, text_col)
    small_arrow(docs.sparkSession)
    frame, at = positional(docs)
    rest = others(at, "ids", "decoded")
    base = frame.select(*rest.values(), F.coalesce(F.col(at[text_col]).cast("string"), F.lit("")).alias("__el_text"))
    schema = base.drop("__el_text").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = _encoder(model_path)
        for b in small_batches(batches):
            parts = [cache.join(bpe.pieces(t)) for t in b.column("__el_text").to_pylist()]
            decoded = bpe.processor.decode([np.frombuffer(p, dtype="<i4").tolist() for p in parts], num_threads=1)
            kept = [b.column(c) for c in rest.values()]
            yield pa.RecordBatch.from_arrays([*kept, id_lists(parts), pa.array(decoded, pa.string())], names=[*rest.values(), "ids", "decoded"])

    return base.mapInArrow(run, schema).toDF(*rest, "ids", "decoded")
