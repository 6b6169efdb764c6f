"""Token ids in a compact binary form: blocks cut into planes, each plane compressed.

A shard holds the ids of consecutive documents.  Blocks of `block_ids` ids are
transposed into byte planes (all lowest bytes, then all second bytes, ...) or bit
planes, and each plane that isn't all zero is compressed with zstandard.  An index at
the end has the place of each plane of each block, so that any range of ids is read
without the rest.

Layout, little-endian:
  magic "EVTS", version u8, plane kind u8 (0: bytes, 1: bits), reserved u16,
  compressed planes, one block after the other,
  document table: n_docs x (n_tokens u32),
  block index: n_blocks x (n_ids u32, offset u64, planes x length u32),
  footer: block_ids u32, planes u32, n_blocks u32, n_docs u32, n_ids u64, table offset u64, magic.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash128, materialize, need, positional, small_arrow
from .pieces import PieceCache, small_batches

MAGIC, VERSION = b"EVTS", 1
_HEAD, _FOOT = struct.Struct("<4sBBH"), struct.Struct("<IIIIQQ4s")
BLOCK_IDS = 1 << 16
#: Ids after which a shard is closed; one document more may go beyond it.
SHARD_IDS = 1 << 20
_BITS = 32


def _to_planes(ids: np.ndarray, bits: bool) -> np.ndarray:
    rows = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return np.ascontiguousarray(rows.T)
    return np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1, bitorder="little")


def _from_planes(planes: np.ndarray, n: int, bits: bool) -> np.ndarray:
    if bits:
        rows = np.packbits(np.unpackbits(planes, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little")
    else:
        rows = planes.T
    return np.ascontiguousarray(rows).view("<u4").reshape(-1)


def write_shard(doc_ids: list[np.ndarray], block_ids: int = BLOCK_IDS, bits: bool = False, level: int = 3) -> bytes:
    """The shard of the documents' ids, in the given order."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=level).compress
    ids = np.concatenate([np.asarray(x, dtype="<u4") for x in doc_ids]) if doc_ids else np.zeros(0, dtype="<u4")
    planes = _BITS if bits else 4
    out, index = bytearray(_HEAD.pack(MAGIC, VERSION, int(bits), 0)), []
    for at in range(0, len(ids), block_ids):
        block = ids[at : at + block_ids]
        packed = [pack(p.tobytes()) if p.any() else b"" for p in _to_planes(block, bits)]
        index.append(struct.pack(f"<IQ{planes}I", len(block), len(out), *map(len, packed)))
        out += b"".join(packed)
    table = len(out)
    out += np.array([len(x) for x in doc_ids], dtype="<u4").tobytes() + b"".join(index)
    out += _FOOT.pack(block_ids, planes, len(index), len(doc_ids), len(ids), table, MAGIC)
    return bytes(out)


class Shard:
    """Reads a shard's bytes."""

    def __init__(self, data: bytes) -> None:
        magic, version, kind, _ = _HEAD.unpack_from(data)
        self.block_ids, self.planes, n_blocks, n_docs, self.n_ids, table, end = _FOOT.unpack_from(data, len(data) - _FOOT.size)
        if magic != MAGIC or end != MAGIC or version != VERSION:
            raise ValueError("not a token shard")
        self.data, self.bits = data, kind == 1
        self.doc_lengths = np.frombuffer(data, dtype="<u4", count=n_docs, offset=table)
        entry = struct.Struct(f"<IQ{self.planes}I")
        self.blocks = [entry.unpack_from(data, table + 4 * n_docs + i * entry.size) for i in range(n_blocks)]

    def block(self, i: int) -> np.ndarray:
        import zstandard

        n, at, *lengths = self.blocks[i]
        size = (n + 7) // 8 if self.bits else n
        planes = np.zeros((self.planes, size), dtype=np.uint8)
        unpack = zstandard.ZstdDecompressor().decompress
        for p, length in enumerate(lengths):
            if length:
                planes[p] = np.frombuffer(unpack(self.data[at : at + length], max_output_size=size), dtype=np.uint8)
            at += length
        return _from_planes(planes, n, self.bits)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop; only the blocks that hold them are opened."""
        if stop <= start:
            return np.zeros(0, dtype="<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        got = np.concatenate([self.block(i) for i in range(first, last + 1)])
        return got[start - first * self.block_ids : stop - first * self.block_ids]

    def documents(self) -> Iterator[np.ndarray]:
        ends = np.cumsum(self.doc_lengths, dtype=np.int64)
        for e, n in zip(ends.tolist(), self.doc_lengths.tolist()):
            yield self.read(e - n, e) if n > self.block_ids else self._near(e - n, e)

    def _near(self, start: int, stop: int) -> np.ndarray:
        """As read(), but the last two blocks opened are kept for the next document."""
        cache = self.__dict__.setdefault("_open", {})
        first, last = start // self.block_ids, max(start, stop - 1) // self.block_ids
        if stop <= start:
            return np.zeros(0, dtype="<u4")
        for i in range(first, last + 1):
            if i not in cache:
                while len(cache) > 1:
                    del cache[min(cache)]
                cache[i] = self.block(i)
        got = np.concatenate([cache[i] for i in range(first, last + 1)]) if last > first else cache[first]
        return got[start - first * self.block_ids : stop - first * self.block_ids]


_OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_ASCII_SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"


def cut(text: str) -> tuple[str, list[str]]:
    """Cut a text before single spaces between other characters, where the byte-level pre-tokeniser always cuts.

    Returns the first piece and the others, without the space that each begins with.
    """
    parts = text.split(" ")
    if text.isascii() or not _OTHER_SPACE.search(text):
        if len(text.split()) == 1 + sum(map(text.count, _ASCII_SPACE)):  # no space next to another, or at an end
            return parts[0], parts[1:]
    out, held = [], parts[0]
    for p in parts[1:]:
        if p and not p[0].isspace() and held and not held[-1].isspace():
            out.append(held)
            held = " " + p
        else:
            held += " " + p
    out.append(held)
    return out[0], [p[1:] for p in out[1:]]


#: The byte-level pre-tokeniser's rule for texts of settled characters only: those whose classes no two
#: versions of Unicode or libraries see differently.  Fixed values.
_SETTLED = re.compile("[\t\n\r\x20-\x7e\xa1-\u024f]*")
_LETTERS, _NUMBERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, other bytes for letters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class WordEncoder:
    """A byte-level BPE of the tokenizers library, through a cache of pre-tokens.

    Texts are cut here as the library's pre-tokeniser cuts them, and each pre-token that is new goes to
    the library's model.  What holds characters outside of the settled ones goes through the whole
    library, in pieces between spaces; so do texts that spell an added token (as <|endoftext|>).
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers

        tok = Tokenizer.from_file(path)
        pre, model = tok.pre_tokenizer, tok.model
        if tok.normalizer is not None or not isinstance(pre, pre_tokenizers.ByteLevel) or pre.add_prefix_space or not pre.use_regex:
            raise ValueError("only byte-level BPE without normaliser or added space can be encoded word by word")
        if not isinstance(model, models.BPE) or model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix:
            raise ValueError("only plain BPE models can be encoded word by word")
        self.tokenizer, self.model = tok, model.tokenize
        self.letters = _byte_letters()
        self.added = [t.content for t in tok.get_added_tokens_decoder().values() if t.content]
        self.cache = PieceCache(self._encode)

    def _encode(self, parts: list[str]) -> list[bytes]:
        """Ids of single pre-tokens, or of pieces with unsettled characters."""
        out, model = [], self.model
        for p in parts:
            if p[1:].isalpha() and p.isascii() and p[0] == " ":
                ids = [t.id for t in model("\u0120" + p[1:])]
            elif _SETTLED.fullmatch(p):
                ids = [t.id for t in model(p.encode().decode("latin-1").translate(self.letters))]
            else:
                ids = self.tokenizer.encode(p, add_special_tokens=False).ids
            out.append(array("I", ids).tobytes())
        return out

    def encode(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if _SETTLED.fullmatch(text):
            return self.cache.join(_PARTS.findall(text))
        first, rest = cut(text)
        parts: list[str] = []
        for p in (first, *(" " + r for r in rest)):
            if _SETTLED.fullmatch(p):
                parts += _PARTS.findall(p)
            else:
                parts.append(p)
        return self.cache.join(parts)


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


_SHARD = "part int, seq int, start long, n_tokens long, doc_ids array<long>, shard binary"


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", bits: bool = False, block_ids: int = BLOCK_IDS, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode all texts and store them as shards, in ascending order of the id; returns the stored table, read again.

    Columns: part, seq (order of the shards), start (ids before the shard within its
    part), n_tokens, doc_ids, shard (the bytes described above).  The table lies in the
    shared folder, written by Spark's own committer, so a lost task leaves nothing half
    done.  A null text has the end id only; rows of equal id stand next to each other, in the
    order of a hash of their texts; null ids come first.  An empty table gives no shards.

    Rows are dealt by ranges of the id, so each part holds consecutive documents; only
    the texts move, once, and encoding comes after.  Other columns play no part, whatever their names.  A task
    holds one shard's ids at a time, and a document longer than SHARD_IDS whole.
    """
    need(docs, id_col, text_col)
    small_arrow(docs.sparkSession)
    frame, at = positional(docs)
    text = F.coalesce(F.col(at[text_col]).cast("string"), F.lit(""))
    dealt = frame.select(F.col(at[id_col]).cast("long").alias("i"), text.alias("t")).repartitionByRange("i").sortWithinPartitions("i", *hash128(F.col("t")))
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = _encoder(tokenizer_path).encode, TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        seq, before, held = 0, 0, 0
        schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("shard", pa.binary())])

        def close() -> pa.RecordBatch:
            row = {"part": part, "seq": seq, "start": before, "n_tokens": held, "doc_ids": names, "shard": write_shard(ids, block_ids, bits)}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for b in small_batches(batches):
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.concatenate([np.frombuffer(encode(t), dtype="<u4"), end])
                ids.append(x)
                names.append(i)
                held += len(x)
                if held >= shard_ids:
                    yield close()
                    seq, before, held, ids, names = seq + 1, before + held, 0, [], []
        if ids:
            yield close()

    return materialize(dealt.mapInArrow(run, _SHARD), "tokens")


def read_tokens(shards: DataFrame) -> DataFrame:
    """Read the shards back: doc_id, start (ids of all documents before it), ids (binary: little-endian unsigned 32-bit, end id included)."""
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each part of the write
    offsets = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, doc_ids, data in zip(b.column("first").to_pylist(), b.column("doc_ids").to_pylist(), b.column("shard")):
                shard = Shard(data.as_py())
                starts = start + np.concatenate([[0], np.cumsum(shard.doc_lengths, dtype=np.int64)])[:-1]
                found: list[bytes] = []
                done = 0
                for k, x in enumerate(shard.documents()):
                    found.append(x.tobytes())
                    if len(found) == 256 or k + 1 == len(doc_ids):
                        stop = done + len(found)
                        yield pa.RecordBatch.from_arrays([pa.array(doc_ids[done:stop], pa.int64()), pa.array(starts[done:stop], pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "start", "ids"])
                        found, done = [], stop

    rows = shards.join(offsets, "part").select((F.col("start") + F.col("offset")).alias("first"), "doc_ids", "shard")
    return rows.mapInArrow(run, T.StructType().add("doc_id", T.LongType()).add("start", T.LongType()).add("ids", T.BinaryType()))

