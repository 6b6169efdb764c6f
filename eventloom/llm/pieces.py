"""Encoding by cached pieces: most words of a corpus were seen a moment ago."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Bytes that both generations of a worker's cache may take together, by the estimate below.
BUDGET = 64 << 20
#: What an entry takes beside its text and ids: two objects and a place in a dict.
ENTRY = 180
#: Longer pieces seldom come again (a text in a script without spaces is one piece) and are never kept.
LONGEST = 40


class PieceCache:
    """A map from a piece of text to its ids (little-endian 32-bit), of two generations and bounded in bytes.

    A piece found in the older generation moves to the newer one.  When the newer holds half
    of the budget it becomes the older, and what was not used meanwhile is forgotten.  The pieces of one text may go beyond it.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], budget: int = BUDGET, longest: int = LONGEST) -> None:
        self.encode, self.half, self.longest, self.size = encode, budget // 2, longest, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def join(self, pieces: list[str]) -> bytes:
        """The ids of the pieces, one after the other."""
        new = self.new
        got = list(map(new.get, pieces))
        if None in got:
            own: dict[str, bytes] = {}
            missing: list[str] = []
            for p in set(pieces).difference(new):
                was = self.old.get(p)
                if was is None:
                    missing.append(p)
                else:
                    own[p] = was
            own.update(zip(missing, self.encode(missing)))
            got = [own[p] if ids is None else ids for p, ids in zip(pieces, got)]
            if max(map(len, own)) > self.longest:
                own = {p: ids for p, ids in own.items() if len(p) <= self.longest}
            new.update(own)
            self.size += sum(map(len, own)) + sum(map(len, own.values())) + ENTRY * len(own)
            if self.size >= self.half:
                self.old, self.new, self.size = new, {}, 0
        return b"".join(got)


def id_lists(parts: list[bytes]) -> pa.Array:
    """Byte strings of 32-bit ids as one array<int>."""
    sizes = np.fromiter((len(p) // 4 for p in parts), dtype=np.int64, count=len(parts))
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    values = np.frombuffer(b"".join(parts), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def small_batches(batches, rows: int = 64, chars: int = 1 << 20):
    """Slices of at most `rows` rows and about `chars` bytes (one row at least), so that outputs stay small."""
    for b in batches:
        start = 0
        while start < b.num_rows:
            n = min(rows, b.num_rows - start)
            while n > 1 and b.slice(start, n).nbytes > chars:
                n //= 2
            yield b.slice(start, n)
            start += n
