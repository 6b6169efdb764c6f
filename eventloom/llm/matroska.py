"""Matroska containers as columns: write PCM tracks, parse EBML elements into packet tables.

The parser reads variable-length EBML ids and sizes (unknown sizes too), clusters with
simple blocks and block groups, all four kinds of lacing, and cues.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import need, others, positional, small_arrow
from .pieces import small_batches

#: Element ids of the Matroska and EBML specifications.
EBML, EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE, DOC_TYPE, DOC_VERSION, DOC_READ_VERSION = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, MUXING_APP, WRITING_APP = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, FLAG_LACING = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x9C
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE_BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0xFB
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
_TOP = {CLUSTER, CUES, INFO, TRACKS}
NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3

RATE = 8000  # samples a second of the tracks written here
NS_A_SAMPLE = 1_000_000_000 // RATE
FRAME = 1024  # samples in a frame
LACED = 4  # frames in a block
CLUSTER_BLOCKS = 8


class Packet(NamedTuple):
    track: int
    timestamp: int  # nanoseconds
    start: int  # first byte in the file
    size: int
    keyframe: bool
    lacing: int
    cluster: int  # number of the cluster, from 0


class Parsed(NamedTuple):
    packets: list[Packet]
    cues: list[tuple[int, int, int]]  # time (ticks), track, cluster's place in the segment
    clusters: list[int]  # place of each cluster in the segment
    scale: int
    tracks: list[tuple[int, str]]


def vint(n: int, width: int = 0) -> bytes:
    """An EBML size; of the least width that holds it, unless given."""
    width = width or next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return (n | 1 << 7 * width).to_bytes(width, "big")


def element(eid: int, body: bytes | int | str | float) -> bytes:
    if isinstance(body, int):
        body = body.to_bytes(max(1, (body.bit_length() + 7) // 8), "big")
    elif isinstance(body, float):
        body = struct.pack(">d", body)
    elif isinstance(body, str):
        body = body.encode()
    return eid.to_bytes((eid.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def lace(frames: list[bytes], lacing: int) -> bytes:
    """Body of a block after its header: lacing head and frames."""
    if lacing == NO_LACING:
        return frames[0]
    head = bytes([len(frames) - 1])
    sizes = [len(f) for f in frames]
    if lacing == XIPH:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif lacing == EBML_LACING:
        head += vint(sizes[0])
        for a, b in zip(sizes, sizes[1:-1]):
            width = next(w for w in range(1, 9) if abs(b - a) < (1 << 7 * w - 1) - 1)
            head += vint(b - a + (1 << 7 * width - 1) - 1, width)
    return head + b"".join(frames)


_HEADER = element(EBML, b"".join((element(EBML_VERSION, 1), element(EBML_READ_VERSION, 1), element(EBML_MAX_ID, 4), element(EBML_MAX_SIZE, 8), element(DOC_TYPE, "matroska"), element(DOC_VERSION, 4), element(DOC_READ_VERSION, 2))))
_INFO = element(INFO, element(TIMESTAMP_SCALE, 125_000) + element(MUXING_APP, "eventloom") + element(WRITING_APP, "eventloom"))
_TRACKS = element(
    TRACKS,
    element(TRACK_ENTRY, element(TRACK_NUMBER, 1) + element(TRACK_UID, 1) + element(TRACK_TYPE, 2) + element(FLAG_LACING, 1) + element(CODEC_ID, "A_PCM/INT/LIT") + element(AUDIO, element(SAMPLING_FREQUENCY, float(RATE)) + element(CHANNELS, 1) + element(BIT_DEPTH, 8))),
)


def write_pcm(samples: bytes, frame: int = FRAME, laced: int = LACED, cluster_blocks: int = CLUSTER_BLOCKS) -> bytes:
    """A Matroska file with one track of 8-bit samples; a tick is one sample.

    Blocks of several frames are laced: fixed-size if the frames are equal, else EBML.
    """
    body = bytearray(_INFO + _TRACKS)
    cues = []
    step = frame * laced
    for first in range(0, len(samples), step * cluster_blocks):
        blocks = [element(TIMESTAMP, first)]
        for at in range(first, min(len(samples), first + step * cluster_blocks), step):
            frames = [samples[i : i + frame] for i in range(at, min(len(samples), at + step), frame)]
            lacing = NO_LACING if len(frames) == 1 else FIXED if len(frames[-1]) == frame else EBML_LACING
            blocks.append(element(SIMPLE_BLOCK, b"\x81" + struct.pack(">h", at - first) + bytes([0x80 | lacing << 1]) + lace(frames, lacing)))
        cues.append(element(CUE_POINT, element(CUE_TIME, first) + element(CUE_TRACK_POSITIONS, element(CUE_TRACK, 1) + element(CUE_CLUSTER_POSITION, len(body)))))
        body += element(CLUSTER, b"".join(blocks))
    body += element(CUES, b"".join(cues))
    return _HEADER + element(SEGMENT, bytes(body))


def _read_vint(data: bytes, at: int, keep_marker: bool) -> tuple[int, int, int]:
    """Value, place after it, width."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no EBML number at byte {at}")
    width = 9 - data[at].bit_length()
    if at + width > len(data):
        raise ValueError("the file ends within a number")
    v = int.from_bytes(data[at : at + width], "big")
    return (v if keep_marker else v & (1 << 7 * width) - 1), at + width, width


def elements(data: bytes, at: int, end: int, until: frozenset | set = frozenset()) -> Iterator[tuple[int, int, int, int]]:
    """(id, start, body start, body end) of the elements side by side; an unknown size lasts to the next id in `until`, or the end."""
    while at < end:
        start = at
        eid, at, _ = _read_vint(data, at, True)
        size, at, width = _read_vint(data, at, False)
        if size == (1 << 7 * width) - 1:
            stop = end
            if eid != SEGMENT:
                stop = at
                while stop < end:
                    child, body, _ = _read_vint(data, stop, True)
                    if child in until:
                        break
                    n, body, _ = _read_vint(data, body, False)
                    stop = body + n
        else:
            stop = at + size
        if stop > end:
            raise ValueError(f"the element at byte {start} goes beyond its parent")
        yield eid, start, at, stop
        at = stop


def _uint(data: bytes, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def _frames(data: bytes, at: int, end: int, lacing: int) -> list[tuple[int, int]]:
    """(start, size) of the frames of a block's body."""
    if lacing == NO_LACING:
        return [(at, end - at)]
    n, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if lacing == XIPH:
        for _ in range(n - 1):
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + data[at])
            at += 1
    elif lacing == EBML_LACING:
        for k in range(n - 1):
            v, at, width = _read_vint(data, at, False)
            sizes.append(sizes[-1] + v - (1 << 7 * width - 1) + 1 if k else v)
    else:
        if (end - at) % n:
            raise ValueError("frames of fixed lacing differ in size")
        sizes = [(end - at) // n] * (n - 1)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("lacing sizes go beyond the block")
    out = []
    for s in sizes:
        out.append((at, s))
        at += s
    return out


def parse(data: bytes) -> Parsed:
    """Packets with track, timestamp and byte range, in file order, and the cues."""
    packets: list[Packet] = []
    cues, clusters, tracks = [], [], []
    scale = 1_000_000

    def cluster(c: int, d: int) -> None:
        base = 0
        for e, _, x, y in elements(data, c, d, _TOP):
            if e == TIMESTAMP:
                base = _uint(data, x, y)
            elif e == SIMPLE_BLOCK:
                block(x, y, base, None)
            elif e == BLOCK_GROUP:
                inner = list(elements(data, x, y))
                key = all(g != REFERENCE_BLOCK for g, *_ in inner)
                for g, _, p, q in inner:
                    if g == BLOCK:
                        block(p, q, base, key)

    def block(a: int, b: int, base: int, key: bool | None) -> None:
        track, a, _ = _read_vint(data, a, False)
        (rel,), flags = struct.unpack_from(">h", data, a), data[a + 2]
        lacing = flags >> 1 & 3
        for start, size in _frames(data, a + 3, b, lacing):
            packets.append(Packet(track, (base + rel) * scale, start, size, bool(flags & 0x80) if key is None else key, lacing, len(clusters) - 1))

    for eid, _, a, b in elements(data, 0, len(data)):
        if eid != SEGMENT:
            continue
        for top, start, c, d in elements(data, a, b, _TOP):
            if top == INFO:
                scale = next((_uint(data, x, y) for e, _, x, y in elements(data, c, d) if e == TIMESTAMP_SCALE), scale)
            elif top == TRACKS:
                for e, _, x, y in elements(data, c, d):
                    if e == TRACK_ENTRY:
                        own = {k: (p, q) for k, _, p, q in elements(data, x, y)}
                        tracks.append((_uint(data, *own[TRACK_NUMBER]), data[slice(*own.get(CODEC_ID, (0, 0)))].decode()))
            elif top == CLUSTER:
                clusters.append(start - a)
                cluster(c, d)
            elif top == CUES:
                for e, _, x, y in elements(data, c, d):
                    if e != CUE_POINT:
                        continue
                    time = 0
                    for k, _, p, q in elements(data, x, y):
                        if k == CUE_TIME:
                            time = _uint(data, p, q)
                        elif k == CUE_TRACK_POSITIONS:
                            own = {m: _uint(data, u, v) for m, _, u, v in elements(data, p, q)}
                            cues.append((time, own[CUE_TRACK], own[CUE_CLUSTER_POSITION]))
    return Parsed(packets, cues, clusters, scale, tracks)


def padded(text: str | None) -> tuple[bytes, int]:
    """UTF-8 of a text with zero bytes up to a positive multiple of 64, and its length without them."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(max(1, -(-len(raw) // 64)) * 64 - len(raw)), len(raw)


def store_texts(docs: DataFrame, text_col: str = "text", drop_text: bool = False) -> DataFrame:
    """Add `media` (a Matroska file of the padded text's bytes as samples) and `n_bytes` to every row.

    A null text counts as empty (64 zero bytes).  Input columns of these names are replaced, in whatever
    case.  Equal texts give equal files; an empty table stays empty; a very long text is one file, made in
    memory in the one task that holds it.
    """
    return _mapped(docs, text_col, drop_text, [("n_bytes", T.LongType(), pa.int64()), ("media", T.BinaryType(), pa.binary())], lambda t: (lambda p: (p[1], write_pcm(p[0])))(padded(t)))


def _mapped(df: DataFrame, col: str, drop: bool, new: list[tuple[str, T.DataType, pa.DataType]], fn) -> DataFrame:
    """All columns (without `col` if `drop`) but those of the new names, and what fn returns for `col`."""
    need(df, col)
    small_arrow(df.sparkSession)
    names = [n for n, _, _ in new]
    frame, at = positional(df)
    rest = {name: place for name, place in others(at, *names).items() if not (drop and name == col)}
    base = frame.select(*{**rest, col: at[col]}.values())
    schema = T.StructType([f for f in base.schema.fields if f.name in rest.values()])
    for n, kind, _ in new:
        schema = schema.add(n, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, rows=256):
            got = [fn(x) for x in b.column(at[col]).to_pylist()]
            cols = [pa.array([g[i] for g in got], kind) for i, (_, _, kind) in enumerate(new)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest.values()), *cols], names=[*rest.values(), *names])

    return base.mapInArrow(run, schema).toDF(*rest, *names)


_PACKET = T.StructType().add("track", T.IntegerType()).add("timestamp_ns", T.LongType()).add("start", T.LongType()).add("size", T.LongType()).add("keyframe", T.BooleanType()).add("lacing", T.IntegerType()).add("cluster", T.IntegerType())


def packets(media: DataFrame, media_col: str = "media") -> DataFrame:
    """Packet table of Matroska files: every column but the file's, repeated for each packet, and the packet's fields.

    Columns: packet (number in file order), track, timestamp_ns, start, size, keyframe,
    lacing, cluster.  Null or broken files give no row.
    """
    need(media, media_col)
    arrow = pa.list_(pa.struct([("track", pa.int32()), ("timestamp_ns", pa.int64()), ("start", pa.int64()), ("size", pa.int64()), ("keyframe", pa.bool_()), ("lacing", pa.int32()), ("cluster", pa.int32())]))
    names = _PACKET.names

    def table(data: bytes | None) -> tuple[list[dict]]:
        try:
            return ([dict(zip(names, p)) for p in parse(data).packets] if data else [],)
        except (ValueError, IndexError, KeyError, struct.error):
            return ([],)

    out = _mapped(media, media_col, True, [("_packets", T.ArrayType(_PACKET), arrow)], table)
    rest = [c for c in media.columns if c != media_col and c not in names and c != "packet"]
    return out.select(*(F.col(f"`{c}`") for c in rest), F.posexplode("_packets").alias("packet", "_p")).select(*(F.col(f"`{c}`") for c in rest), "packet", "_p.*")


def read_payload(media: DataFrame, media_col: str = "media") -> DataFrame:
    """Add what the stored file holds: payload (frames joined in order of their times), n_packets, n_clusters, cues_ok, duration_ns, table_crc32.

    `cues_ok`: there is a cue for each cluster, which points to it and has the time of its first packet.
    `duration_ns`: from the first packet's time to the end of the last.  `table_crc32`: of the packet
    table, a line `track timestamp start size` for each packet.  A null or broken file has a null payload
    and zeros.
    """

    def read(data: bytes | None):
        try:
            p = parse(data) if data else None
        except (ValueError, IndexError, KeyError, struct.error):
            p = None
        if p is None:
            return None, 0, 0, False, 0, 0
        first: dict[int, int] = {}
        for x in p.packets:
            first.setdefault(x.cluster, x.timestamp)
        place = {at: first.get(i) for i, at in enumerate(p.clusters)}
        ok = {at for _, _, at in p.cues} == set(p.clusters) and all(place.get(at) == time * p.scale for time, _, at in p.cues)
        ordered = sorted(p.packets, key=lambda x: (x.timestamp, x.start))
        payload = b"".join(data[x.start : x.start + x.size] for x in ordered)
        end = ordered[-1].timestamp if ordered else 0  # laced frames share their block's time
        length = end + sum(x.size for x in ordered if x.timestamp == end) * NS_A_SAMPLE - ordered[0].timestamp if ordered else 0
        table = "\n".join(f"{x.track} {x.timestamp} {x.start} {x.size}" for x in p.packets)
        return payload, len(p.packets), len(p.clusters), ok, length, zlib.crc32(table.encode())

    new = [("payload", T.BinaryType(), pa.binary()), ("n_packets", T.LongType(), pa.int64()), ("n_clusters", T.LongType(), pa.int64()), ("cues_ok", T.BooleanType(), pa.bool_()), ("duration_ns", T.LongType(), pa.int64()), ("table_crc32", T.LongType(), pa.int64())]
    return _mapped(media, media_col, False, new, read)

