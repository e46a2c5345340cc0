"""Media columns: a Matroska muxer and parser over binary columns.

The parser walks variable-length EBML elements and turns clusters, blocks (all four lacings) and cues
into a table of packets with track, timestamp and byte range; it never copies media bytes itself.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from costquarry.llm import runtime

# Fixed values of the format: element ids.
EBML, DOC_TYPE, DOC_VERSION, DOC_READ_VERSION = 0x1A45DFA3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, DURATION = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86
FLAG_LACING, DEFAULT_DURATION, AUDIO, SAMPLING, CHANNELS, BIT_DEPTH = 0x9C, 0x23E383, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, CLUSTER_TIME, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0xFB
CUES, CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
MASTERS = {SEGMENT, INFO, TRACKS, TRACK_ENTRY, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_POSITIONS}
NO_LACING, XIPH, FIXED, EBML_LACING = 0, 1, 2, 3

FRAME = 576
RATE = 8000


class Packet(NamedTuple):
    track: int
    time_ms: float
    offset: int
    size: int
    key: bool
    lacing: int


class Parsed(NamedTuple):
    packets: list[Packet]
    tracks: dict[int, dict]
    cues: list[tuple[int, int, int]]  # time, track, byte offset of the cluster in the file
    intact: bool


def vint(n: int, width: int = 0) -> bytes:
    """A size as a variable-length integer, of the given or the least width (all ones is kept for unknown sizes)."""
    w = width or next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return (n | 1 << 7 * w).to_bytes(w, "big")


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def number(ident: int, n: int) -> bytes:
    return element(ident, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def lace(frames: list[bytes], lacing: int) -> bytes:
    """Lacing header and frames of one block."""
    if lacing == NO_LACING:
        return frames[0]
    sizes = [len(f) for f in frames]
    head = bytes([len(frames) - 1])
    if lacing == XIPH:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif lacing == EBML_LACING:
        head += vint(sizes[0])
        for a, b in zip(sizes, sizes[1:-1]):
            d = b - a
            w = next(w for w in range(1, 9) if abs(d) < (1 << 7 * w - 1))
            head += vint(d + (1 << 7 * w - 1) - 1, w)
    return head + b"".join(frames)


def mux(payload: bytes, frame: int = FRAME, rate: int = RATE, per_block: int = 8, per_cluster: int = 64, lacing: int = FIXED) -> bytes:
    """A Matroska file with one track of unsigned 8-bit PCM that holds the payload's bytes as samples."""
    step = frame * 1000 // rate
    frames = [payload[i : i + frame] for i in range(0, len(payload), frame)]
    audio = element(AUDIO, element(SAMPLING, struct.pack(">d", rate)) + number(CHANNELS, 1) + number(BIT_DEPTH, 8))
    track = number(TRACK_NUMBER, 1) + number(TRACK_UID, 1) + number(TRACK_TYPE, 2) + number(FLAG_LACING,
        int(lacing != NO_LACING)) + number(DEFAULT_DURATION, step * 1_000_000) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio
    parts = [element(INFO, number(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", float(step * len(frames))))),
        element(TRACKS, element(TRACK_ENTRY, track))]
    at, cues = sum(map(len, parts)), []
    for c in range(0, len(frames), per_cluster):
        group, body = frames[c : c + per_cluster], [number(CLUSTER_TIME, c * step)]
        many = 1 if lacing == NO_LACING else per_block
        for b in range(0, len(group), many):
            body.append(element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hB", b * step, 0x80 | lacing << 1) + lace(group[b : b + many], lacing)))
        parts.append(element(CLUSTER, b"".join(body)))
        cues.append(element(CUE_POINT, number(CUE_TIME, c * step) + element(CUE_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER, at))))
        at += len(parts[-1])
    parts.append(element(CUES, b"".join(cues)))
    head = element(EBML, element(DOC_TYPE, b"matroska") + number(DOC_VERSION, 4) + number(DOC_READ_VERSION, 2))
    return head + element(SEGMENT, b"".join(parts))


def _vint(data: bytes, at: int, end: int, keep_marker: bool) -> tuple[int | None, int]:
    """(value, place after it); value None: all ones, an unknown size."""
    if at >= end or not data[at]:
        raise ValueError("no variable-length integer")
    w = 9 - data[at].bit_length()
    if at + w > end:
        raise ValueError("cut off")
    n = int.from_bytes(data[at : at + w], "big")
    if keep_marker:
        return n, at + w
    n &= (1 << 7 * w) - 1
    return (None if n == (1 << 7 * w) - 1 else n), at + w


def _frames(data: bytes, at: int, end: int, lacing: int) -> list[tuple[int, int]]:
    """(offset, size) of each frame of a block."""
    if lacing == NO_LACING:
        return [(at, end - at)]
    n, at, sizes = data[at] + 1, at + 1, []
    if lacing == XIPH:
        for _ in range(n - 1):
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + data[at])
            at += 1
    elif lacing == EBML_LACING and n > 1:
        size, at = _vint(data, at, end, False)
        sizes.append(size)
        for _ in range(n - 2):
            w = 9 - data[at].bit_length()
            d, at = _vint(data, at, end, False)
            sizes.append(sizes[-1] + (d if d is not None else (1 << 7 * w) - 1) - ((1 << 7 * w - 1) - 1))
    elif lacing == FIXED:
        if (end - at) % n:
            raise ValueError("frames of one size don't fill the block")
        sizes = [(end - at) // n] * (n - 1)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("lacing exceeds its block")
    out = []
    for size in sizes:
        out.append((at, size))
        at += size
    return out


def parse(data: bytes | None) -> Parsed:
    """Packets, tracks and cues of a file. Null, empty, cut-off or foreign bytes: what was read until then, intact False."""
    packets: list[Packet] = []
    tracks: dict[int, dict] = {}
    points: list[tuple[dict, list[dict]]] = []  # of each cue point its fields, and those of its positions
    data = data or b""
    scale, cluster, segment, track = 1_000_000, 0, 0, {}
    group, refers = 0, False  # first packet of the block group; whether it refers to other blocks

    def parsed(intact: bool) -> Parsed:
        cues = [(point.get(CUE_TIME, 0), p.get(CUE_TRACK, 0), segment + p[CUE_CLUSTER]) for point, positions in points for p in positions if CUE_CLUSTER in p]
        return Parsed(packets, tracks, cues, intact)

    stack, at, seen = [len(data)], 0, False
    try:
        while at < len(data):
            while len(stack) > 1 and at >= stack[-1]:
                stack.pop()
            ident, body = _vint(data, at, stack[-1], True)
            size, body = _vint(data, body, stack[-1], False)
            end = stack[-1] if size is None else body + size
            if end > stack[-1] or not seen and ident != EBML:
                raise ValueError("not a whole Matroska file")
            seen, at = True, end
            if ident in MASTERS:
                at = body
                if size is not None:
                    stack.append(end)
                if ident == SEGMENT:
                    segment = body
                elif ident == TRACK_ENTRY:
                    track = {}
                elif ident == BLOCK_GROUP:
                    group, refers = len(packets), False
                elif ident == CUE_POINT:
                    points.append(({}, []))
                elif ident == CUE_POSITIONS:
                    points[-1][1].append({})
            elif ident in (SIMPLE_BLOCK, BLOCK):
                which, p = _vint(data, body, end, False)
                relative, flags = struct.unpack_from(">hB", data, p)
                lacing = flags >> 1 & 3
                step = tracks.get(which, {}).get("default_ns", 0) / 1e6
                for i, (offset, n) in enumerate(_frames(data, p + 3, end, lacing)):
                    packets.append(Packet(which, (cluster + relative) * scale / 1e6 + i * step, offset, n,
                        bool(flags & 0x80) if ident == SIMPLE_BLOCK else not refers, lacing))
            elif ident == REFERENCE:
                refers = True
                packets[group:] = [p._replace(key=False) for p in packets[group:]]
            elif ident == TIMESTAMP_SCALE:
                scale = int.from_bytes(data[body:end], "big")
            elif ident == CLUSTER_TIME:
                cluster = int.from_bytes(data[body:end], "big")
            elif ident == TRACK_NUMBER:
                track = tracks[int.from_bytes(data[body:end], "big")] = {}
            elif ident == CODEC_ID:
                track["codec"] = data[body:end].decode("ascii", "replace")
            elif ident == DEFAULT_DURATION:
                track["default_ns"] = int.from_bytes(data[body:end], "big")
            elif ident == CUE_TIME:
                points[-1][0][ident] = int.from_bytes(data[body:end], "big")
            elif ident in (CUE_TRACK, CUE_CLUSTER):
                points[-1][1][-1][ident] = int.from_bytes(data[body:end], "big")
    except (ValueError, IndexError, struct.error, StopIteration):
        return parsed(False)
    return parsed(seen)


def packet_table(df: DataFrame, id_col: str, media: str) -> DataFrame:
    """A row for each packet of a binary column: id, track, time_ms, offset, size, key, lacing (none for null or foreign bytes)."""
    runtime.ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runtime.slices(batches, "_m", max_rows=64):
            for i, m in enumerate(b.column("_m")):
                if p := parse(m.as_py()).packets:
                    yield pa.RecordBatch.from_arrays([pa.array([b.column("_i")[i].as_py()] * len(p), b.column("_i").type),
                        *map(pa.array, zip(*p))], ["_i", *Packet._fields])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(df[id_col].alias("_i"), df[media].alias("_m")).mapInArrow(run,
        f"_i {kind}, track long, time_ms double, offset long, size long, key boolean, lacing long").withColumnRenamed("_i", id_col)


def payload_of(text: bytes | None, unit: int = FRAME) -> bytes:
    """The bytes, then bytes 255 up to a positive multiple of the unit."""
    raw = text or b""
    return raw + b"\xff" * (max(unit, -(-len(raw) // unit) * unit) - len(raw))


def features(samples: np.ndarray, packets: list[Packet], step: float) -> str:
    """A summary of whole media: packets, duration, mean, deviation, crossings of the middle, share of each quarter of the range."""
    n = max(1, len(samples))
    quarter = np.bincount(samples >> 6, minlength=4) / n
    cross = int(np.count_nonzero((samples[1:] < 128) != (samples[:-1] < 128)))
    last = packets[-1].time_ms + step if packets else 0.0
    return f"packets={len(packets)};ms={last:.0f};mean={samples.mean() if len(samples) else 0:.4f};dev={samples.std() if len(samples) else 0:.4f};cross={cross};quarters=" + ",".join(f"{q:.4f}" for q in quarter)


def text_media(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Store each text as a Matroska file, read the packets back and describe them.

    Returns id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature,
    packets and cues. Null text: as empty (one padded frame). Equal texts have equal values. A text is held
    whole, with its file, however long. Ids may be null or repeat, and an empty table gives no rows; other
    columns are not read.
    """
    runtime.ship(df.sparkSession)
    names = ["_i", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "packets", "cues"]

    def describe(raw: bytes | None) -> tuple:
        media = mux(payload_of(raw))
        got = parse(media)
        view = memoryview(media)
        payload = b"".join(view[p.offset : p.offset + p.size] for p in got.packets)
        feature = features(np.frombuffer(payload, np.uint8), got.packets, FRAME * 1000 / RATE)
        return len(raw or b""), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, len(got.packets), len(got.cues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runtime.slices(batches, "_t"):
            cols = list(zip(*(describe(t) for t in b.column("_t").cast(pa.binary()).to_pylist())))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column("_i"), *(pa.array(c, t) for c, t in zip(cols, kinds))], names)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"_i {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, packets long, cues long"
    return df.select(df[id_col].alias("_i"), df[text].alias("_t")).mapInArrow(run, schema).withColumnRenamed("_i", id_col)
