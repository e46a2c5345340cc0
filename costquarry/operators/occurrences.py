"""Which of many markers stand in which of many texts: a join on one window of each marker, no text compared with all markers.

A marker is met by a window of its first bytes, of 1 to 24 bytes by its length, the one that fewest markers have. Tasks
hash the windows at all places of a text; only those that hit a table of bits, of a bounded size and made of the markers'
windows, go on to the join, and what meets is then looked for in the text itself. Long texts are cut into blocks that
overlap by the longest marker, so that time goes by the length of a text and no task holds more of it than a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costquarry import ship
from costquarry.scratch import stage
from costquarry.spread import dealt

SPANS = (24, 16, 12, 8, 4, 2, 1)
#: Places of a marker at which its window may begin.
PLACES = 16
BLOCK = 4096
#: Bits of the table for each marker, and the most that it has (32 MB).
BITS_A_MARKER, MOST_BITS = 64, 1 << 28
SLICES = 64
#: Bytes that are hashed at once.
CHUNK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_keys(data: np.ndarray, span: int) -> np.ndarray:
    """A 63-bit hash of the `span` bytes at each place."""
    n = len(data) - span + 1
    key = np.full(max(n, 0), span, np.uint64)
    for at in range(0, span, 8):
        word = np.zeros(len(key), np.uint64)
        for j in range(at, min(at + 8, span)):
            word = (word << np.uint64(8)) | data[j : j + n]
        key = mixed(key ^ word)
    return (key >> np.uint64(1)).astype(np.int64)


def _windows(column: pa.Array, spans: tuple[int, ...]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of texts in runs of about CHUNK bytes: (span, first row, rows' ends, places, keys), places of windows within a row only."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        part, ends = data[offsets[first] : offsets[last]], offsets[first + 1 : last + 1] - offsets[first]
        for span in spans:
            yield span, first, ends, np.arange(max(len(part) - span + 1, 0)), window_keys(part, span)
        first = last


def _marker_windows(markers: DataFrame) -> DataFrame:
    """(scope, marker, span, key) of the windows by which a marker may be met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, spans, keys = [], [], []
            for i, m in enumerate(b.column("marker").to_pylist()):
                raw = m.encode()
                span = next(s for s in SPANS if s <= len(raw))
                each = window_keys(np.frombuffer(raw[: span + PLACES - 1], np.uint8), span)
                rows += [i] * len(each)
                spans += [span] * len(each)
                keys.append(each)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("scope").take(at), b.column("marker").take(at), pa.array(spans, pa.int32()),
                pa.array(np.concatenate(keys) if keys else [], pa.int64())], ["scope", "marker", "span", "key"])

    return markers.select("scope", "marker").mapInArrow(run, "scope string, marker string, span int, key long")


def _table(keys: DataFrame, bits: int) -> np.ndarray:
    """A table with the bit of each key set; tasks make its slices."""
    size = bits // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            at = b.column("bit").to_numpy()
            for s in np.unique(at // size):
                held.setdefault(int(s), np.zeros(size, bool))[at[at // size == s] % size] = True
        for s, each in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([np.packbits(each, bitorder="little").tobytes()], pa.binary())], ["slice", "part"])

    bit = (F.col("key") % bits).alias("bit")
    dealt_keys = keys.select(bit).repartition(SLICES, F.floor(F.col("bit") / size))
    out = np.zeros(bits // 8, np.uint8)
    for r in dealt_keys.mapInArrow(run, "slice long, part binary").toLocalIterator():
        out[r["slice"] * (size // 8) : (r["slice"] + 1) * (size // 8)] = np.frombuffer(r["part"], np.uint8)
    return out


def _hits(blocks: DataFrame, spans: tuple[int, ...], table: np.ndarray) -> DataFrame:
    """(id, block, scope, key): windows of the blocks whose bit is set, each once a block."""
    shared, bits = blocks.sparkSession.sparkContext.broadcast(table), len(table) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            for span, first, ends, places, keys in _windows(b.column("piece"), spans):
                bit = keys % bits
                hit = np.flatnonzero((known[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                row = np.searchsorted(ends, places[hit], "right")
                inside = places[hit] + span <= ends[row]
                found = np.unique(np.stack([row[inside] + first, keys[hit][inside]]), axis=1)
                at = pa.array(found[0], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(c).take(at) for c in ("id", "block", "scope")] + [pa.array(found[1], pa.int64())], ["id", "block", "scope", "key"])

    kind = blocks.schema["id"].dataType.simpleString()
    return blocks.select("id", "block", "scope", "piece").mapInArrow(run, f"id {kind}, block int, scope string, key long")


def occurrences(texts: DataFrame, markers: DataFrame) -> DataFrame:
    """(id, scope, marker), each once: the markers (scope, marker) that stand in a text (id, scope, text) of their scope, letter by letter.

    Empty markers and nulls are left out. `texts` is read twice, so it should be stable.
    """
    ship(texts.sparkSession)
    known = stage(dealt(markers.select("scope", "marker").where("marker <> '' and scope is not null").distinct()), "markers")
    windows = stage(_marker_windows(known), "windows")
    often = windows.groupBy("scope", "key").agg(F.count(F.lit(1)).alias("n"))
    chosen = windows.join(often, ["scope", "key"]).groupBy("scope", "marker").agg(F.min_by(F.struct("key", "span"), F.struct("n", "key")).alias("w"))
    chosen = stage(chosen.select("scope", "marker", "w.key", "w.span"), "chosen")
    facts = chosen.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("marker")).alias("longest"), F.collect_set("span").alias("spans")).first()
    if not facts["n"]:
        return chosen.join(texts.select("id", "scope"), "scope").select("id", "scope", "marker")
    bits = min(MOST_BITS, max(1 << 16, 1 << (BITS_A_MARKER * facts["n"] - 1).bit_length()))
    size = max(BLOCK, facts["longest"])
    text, parts = F.col("text"), F.col("_parts")
    long = F.length(text) > 2 * size
    cut = texts.where("text is not null and scope is not null").select("id", "scope", "text", F.when(long, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))).alias("_parts"))
    joined = F.transform(parts, lambda x, i: F.concat(x, F.left(F.coalesce(F.get(parts, i + 1), F.lit("")), F.lit(facts["longest"]))))
    blocks = cut.select("id", "scope", F.posexplode_outer(F.coalesce(joined, F.array(text))).alias("block", "piece"))
    hits = _hits(blocks, tuple(facts["spans"]), _table(chosen.select("key"), bits))
    pairs = hits.join(chosen.select("scope", "key", "marker"), ["scope", "key"]).select("id", "block", "scope", "marker")
    return pairs.join(blocks, ["id", "block", "scope"]).where(F.contains("piece", "marker")).select("id", "scope", "marker").distinct()
