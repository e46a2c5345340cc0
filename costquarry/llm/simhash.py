"""SimHash near-duplicates: fingerprints are split into blocks so that close pairs share a block key,
rows are dealt out by block key, and pairs under one key are verified by their Hamming distance.

Two ways to make keys:
* pigeonhole(): a fingerprint of 64 bits in m blocks; if at most k bits differ, at least m - k blocks
  agree, so there is a key for each choice of m - k blocks. No close pair is missed.
* sampled(): for distances too wide for that, as a word-shingle similarity of 0.8 is: keys of b bits
  drawn from a wider fingerprint, as many as a stated recall takes.

Equal fingerprints are one node before keys are made. Under a key, only the edges of a spanning forest
of close fingerprints are given out, never all pairs; a key with more than LARGE fingerprints is dealt
out again in pairs of chunks, so that no task holds more than two chunks at once.

similar_texts() takes linked fingerprints as candidates only: the shingle sets of each candidate
component are compared exactly, and components are made from what that leaves.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costquarry.llm import runtime
from costquarry.llm.components import connected_components

LARGE = 4096
FEW = 16
#: Distinct shingles that a task compares of each chunk of a candidate component, and texts.
CHUNK_SHINGLES, CHUNK_TEXTS = 500_000, 2048
#: Sets of up to so many shingles also meet under their smallest shingles, as few shingles make noisy fingerprints.
SHORT = 30
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # fixed values of the splitmix64 generator


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of `words` words of lower-cased text, repeats included."""
    parts = text.lower().split()  # bytes: A-Z and the six ASCII white spaces only
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    begins = [0, *ends[: len(parts) - words].tolist()]
    digest, last = xxhash.xxh64_intdigest, (ends[words - 1 :] - 1).tolist()
    return np.array([digest(joined[i:j], 42) for i, j in zip(begins, last)], np.uint64)


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> np.ndarray:
    """`lanes` 64-bit words: a bit is 1 if set in over half the hashes (further lanes: remixed hashes); none: zero."""
    n = len(hashes)
    out = np.zeros(lanes, np.uint64)
    for lane in range(lanes if n else 0):
        h = hashes
        if lane:
            h = hashes + np.uint64(MIX[0] * lane & 0xFFFFFFFFFFFFFFFF)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX[1])
            h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[2])
            h = h ^ (h >> np.uint64(31))
        bits = np.unpackbits(h.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
        count, whole = np.zeros(64, np.int64), n // 255 * 255
        if whole:  # sums of 255 bits fit a byte
            count += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        count += bits[whole:].sum(axis=0, dtype=np.int64)
        out[lane] = np.packbits(count * 2 > n, bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(df: DataFrame, text: str = "text", words: int = 4, lanes: int = 1, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, then f0, f1, ... (one long for each 64 bits). Null text: as empty, fingerprint zero."""
    runtime.ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runtime.slices(batches, "_text"):
            f = np.array([fingerprint(shingle_hashes(t or b"", words), lanes) for t in b.column("_text").cast(pa.binary()).to_pylist()],
                np.uint64).reshape(-1, lanes)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array(f[:, i].view(np.int64)) for i in range(lanes))],
                [*keep, *(f"f{i}" for i in range(lanes))])

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), *(f"f{i} long" for i in range(lanes))])
    return df.select(*(df[c] for c in keep), df[text].alias("_text")).mapInArrow(run, schema)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks_pigeonhole(distance: int, blocks: int) -> list[list[int]]:
    """64-bit masks, one for each choice of blocks - distance blocks."""
    edge = [round(i * 64 / blocks) for i in range(blocks + 1)]
    block = [((1 << (j - i)) - 1) << i for i, j in itertools.pairwise(edge)]
    return [[sum(c)] for c in itertools.combinations(block, blocks - distance)]


def blocks_for(n: int, distance: int, least: int = 7, spurious: float = 8.0) -> int:
    """Blocks so that a fingerprint meets few unrelated ones under all its keys: more as n grows."""
    m = max(least, distance + 1)
    while m < 24 and math.comb(m, distance) * n / 2 ** (64 * (m - distance) / m) > spurious:
        m += 1
    return m


def masks_sampled(lanes: int, n: int, differs: float, recall: float = 0.99) -> list[list[int]]:
    """Masks of b drawn bits; as many that a pair with a share `differs` of unlike bits meets with the given recall."""
    b = max(16, math.ceil(math.log2(max(n, 2))) - 2)
    tables = math.ceil(math.log(1 - recall) / math.log(1 - (1 - differs) ** b))
    draw = np.random.default_rng(64 * lanes + b)
    out = []
    for _ in range(tables):
        bits = draw.choice(64 * lanes, b, replace=False).tolist()
        out.append([sum(1 << (x % 64) for x in bits if x // 64 == lane) for lane in range(lanes)])
    return out


def block_keys(prints: DataFrame, masks: list[list[int]]) -> DataFrame:
    """A row for each fingerprint and mask, and each of further keys in a column `keys`: key (long) and the fingerprint."""
    lanes = [f"f{i}" for i in range(len(masks[0]))]

    def key(k: int, mask: list[int]) -> Column:
        return F.xxhash64(F.lit(k), *(F.col(f).bitwiseAND(F.lit(signed(m))) for f, m in zip(lanes, mask) if m))

    keys = F.array(*(key(k, m) for k, m in enumerate(masks)))
    if "keys" in prints.columns:
        keys = F.concat(keys, "keys")
    return prints.select(F.explode(keys).alias("key"), *lanes)


def _close(f: np.ndarray, g: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(f ^ g).sum(axis=-1, dtype=np.int64) <= distance


def _forest(f: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the close pairs of f.

    Fingerprints are taken in their order, so that a cluster that meets under many keys has mostly the same
    edges under each, to its first fingerprint.
    """
    rest, edges = np.lexsort(f.T[::-1]), []
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = _close(f[rest], f[x], distance)
            if near.any():
                got = rest[near].tolist()
                edges += [(x, y) for y in got]
                queue += got
                rest = rest[~near]
    return edges


def _runs(batches: Iterator[pa.RecordBatch], by: list[str], lanes: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted rows as arrays (keys, fingerprints) that end where a key ends; a long run comes in parts of over LARGE rows each."""
    keep: list[np.ndarray] | None = None
    for b in batches:
        k = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in by], axis=1)
        f = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in lanes], axis=1).view(np.uint64)
        if keep is not None:
            k, f = np.concatenate([keep[0], k]), np.concatenate([keep[1], f])
        cut = int(np.searchsorted((k != k[-1]).any(axis=1)[::-1], True)) if len(k) else 0
        at = len(k) - cut
        if at == 0 and len(k) > 4 * LARGE:
            at = len(k) - LARGE - 1  # one long run: what stays is still over LARGE
        if at:
            yield k[:at], f[:at]
        keep = [k[at:], f[at:]]
    if keep is not None and len(keep[0]):
        yield keep[0], keep[1]


def close_edges(keyed: DataFrame, by: list[str], lanes: list[str], distance: int, split: bool) -> DataFrame:
    """Edges (a*, b*) between close fingerprints under one key. split: a key of over LARGE rows gives its rows as hot instead."""
    n = len(lanes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, f in _runs(batches, by, lanes):
            starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)])
            size = np.diff(np.r_[starts, len(k)])
            left, right, hot = [], [], []
            for lag in range(1, FEW):
                i = starts[size <= FEW]
                m = size[size <= FEW]
                i, m = i[m > lag], m[m > lag]
                if not len(i):
                    break
                x = np.repeat(i, m - lag) + np.arange((m - lag).sum()) - np.repeat(np.cumsum(m - lag) - (m - lag), m - lag)
                near = x[_close(f[x], f[x + lag], distance)]
                left.append(near)
                right.append(near + lag)
            for i, m in zip(starts[size > FEW].tolist(), size[size > FEW].tolist()):
                if split and m > LARGE:
                    hot.append(np.arange(i, i + m))
                elif e := _forest(f[i : i + m], distance):
                    e = np.array(e) + i
                    left.append(e[:, 0])
                    right.append(e[:, 1])
            a = f[np.concatenate(left)] if left else f[:0]
            b = f[np.concatenate(right)] if right else f[:0]
            h = np.concatenate(hot) if hot else np.zeros(0, np.int64)
            a, b = np.concatenate([a, f[h]]).view(np.int64), np.concatenate([b, f[h]]).view(np.int64)
            key = np.concatenate([np.zeros(len(a) - len(h), np.int64), k[h, 0]])
            is_hot = np.arange(len(a)) >= len(a) - len(h)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(is_hot), pa.array(key),
                    *(pa.array(np.ascontiguousarray(a[:, i])) for i in range(n)), *(pa.array(np.ascontiguousarray(b[:, i])) for i in range(n))], names)

    names = ["hot", "key", *(f"a{i}" for i in range(n)), *(f"b{i}" for i in range(n))]
    dealt = keyed.repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, "hot boolean, key long, " + ", ".join(f"{c} long" for c in names[2:]))


def link(prints: DataFrame, distance: int, masks: list[list[int]]) -> DataFrame:
    """Edges between distinct fingerprints at most `distance` bits apart that share a mask's bits: a0.. b0.., enough to connect them."""
    lanes = [f"f{i}" for i in range(len(masks[0]))]
    found = runtime.stage(close_edges(block_keys(prints, masks), ["key"], lanes, distance, True), "links")
    cold = found.where("not hot").drop("hot", "key")
    hot = found.where("hot").select("key", *(F.col(f"a{i}").alias(f"f{i}") for i in range(len(lanes))))
    size = hot.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select("key", F.ceil(F.col("n") / (LARGE // 2)).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64(F.lit("chunk"), *lanes), F.col("chunks"))
    dealt = hot.join(size, "key").withColumn("own", own.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("key", F.least("own", "other").cast("long").alias("c1"), F.greatest("own", "other").cast("long").alias("c2"), *lanes)
    again = close_edges(dealt, ["key", "c1", "c2"], lanes, distance, False).drop("hot", "key")
    return cold.union(again)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 4, lanes: int = 1, distance: int = 4,
    exact: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, `keep`, fingerprint (hex) and component_id.

    Fingerprints link at `distance` or fewer differing bits; component_id is the smallest id that can
    be reached, the row's own included. exact=True needs lanes=1 and misses no link; exact=False draws
    keys with a recall of 0.99 for pairs at that distance. Equal texts have equal fingerprints and are
    one node. Null or empty text: fingerprint zero, linked like any other. Null ids never name a
    component (a component of null ids only has null). Repeated rows are kept, each with the same
    result. A text is read whole by one task, however long. Other columns are not read. An empty table gives
    an empty result.
    """
    cols = [f"f{i}" for i in range(lanes)]
    with runtime.Scope(df.sparkSession) as scope:
        docs = scope.keep(runtime.stage(fingerprints(df, text, words, lanes, tuple(dict.fromkeys([id_col, *keep]))), "prints"))
        classes, rows = fingerprint_classes(docs, id_col, cols, distance, exact)
        scope.keep(classes)
    digits = F.concat(*(F.lpad(F.lower(F.hex(c)), 16, "0") for c in reversed(cols)))
    joined = runtime.join_counted(docs, classes, cols, "copies", rows)
    return joined.select(id_col, *keep, digits.alias("fingerprint"), "component_id")


def fingerprint_classes(docs: DataFrame, id_col: str, cols: list[str], distance: int, exact: bool) -> tuple[DataFrame, int]:
    """Distinct fingerprints of docs (cols, copies, component_id), staged, and the number of rows."""
    lanes = len(cols)
    nodes = docs.groupBy(*cols).agg(F.min(id_col).alias("least_id"), F.count(F.lit(1)).alias("copies"))
    nodes = runtime.stage(nodes.withColumn("node", F.col("f0") if lanes == 1 else F.xxhash64(*cols)), "nodes")
    n, rows = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0))).first()
    masks = masks_pigeonhole(distance, blocks_for(n, distance)) if exact else masks_sampled(lanes, n, distance / (64 * lanes))
    one = lambda s: F.col(f"{s}0") if lanes == 1 else F.xxhash64(*(F.col(f"{s}{i}") for i in range(lanes)))
    with runtime.Scope(docs.sparkSession) as scope:
        found = link(nodes.select(*cols), distance, masks)
        roots = scope.keep(runtime.stage(connected_components(found.select(one("a").alias("a"), one("b").alias("b"))), "roots"))
    linked = runtime.stage(nodes.join(roots, "node").select(*cols, "root", "least_id"), "linked")
    least = linked.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    linked = runtime.join_counted(linked, least, ["root"], "n", n).select(*cols, "component_id")
    classes = nodes.join(linked, cols, "left").select(*cols, "copies", F.coalesce("component_id", "least_id").alias("component_id"))
    return runtime.stage(classes, "classes"), rows


def smallest_shingles(distinct: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """Of a sorted set, as many of the smallest that sets with the given similarity share one (none for sets over SHORT)."""
    n = len(distinct)
    return distinct[: n - -(-n * similar[0] // similar[1]) + 1] if n <= SHORT else distinct[:0]


def set_fingerprints(df: DataFrame, id_col: str, text: str, words: int, lanes: int, similar: tuple[int, int]) -> DataFrame:
    """Of each row's set of shingles: id, row (hash of id and text), mark (hash of the set), size, keys, f0, f1, ..."""
    runtime.ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runtime.slices(batches, "_text"):
            sets = [np.unique(shingle_hashes(t or b"", words)) for t in b.column("_text").cast(pa.binary()).to_pylist()]
            f = np.array([fingerprint(s, lanes) for s in sets], np.uint64).reshape(-1, lanes)
            marks = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            keys = pa.array([smallest_shingles(s, similar).view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), b.column("row"), pa.array(marks), pa.array([len(s) for s in sets], pa.int64()), keys,
                    *(pa.array(f[:, i].view(np.int64)) for i in range(lanes))],
                [id_col, "row", "mark", "size", "keys", *(f"f{i}" for i in range(lanes))],
            )
        runtime.tidy()

    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, row long, mark long, size long, keys array<long>, " + ", ".join(f"f{i} long" for i in range(lanes))
    return df.select(df[id_col], F.xxhash64(df[id_col], df[text]).alias("row"), df[text].alias("_text")).mapInArrow(run, schema)


def similar_forest(sets: list[np.ndarray], similar: tuple[int, int]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs of sets whose shared part of their union is at least similar[0] / similar[1]."""
    size = np.array([len(s) for s in sets], np.int64)
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.cumsum(size) - size
    own = [flat[i : i + n] for i, n in zip(cuts.tolist(), size.tolist())]
    owner, marked = np.repeat(np.arange(len(sets)), size), np.zeros(len(values), bool)
    rest, edges = np.arange(len(sets)), []
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            marked[own[x]] = True
            both = np.bincount(owner[marked[flat]], minlength=len(sets))
            marked[own[x]] = False
            near = both[rest] * similar[1] >= (size[x] + size[rest] - both[rest]) * similar[0]
            if near.any():
                got = rest[near].tolist()
                edges += [(x, y) for y in got]
                queue += got
                rest = rest[~near]
                left = np.zeros(len(sets), bool)
                left[rest] = True
                keep = left[owner]
                flat, owner = flat[keep], owner[keep]
    return edges


def similar_edges(texts: DataFrame, words: int, similar: tuple[int, int]) -> DataFrame:
    """Edges (a, b) between marks of similar texts within each of texts (group, c1, c2, mark, text)."""
    runtime.ship(texts.sparkSession)

    def run(rows: pa.Table) -> pa.Table:
        # Texts are read one at a time, in the order of their marks: no other copy of them is made.
        marks, held = rows.column("mark").to_numpy(), rows.column("text")
        large = rows.nbytes > 8 << 20
        order = np.argsort(marks, kind="stable")
        raw = lambda i: b"" if (t := held[i].as_buffer()) is None else t.to_pybytes()
        sets = [np.unique(shingle_hashes(raw(int(i)), words)) for i in order]
        marks = marks[order]
        del rows, held
        e = np.array(similar_forest(sets, similar), np.int64).reshape(-1, 2)
        del sets
        if large:
            runtime.tidy()
        return pa.table({"a": marks[e[:, 0]], "b": marks[e[:, 1]]})

    return texts.groupBy("group", "c1", "c2").applyInArrow(run, "a long, b long")


def similar_texts(df: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 5, lanes: int = 4, distance: int = 64,
    likely: int = 48, similar: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row per input row: id and component_id, the smallest id that can be reached over similar texts.

    Texts are similar if the sets of their shingles share similar[0] / similar[1] or more of their union,
    which is counted exactly for all pairs of a candidate component. Candidates are fingerprints (of the
    sets) at `distance` or fewer unlike bits that meet under a key; keys are drawn with a recall of 0.99
    at `likely` unlike bits. Texts of one set are one node, null and empty texts too. Null ids never name
    a component but one of null ids only. A text is read whole by one task, however long; a component of many
    or long texts is compared in pairs of chunks. Other columns are not read. An empty table gives no rows.
    """
    cols = [f"f{i}" for i in range(lanes)]
    with runtime.Scope(df.sparkSession) as scope:
        prints = scope.keep(runtime.stage(set_fingerprints(df, id_col, text, words, lanes, similar), "prints"))
        classes, rows = set_classes(df, prints, id_col, text, words, cols, distance, likely, similar)
        scope.keep(classes)
    return runtime.join_counted(prints.select(id_col, "mark"), classes, ["mark"], "copies", rows).select(id_col, "component_id")


def set_classes(df: DataFrame, prints: DataFrame, id_col: str, text: str, words: int, cols: list[str], distance: int, likely: int,
        similar: tuple[int, int]) -> tuple[DataFrame, int]:
    """Distinct sets of shingles (mark, copies, component_id), staged, and the number of rows. What is made on the way goes as soon as it is read."""
    lanes = len(cols)
    nodes = prints.groupBy("mark", "size", "keys", *cols).agg(F.min(id_col).alias("least_id"), F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"))
    nodes = runtime.stage(nodes.withColumn("node", F.xxhash64(*cols)), "nodes")
    # A smaller set is similar to none but its equals.
    n, rows = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0))).first()
    likes = nodes.where(F.col("size") * (similar[1] - similar[0]) >= similar[0])
    one = lambda s: F.xxhash64(*(F.col(f"{s}{i}") for i in range(lanes)))
    with runtime.Scope(df.sparkSession) as scope:
        found = link(likes.select(*cols, "keys").distinct(), distance, masks_sampled(lanes, n, likely / (64 * lanes)))
        roots = scope.keep(runtime.stage(connected_components(found.select(one("a").alias("a"), one("b").alias("b"))), "roots"))
    with runtime.Scope(df.sparkSession) as scope:
        held = likes.join(roots, "node", "left").select(F.coalesce("root", "node").alias("group"), "mark", "size", "row")
        chunks = F.ceil(F.greatest(F.col("n") / CHUNK_TEXTS, F.col("total") / CHUNK_SHINGLES)).cast("int")
        groups = held.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total")).where("n > 1").select("group", chunks.alias("chunks"), "n")
        wanted = runtime.stage(runtime.join_counted(held, groups, ["group"], "n", n), "candidates")
        texts = df.select(F.xxhash64(df[id_col], df[text]).alias("row"), df[text].alias("text")).join(wanted, "row").dropDuplicates(["mark"])
        texts = texts.withColumn("own", F.pmod("mark", "chunks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        edges = similar_edges(texts.select("group", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"), "mark", "text"), words, similar)
        roots = connected_components(edges).withColumnRenamed("node", "mark")
        linked = scope.keep(runtime.stage(nodes.join(roots, "mark").select("mark", "root", "least_id"), "linked"))
    least = linked.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    linked = runtime.join_counted(linked, least, ["root"], "n", n).select("mark", "component_id")
    classes = nodes.join(linked, "mark", "left").select("mark", "copies", F.coalesce("component_id", "least_id").alias("component_id"))
    return runtime.stage(classes, "classes"), rows
