"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product is nearest distance once every vector is given one more component that brings it to the longest
vector's length; a query's own is 0 and its length does not matter, so all are taken as of length 1. A table's hash is
a few Gaussian projections, each cut into slots of one width at a random offset. A query visits, in each table, the
buckets in the order of the estimated probability that its k-th neighbour is there, by the normal distribution of
the neighbour's projections around its own, until the probabilities add up to what the tables together need to
find it with the probability `target`. Candidates are scored by the inner product of the vectors themselves, in
double precision, and those of all tables are merged.

Rows and probes meet in tiles: a cell is what agrees in the first few slots of a table, and rows and queries of a
cell are dealt into tiles of bounded size, however many one cell has. A tile gives its k best for each query, never
its pairs. Of vectors that are equal only the k + 1 smallest ids can be among the k nearest of anything, so a vector
on a third of all rows is indexed k + 1 times. A query that finds fewer than k rows is compared with all.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costquarry.llm import runtime

TABLES, WIDTH, TARGET = 8, 2.0, 0.93
BUCKET, CELL = 128, 65536  #: rows that a bucket and a cell are meant to have; they may have any number
TILE_ROWS, TILE_BYTES = 65536, 32 << 20
SAMPLE_ROWS = 2000  #: vectors by which a query estimates how near its k-th neighbour is, the first by hash; all rows are indexed
LEAST = 1e-4  # slots that are less probable are not visited


class Hashes(NamedTuple):
    """Projections of all tables with what is known of the data."""

    plane: np.ndarray  # (tables * slots, dim + 1)
    offset: np.ndarray
    weight: np.ndarray  # of a slot in the number of a bucket
    slots: int
    cell_slots: int  # the first ones, which make the cell
    longest: float
    ids: np.ndarray  # of the sample
    sample: np.ndarray
    share: float  # k of all rows


def usable(df: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(id, v, n2, size): vectors with an id that are neither null nor zero and hold neither nulls nor other than finite numbers."""
    kind = df.schema[vec].dataType.simpleString()
    v = df[vec] if kind in ("array<float>", "array<double>") else df[vec].cast("array<double>")
    rows = df.select(df[id_col].alias("id"), v.alias("v")).where(F.col("id").isNotNull())
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    n2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return rows.where(F.coalesce(fine, F.lit(False))).select("id", "v", n2.alias("n2"), F.size("v").alias("size"))


def lifted(v: np.ndarray, longest: float) -> np.ndarray:
    """Vectors at length 1: shorter ones by one more component."""
    v = v / longest
    return np.column_stack([v, np.sqrt(np.maximum(0, 1 - (v * v).sum(axis=1)))])


def fit(rows: DataFrame, n: int, dim: int, longest: float, k: int, seed: int = 5) -> Hashes:
    """Projections for n rows: as many slots as make buckets of about BUCKET rows; and a bounded sample."""
    some = runtime.smallest_hashes(rows, F.struct("id", "v"), SAMPLE_ROWS).orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE_ROWS).collect()
    x = lifted(np.array([r.v for r in some], np.float64), longest)
    slots, cell = (max(0, math.ceil(math.log2(max(1, n / size)))) for size in (BUCKET, CELL))
    rng = np.random.default_rng(seed)
    weight = rng.integers(1 << 40, 1 << 55, slots, dtype=np.int64) | 1
    return Hashes(rng.normal(0, 1, (TABLES * slots, dim + 1)), rng.uniform(0, WIDTH, TABLES * slots), weight, slots, min(cell, slots), longest,
        np.array([r.id for r in some]), x.astype(np.float32), min(1.0, k / max(n, 1)))


def placed(h: Hashes, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and bucket of each vector in each table."""
    slot = np.floor((x @ h.plane.T + h.offset) / WIDTH).astype(np.int64).reshape(len(x), -1, h.slots) if h.slots else np.zeros((len(x), 1, 0), np.int64)
    return slot[:, :, : h.cell_slots] @ h.weight[: h.cell_slots], slot @ h.weight


def normal(x: np.ndarray) -> np.ndarray:
    """The normal distribution function, to about 3e-4."""
    return 0.5 * (1 + np.tanh(math.sqrt(2 / math.pi) * (x + 0.044715 * x**3)))


def visited(sure: float, others: list[list[tuple[float, int, int]]], cell: int, bucket: int, target: float) -> list[tuple[int, int]]:
    """(cell, bucket) in falling order of probability until the probabilities add up to the target.

    sure: probability of the likeliest bucket, which is given. others: for each slot its other places, as (loss of log
    probability, change of cell, change of bucket), by loss; the slots by the loss of their first. A state is what it
    changes up to slot i; it is followed by the next place of slot i, by a change of slot i + 1 besides, and by one of
    slot i + 1 instead, none of which is likelier, and by which each combination comes up once.
    """
    out, total, heap = [(cell, bucket)], sure, []
    if others:
        loss, dc, db = others[0][0]
        heap.append((loss, 0, 0, cell + dc, bucket + db))
    while heap and total < target:
        loss, i, j, c, b = heapq.heappop(heap)
        out.append((c, b))
        total += sure * math.exp(-loss)
        own = others[i]
        l0, c0, b0 = own[j]
        if j + 1 < len(own):
            l1, c1, b1 = own[j + 1]
            heapq.heappush(heap, (loss - l0 + l1, i, j + 1, c - c0 + c1, b - b0 + b1))
        if i + 1 < len(others):
            l1, c1, b1 = others[i + 1][0]
            heapq.heappush(heap, (loss + l1, i + 1, 0, c + c1, b + b1))
            if j == 0:
                heapq.heappush(heap, (loss - l0 + l1, i + 1, 0, c - c0 + c1, b - b0 + b1))
    return out


def nearness(h: Hashes, x: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The cosine of each query and its k-th neighbour, estimated by the sample.

    That is the sample's at the same share of rows; where this is less than one row, the line through its fifth and
    fiftieth, over the normal quantiles of their shares, is carried on.
    """
    score = x.astype(np.float32) @ h.sample.T
    score[own[:, None] == h.ids[None]] = -1
    score = -np.sort(-score, axis=1)
    m = score.shape[1]
    if h.share * m >= 1:
        near = score[:, min(math.ceil(h.share * m), m) - 1]
    else:
        at = lambda p: NormalDist().inv_cdf(1 - p)
        high, low = score[:, min(4, m - 1)], score[:, min(49, m - 1)]
        near = high + (high - low) * (at(max(h.share, 1e-12)) - at(5 / m)) / (at(5 / m) - at(50 / m)) if m > 100 else high
    return np.clip(near, 0.05, 0.95).astype(np.float64)


def probes(h: Hashes, x: np.ndarray, own: np.ndarray, target: float = TARGET) -> Iterator[list[list[tuple[int, int]]]]:
    """For each query (x, of length 1; own: its id), for each table, the buckets it visits."""
    if not h.slots:
        yield from ([[(0, 0)]] for _ in x)
        return
    near = nearness(h, x, own)
    spread = np.sqrt(1 - near**2)
    at = near[:, None] * (x @ h.plane.T) + h.offset  # where the neighbour's projections are expected
    home = np.floor(at / WIDTH).astype(np.int64)
    reach = np.arange(-3, 5)
    edges = ((home[:, :, None] + reach) * WIDTH - at[:, :, None]) / spread[:, None, None]
    share = np.maximum(np.diff(normal(edges), axis=2), 1e-12)  # of slots home - 3 .. home + 3
    order = np.argsort(-share, axis=2, kind="stable")
    share = np.take_along_axis(share, order, 2)
    first, step = (home + reach[order[:, :, 0]]).tolist(), (order - order[:, :, :1]).tolist()
    losses, likely = np.log(share[:, :, :1] / share).tolist(), (share >= LEAST).sum(axis=2).tolist()
    sure = share[:, :, 0].reshape(len(x), TABLES, h.slots).prod(axis=2).tolist()
    per_table = 1 - (1 - target) ** (1 / TABLES)
    weights = [(int(w), int(w) if i < h.cell_slots else 0) for i, w in enumerate(h.weight)]
    for q in range(len(x)):
        tables = []
        for t in range(TABLES):
            cell, bucket, others = 0, 0, []
            for (w, c), col in zip(weights, range(t * h.slots, (t + 1) * h.slots)):
                bucket += first[q][col] * w
                cell += first[q][col] * c
                if likely[q][col] > 1:
                    others.append([(losses[q][col][s], step[q][col][s] * c, step[q][col][s] * w) for s in range(1, likely[q][col])])
            others.sort(key=lambda more: more[0][0])
            tables.append(visited(sure[q][t], others, cell, bucket, per_table))
        yield tables


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def index(rows: DataFrame, h: Hashes, dim: int) -> DataFrame:
    """id, v and `at`: (table_no, cell, bucket) of each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 2048) for i in range(0, whole.num_rows, 2048)):
                cell, bucket = placed(h, lifted(_matrix(b.column("v"), dim), h.longest))
                n, tables = cell.shape
                at = pa.StructArray.from_arrays([pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), pa.array(cell.reshape(-1)),
                    pa.array(bucket.reshape(-1))], ["table_no", "cell", "bucket"])
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * tables), at)], ["id", "v", "at"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("id", "v").mapInArrow(run, f"id {kinds['id']}, v {kinds['v']}, at array<struct<table_no:int,cell:bigint,bucket:bigint>>")


def probed(rows: DataFrame, h: Hashes, dim: int, target: float) -> DataFrame:
    """id, v and `at`: (table_no, cell, buckets) of each table and cell that the query visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                v = _matrix(b.column("v"), dim)
                x = np.column_stack([v / np.sqrt((v * v).sum(axis=1))[:, None], np.zeros(len(v))])
                out = []
                for tables in probes(h, x, b.column("id").to_numpy(), target):
                    cells: dict[tuple[int, int], list[int]] = {}
                    for t, buckets in enumerate(tables):
                        for c, k in buckets:
                            cells.setdefault((t, c), []).append(k)
                    out.append([{"table_no": t, "cell": c, "buckets": ks} for (t, c), ks in cells.items()])
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(out, kind)], ["id", "v", "at"])

    kind = pa.list_(pa.struct([("table_no", pa.int32()), ("cell", pa.int64()), ("buckets", pa.list_(pa.int64()))]))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("id", "v").mapInArrow(run, f"id {kinds['id']}, v {kinds['v']}, at array<struct<table_no:int,cell:bigint,buckets:array<bigint>>>")


def best(q: np.ndarray, p: np.ndarray, s: np.ndarray, ids: np.ndarray | None, k: int, slack: np.ndarray) -> tuple:
    """Of (query, row, score) those that are, or within the slack may be, among a query's k largest by distinct id; and its k-th score.

    ids: of the rows, if some repeat.
    """
    if ids is not None:
        order = np.lexsort((-s, ids[p], q))
        q, p, s = q[order], p[order], s[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (ids[p[1:]] != ids[p[:-1]])
        q, p, s = q[new], p[new], s[new]
    order = np.lexsort((-s, q))
    q, p, s = q[order], p[order], s[order]
    begin = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    size = np.diff(np.r_[begin, len(q)])
    low = np.full(len(slack), -np.inf)
    full = size >= k
    low[q[begin[full]]] = s[begin[full] + k - 1]
    low -= slack
    keep = s >= low[q]
    return q[keep], p[keep], s[keep], low


def tile(points: pa.Table, queries: pa.Table, dim: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, row id, score) of the k largest inner products of each query with the rows in buckets it visits, its own id left out."""
    ids, own = points.column("id").to_numpy(), queries.column("id").to_numpy()
    v, x = _matrix(points.column("v"), dim), _matrix(queries.column("v"), dim)
    bucket = points.column("bucket").to_numpy()
    order = np.argsort(bucket, kind="stable")
    ids, v = ids[order], v[order]
    repeated = ids if len(np.unique(ids)) < len(ids) else None
    there, begin, size = np.unique(bucket[order], return_index=True, return_counts=True)
    asked = queries.column("buckets").combine_chunks()
    b, q = asked.flatten().to_numpy(), np.repeat(np.arange(len(own)), pa.compute.list_value_length(asked).to_numpy(zero_copy_only=False))
    at = np.searchsorted(there, b)
    hit = (at < len(there)) & (there[np.minimum(at, len(there) - 1)] == b)
    at, q = at[hit], q[hit]
    order = np.argsort(at, kind="stable")
    at, q = at[order], q[order]
    slack = 1e-10 * np.sqrt((x * x).sum(axis=1)) * math.sqrt((v * v).sum(axis=1).max(initial=0))
    low, held, count = np.full(len(x), -np.inf), [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))], 0
    edges = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else []
    most = 1024 + 8 * k * len(x)  # pairs that are held before the k best are taken, which raises what later ones have to reach
    for e, f in zip(edges, [*edges[1:], len(at)]):
        who, first, last = q[e:f], begin[at[e]], begin[at[e]] + size[at[e]]
        step = max(1, (1 << 20) // len(who))
        for lo in range(first, last, step):
            hi = min(lo + step, last)
            score = x[who] @ v[lo:hi].T
            score[own[who][:, None] == ids[None, lo:hi]] = -np.inf
            r, c = np.nonzero(score >= np.maximum(low[who], -1e308)[:, None])
            held.append((who[r], lo + c, score[r, c]))
            count += len(r)
            if count > most:
                *one, low = best(*(np.concatenate(a) for a in zip(*held)), repeated, k, slack)
                held, count = [tuple(one)], 0
    q, p, _, _ = best(*(np.concatenate(a) for a in zip(*held)), repeated, k, slack)
    # Rows of equal vectors get the same number here, unlike in a product of matrices.
    score = np.concatenate([np.empty(0), *((x[q[i : i + 65536]] * v[p[i : i + 65536]]).sum(axis=1) for i in range(0, len(q), 65536))])
    order = np.lexsort((ids[p], -score, q))
    q, p, score = q[order], p[order], score[order]
    begin = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(begin, np.diff(np.r_[begin, len(q)]))
    keep = rank < k
    return own[q[keep]], ids[p[keep]], score[keep]


def tiles(points: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """(query_id, vec_id, score) of all tiles: points (table_no, cell, bucket, id, v), queries (table_no, cell, buckets, id, v)."""
    rows = min(TILE_ROWS, max(1, TILE_BYTES // (8 * dim)))
    key = ["table_no", "cell"]
    count = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))
    # A row for each cell that is visited; whether it is sent to all is left to its size.
    sizes = runtime.stage(count(points, "chunks").join(count(queries, "blocks"), key), "cells")
    dealt = lambda n: F.pmod(F.xxhash64("id", "v"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = points.join(sizes, key).select(*key, dealt("chunks").alias("chunk"), every("blocks").alias("block"), "bucket", "id", "v")
    right = queries.join(sizes, key).select(*key, every("chunks").alias("chunk"), dealt("blocks").alias("block"), "buckets", "id", "v")

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not (a.num_rows and b.num_rows):
            return pa.table([pa.array([], t) for t in (kind, kind, pa.float64())], names=["query_id", "vec_id", "score"])
        who, what, score = tile(a, b, dim, k)
        return pa.table([pa.array(who, kind), pa.array(what, kind), pa.array(score)], names=["query_id", "vec_id", "score"])

    kind = pa.int64()
    by = [*key, "chunk", "block"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, "query_id long, vec_id long, score double")


def nearest(points: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec: str = "embedding", k: int = 20, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest inner product found for each query, ties to the smaller id.

    Ids are whole numbers. Vectors that are null, zero or empty or hold a null or a number that is not finite take no
    part, nor do rows with a null id, nor vectors of another length than most have (of equally many, the longer). A
    query's own rows, those with its id, are left out. Repeated rows count once; of an id with several vectors the
    nearest counts, on either side. With fewer than k other ids all are returned. Empty tables give no rows; other
    columns are not read.
    """
    spark = points.sparkSession
    runtime.ship(spark)
    narrow = lambda df: usable(df, id_col, vec).withColumn("id", F.col("id").cast("long"))
    rows, asked = narrow(points), narrow(queries)
    most = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max("n2").alias("n2")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    if not most:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, longest = most[0]["size"], math.sqrt(most[0].n2)
    rows, asked = (df.where(F.col("size") == dim).select("id", "v").distinct() for df in (rows, asked))
    # Equal vectors meet by their hash first, so that few are compared by their components.
    same = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id")
    rows = rows.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1).select("id", "v")
    # Probes take time by the row, of which there are few: they are dealt to all partitions.
    asked = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")
    with runtime.Scope(spark) as scope:
        return scope.keep(_found(runtime.stage(rows, "vectors"), asked, dim, longest, k, target))


def _found(rows: DataFrame, asked: DataFrame, dim: int, longest: float, k: int, target: float) -> DataFrame:
    """The k best rows of each query asked, staged."""
    h = fit(rows, rows.count(), dim, longest, k)
    table = runtime.stage(index(rows, h, dim), "index")
    visits = runtime.stage(probed(asked, h, dim, target), "probes")
    hits = runtime.stage(_merged(tiles(table.select("id", "v", F.inline("at")), visits.select("id", "v", F.inline("at")), dim, k), k), "hits")
    if not h.slots:
        return hits
    counts = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    short = visits.select("id", "v").join(counts.where(F.col("n") >= k), F.col("id") == F.col("query_id"), "left_anti")
    short = runtime.stage(short, "short")
    if not short.limit(1).count():
        return hits
    zero = (F.lit(0).alias("table_no"), F.lit(0).cast("long").alias("cell"))
    whole = tiles(table.select(*zero, F.lit(0).cast("long").alias("bucket"), "id", "v"),
        short.select(*zero, F.array(F.lit(0).cast("long")).alias("buckets"), "id", "v"), dim, k)
    rest = hits.join(short.select("id").distinct(), F.col("id") == F.col("query_id"), "left_anti")
    return runtime.stage(rest.unionByName(_merged(whole, k)), "hits")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of all tiles: a query's rows come together once."""
    each = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def every(df: DataFrame, n: int, id_col: str = "vec_id") -> Column:
    """Rows that are queries: those with an id divisible by n."""
    return df[id_col] % n == 0


import pyarrow.compute  # noqa: E402,F401  (pa.compute is a submodule)
