"""Connected components of a graph of numbered nodes, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costquarry.llm import runtime

from costquarry.llm.runtime import drop_staged, join_counted, stage


#: Edges that one task thins at once.
EDGES_A_TASK = 250_000


def thinned(edges: DataFrame, rows: int) -> DataFrame:
    """Of edges (u, v), of which there are about `rows`, a spanning forest of each EDGES_A_TASK of them: what they connect stays connected."""
    runtime.ship(edges.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}
        seen = 0
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b.column("u").to_pylist(), b.column("v").to_pylist())):
                while (p := above.get(x, x)) != x:
                    above[x] = x = above.get(p, p)
                while (p := above.get(y, y)) != y:
                    above[y] = y = above.get(p, p)
                if x != y:
                    above[x] = y
                    keep.append(i)
            if keep:
                yield b.take(pa.array(keep, pa.int64()))
            seen += b.num_rows
            if seen >= EDGES_A_TASK:
                above, seen = {}, 0
        runtime.tidy()

    return edges.select("u", "v").coalesce(max(1, -(-rows // EDGES_A_TASK))).mapInArrow(run, "u long, v long")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Rows (node, root) for each node with an edge; root is the smallest node that can be reached.

    Loops, repeated edges and nulls are dropped first, and edges between nodes that others of a bounded part of
    the edges connect already. Each round gives a node's neighbours to its
    smallest neighbour; minima are aggregated where the edges lie, and the few nodes with a large share of
    all edges have theirs sent to the edges, so no task gathers a node's neighbours. Rounds are written to
    the shared folder; the edges never come to the driver. No edges: no rows.
    """
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    raw = stage(pair.where("u > v"), "edges")
    now = stage(thinned(raw, raw.count()).distinct(), "edges")
    drop_staged(raw)
    seen, size = None, now.count()
    for _ in range(most_rounds):
        both = now.union(now.select("v", "u"))
        smallest = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = join_counted(both, smallest, ["u"], "n", 2 * size).where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large", 2 * size)
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = join_counted(large, low, ["u"], "n", large.count())
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        after = stage(small.where("u > v").distinct(), "edges", 2 * size)
        mark = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_staged(now)
        drop_staged(large)
        runtime.clean(edges.sparkSession)
        now = after
        if mark == seen:
            break
        seen, size = mark, mark[0]
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
