"""Mixing sources to target weights by pivotal dependent rounding.

Each document has an expected number of copies, target / size of its source. The whole part is taken;
the fractional parts are paired one after another: mass, counted in words, moves from one of the pair
to the other at random (fair in expectation) until one of the two is integral, and the other goes on to
the next pair. Long texts come first, so that the one left over is short. So the words of a block stay as they are, but for one document that is left over.
Those residuals are rounded the same way in the blocks of the next level of a reduction tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costquarry.llm.runtime import ship, stage

BLOCK = 1024
WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
TINY = 1e-9


def word_count(text: Column) -> Column:
    """Runs of other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Adds weight and target to a table (source, source_size).

    Sources by code point, null last, have the weights in turn and share the sum of all sizes; a target
    stops at cap times its source's size and the excess goes to the others by weight, until none is
    above. That is target = min(cap * size, level * weight): with the sources ordered by the level at
    which they stop, the level is where the first that doesn't stop is found. One row per source; the
    windows run over this table only.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    t = sources.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy((F.col("_cap") / F.col("weight")), F.col("source").isNull(), F.col("source"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    open_weight = F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight")
    left = F.sum("source_size").over(whole) - (F.sum("_cap").over(upto) - F.col("_cap"))
    t = t.withColumn("_level", left / open_weight).withColumn("_stops", F.col("_cap") / F.col("weight") < F.col("_level"))
    level = F.min(F.when(~F.col("_stops"), F.struct(F.col("_cap") / F.col("weight"), F.col("_level")))).over(whole)
    t = t.withColumn("_final", level.getField("_level"))
    return t.select("source", "source_size", "n_docs", "weight", F.least(F.col("_cap"),
        F.coalesce(F.col("_final") * F.col("weight"), F.col("_cap"))).alias("target"))


def pivot(share: np.ndarray, size: np.ndarray, draw: np.ndarray) -> int:
    """Round fractional shares in place, keeping sum(share * size) but for the one whose place is returned (-1: none left)."""
    held = -1
    for i in range(len(share)):
        if share[i] <= TINY or share[i] >= 1 - TINY:
            share[i] = round(share[i])
            continue
        if held < 0:
            held = i
            continue
        j, a, b = held, size[held], size[i]
        up = min((1 - share[j]) * a, share[i] * b)  # words that can move to the one held
        down = min(share[j] * a, (1 - share[i]) * b)
        move = up if draw[i] * (up + down) < down else -down
        share[j] += move / a
        share[i] -= move / b
        whole = [k for k in (j, i) if share[k] <= TINY or share[k] >= 1 - TINY]
        for k in whole:
            share[k] = round(share[k])
        held = -1 if len(whole) == 2 else i if whole == [j] else j
    return held


def _unit(key: Column, seed: int, salt: str) -> Column:
    """A number in [0, 1) that depends on the key, the seed and the salt only."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(salt), F.lit(seed), key), 11)).cast("double") / float(1 << 53)


def round_blocks(open_rows: DataFrame, blocks: Column, level: int, seed: int) -> DataFrame:
    """One level of the tree: rows (source, key, size, share) are dealt into blocks and rounded; share stays fractional for one a block."""
    salt = f"level {level}"
    block = F.when(blocks <= 1, F.lit(0)).otherwise(F.pmod(F.xxhash64(F.lit(salt), F.lit(seed), F.col("key")), blocks)).cast("int")
    cols = ["source", "doc_id", "key", "size", "share"]
    dealt = open_rows.withColumn("_block", block).withColumn("_draw", _unit(F.col("key"), seed, salt + " draw"))
    dealt = dealt.repartition("source", "_block").sortWithinPartitions("source", "_block", F.desc("size"), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def rounded(t: pa.Table) -> pa.RecordBatch:
            share = t.column("share").to_numpy().copy()
            pivot(share, t.column("size").to_numpy().astype(np.float64), t.column("_draw").to_numpy())
            return pa.RecordBatch.from_arrays([*(t.column(c).combine_chunks() for c in cols[:4]), pa.array(share)], cols)

        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            source, blk = t.column("source").combine_chunks(), t.column("_block").to_numpy()
            code = source.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((code[1:] != code[:-1]) | (blk[1:] != blk[:-1])) + 1
            for i, j in zip([0, *cuts], cuts):
                yield rounded(t.slice(i, j - i))
            rest = t.slice(cuts[-1] if len(cuts) else 0)
        if rest is not None and rest.num_rows:
            yield rounded(rest)

    kinds = {f.name: f.dataType.simpleString() for f in open_rows.schema}
    return dealt.select(*cols, "_block", "_draw").mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in cols))


def mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS,
    cap: float = CAP, seed: int = 7) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, copies and taken (copies * size).

    Words taken of a source come within about one document of its target; no row has more than
    ceil(cap) copies. Null texts have size 0 and the whole part of copies; a null source is a source of
    its own, last in order. Null or repeated ids: each row is rounded by itself; rows that are equal in
    id, source and size are told apart by a running number, so reruns agree. Of a text only its size is used,
    however long. An empty table gives no rows. Extra columns are not read.
    """
    spark = df.sparkSession
    ship(spark)
    sized = df.select(df[id_col].alias("doc_id"), df[source].cast("string").alias("source"), word_count(df[text]).alias("size"),
        F.xxhash64(df[text]).alias("_mark"))
    sized = stage(sized, "sizes")
    per_source = stage(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))), "targets")
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    twin = Window.partitionBy("doc_id", "_mark", "source").orderBy("size")
    rows = sized.withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "_mark", F.row_number().over(twin)))
    rows = rows.join(per_source.select(F.col("source").alias("_s"), "n_docs", ratio.alias("_ratio")),
        F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "_mark")
    rows = rows.withColumn("whole", F.floor(F.col("_ratio") + F.lit(TINY)).cast("long"))
    rows = rows.withColumn("share", F.when(F.col("size") > 0, F.greatest(F.lit(0.0), F.col("_ratio") - F.col("whole"))).otherwise(F.lit(0.0)))
    most = per_source.agg(F.max("n_docs")).first()[0] or 0
    count = F.col("n_docs") / F.lit(float(BLOCK))
    done, level, blocks = [], 0, most / BLOCK
    now = stage(round_blocks(rows.select("source", "doc_id", "key", "size", "share", "n_docs"), F.ceil(count), 0, seed), "rounded")
    fractional = (F.col("share") > 0) & (F.col("share") < 1)
    while blocks > 1:
        done.append(now.where(~fractional))
        level, blocks = level + 1, blocks / BLOCK
        up = now.where(fractional).join(per_source.select(F.col("source").alias("_s"), "n_docs"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        now = stage(round_blocks(up.select("source", "doc_id", "key", "size", "share", "n_docs"),
            F.ceil(F.col("n_docs") / F.lit(float(BLOCK) ** (level + 1))), level, seed), "rounded")
    # At the root one fractional share a source is left: it is drawn.
    last = F.when(fractional, (_unit(F.col("key"), seed, "root") < F.col("share")).cast("double")).otherwise(F.col("share"))
    done.append(now.withColumn("share", last))
    every = done[0]
    for d in done[1:]:
        every = every.union(d)
    by = per_source.select(F.col("source").alias("_s"), "source_size", "target", F.floor(ratio + F.lit(TINY)).cast("long").alias("whole"))
    out = every.join(by, F.col("source").eqNullSafe(F.col("_s")))
    copies = F.col("whole") + F.round("share").cast("long")
    return out.select(F.col("doc_id").alias(id_col), "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
