"""Four-dimensional clustered layout: documents dealt to files along a z-order of source, lang, length and date.

A value's coordinate is its place among all rows, in eighths; the coordinates' bits make z, and rows go to files by z
and id. How many files a query box touches comes from a difference array over the cells: the box of each file,
dilated by the query's reach on length and date, adds signed corners, which are summed by aggregation, and numpy
prefix sums give the number for every cell at once.

Ranks are global but no task sees all rows: rows are dealt by ranges, numbered inside of a range, and the counts of
the ranges (one row each) are added up. What reaches the driver has a fixed bound: 8 thresholds a dimension, at most
9^4 corners and 8^4 cells. Of files there are as many as the input asks for, so what is known of them stays a table.
"""

from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costquarry.llm.runtime import drop_staged, stage

DIMS = ("source", "lang", "length", "date")
ORDER = ("date", "length", "lang", "source")  # in which a round of bits is laid
REACH = {"source": 0, "lang": 0, "length": 1, "date": 1}
BITS, ROWS_A_FILE = 3, 2000
SIDE = 1 << BITS


def values(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """The four values by which a document is laid, with its id and a hash of its text that orders rows of one id."""
    return df.select(df[id_col].alias("doc_id"), F.xxhash64(df[text]).alias("mark"), df[source].cast("string").alias("source"),
        df[lang].cast("string").alias("lang"), F.coalesce(F.octet_length(df[text]).cast("long"), F.lit(-1).cast("long")).alias("length"),
        (F.crc32(df[id_col].cast("string").cast("binary")) % 365).alias("date"))


def numbered(df: DataFrame, order: list[str], weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """df sorted by ranges of `order`, with _part, the place in it (_place), and a row for each part: _part and _before,
    what earlier parts hold (rows, or the sum of a column). The rows are staged, so that numbers stay what they are.
    """
    run = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    run = stage(run, "ranges")
    staged = run._staged_path
    run = run.select("*", F.shiftright("_m", 33).alias("_part"), (F.col("_m").bitwiseAND((1 << 33) - 1)).alias("_place")).drop("_m")
    held = run.groupBy("_part").agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_held"))
    # As many rows as ranges.
    earlier = F.sum("_held").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = held.select("_part", F.coalesce(earlier, F.lit(0)).alias("_before"))
    run._staged_path = staged
    return run, parts


def thresholds(rows: DataFrame, n: int) -> dict[str, list[tuple[int, object]]]:
    """For each dimension the smallest value of each coordinate that occurs, highest coordinate first.

    Values are counted first, so that a frequent one is one row.
    """
    each = [F.struct(F.lit(k).alias("dim"), (F.col(d) if k < 2 else F.lit(None).cast("string")).alias("word"),
        (F.col(d) if k > 1 else F.lit(None).cast("long")).alias("number")) for k, d in enumerate(DIMS)]
    counts = rows.select(F.inline(F.array(*each))).groupBy("dim", "word", "number").agg(F.count(F.lit(1)).alias("n"))
    run, parts = numbered(counts, ["dim", "word", "number"], "n")
    inside = F.sum("n").over(Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1))
    at = run.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(parts), "_part")
    # Each dimension before holds n rows.
    at = at.withColumn("coordinate", F.expr(f"({SIDE} * (_before + _inside - dim * {n}L)) div {n}L"))
    first = at.groupBy("dim", "coordinate").agg(F.min(F.struct("word", "number")).alias("v")).collect()
    drop_staged(run)
    return {d: sorted(((r.coordinate, r.v[0] if k < 2 else r.v[1]) for r in first if r.dim == k), reverse=True) for k, d in enumerate(DIMS)}


def coordinate(dim: str, firsts: list[tuple[int, object]]) -> Column:
    """A value's coordinate: that of the last threshold that it reaches; null is the smallest value."""
    out = F.lit(0)
    for c, value in reversed(firsts):
        out = F.lit(c) if value is None else F.when(F.col(dim) >= F.lit(value), c).otherwise(out)
    return out.cast("int")


def interleaved(of: dict[str, Column]) -> Column:
    out = F.lit(0)
    for b, d in product(reversed(range(BITS)), ORDER):
        out = out * 2 + F.shiftright(of[d], b).bitwiseAND(1)
    return out


def split(z: Column) -> dict[str, Column]:
    """The coordinates that a z was made of."""
    out = dict.fromkeys(DIMS, F.lit(0))
    for k, (b, d) in enumerate(product(reversed(range(BITS)), ORDER)):
        out[d] = out[d] + F.shiftleft(F.shiftright(z, len(DIMS) * BITS - 1 - k).bitwiseAND(1), b)
    return out


def cell_number(of: dict[str, Column]) -> Column:
    """A cell as one number, dimensions in the order of DIMS."""
    out = F.lit(0)
    for d in DIMS:
        out = out * SIDE + of[d]
    return out


def files_touched(bounds: DataFrame) -> np.ndarray:
    """For each cell of the grid, the number of files whose box meets the query around it; bounds: lo_ and hi_ of each dimension."""
    corners = []
    for far in product((0, 1), repeat=len(DIMS)):
        at = F.lit(0)
        for d, end in zip(DIMS, far):
            edge = F.least(F.col(f"hi_{d}") + REACH[d], F.lit(SIDE - 1)) + 1 if end else F.greatest(F.col(f"lo_{d}") - REACH[d], F.lit(0))
            at = at * (SIDE + 1) + edge
        corners.append(F.struct(at.alias("at"), F.lit((-1) ** sum(far)).alias("sign")))
    signed = bounds.select(F.inline(F.array(*corners))).groupBy("at").agg(F.sum("sign").alias("sum")).collect()
    grid = np.zeros((SIDE + 1) ** len(DIMS), np.int64)
    grid[[r["at"] for r in signed]] = [r["sum"] for r in signed]
    grid = grid.reshape((SIDE + 1,) * len(DIMS))
    for axis in range(len(DIMS)):
        grid = grid.cumsum(axis=axis)
    return grid[(slice(SIDE),) * len(DIMS)].reshape(-1)


def files_matching(held: DataFrame) -> np.ndarray:
    """For each cell, the number of files that hold a row inside of the query around it; held: (file, z), once each."""
    of = {d: F.col(d) for d in DIMS}
    near = held.select("file", *(c.alias(d) for d, c in split(F.col("z")).items()))
    for d, reach in REACH.items():
        if reach:
            near = near.withColumn(d, F.explode(F.sequence(F.greatest(F.col(d) - reach, F.lit(0)), F.least(F.col(d) + reach, F.lit(SIDE - 1)))))
    met = near.select("file", cell_number(of).alias("cell")).distinct().groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()
    out = np.zeros(SIDE ** len(DIMS), np.int64)
    out[[r.cell for r in met]] = [r.n for r in met]
    return out


def layout(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
        rows_a_file: int = ROWS_A_FILE) -> DataFrame:
    """One row per input row: id, z, position, file, files_touched, files_matching, file_bounds.

    Null values, a null text (of length -1) and a null id (with a null date) come before all others. Rows of one z and id
    are ordered by a hash of their texts; rows that are equal in all are exchangeable. Texts are read once, for their
    length and hash; an empty table gives no rows; other columns are not read.
    """
    rows = stage(values(df, id_col, text, source, lang), "values")
    n = rows.count()
    coords = {d: coordinate(d, firsts) for d, firsts in thresholds(rows, n).items()} if n else dict.fromkeys(DIMS, F.lit(0))
    run, parts = numbered(rows.select("doc_id", "mark", interleaved(coords).alias("z")), ["z", "doc_id", "mark"])
    drop_staged(rows)
    placed = run.join(F.broadcast(parts), "_part").select("doc_id", "z", (F.col("_before") + F.col("_place")).alias("position"))
    placed = placed.withColumn("file", F.expr(f"position div {rows_a_file}"))
    # A file is a stretch of z, so there are at most as many pairs as files and cells together.
    held = stage(placed.select("file", "z").distinct(), "held")
    of = split(F.col("z"))
    bounds = held.groupBy("file").agg(*(f(of[d]).alias(f"{name}_{d}") for d in DIMS for name, f in (("lo", F.min), ("hi", F.max))))
    touched, matching = files_touched(bounds), files_matching(held)
    cells = df.sparkSession.createDataFrame([(int(c), int(touched[c]), int(matching[c])) for c in np.flatnonzero(matching)],
        "cell int, files_touched long, files_matching long")
    bounds = bounds.select("file", F.concat_ws(",", *(f"{name}_{d}" for d in DIMS for name in ("lo", "hi"))).alias("file_bounds"))
    # The cells' table has at most 8^4 rows; that of files grows with the input, so it is not sent to all.
    out = placed.withColumn("cell", cell_number(of)).join(F.broadcast(cells), "cell").join(bounds.hint("shuffle_hash"), "file")
    return out.select(F.col("doc_id").alias(id_col), F.col("z").cast("long").alias("z"), "position", "file", "files_touched", "files_matching", "file_bounds")


def write_files(df: DataFrame, places: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the rows of df as the files of a layout, a folder each; ids have to be unique and not null."""
    rows = df.join(places.select(F.col(id_col).alias("_id"), "file", "position"), df[id_col] == F.col("_id")).drop("_id")
    rows.repartition("file").sortWithinPartitions("file", "position").drop("position").write.partitionBy("file").parquet(path)


def _step(c: str, n: int = 8) -> str:
    """SQL of n steps of a CRC-32 over the bits of c."""
    return f"list_reduce(list_prepend({c}, {[0] * n}::BIGINT[]), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)"


def _z() -> str:
    return " + ".join(f"((c_{d} >> {b}) & 1) * {1 << len(DIMS) * BITS - 1 - k}" for k, (b, d) in enumerate(product(reversed(range(BITS)), ORDER)))


_MEETS = " AND ".join(f"b.lo_{d} <= c.c_{d} + {r} AND b.hi_{d} >= c.c_{d} - {r}" for d, r in REACH.items())
_INSIDE = " AND ".join(f"h.c_{d} BETWEEN c.c_{d} - {r} AND c.c_{d} + {r}" for d, r in REACH.items())
_CELL = ", ".join(f"c_{d}" for d in DIMS)
ORACLE = f"""
WITH v AS (SELECT doc_id, source, lang, coalesce(strlen(text), -1) AS length,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
            lambda c, byte: {_step("xor(c, byte)")}), 4294967295::BIGINT) % 365 AS date FROM documents),
r AS (SELECT doc_id, {", ".join(f"8 * (rank() OVER (ORDER BY {d} NULLS FIRST) - 1) // count(*) OVER () AS c_{d}" for d in DIMS)} FROM v),
z AS (SELECT *, {_z()} AS z FROM r),
p AS (SELECT *, row_number() OVER (ORDER BY z, doc_id NULLS FIRST) - 1 AS position FROM z),
f AS (SELECT *, position // {ROWS_A_FILE} AS file FROM p),
b AS (SELECT file, {", ".join(f"min(c_{d}) AS lo_{d}, max(c_{d}) AS hi_{d}" for d in DIMS)} FROM f GROUP BY file),
h AS (SELECT DISTINCT file, {_CELL} FROM f),
c AS (SELECT DISTINCT {_CELL} FROM f),
t AS (SELECT {", ".join(f"c.c_{d}" for d in DIMS)}, count(*) AS files_touched FROM c JOIN b ON {_MEETS} GROUP BY ALL),
m AS (SELECT {", ".join(f"c.c_{d}" for d in DIMS)}, count(DISTINCT h.file) AS files_matching FROM c JOIN h ON {_INSIDE} GROUP BY ALL)
SELECT f.doc_id, f.z::BIGINT AS z, f.position::BIGINT AS position, f.file::BIGINT AS file, files_touched, files_matching,
    concat_ws(',', {", ".join(f"lo_{d}, hi_{d}" for d in DIMS)}) AS file_bounds
FROM f JOIN b USING (file) JOIN t USING ({_CELL}) JOIN m USING ({_CELL})
"""
