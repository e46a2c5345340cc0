"""Line dedup by distinct-site spread, with DataFrame functions only.

Each line hash gathers a HyperLogLog sketch of the sites it stands on; sketches merge by aggregation, so
a line on a third of all rows costs as much as any other. Lines whose estimate is too near the threshold
for the sketch's error get exact distinct counts: too near is within SIGMAS standard errors, so that of the
lines outside, decided by their estimate, about two in 10^9 at the very edge are decided wrongly. (Up to some
dozens of sites a sketch is exact.) Lines on enough sites are boilerplate and are cut out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costquarry.llm.runtime import stage

MIN_SITES = 8
LG_K = 9
SIGMAS = 6


def line_key(line: Column) -> Column:
    """Hash of a line without surrounding blanks, tabs and carriage returns."""
    return F.xxhash64(_bare(line))


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def boilerplate(keys: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """Keys of a table (key, site) that stand on at least min_sites distinct sites: rows (key, sites); far from the threshold `sites` is estimated."""
    error = SIGMAS * 1.04 / 2 ** (lg_k / 2)
    spread = keys.groupBy("key").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch")).select("key", F.hll_sketch_estimate("sketch").alias("sites"))
    spread = stage(spread.where(F.col("sites") >= min_sites * (1 - error) - 1), "spread")
    sure = spread.where(F.col("sites") > min_sites * (1 + error) + 1)
    near = spread.where(F.col("sites") <= min_sites * (1 + error) + 1).select("key")
    exact = keys.join(near, "key", "left_semi").groupBy("key", "site").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("one").alias("sites"))
    return sure.union(exact.where(F.col("sites") >= min_sites))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """One row per input row: id, text without boilerplate lines, n_lines, n_removed.

    Lines end at \\n; they are compared without surrounding blanks. Lines without other characters are
    never boilerplate. A null site is a site of its own. Null text: null, 0 lines. Repeated rows are
    kept; a null id is an id like any other. All copies of a boilerplate line go, the first too. A text is
    one row, however long; of its lines only hashes are shuffled. An empty table gives no rows. Other
    columns are not read.
    """
    # Rows of one id are told apart by their texts, so that an id on many rows is many keys.
    docs = df.select(df[id_col].alias("_i"), df[text].alias("_t"), F.xxhash64(df[text]).alias("_m"),
        F.coalesce(df[site].cast("string"), F.lit("\u0000")).alias("site"))
    line = docs.select("_i", "_m", "site", F.explode(F.split("_t", "\n", -1)).alias("line")).where(_bare(F.col("line")) != "")
    keys = stage(line.select("_i", "_m", "site", line_key(F.col("line")).alias("key")), "lines")
    common = stage(boilerplate(keys, min_sites, lg_k), "boilerplate")
    # Of a document only the boilerplate keys that it holds are gathered.
    held = keys.join(common, "key", "left_semi").groupBy(F.col("_i").alias("_j"), F.col("_m").alias("_n")).agg(F.collect_set("key").alias("_keys"))
    parts = F.split("_t", "\n", -1)
    kept = F.filter(parts, lambda x: (_bare(x) == "") | ~F.array_contains("_keys", line_key(x)))
    out = docs.join(held, F.col("_i").eqNullSafe(F.col("_j")) & (F.col("_m") == F.col("_n")), "left")
    out = out.withColumn("_kept", F.when(F.col("_keys").isNotNull(), kept))
    clean = F.when(F.col("_keys").isNull(), F.col("_t")).otherwise(F.array_join("_kept", "\n"))
    n = F.when(F.col("_t").isNull(), F.lit(0)).otherwise(F.size(parts))
    removed = F.when(F.col("_keys").isNull(), F.lit(0)).otherwise(F.size(parts) - F.size("_kept"))
    return out.select(F.col("_i").alias(id_col), clean.alias(text), n.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))


#: The same by exact distinct counts.
ORACLE = f"""
WITH lines AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents),
     bare AS (SELECT coalesce(source, chr(0)) AS site, trim(line, ' ' || chr(9) || chr(13)) AS line FROM lines),
     common AS (SELECT list(line) AS all_lines FROM (SELECT line FROM bare WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES})),
     cut AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts,
                    list_filter(string_split(text, chr(10)), lambda x: NOT coalesce(list_contains(all_lines, trim(x, ' ' || chr(9) || chr(13))), false)) AS kept
             FROM documents, common)
SELECT doc_id, array_to_string(kept, chr(10)) AS text, CAST(coalesce(len(parts), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(parts) - len(kept),
0) AS BIGINT) AS n_removed FROM cut
"""
