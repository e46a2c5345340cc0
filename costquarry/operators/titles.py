"""Titles compared in tiles of those that share a country, and markers met by a join on windows of bytes: no list goes through the driver."""

from __future__ import annotations

from difflib import SequenceMatcher

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costquarry.functions.scalars import normalize_title
from costquarry.operators.occurrences import occurrences
from costquarry.operators.title_tiles import WITHIN, WITHIN_SCORE, alike
from costquarry.scratch import stage

LEAST = 0.82  #: scores that are told; what links needs is 0.86, with 0.04 to the second, and more


def title_score(a: str, b: str, least: float = 0.0) -> float:
    """Of normalized titles: 0.99 if one of at least 12 characters is within the other, else their matching-block ratio; empty: 0.

    Below `least` any smaller number may be given.
    """
    if not a or not b:
        return 0.0
    short, long = sorted((a, b), key=len)
    if len(short) >= WITHIN and short in long:
        return WITHIN_SCORE
    m = SequenceMatcher(None, a, b)
    return m.ratio() if not least or (m.real_quick_ratio() >= least and m.quick_ratio() >= least) else 0.0


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """Distinct rows (t, keys) with a number each, staged so that it stays."""
    return stage(df.select("t", "keys").distinct().withColumn("id", F.monotonically_increasing_id()), name)


def score_titles(records: DataFrame, candidates: DataFrame, key: str = "record_id", least: float = LEAST) -> DataFrame:
    """Of records (key, title, countries) the best of the candidates (project_no, title, country) that may share a country: key, project_no, score, second.

    Where a side names no country any candidate may be meant. Records whose best score is below `least` have no row, and
    a second below it is null. Equal titles of the same countries are compared once, however many rows have them; of the
    projects of one title and country only the two first can be best or second. Titles without a character have no partner.
    """
    blank = F.lit("")
    # A key is a country, "=" for one that isn't named, or "*" for records that name none.
    rec = records.select(key, normalize_title(F.col("title")).alias("t"), F.array_sort(F.array_distinct(F.filter(F.coalesce("countries", F.array()), lambda c: c.isNotNull() & (c != "")))).alias("c"))
    rec = rec.select(key, "t", F.when(F.size("c") == 0, F.array(F.lit("*"))).otherwise(F.concat(F.transform("c", lambda x: F.concat(F.lit("c:"), x)), F.array(F.lit("=")))).alias("keys"))
    rec = stage(rec.where(F.length("t") > 0), "records")
    country = F.coalesce("country", blank)
    cand = candidates.select("project_no", normalize_title(F.col("title")).alias("t"), F.array(F.when(country == "", F.lit("=")).otherwise(F.concat(F.lit("c:"), country)), F.lit("*")).alias("keys"))
    cand = cand.where((F.length("t") > 0) & F.col("project_no").isNotNull()).distinct()
    cand = cand.withColumn("r", F.row_number().over(Window.partitionBy("t", "keys").orderBy("project_no"))).where("r <= 2").drop("r")
    cand = stage(cand, "candidates")
    left, right = _numbered(rec, "titles"), _numbered(cand, "titles")
    scores = stage(alike(left, right, least), "scores")
    found = scores.join(right.join(cand, ["t", "keys"]).select(F.col("id").alias("b"), "project_no"), "b")
    each = found.groupBy("a", "project_no").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("score"), "project_no"))
    two = each.withColumn("r", rank).where("r <= 2").groupBy("a").agg(F.max(F.when(F.col("r") == 1, F.col("project_no"))).alias("project_no"),
        F.max(F.when(F.col("r") == 1, F.col("score"))).alias("score"), F.max(F.when(F.col("r") == 2, F.col("score"))).alias("second"))
    best = left.join(two, F.col("id") == F.col("a")).select("t", "keys", "project_no", "score", "second")
    return rec.join(best, ["t", "keys"]).select(key, "project_no", "score", "second")


def longest_marker(df: DataFrame, text: str, markers: DataFrame, out: str = "country") -> DataFrame:
    """Adds the label of the longest marker (label, marker) in the text, whatever the case; ties by label; none: null.

    Markers and texts meet as in `occurrences`. Rows may repeat.
    """
    known = markers.select("label", F.lower("marker").alias("marker")).where("marker <> ''").groupBy("marker").agg(F.min(F.struct("label")).alias("l"))
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    texts = rows.select(F.col("_row").alias("id"), F.lit("").alias("scope"), F.lower(F.col(text)).alias("text"))
    found = occurrences(texts, known.select(F.lit("").alias("scope"), "marker")).join(known, "marker")
    best = found.groupBy(F.col("id").alias("_row")).agg(F.min_by("l.label", F.struct(-F.length("marker"), "l.label")).alias(out))
    return rows.join(best, "_row", "left").drop("_row")
