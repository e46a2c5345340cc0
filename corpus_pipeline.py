"""A training corpus from `documents`: language, near duplicates, benchmark passages, source mix, token ids.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is
written and read again as the next one's docs. All but the last return the columns of docs. run()
applies them in turn.

Rows that are equal in doc_id and text are one document from the second stage on, that of the row whose
JSON comes first; null ids are ids like any other there, told apart by their text. Texts are read whole by
all stages, however long, and empty tables give empty ones. Extra columns go through; of columns that clash
with names used inside nothing is lost, as rows travel as one struct or are joined back. The same rows in
another order give the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costquarry.llm import decontaminate, language, mixing, repair, simhash
from costquarry.llm.runtime import drop_staged, read, stage

#: Five-word shingles at a similarity of 0.8: of 256 bits, those of such a pair differ in 39 on average, in 48 for
#: the shortest; pairs up to DISTANCE are candidates, whose shingles are compared. Unrelated texts differ in 128.
SHINGLE, LANES, LIKELY, DISTANCE, SIMILAR = 5, 4, 48, 64, (4, 5)

#: The stages learn, draw and compress, which SQL can't express; tests compare them with brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined: null texts and those without a letter go, those of which no language
    has most, and those that are like nothing learned. Without a labelled text to learn from all go.
    """
    net = language.fit(docs)
    rest = F.struct(*(docs[c] for c in docs.columns if c != "text"))
    rows = docs.select("doc_id", "text", rest.alias("row"))
    kept = language.predict(rows, net, keep=("text", "row")).where(~language.rejected(F.col("lang_pred"), F.col("score")))
    return kept.select(*(F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))


def _key() -> Column:
    return F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"))


def _take(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs whose key is in keys (key, rows, ...), once each, with the other columns of keys; of rows of one key the first as JSON."""
    row = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), "doc_id", "text")
    renamed = keys.withColumnRenamed("key", "_key")
    same = row["doc_id"].eqNullSafe(renamed["_key.id"]) & (F.xxhash64(row["text"]) == renamed["_key.mark"])
    got = row.join(renamed, same).select("_row", *renamed.columns)
    if keys.where("rows > 1").limit(1).count():
        got = got.groupBy(*renamed.columns).agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return got


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, five-word shingles similar to 0.8 or more: the one with the smallest id.

    Null and empty texts are one group, as are texts of blanks. A null id comes before all others.
    """
    keyed = docs.select(_key().alias("key"), "text")
    classes = simhash.similar_texts(keyed, id_col="key", words=SHINGLE, lanes=LANES, distance=DISTANCE, likely=LIKELY, similar=SIMILAR)
    first = stage(classes.where(F.col("key").eqNullSafe(F.col("component_id"))).groupBy("key").agg(F.count(F.lit(1)).alias("rows")), "kept")
    return _take(docs, first).select("_row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item. A document is its id and text: others of the same or of a null id stay.

    Null and empty texts overlap nothing; rows that repeat stay or go together.
    """
    keyed = docs.select(_key().alias("key"), "text")
    found = decontaminate.contaminated(keyed, read(spark, sf_dir, "benchmark"), id_col="key")
    bad = stage(found.select(F.col("key.id").alias("_id"), F.col("key.mark").alias("_mark")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_mark"]), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, which may be never. Texts without a word count nothing and stay as
    often as their source's whole part says; a null source is a source of its own.
    """
    copies = mixing.mix(docs.select(_key().alias("key"), "text", "source"), id_col="key")
    copies = stage(copies.groupBy("key").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0"), "copies")
    return _take(docs, copies).select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What can be read back from the shards of token ids: doc_id, start, n_tokens, ids_crc32 of each row, null ids first,
    null texts as empty. Other columns end here.
    """
    return repair.read_shards(repair.write_shards(docs))


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID output", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written and read again, and what it was made from is deleted."""
    docs, made = read(spark, sf_dir, "documents"), None
    for _, f in STAGES[:-1]:
        before, made = made, stage(f(spark, docs, sf_dir), "stage")
        docs = made
        if before is not None:
            drop_staged(before)
    return STAGES[-1][1](spark, docs, sf_dir)
