"""The registered queries of this subpackage: one opN_<name> for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costquarry.llm import bpe_counts, chat, clustered, decontaminate, language, lines, matroska, middle, mixing, neighbours, repair, simhash, toxicity
from costquarry.llm.runtime import read

Query = Callable[[SparkSession, str], DataFrame]


#: A conversation whose texts hold control strings of a chat template, added to the table's own.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(read(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    rows = rows.union(extra).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.digests(chat.format_chats(rows))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_counts.token_counts(read(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), words=4, distance=4)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.read_shards(repair.write_shards(read(spark, sf_dir, "documents")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.text_media(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.where(neighbours.every(rows, 20)))


def op12_clustered_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered.layout(read(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.digests(middle.fill_in_middle(read(spark, sf_dir, "documents")))


def queries() -> dict[str, Query]:
    each = (op1_line_dedup, op2_mixing, op3_chat, op4_token_counts, op5_simhash, op6_language, op7_token_ids, op8_decontamination, op9_matroska, op10_toxicity,
        op11_neighbours, op12_clustered_layout, op13_fill_in_middle)
    return {f.__name__: f for f in each}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": lines.ORACLE, "op8_decontamination": decontaminate.ORACLE, "op12_clustered_layout": clustered.ORACLE,
        "op13_fill_in_middle": middle.ORACLE}
