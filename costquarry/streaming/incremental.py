"""Incremental collection with Structured Streaming: only keys that were not collected before are added."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def new_rows(batch: DataFrame, collected: DataFrame | None, key: str) -> DataFrame:
    """Rows of a batch whose key was not collected, one per key."""
    fresh = batch.dropDuplicates([key])
    return fresh if collected is None else fresh.join(collected.select(key), key, "left_anti")


def collect_incrementally(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, key: str) -> StreamingQuery:
    """Run over the Parquet files that are new in `source` and append their new keys to `target`; a batch that is run again adds nothing."""

    def add(batch: DataFrame, _: int) -> None:
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_SUCCESS")
        known = spark.read.parquet(target) if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path) else None
        new_rows(batch, known, key).write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def page_violations(pages: DataFrame) -> DataFrame:
    """What is wrong about the pages (page, total, rows) of one listing: a total that changed while paging, and rows that don't add up to it."""
    whole = pages.agg(F.min_by("total", "page").alias("expected"), F.sum("rows").alias("got"))
    drift = pages.join(whole.select("expected")).where(F.col("total") != F.col("expected")).select("page",
        F.format_string("total changed from %s to %s", "expected", "total").alias("violation"))
    lost = whole.where(F.col("got") != F.col("expected")).select(F.lit(None).cast("int").alias("page"),
        F.format_string("expected %s rows, got %s", "expected", "got").alias("violation"))
    return drift.union(lost)


def until_stopped(attempts: DataFrame, group: str, most: int) -> DataFrame:
    """Attempts (group, step, ok) of each group up to the one that is its `most`-th failure in a row."""
    upto = Window.partitionBy(group).orderBy("step")
    # A success begins a new run of failures; within it failures are counted.
    runs = attempts.withColumn("_run", F.sum(F.col("ok").cast("int")).over(upto))
    within = Window.partitionBy(group, "_run").orderBy("step")
    counted = runs.withColumn("_bad", F.sum((~F.col("ok")).cast("int")).over(within))
    stop = counted.where(F.col("_bad") == most).groupBy(group).agg(F.min("step").alias("_stop"))
    return counted.join(stop, group, "left").where(F.col("_stop").isNull() | (F.col("step") <= F.col("_stop"))).drop("_run", "_bad", "_stop")
