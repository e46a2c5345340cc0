"""Files and tables that are written to be read back: in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which only a local master may leave unset; it goes when the driver ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file:///tmp/checkpoints"
    path = f"{base.rstrip('/')}/costquarry-files/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    jpath, files = _files(spark, path)
    files.mkdirs(jpath)
    files.deleteOnExit(jpath)
    return path


def _files(spark: SparkSession, path: str):  # noqa: ANN202
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def put(spark: SparkSession, path: str, content: bytes) -> str:
    """Write one file; returns its path."""
    jpath, files = _files(spark, path)
    out = files.create(jpath, True)
    out.write(bytearray(content))
    out.close()
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table as Parquet and read it again, which cuts its lineage."""
    path = f"{folder(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
