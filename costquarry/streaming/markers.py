"""Files that are handled again only when they are new or have changed: one marker a path, kept as state of a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from costquarry.sources import archives

LISTING = "path string, size long, mtime timestamp, run int"
MARKED = "path string, size long, mtime long, run int, action string"
CHANGED = "path string, size long, mtime timestamp, run int, action string"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Markers(StatefulProcessor):
    """The state of a path is the size and time with which it was last given out, and for which version of the handler."""

    def __init__(self, version: str):
        self.version = version

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.marker = handle.getValueState("marker", "version string, size long, mtime long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        # Of listings that wait together the last counts; of a path that it names twice, the later time.
        r = max(rows, key=lambda x: (x.run, x.mtime is not None, x.mtime or 0, x.size is not None, x.size or 0))
        now = (self.version, r.size, r.mtime)
        old = self.marker.get()
        if old is None or tuple(old) != now:
            self.marker.update(now)
            yield Row(path=key[0], size=r.size, mtime=r.mtime, run=r.run, action="new" if old is None else "changed" if old[0] == self.version else "version")


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of all files below a folder, by tasks; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def members_of_changed(spark: SparkSession, folder: str, limits: archives.Limits = archives.Limits()) -> Callable[[DataFrame], DataFrame]:
    """A handler: the members of changed archives below a folder, with the archive's path.

    Only files within the sizes and times of the changed ones are read. A file that changed after it was listed gives no
    rows now, and is handled after the next listing.
    """

    def handle(changed: DataFrame) -> DataFrame:
        low, high, least, most = changed.agg(F.min("mtime"), F.max("mtime"), F.min("size"), F.max("size")).first()
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        files = files.where(F.col("modificationTime").between(F.lit(low), F.lit(high)) & F.col("length").between(F.lit(least), F.lit(most)))
        wanted = changed.select("path", F.col("size").alias("length"), F.col("mtime").alias("modificationTime"))
        rows = archives.unpack_archives(files.join(wanted, ["path", "length", "modificationTime"], "left_semi"), limits)
        return rows.withColumnRenamed("path", "member").withColumnRenamed("root", "path")

    return handle


@dataclass
class WatchedFiles:
    """Listings, markers and results below `path`, for one writer at a time.

    The markers' number of partitions is that of spark.sql.shuffle.partitions at the first update.
    """

    spark: SparkSession
    path: str
    version: str = "1"

    def update(self, listing: DataFrame, handle: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Take a listing (path, size, mtime) and hand its new and changed files to `handle`, whose rows carry `path`.

        A file is changed if its size or time is another than when it was last handed out, be it one of before; with
        another version all are. Rows without a path are left out, files that a listing lacks keep their markers. If the
        handler fails, no marker is set, and the same files are handed out by the next update. An empty listing changes nothing.
        """
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/listings")
        fs = jpath.getFileSystem(self.spark._jsc.hadoopConfiguration())
        run = 1 + max((int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(jpath) if "=" in s.getPath().getName()), default=0) if fs.exists(jpath) else 1
        listing.where("path is not null").select("path", F.col("size").cast("long"), F.col("mtime").cast("timestamp")).write.parquet(f"{self.path}/listings/run={run}")

        def add(batch: DataFrame, number: int) -> None:
            to = f"{self.path}/changed/batch={number}"
            batch.write.mode("overwrite").parquet(to)
            changed = self.spark.read.schema(CHANGED).parquet(to)
            if handle is not None and not changed.isEmpty():
                handle(changed).write.mode("overwrite").parquet(f"{self.path}/results/batch={number}")

        key = "spark.sql.streaming.stateStore.providerClass"
        before = self.spark.conf.get(key, None)
        self.spark.conf.set(key, STORE)
        try:
            # Times are whole microseconds in the state, as Python's times depend on a zone.
            rows = self.spark.readStream.schema(LISTING).parquet(f"{self.path}/listings").withColumn("mtime", F.unix_micros("mtime"))
            marked = rows.groupBy("path").transformWithState(Markers(self.version), MARKED, "Append", "None")
            query = marked.withColumn("mtime", F.timestamp_micros("mtime")).writeStream.foreachBatch(add).option("checkpointLocation", f"{self.path}/markers").trigger(availableNow=True).start()
            query.awaitTermination()
        finally:
            self.spark.conf.set(key, before) if before else self.spark.conf.unset(key)

    def changed(self) -> DataFrame:
        """All files that were handed out, by run."""
        return self.spark.read.schema(f"{CHANGED}, batch long").parquet(f"{self.path}/changed")

    def results(self) -> DataFrame:
        """The handler's rows of each path's last change; those of earlier changes don't count any more."""
        last = self.changed().groupBy("path").agg(F.max("batch").alias("batch"))
        return self.spark.read.parquet(f"{self.path}/results").join(last, ["path", "batch"], "left_semi").drop("batch")
