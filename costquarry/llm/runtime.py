"""What the operators of this subpackage share: staging tables, shipping code, bounded Arrow slices."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costquarry import ship  # noqa: F401


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application that driver and executors share: under spark.checkpoint.dir, which only a local master may leave unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = "file:///tmp/checkpoints"
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{base.rstrip('/')}/costquarry/{spark.sparkContext.applicationId}"


def _path(spark: SparkSession, name: str):  # noqa: ANN202
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


#: Narrow rows that one task writes at least where a table's size is known before.
ROWS_A_FILE = 100_000


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: cuts lineage and survives lost executors.

    rows: about how many narrow rows there are, if known; few are written as few files. What no call of
    drop_staged() has deleted goes when the driver ends.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    folder = shared_dir(spark)
    path = f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    top, files = _path(spark, folder)
    files.deleteOnExit(top)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    if _scopes:
        _scopes[-1].tables.append(path)
    return out


def clean(spark: SparkSession) -> None:
    """Let Spark delete shuffle files and broadcasts of plans that are done: its cleaner acts when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scope:
    """Tables staged inside of it are deleted at its end, but for those that are kept: these belong to the scope around it.

    What is read by a plan that runs later has to be kept or staged anew. Only paths are held, no plans.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.tables: list[str] = []
        self.kept: set[str] = set()

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.add(df._staged_path)
        return df

    def __enter__(self) -> Scope:
        _scopes.append(self)
        return self

    def __exit__(self, *failed: object) -> None:
        _scopes.pop()
        for name in self.tables:
            if name not in self.kept:
                path, files = _path(self.spark, name)
                files.delete(path, True)
            elif _scopes:
                _scopes[-1].tables.append(name)
        clean(self.spark)


_scopes: list[Scope] = []


def drop_staged(df: DataFrame) -> None:
    """Delete a table written by stage() that no later plan reads."""
    path, files = _path(df.sparkSession, df._staged_path)
    files.delete(path, True)


def hot_bound(spark: SparkSession) -> int:
    """A key with a share of 1 / hot_bound of all rows, or more, is hot: there are at most hot_bound such keys."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_counted(rows: DataFrame, counted: DataFrame, cols: list[str], count: str, total: int) -> DataFrame:
    """rows joined with a table that has each of their keys (cols) once and says how many rows there are of it.

    The at most hot_bound() keys with that share of all rows are sent to every executor, so that their rows
    stay where they are; the others are joined by a shuffle.
    """
    most = hot_bound(rows.sparkSession)
    hot = F.col(count) * most >= total
    few = F.broadcast(counted.where(hot).drop(count))
    return rows.join(few, cols).unionByName(rows.join(few.select(*cols), cols, "left_anti").join(counted.where(~hot).drop(count), cols))


def smallest_hashes(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """The rows of about `rows` keys (of all if there are fewer): those with the smallest hashes.

    The key has to tell apart what repeats of it teach nothing new: rows of one key stay or go together, so
    an id on all rows is no key, but an id with its text is. A share of the hash range is cut off by the estimated number
    of keys, so that what is sorted or sent to the driver afterwards does not grow with the number of
    partitions; a tenth more than `rows` is taken, five times the estimate's error.
    """
    hashed = F.xxhash64(key, F.lit(0))
    n = df.select(F.approx_count_distinct(hashed, 0.02)).first()[0]
    share = (1.1 * rows + 100) / max(n, 1)
    return df if share >= 1 else df.where(hashed <= F.lit(int(-(2**63) + share * 2**64)))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 4, is 2 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def tidy() -> None:
    """Give memory that is free back to the system: Python workers live on when a task has ended."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library has no such call


def slices(batches: Iterator[pa.RecordBatch], column: str, max_rows: int = 512, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that Python holds a few MB of text at a time; one long text is a slice of its own."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        begin = total = 0
        for i, n in enumerate(sizes):
            if i > begin and (total + n > max_bytes or i - begin >= max_rows):
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


import pyarrow.compute  # noqa: E402,F401  (pa.compute is a submodule)
