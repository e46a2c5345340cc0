"""A table that is merged by parts: only parts in which a key is new, changed or gone are written again."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costquarry import scratch
from costquarry.functions.scalars import to_json_with_nulls
from costquarry.operators import quality

PART, DIGEST, SYNCED = "_part", "_digest", "synced_at"
ACTIONS = ("inserted", "updated", "kept", "deleted")
COUNTS = "part long, " + ", ".join(f"{a} long" for a in ACTIONS)


def part_of(keys: list[str], parts: int) -> Column:
    """The part of a row: the first 32 bits of MD5 of its keys as JSON, modulo the number of parts."""
    return F.conv(F.substring(F.md5(to_json_with_nulls(F.struct(*keys))), 1, 8), 16, 10).cast("long") % parts


@dataclass
class PartitionedTable:
    """Rows of unique keys below `path`, one folder a part, each row with its digest and the time of its last change.

    The number of parts is fixed for the life of a table; a part should hold about a gigabyte. A merge compares keys
    and digests, which is all that it reads of the old table, and overwrites the parts that differ in one job.
    """

    spark: SparkSession
    path: str
    keys: list[str]
    parts: int = 64

    def __post_init__(self) -> None:
        self._jpath = self.spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jpath(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _stored(self) -> DataFrame | None:
        """All columns that are kept, with the ones of the merge; None before the first merge."""
        if not self._fs.exists(self._jpath(f"{self.path}/schema.json")):
            return None
        text = self.spark.read.text(f"{self.path}/schema.json", wholetext=True).first()[0]
        return self.spark.read.schema(T.StructType.fromJson(json.loads(text))).parquet(f"{self.path}/rows")

    def read(self) -> DataFrame:
        if (old := self._stored()) is None:
            raise FileNotFoundError(f"no table in {self.path}")
        return old.drop(PART, DIGEST)

    def merge(self, new: DataFrame, stamp: str | None = None) -> DataFrame:
        """Make the table's rows those of `new`; returns a row for each part that had or has rows: its keys by what was done to them.

        A part was written again unless all its keys were kept. Columns that `new` lacks keep their values by key (new
        keys: null), columns that the table lacks are left out, and is_published, where there is such a column, is true
        where it is null. synced_at is `stamp` (now, if there is none) for keys that are new or changed, and stays for the
        others. A null or repeated key is a QualityError, with the table as it was. Of an
        empty `new` all keys go. A merge that was cut off while its parts were moved in is mended by the same merge again.
        """
        if taken := {PART, DIGEST, SYNCED} & set(new.columns):
            raise ValueError(f"columns of the merge itself: {', '.join(sorted(taken))}")
        old = self._stored()
        rows = self._completed(new, old)
        values = rows.columns
        rows = rows.select("*", F.sha2(to_json_with_nulls(F.struct(*sorted(values))), 256).alias(DIGEST), part_of(self.keys, self.parts).alias(PART))
        staged = f"{scratch.folder(self.spark, 'merge')}/rows"
        # Parts of any size: the rebalancing splits large ones among tasks and puts small ones together.
        rows.hint("rebalance", PART).write.partitionBy(PART).parquet(staged)
        fresh = self.spark.read.schema(rows.schema).parquet(staged)
        counted = self._compare(fresh, old)
        if bad := {k: n for k in ("repeated key", "null key") if (n := sum(r[k] for r in counted))}:
            raise quality.QualityError(bad)
        changed = [r[PART] for r in counted if r["inserted"] + r["updated"] + r["deleted"]]
        self._overwrite(fresh, old, values, changed, stamp)
        self._remove([r[PART] for r in counted if r["deleted"] and not r["inserted"] + r["updated"] + r["kept"]])
        return self.spark.createDataFrame([(r[PART], *(r[a] for a in ACTIONS)) for r in counted], COUNTS)

    def _completed(self, new: DataFrame, old: DataFrame | None) -> DataFrame:
        out = new
        if old is not None:
            columns = [c for c in old.columns if c not in (PART, DIGEST, SYNCED)]
            if missing := [c for c in columns if c not in new.columns]:
                out = out.join(old.select(*self.keys, *missing), self.keys, "left")
            out = out.select(*(F.col(c).cast(old.schema[c].dataType).alias(c) for c in columns))
        if "is_published" in out.columns:
            out = out.withColumn("is_published", F.coalesce("is_published", F.lit(True)))
        return out

    def _compare(self, fresh: DataFrame, old: DataFrame | None) -> list:
        """Per part its counts, at most as many rows as there are parts; keys are counted and compared in one pass."""
        by = [PART, *self.keys]
        new = fresh.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min(DIGEST).alias("_new"))
        both = new.withColumn("_old", F.lit(None).cast("string")) if old is None else new.join(old.select(*by, F.col(DIGEST).alias("_old")), by, "full")
        no_key = F.lit(False)
        for k in self.keys:
            no_key = no_key | F.col(k).isNull()
        was, is_now = F.col("_old").isNotNull(), F.col("_n").isNotNull()
        same = F.col("_old") == F.col("_new")
        return both.groupBy(PART).agg(
            F.count_if(is_now & ~was).alias("inserted"), F.count_if(was & is_now & ~same).alias("updated"), F.count_if(was & is_now & same).alias("kept"),
            F.count_if(was & ~is_now).alias("deleted"), F.count_if(F.col("_n") > 1).alias("repeated key"), F.count_if(no_key).alias("null key"),
        ).orderBy(PART).collect()

    def _overwrite(self, fresh: DataFrame, old: DataFrame | None, values: list[str], changed: list[int], stamp: str | None) -> None:
        now = (F.lit(stamp) if stamp else F.current_timestamp()).cast("timestamp")
        if old is None:
            out = fresh.withColumn(SYNCED, now)
        elif changed:
            before = old.where(F.col(PART).isin(changed)).select(*self.keys, F.col(DIGEST).alias("_old"), F.col(SYNCED).alias("_at"))
            out = fresh.where(F.col(PART).isin(changed)).join(before, self.keys, "left")
            out = out.withColumn(SYNCED, F.when(F.col("_old") == F.col(DIGEST), F.col("_at")).otherwise(now))
        else:
            return
        out = out.select(*values, SYNCED, DIGEST, PART)
        # The overwrite of parts moves them in when all are written, so that tasks may read the old ones until then.
        out.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(f"{self.path}/rows")
        if old is None:
            scratch.put(self.spark, f"{self.path}/schema.json", out.schema.json().encode())

    def _remove(self, parts: list[int]) -> None:
        for p in parts:
            self._fs.delete(self._jpath(f"{self.path}/rows/{PART}={p}"), True)
