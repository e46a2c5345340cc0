"""Replacing snapshots: validate, upsert, delete what is absent, and swap the new version in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costquarry.operators import quality

LIMITS = {"cases": 10_000, "related_notices": 50_000, "evaluation_projects": 10_000, "evaluation_reports": 10_000,
    "evaluation_matches": 20_000, "evaluation_findings": 100_000}
IDENTITY = ("schema_version", "data_version", "audit_date", "source_sha256")


def merge(old: DataFrame, new: DataFrame, keys: list[str], stamp: str | None = None) -> DataFrame:
    """The rows of `new`, with is_published true where it is null and synced_at set; keys that are absent are gone.

    Incoming columns replace old ones; columns that `new` lacks keep their old values by key. A key that stands
    twice in `new` is an error.
    """
    quality.gate({"repeated key": quality.unique(new, *keys)})
    out = new
    kept = [c for c in old.columns if c not in new.columns and c not in ("is_published", "synced_at")]
    if kept:
        out = out.join(old.select(*keys, *kept), keys, "left")
    if "is_published" in old.columns:
        flag = F.coalesce("is_published", F.lit(True)) if "is_published" in new.columns else F.lit(True)
        out = out.withColumn("is_published", flag)
    if "synced_at" in old.columns:
        out = out.withColumn("synced_at", (F.lit(stamp) if stamp else F.current_timestamp()).cast("timestamp"))
    return out.select(*(F.col(c).cast(old.schema[c].dataType).alias(c) for c in old.columns))


def upsert_singleton(old: DataFrame, new: DataFrame) -> DataFrame:
    """The one row of snapshot metadata: the new one, or the old one where there is no new one."""
    ranked = new.withColumn("_n", F.lit(0)).unionByName(old.withColumn("_n", F.lit(1)), allowMissingColumns=True)
    return ranked.orderBy("_n").limit(1).drop("_n")


def changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Per key what a merge does: insert, update, keep or delete; one full join, columns compared as one struct."""
    values = [c for c in new.columns if c not in keys and c in old.columns]
    o, n = old.select(*keys, F.struct(*values).alias("o")), new.select(*keys, F.struct(*values).alias("n"))
    kind = F.when(F.col("o").isNull(), "insert").when(F.col("n").isNull(), "delete").when(F.col("o").eqNullSafe(F.col("n")), "keep").otherwise("update")
    return o.join(n, keys, "full").select(*keys, kind.alias("action"))


def change_counts(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row of counts, as a merge returns it."""
    a = F.col("action")
    return changes(old, new, keys).agg(*(F.count_if(a == k).alias(f"{k}_count") for k in ("insert", "update", "keep", "delete")))


def validate_cases(cases: DataFrame, notices: DataFrame, identity: dict[str, str], limits: dict[str, int] = LIMITS) -> None:
    """Raise QualityError unless cases and notices are a whole and consistent snapshot, within the limits of the tables that have one."""
    for table, df in (("cases", cases), ("related_notices", notices)):
        if bad := quality.columns_are(df, ["case_id"], ("contact", "manager", "phone", "email")):
            raise quality.QualityError({f"{table} {b}": 1 for b in bad})
    if missing := [k for k in IDENTITY if not identity.get(k)]:
        raise quality.QualityError({f"identity {k}": 1 for k in missing})
    positive = (F.coalesce("gross_floor_area_m2", F.lit(1)) > 0) & (F.coalesce("construction_cost_usd", F.lit(1)) > 0)
    quality.gate_tables({"cases": cases, "related_notices": notices}, {
        "cases": quality.Rules(
            {"case id": F.trim(F.coalesce(F.col("case_id").cast("string"), F.lit(""))) != "",
                "grade": F.col("evidence_grade").isin("A", "B", "C", "C?", "U", "X"),
                "case kind": F.col("case_kind").isin("CONSTRUCTION_NOTICE", "DESIGN_SUPERVISION_REFERENCE"), "area or cost not positive": positive},
            unique={"repeated case": ("case_id",)}, least=1, most=limits.get("cases")),
        "related_notices": quality.Rules(unique={"repeated notice": ("case_id", "related_bid_base_no")},
            foreign={"notice without case": (("case_id",), "cases", ("case_id",))}, most=limits.get("related_notices")),
    })


def validate_evaluations(projects: DataFrame, reports: DataFrame, matches: DataFrame, findings: DataFrame, identity: dict[str, str],
    current: dict[str, str]) -> None:
    """Raise QualityError unless the evaluation tables fit each other and belong to the current cases' snapshot."""
    if differ := [k for k in IDENTITY if identity.get(k) != current.get(k)]:
        raise quality.QualityError({f"identity {k}": 1 for k in differ})
    paged = findings.join(matches.select("match_id", "report_id"), "match_id")
    quality.gate_tables(
        {"projects": projects, "reports": reports, "matches": matches, "findings": findings},
        {
            "projects": quality.Rules(unique={"repeated project": ("project_no",)}, least=1),
            "reports": quality.Rules(unique={"repeated report": ("report_id",)}),
            "matches": quality.Rules({"match score": F.col("match_score").between(0, 1)},
                unique={"repeated match": ("match_id",), "repeated pair": ("report_id", "project_no")},
                foreign={"match without project": (("project_no",), "projects", ("project_no",)),
                    "match without report": (("report_id",), "reports", ("report_id",))}),
            "findings": quality.Rules({"number and unit": F.col("value_numeric").isNull() == F.col("unit").isNull()},
                unique={"repeated finding": ("finding_id",)}, foreign={"finding without match": (("match_id",), "matches", ("match_id",))}),
        },
    )
    # Pages are held against another table's bound, once keys are known to fit.
    quality.gate({"pages": quality.outside(paged, reports, "report_id", "pdf_page_start", "pdf_page_end", "page_count")})


class SnapshotStore:
    """Versions of tables below one folder; readers see the version that the pointer names, which is written last."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self) -> str | None:
        files = self._fs.globStatus(self._path(f"{self.root}/_current/*.version")) or []
        names = sorted((f.getModificationTime(), f.getPath().getName()) for f in files)
        return names[-1][1].removesuffix(".version") if names else None

    def read(self, table: str) -> DataFrame:
        v = self.version()
        if v is None:
            raise FileNotFoundError(f"no snapshot in {self.root}")
        return self.spark.read.parquet(f"{self.root}/{v}/{table}")

    def publish(self, tables: dict[str, DataFrame], checks: dict[str, DataFrame] | None = None, rules: dict[str, quality.Rules] | None = None) -> str:
        """Write all tables as a new version, check them, then move the pointer; on a violation the old version stays current.

        Conditions on rows among the rules are checked as the rows are written.
        """
        v = uuid.uuid4().hex
        try:
            counts = quality.write_checked(tables, f"{self.root}/{v}", rules or {})
            if bad := {k: n for k, n in counts.items() if n}:
                raise quality.QualityError(bad)
            quality.gate(checks or {})
        except quality.QualityError:
            self._fs.delete(self._path(f"{self.root}/{v}"), True)
            raise
        old = self._fs.globStatus(self._path(f"{self.root}/_current/*.version")) or []
        self._fs.create(self._path(f"{self.root}/_current/{v}.version"), True).close()
        for f in old:
            self._fs.delete(f.getPath(), False)
        return v


#: The tables of a snapshot, in the order in which they are written.
SNAPSHOT = ("cases", "related_notices", "evaluation_projects", "evaluation_reports", "evaluation_matches", "evaluation_findings")


def write_snapshot(tables: dict[str, DataFrame], identity: dict[str, str], path: str) -> None:
    """A snapshot as files: a CSV folder for each of its six tables, then one line of JSON with its identity and row counts."""
    spark = tables["cases"].sparkSession
    counts = {}
    for name in SNAPSHOT:
        tables[name].write.option("header", True).mode("overwrite").csv(f"{path}/{name}")
        counts[f"{name}_count"] = spark.read.option("header", True).csv(f"{path}/{name}").count()
    meta = spark.range(1).select(*(F.lit(identity[k]).alias(k) for k in IDENTITY), *(F.lit(n).alias(k) for k, n in counts.items()))
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def sync(store: SnapshotStore, tables: dict[str, DataFrame], identity: dict[str, str], limits: dict[str, int] = LIMITS) -> list[str]:
    """Publish a snapshot in two calls: cases and notices first, then the evaluations that belong to them; returns the versions.

    Each call is checked before readers see it, so a failure of the second leaves the cases of the first. limits: the most
    rows of a table, as a payload has them; a snapshot that goes from table to table needs none ({}).
    """
    validate_cases(tables["cases"], tables["related_notices"], identity, limits)
    first = {n: tables[n] for n in SNAPSHOT[:2]}
    versions = [store.publish(first)]
    validate_evaluations(*(tables[n] for n in SNAPSHOT[2:]), identity, identity)
    versions.append(store.publish({n: tables[n] for n in SNAPSHOT}))
    return versions
