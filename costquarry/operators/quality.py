"""Constraints as queries: each check is a DataFrame of the rows that break it; a gate passes if all are empty."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from costquarry.functions.scalars import to_json_with_nulls


class QualityError(ValueError):
    """A gate found violations; `counts` has them by check."""

    def __init__(self, counts: dict[str, int]):
        super().__init__("; ".join(f"{k}: {v}" for k, v in counts.items()))
        self.counts = counts


def unique(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def foreign(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key, if they have one, no parent has."""
    p = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(p, key, "left_anti")


def required(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where one of the columns is null or blank."""
    blank = F.lit(False)
    for c in columns:
        blank = blank | (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "")
    return df.where(blank)


def breaks(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which a rule is false; a rule that is unknown (null) holds, as in a CHECK."""
    return df.where(~F.coalesce(rule, F.lit(True)))


def one_of(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    return breaks(df, F.col(column).isin(*allowed))


def both_or_none(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where some of the columns have values and some don't."""
    n = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return df.where((n > 0) & (n < len(columns)))


def childless(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    return parent.join(child.select(key).distinct(), key, "left_anti")


def unequal(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """Keys of both tables whose column differs, null from a value included."""
    x, y = a.select(key, F.col(column).alias("left_value")), b.select(key, F.col(column).alias("right_value"))
    return x.join(y, key).where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def counts_differ(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """Keys of which two tables have different numbers of rows."""
    n = F.count(F.lit(1))
    both = a.groupBy(*keys).agg(n.alias("left_count")).join(b.groupBy(*keys).agg(n.alias("right_count")), list(keys), "full")
    both = both.select(*keys, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("left_count", "right_count")))
    return both.where("left_count <> right_count")


def recomputed(df: DataFrame, column: str, rule: Column) -> DataFrame:
    """Rows whose stored value isn't the one that the rule gives, null from a value included."""
    return df.where(~F.col(column).eqNullSafe(rule))


def outside(child: DataFrame, parent: DataFrame, key: str, first: str, last: str, bound: str) -> DataFrame:
    """Child ranges first..last that don't lie within 1..bound of the parent."""
    return child.join(parent.select(key, bound), key).where((F.col(first) < 1) | (F.col(last) < F.col(first)) | (F.col(last) > F.col(bound)))


def count_is(df: DataFrame, expected: int, name: str = "rows") -> DataFrame:
    """One row if the table has another number of rows than expected."""
    return df.agg(F.count(F.lit(1)).alias(name)).where(F.col(name) != expected)


def columns_are(df: DataFrame, wanted: list[str], forbidden: tuple[str, ...] = ()) -> list[str]:
    """What is wrong about a table's columns: missing and forbidden names."""
    return [f"missing {c}" for c in wanted if c not in df.columns] + [f"forbidden {c}" for c in df.columns if c in forbidden]


@dataclass(frozen=True)
class Rules:
    """What has to hold of a table, by the names of the checks.

    rows: a condition that each row meets (unknown holds); unique: columns whose values stand once (nulls are equal);
    foreign: columns, and a table with its columns where their values stand, if none is null; least, most: how many rows.
    """

    rows: dict[str, Column] = field(default_factory=dict)
    unique: dict[str, tuple[str, ...]] = field(default_factory=dict)
    foreign: dict[str, tuple[tuple[str, ...], str, tuple[str, ...]]] = field(default_factory=dict)
    least: int = 0
    most: int | None = None

    def metrics(self) -> list[Column]:
        """Aggregates m0, m1, ...: how many rows break each condition."""
        return [F.count_if(~F.coalesce(rule, F.lit(True))).alias(f"m{i}") for i, rule in enumerate(self.rows.values())]


def _counts(table: str, named: list[tuple[str, Column]]) -> Column:
    rows = (F.struct(F.lit(table).alias("table"), F.lit(name).alias("name"), n.cast("long").alias("n")) for name, n in named)
    return F.inline(F.array(*rows))


def check_rows(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame | None:
    """How many rows of each table break its conditions, and 1 if a table has too few or too many: one aggregation a table."""
    out = []
    for t, r in rules.items():
        named = [(name, F.col(f"m{i}")) for i, name in enumerate(r.rows)]
        if r.least or r.most is not None:
            wrong = (F.col("all") < r.least) | (F.col("all") > (F.lit(r.most) if r.most is not None else F.col("all")))
            named.append(("number of rows", wrong.cast("long")))
        if named:
            out.append(tables[t].agg(*r.metrics(), F.count(F.lit(1)).alias("all")).select(_counts(t, named)))
    return reduce(DataFrame.union, out) if out else None


def check_keys(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame | None:
    """How many keys of each unique check stand more than once, and how many rows of each foreign check have no parent.

    Each table is read once, whatever the number of its checks: a row gives a mark for each key that it has or refers to,
    and one aggregation by check and key counts the marks on both sides, before the shuffle where a key is frequent.
    """
    marks: dict[str, list[Column]] = {}

    def mark(source: str, table: str, kind: str, name: str, key: list[Column], *, parent: bool) -> None:
        no_key = F.lit(False)
        if kind == "foreign":
            no_key = reduce(lambda a, b: a | b, (k.isNull() for k in key))
        text = to_json_with_nulls(F.struct(*(k.alias(f"k{i}") for i, k in enumerate(key))))
        one = F.struct(F.lit(table).alias("table"), F.lit(kind).alias("kind"), F.lit(name).alias("name"), text.alias("key"), F.lit(parent).alias("parent"))
        marks.setdefault(source, []).append(F.when(~no_key, one))

    for t, r in rules.items():
        for name, columns in r.unique.items():
            mark(t, t, "unique", name, [F.col(c) for c in columns], parent=False)
        for name, (columns, parent, parent_columns) in r.foreign.items():
            mark(t, t, "foreign", name, [F.col(c) for c in columns], parent=False)
            types = [tables[t].schema[c].dataType for c in columns]
            mark(parent, t, "foreign", name, [F.col(c).cast(k) for c, k in zip(parent_columns, types, strict=True)], parent=True)
    if not marks:
        return None
    rows = reduce(DataFrame.union, (tables[t].select(F.inline(F.array_compact(F.array(*m)))) for t, m in marks.items()))
    keys = rows.groupBy("table", "kind", "name", "key").agg(F.count_if(~F.col("parent")).alias("n"), F.bool_or("parent").alias("known"))
    bad = F.when(F.col("kind") == "unique", (F.col("n") > 1).cast("long")).otherwise(F.when(F.col("known"), 0).otherwise(F.col("n")))
    found = keys.groupBy("table", "name").agg(F.sum(bad).alias("n"))
    # Checks of empty tables have no keys, but a count.
    every = [(t, name) for t, r in rules.items() for name in (*r.unique, *r.foreign)]
    names = reduce(DataFrame.union, (tables[t].sparkSession.range(1).select(F.lit(t).alias("table"), F.lit(name).alias("name"), F.lit(0).cast("long").alias("n"))
        for t, name in every))
    return found.union(names).groupBy("table", "name").agg(F.sum("n").alias("n"))


def check_tables(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    """Counts (table, name, n) of all checks; a table is read once for its conditions and once for its keys."""
    return reduce(DataFrame.union, [df for df in (check_rows(tables, rules), check_keys(tables, rules)) if df is not None])


def gate_tables(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> None:
    """Raise QualityError with the counts of all checks that find something; one job."""
    bad = {f"{r['table']}: {r['name']}": r["n"] for r in check_tables(tables, rules).where("n > 0").collect()}
    if bad:
        raise QualityError(bad)


def write_checked(tables: dict[str, DataFrame], path: str, rules: dict[str, Rules]) -> dict[str, int]:
    """Write tables as Parquet below a path; the counts of all checks by `table: name`.

    Conditions are observed on the write itself, so that they read nothing again; keys and numbers of rows are counted in
    the written files. A task that is run again may raise the count of a condition, but not from or to zero.
    """
    spark = next(iter(tables.values())).sparkSession
    counts = {}
    for t, df in tables.items():
        seen, r = Observation(), rules.get(t, Rules())
        (df.observe(seen, *r.metrics()) if r.rows else df).write.parquet(f"{path}/{t}")
        counts |= {f"{t}: {name}": seen.get[f"m{i}"] for i, name in enumerate(r.rows)}
    written = {t: spark.read.schema(df.schema).parquet(f"{path}/{t}") for t, df in tables.items()}
    rest = {t: Rules(unique=r.unique, foreign=r.foreign, least=r.least, most=r.most) for t, r in rules.items()}
    parts = [df for df in (check_rows(written, rest), check_keys(written, rest)) if df is not None]
    return counts | {f"{r['table']}: {r['name']}": r["n"] for df in parts for r in df.collect()}


def gate(checks: dict[str, DataFrame]) -> None:
    """Raise QualityError with the counts of all checks that find rows; all are counted in one job."""
    counts = None
    for name, df in checks.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        counts = one if counts is None else counts.union(one)
    bad = {r["name"]: r["n"] for r in counts.where("n > 0").collect()} if counts is not None else {}
    if bad:
        raise QualityError(bad)
