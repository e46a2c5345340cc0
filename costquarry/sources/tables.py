"""Manifests, delimited text, portal pages and wide series as typed DataFrames."""

from __future__ import annotations

import csv
import html
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENCODINGS = ("utf-8-sig", "cp949", "euc-kr")


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A JSON array of objects (or lines of objects), with a fixed schema; what doesn't fit fails."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_json_map(spark: SparkSession, path: str, value: T.StructType | str, key: str = "bid_no") -> DataFrame:
    """A JSON object keyed by id as rows: the key, then the value's fields."""
    kind = value if isinstance(value, str) else value.simpleString()
    kind = kind if kind.startswith("struct<") else f"struct<{kind}>"
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", f"map<string,{kind}>")).alias(key, "_v"))
    return entries.select(key, "_v.*")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """UTF-8 text with a header, with or without a byte order mark; all columns strings unless a schema is given."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*(c.removeprefix("﻿") for c in df.columns))
    if schema is None:
        return df
    return df.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns))


def decode(raw: bytes) -> tuple[str, str]:
    """Text and encoding, by the first that fits and leaves no replacement character."""
    for name in ENCODINGS:
        try:
            text = raw.decode(name)
        except UnicodeDecodeError:
            continue
        if "�" not in text:
            return text, name
    raise ValueError("no known encoding fits")


def read_csv_any_encoding(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Files in UTF-8 or a Korean code page with the required columns, as rows (path, encoding, row, values map), unescaped and trimmed.

    A file without a required column fails. Each file is read by one task.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, raw in zip(f["path"], f["content"]):
                text, name = decode(bytes(raw))
                rows = list(csv.DictReader(io.StringIO(text)))
                if missing := [c for c in required if rows and c not in rows[0]]:
                    raise ValueError(f"{p} lacks {missing}")
                values = [{k: html.unescape(v or "").strip() for k, v in r.items() if k} for r in rows]
                yield pd.DataFrame({"path": p, "encoding": name, "row": range(1, len(values) + 1),
                    "values": values}) if values else pd.DataFrame({"path": [], "encoding": [], "row": [], "values": []})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run,
        "path string, encoding string, row int, values map<string,string>")


def typed(rows: DataFrame, fields: dict[str, str], values: str = "values") -> DataFrame:
    """Columns of a map by name and type; blank text is null for numbers and dates."""
    return rows.select(*(F.nullif(F.col(values)[name],
        F.lit("")).try_cast(kind).alias(name) if kind != "string" else F.col(values)[name].alias(name) for name, kind in fields.items()))


def rows_match(rows: DataFrame, published: int) -> DataFrame:
    """One row if the count isn't the one that the portal gives."""
    return rows.agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") != published)


def page_metadata(pages: DataFrame, page_html: str = "html") -> DataFrame:
    """Adds content_url, row_count, version and title, read from a portal page's embedded data and head."""
    h = F.col(page_html)
    pick = lambda p: F.nullif(F.regexp_extract(h, p, 1), F.lit(""))
    return (
        pages.withColumn("content_url", pick(r'"contentUrl"\s*:\s*"([^"]+)"'))
        .withColumn("row_count", F.regexp_replace(pick(r"(?:전체 행|rows)\D{0,40}?([\d,]+)"), ",", "").try_cast("long"))
        .withColumn("version", pick(r'"(?:dateModified|version)"\s*:\s*"([^"]+)"'))
        .withColumn("title", page_title(h))
    )


def page_title(h: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(h, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def strip_tags(h: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(h, "<[^>]+>", " "), r"\s+", " "))


def table_rows(pages: DataFrame, key: str, page_html: str = "html") -> DataFrame:
    """Rows of the page's tables: key, row (from 1), cells (texts without tags)."""
    tr = F.regexp_extract_all(F.col(page_html), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(F.regexp_extract_all(F.col("tr"), F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), strip_tags)
    return pages.select(key, F.posexplode(tr).alias("row", "tr")).select(key, (F.col("row") + 1).alias("row"), cells.alias("cells"))


def detail_fields(pages: DataFrame, key: str, page_html: str = "html") -> DataFrame:
    """Header cells and the data cells behind them as a map per page; of a repeated header the last counts."""
    pairs = F.regexp_extract_all(F.col(page_html), F.lit(r"(?is)<th[^>]*>(.*?)</th>\s*<td[^>]*>.*?</td>"), F.lit(1))
    values = F.regexp_extract_all(F.col(page_html), F.lit(r"(?is)<th[^>]*>.*?</th>\s*<td[^>]*>(.*?)</td>"), F.lit(1))
    each = pages.select(key, F.posexplode(F.arrays_zip(pairs.alias("k"), values.alias("v"))).alias("pos", "kv"))
    each = each.select(key, "pos", strip_tags(F.col("kv.k")).alias("k"), strip_tags(F.col("kv.v")).alias("v"))
    last = each.groupBy(key, "k").agg(F.max_by("v", "pos").alias("v"))
    return last.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("fields"))


def index_posts(pages: DataFrame, key: str, page_html: str = "html") -> DataFrame:
    """Links of an index page in order: key, pos, href, text."""
    h = F.col(page_html)
    hrefs = F.regexp_extract_all(h, F.lit(r'(?is)<a[^>]*?href="([^"]*)"[^>]*>.*?</a>'), F.lit(1))
    texts = F.regexp_extract_all(h, F.lit(r'(?is)<a[^>]*?href="[^"]*"[^>]*>(.*?)</a>'), F.lit(1))
    return pages.select(key, F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("text"))).alias("pos", "p")).select(key, "pos",
        "p.href", strip_tags(F.col("p.text")).alias("text"))


def unpivot_years(wide: DataFrame, ids: list[str], first: int = 2015, last: int = 2026, name: str = "period", value: str = "value") -> DataFrame:
    """Year columns as rows (ids, period, value); empty and non-numeric cells are left out."""
    years = [str(y) for y in range(first, last + 1) if str(y) in wide.columns]
    long = wide.select(*ids, *(F.col(y).cast("string").try_cast("double").alias(y) for y in years)).unpivot(ids, years, name, value)
    return long.where(F.col(value).isNotNull())


def source_documents(paths: DataFrame, path: str = "source_file") -> DataFrame:
    """Without completion marks, system files, resource forks and lock files; folders that begin with a dot stay."""
    name = F.element_at(F.split(path, "/"), -1)
    bad = name.isin(".complete", ".DS_Store", "Thumbs.db") | name.rlike(r"^(\.complete-|\._|~\$)") | F.array_contains(F.split(path, "/"), "__MACOSX")
    return paths.where(~bad & (name != ""))


def nested_inventory(nested: DataFrame, index: DataFrame) -> DataFrame:
    """Files found in archives with their entry of the index; those without say why."""
    from costquarry.functions.rules import document_types
    from costquarry.functions.scalars import nfc

    n, i = nested.withColumn("_p", nfc(F.col("source_file"))), index.select(nfc(F.col("source_file")).alias("_p"), F.lit(True).alias("_in"))
    ext = F.lower(F.regexp_extract("source_file", r"\.([A-Za-z0-9]+)$", 1))
    why = F.when(F.col("_in"), F.lit(None)).when(ext.isin("zip", "hwpx"), "container").when(ext == "", "no extension").otherwise("format not read")
    return n.join(i.distinct(), "_p", "left").withColumn("exclusion", why).withColumn("types", document_types(F.col("source_file"))).drop("_p", "_in")


def write_csv(df: DataFrame, path: str, fields: list[str]) -> None:
    """The given fields in their order, with a header; other columns are left out."""
    df.select(*fields).write.option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Rows as lines of JSON, with nulls."""
    df.write.option("ignoreNullFields", False).mode("overwrite").json(path)


def projected(rows: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """Rows as the columns of a table, by place: the i-th column gets the i-th field's name and type; what doesn't fit is null."""
    if len(fields) != len(rows.columns):
        raise ValueError(f"{len(rows.columns)} columns for {len(fields)} fields")
    return rows.toDF(*(f"_{i}" for i in range(len(fields)))).select(*(F.col(f"_{i}").cast("string").try_cast(kind).alias(name) for i,
        (name, kind) in enumerate(fields)))


def repair_paths(attachments: DataFrame, files: DataFrame) -> DataFrame:
    """Attachments with the path of a file of the same notice, size and digest, the first by path; without one, as they were."""
    keys = ["bid_no", "bytes", "sha256"]
    found = files.groupBy(*keys).agg(F.min("path").alias("_found"))
    return attachments.join(found, keys, "left").withColumn("path", F.coalesce("_found", "path")).drop("_found")
