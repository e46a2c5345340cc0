"""Queries of readers and writers: files made from the tables are written to the shared folder and read back."""

from __future__ import annotations

import io
import json
import sqlite3
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costquarry import scratch
from costquarry.operators import evidence, quality
from costquarry.plans.made import archive_file, hwp_file, made_files, office_file, zipped
from costquarry.plans.queries import query, t
from costquarry.sources import archives, files, office, tables
from costquarry.streaming import incremental


def nations(spark: SparkSession, sf_dir: str) -> list[tuple[int, str, int]]:
    """The 25 nations, of which small files are made."""
    return [tuple(r) for r in t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_nationkey").collect()]


# ---- text files ----


@query("SELECT 'rows' AS kind, n_nationkey, n_name, CASE WHEN n_regionkey <> 2 THEN n_regionkey END AS region FROM nation UNION ALL SELECT 'map', n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT 'written', n_nationkey, n_name, n_regionkey FROM nation")
def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON array, a JSON object by id, and lines that the writer wrote."""
    path, rows = scratch.folder(spark, "json"), nations(spark, sf_dir)
    scratch.put(spark, f"{path}/rows.json", json.dumps([{"n_nationkey": k, "n_name": n} | ({} if r == 2 else {"region": r}) for k, n, r in rows]).encode())
    scratch.put(spark, f"{path}/map.json", json.dumps({str(k): {"n_name": n, "region": r} for k, n, r in rows}).encode())
    tables.write_json(t(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "region"), f"{path}/lines")
    schema = "n_nationkey int, n_name string, region int"
    parts = {
        "rows": tables.read_json_rows(spark, f"{path}/rows.json", schema),
        "map": tables.read_json_map(spark, f"{path}/map.json", "n_name string, region int", "n_nationkey").withColumn("n_nationkey",
            F.col("n_nationkey").cast("int")),
        "written": spark.read.schema(schema).json(f"{path}/lines"),
    }
    out = None
    for kind, df in parts.items():
        one = df.select(F.lit(kind).alias("kind"), *schema.replace(" int", "").replace(" string", "").split(", "))
        out = one if out is None else out.union(one)
    return out


@query(
    """SELECT 'utf-8-sig' AS encoding, n_nationkey, '가나 ' || n_name AS name, CASE WHEN n_nationkey % 5 <> 0 THEN n_regionkey END AS region
FROM nation WHERE n_nationkey < 10
UNION ALL SELECT 'cp949', n_nationkey, '가나 ' || n_name, CASE WHEN n_nationkey % 5 <> 0 THEN n_regionkey END FROM nation WHERE n_nationkey >= 10
UNION ALL SELECT 'written', n_nationkey, n_name, n_regionkey FROM nation"""
)
def delimited_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files in two encodings with typed columns, and one that the writer wrote and the plain reader reads."""
    path, rows = scratch.folder(spark, "csv"), nations(spark, sf_dir)
    text = lambda some: "key,name,region\n" + "".join(f"{k},가나 {n},{r if k % 5 else ''}\n" for k, n, r in some)
    scratch.put(spark, f"{path}/in/a.csv", text(rows[:10]).encode("utf-8-sig"))
    scratch.put(spark, f"{path}/in/b.csv", text(rows[10:]).encode("cp949"))
    raw = tables.read_csv_any_encoding(spark, f"{path}/in/*.csv", ["key", "name"])
    got = raw.select("encoding", "values").transform(lambda df: df.select("encoding", F.col("values")))
    named = tables.typed(got.withColumn("values", F.map_concat("values", F.create_map(F.lit("encoding"), "encoding"))),
        {"encoding": "string", "key": "int", "name": "string", "region": "int"})
    tables.write_csv(t(spark, sf_dir, "nation").withColumn("left_out", F.lit(1)), f"{path}/out", ["n_nationkey", "n_name", "n_regionkey"])
    schema = t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").schema
    again = tables.read_csv(spark, f"{path}/out", schema).select(F.lit("written"), "n_nationkey", "n_name", "n_regionkey")
    return named.toDF("encoding", "n_nationkey", "name", "region").union(again)


@query("SELECT CAST(n_nationkey AS VARCHAR) AS code, CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey END AS amount, n_name AS label FROM nation")
def projected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0,
        F.col("n_regionkey").cast("string")).otherwise("n/a"), "n_name")
    return tables.projected(rows, [("code", "string"), ("amount", "int"), ("label", "string")])


# ---- portal pages ----


def portal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each page of the table, with a detail table, a list and the portal's embedded data."""
    lit, key = F.lit, F.col("page_id").cast("string")
    rows = F.concat(lit("<TABLE><tr class='a'><th>번호</th><td> "), key, lit("</td></tr>\n<tr><th><b>제목</b></th><td><a>Title "), key,
        lit("</a> &amp; co</td><th>번호</th><td>last</td></tr></TABLE>"))
    data = F.concat(lit('<script>{"contentUrl" : "http://files/'), key, lit('.csv", "dateModified": "2026-01-0'),
        (F.col("page_id") % 9 + 1).cast("string"), lit('"}</script><p>전체 행: 1,'), F.lpad(key, 3, "0"), lit(" 건</p>"))
    return t(spark, sf_dir, "pages").select("page_id", F.concat(lit("<html><title> List "), key, lit("</title>"), data, rows, lit("</html>")).alias("html"))


@query(
    """SELECT page_id, 'http://files/' || page_id || '.csv' AS content_url, CAST('1' || lpad(CAST(page_id AS VARCHAR), 3,
'0')[1:3] AS BIGINT) AS row_count, '2026-01-0' || (page_id % 9 + 1) AS version, 'List ' || page_id AS title FROM pages"""
)
def portal_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.page_metadata(portal_pages(spark, sf_dir)).drop("html")


@query(
    """SELECT page_id, 1 AS row, '번호|' || page_id AS cells FROM pages UNION ALL SELECT page_id, 2, '제목|Title ' || page_id || ' &amp; co|번호|last' FROM pages"""
)
def portal_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table_rows(portal_pages(spark, sf_dir), "page_id").select("page_id", "row", F.array_join("cells", "|").alias("cells"))


@query("SELECT page_id, 'last' AS number, 'Title ' || page_id || ' &amp; co' AS title, CAST(2 AS INTEGER) AS fields FROM pages")
def portal_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = tables.detail_fields(portal_pages(spark, sf_dir), "page_id")
    return got.select("page_id", F.col("fields")["번호"].alias("number"), F.col("fields")["제목"].alias("title"), F.size("fields").alias("fields"))


@query("SELECT count(*) AS rows FROM pages HAVING count(*) <> 7")
def portal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    return tables.rows_match(p, 7).unionByName(tables.rows_match(p, p.count()))


# ---- archives and office files ----


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


@query(
    """WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS k, c_custkey % 6 AS kind, c_name AS n, c_mktsegment AS s FROM customer)
SELECT k || '.docx' AS path, '문단 1' AS locator, n AS text, false AS broken FROM c WHERE kind = 0 UNION ALL SELECT k || '.docx', '표 1 행 1', s || ' | ' || k, false FROM c WHERE kind = 0
UNION ALL SELECT k || '.pptx', '슬라이드 2', n || ' x', false FROM c WHERE kind = 1 UNION ALL SELECT k || '.pptx', '슬라이드 10', s || ' x', false FROM c WHERE kind = 1
UNION ALL SELECT k || '.xlsx', 'One!1', 'A1=Name | B1=Key', false FROM c WHERE kind = 2 UNION ALL SELECT k || '.xlsx', 'One!2', 'A2=' || n || ' | B2=' || k, false FROM c WHERE kind = 2
UNION ALL SELECT k || '.xlsx', 'Two!1', 'A1==1+2 | C1=q"<', false FROM c WHERE kind = 2 UNION ALL SELECT k || '.html', '본문', '가나 ' || n, false FROM c WHERE kind = 3
UNION ALL SELECT k || '.xlsx', NULL, NULL, true FROM c WHERE kind = 4"""
)
def office_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of each customer, in one of the formats; broken ones are error rows, unknown ones give nothing."""
    return office.extract_chunks(made_files(customers(spark, sf_dir), office_file)).select("path", "locator", "text", F.col("error").isNotNull().alias("broken"))


@query(
    """SELECT c_custkey || '.xlsx' AS path, sheet, n AS rows, broken FROM customer JOIN (VALUES (2, 'One', 2, false), (2, 'Two', 1, false), (4, NULL, NULL, true)) v(kind, sheet, n, broken)
ON c_custkey % 6 = kind"""
)
def office_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = made_files(customers(spark, sf_dir), office_file).where("path like '%.xlsx'")
    return office.extract_sheets(books).select("path", "sheet", F.when(F.col("cells").isNotNull(), F.size("cells")).alias("rows"),
        F.col("error").isNotNull().alias("broken"))


@query(
    """SELECT c_custkey || '/Section0' AS path, v.pos, CASE v.pos WHEN 0 THEN c_name ELSE c_mktsegment END || ' 본문' AS text, false AS broken
FROM customer, (VALUES (0), (1)) v(pos) WHERE c_custkey % 7 <> 6 UNION ALL SELECT c_custkey || '/Section0', 0, NULL, true FROM customer WHERE c_custkey % 7 = 6"""
)
def hwp_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraph records of a body section of each customer; other records are skipped, broken sections are error rows."""
    got = office.extract_sections(made_files(customers(spark, sf_dir), hwp_file))
    return got.select("path", "pos", "text", F.col("error").isNotNull().alias("broken"))


@query(
    """WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS k, c_custkey % 5 AS kind, CAST(length(c_name) AS BIGINT) AS n, CAST(length(c_mktsegment) AS BIGINT) AS s FROM customer)
SELECT k || '.zip' AS root, 'n.txt' AS path, 0 AS depth, n AS bytes, false AS bad FROM c WHERE kind = 0 UNION ALL SELECT k || '.zip', 'in.zip!/s.txt', 1, s, false FROM c WHERE kind = 0
UNION ALL SELECT k || '.txt', k || '.txt', 0, n, false FROM c WHERE kind = 1 UNION ALL SELECT k || '.zip', k || '.zip', 0, 0, true FROM c WHERE kind = 2
UNION ALL SELECT k || '.zip', '../up.txt', 0, 0, true FROM c WHERE kind = 3 UNION ALL SELECT k || '.zip', 's.txt', 0, s, false FROM c WHERE kind = 3
UNION ALL SELECT k || '.zip', 'a/n.txt', 0, n, false FROM c WHERE kind = 4 UNION ALL SELECT k || '.zip', 'a/s.txt', 0, s, false FROM c WHERE kind = 4"""
)
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of each customer, some with an archive within; climbing paths and broken archives are error rows."""
    found = archives.unpack_archives(made_files(customers(spark, sf_dir), archive_file))
    return found.where("path <> 'in.zip'").select("root", "path", "depth", "bytes", (F.coalesce("error", F.lit("")) != "").alias("bad"))


@query("SELECT 'ISO' || n_nationkey AS iso3, y AS period, CAST(n_regionkey + CAST(y AS INTEGER) / 10.0 AS DOUBLE) AS value FROM nation, (VALUES ('2015'), ('2026')) p(y) WHERE y = '2015' OR n_nationkey % 2 = 0")
def indicator_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.folder(spark, "indicators")
    for part in (0, 1):
        lines = ['"Data Source","x"', "", '"Country Name","Country Code","2014","2015","2026"']
        lines += [f'"{n}","ISO{k}","1","{r + 201.5}","{r + 202.6 if k % 2 == 0 else ""}"' for k, n,
            r in nations(spark, sf_dir) if k % 3 == part or part == 1 and k % 3 == 2]
        scratch.put(spark, f"{path}/{part}.zip", zipped({"Metadata_x.csv": "no", "API_x.csv": "﻿" + "\n".join(lines)}))
    return files.read_indicators(spark, path)


# ---- databases, pages, packages ----


@query("SELECT n_nationkey AS id, n_name AS name, false AS broken FROM nation WHERE n_regionkey = 1 UNION ALL SELECT NULL, NULL, true")
def sqlite_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, db = scratch.folder(spark, "sqlite"), sqlite3.connect(":memory:")
    db.execute("CREATE TABLE nation (id INTEGER, name TEXT, region INTEGER)")
    db.executemany("INSERT INTO nation VALUES (?, ?, ?)", nations(spark, sf_dir))
    db.commit()
    scratch.put(spark, f"{path}/a.db", db.serialize())
    scratch.put(spark, f"{path}/b.db", b"no database at all" * 100)
    return files.read_sqlite(spark, path, "SELECT id, name FROM nation WHERE region = 1", "id int, name string",
        errors="error").select("id", "name", F.col("error").isNotNull().alias("broken"))


@query(
    """SELECT 'doc' || n_regionkey AS document, count(*) AS pages, sha256(string_agg((n_nationkey + 1) || chr(0) || n_name || chr(10),
'' ORDER BY n_nationkey)) AS digest, max(n_nationkey) + 1 <> count(*) AS incomplete FROM nation GROUP BY n_regionkey"""
)
def page_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of page texts for each region; most lack pages."""
    path = scratch.folder(spark, "pages")
    for k, n, r in nations(spark, sf_dir):
        scratch.put(spark, f"{path}/doc{r}/page-{k + 1:03}.txt", n.encode())
    pages = files.read_page_texts(spark, f"{path}/*")
    docs = pages.groupBy("document").agg(F.count(F.lit(1)).alias("n"), F.max("page").alias("page_count"))
    lacking = files.incomplete_pages(pages, docs.drop("n")).select("document", F.lit(True).alias("_bad"))
    return docs.join(files.page_digests(pages), "document").join(lacking, "document", "left").select("document", F.col("n").alias("pages"),
        F.col("text_digest").alias("digest"), F.coalesce("_bad", F.lit(False)).alias("incomplete"))


@query(
    """SELECT 'a' AS source, n_nationkey AS id, n_name AS name, CAST(NULL AS INTEGER) AS region
FROM nation WHERE n_nationkey < 10 UNION ALL SELECT 'b', n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey >= 10
UNION ALL SELECT 'record', n_nationkey, n_name || '!', CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey END FROM nation UNION ALL SELECT 'repeated', 2, NULL, NULL"""
)
def fragments_and_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table and its fragment as one, records unpacked from JSON, and how many keys stand twice where fragments overlap."""
    n = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    a, b = n.where("id < 10").drop("region").withColumn("source", F.lit("a")), n.where("id >= 10").withColumn("source", F.lit("b"))
    doc = F.concat(F.lit('[{"name": "'), "name", F.lit('!"'), F.when(F.col("id") % 2 == 0,
        F.concat(F.lit(', "region": '), F.col("region").cast("string"))).otherwise(""), F.lit("}]"))
    records = files.unpack_records(n.select("id", doc.alias("doc")), "doc", "name string, region int").withColumn("source", F.lit("record"))
    try:
        twice = 0
        files.merge_fragments(n.where("id < 10"), n.where("id between 8 and 12"), keys=["id"])
    except quality.QualityError as e:
        twice = sum(e.counts.values())
    bad = spark.createDataFrame([("repeated", twice)], "source string, id int")
    return files.union_sources(files.merge_fragments(a, b, keys=["id"]), records, bad).select("source", "id", "name", "region")


@query(
    """SELECT n_name || '.txt' AS name, CAST(3 AS BIGINT) AS bytes, sha256('r' || n_regionkey || chr(10)) AS sha256,
'[r' || n_regionkey || ']' AS scanned, 5 AS contents FROM nation"""
)
def scanned_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with few contents: digests of all, and a scan that sees each content once."""
    path = scratch.folder(spark, "scan")
    for _, n, r in nations(spark, sf_dir):
        scratch.put(spark, f"{path}/{n}.txt", f"r{r}\n".encode())
    digests = files.file_digests(spark, path).withColumn("text", F.lit(None).cast("string")).drop("text")
    content = spark.read.format("binaryFile").load(path).select("path", F.decode("content", "UTF-8").alias("text"))
    seen: list[int] = []

    def scan(rows: DataFrame) -> DataFrame:
        seen.append(rows.count())
        return rows.select("sha256", F.concat(F.lit("["), F.trim(F.replace("text", F.lit("\n"), F.lit(""))), F.lit("]")).alias("scanned"))

    out = files.scan_once(digests.join(content, "path"), scan)
    return out.select(F.element_at(F.split("path", "/"), -1).alias("name"), "bytes", "sha256", "scanned").withColumn("contents", F.lit(seen[0]).cast("int"))


@query(
    """SELECT o_custkey AS package, o_orderkey || '.txt' AS path, CAST(length(o_orderpriority) AS BIGINT) AS bytes, sha256(o_orderpriority) AS sha256, true AS same
FROM orders"""
)
def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of each customer as a package of files: their manifests, and that a package is the same in whatever order its members come."""
    o = t(spark, sf_dir, "orders")
    members = o.select(F.col("o_custkey").alias("package"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".txt")).alias("path"),
        F.encode("o_orderpriority", "UTF-8").alias("content"), "o_totalprice")
    first, second = (files.pack(m, "package").withColumn("content", F.sha2("content", 256)) for m in (members, members.orderBy("o_totalprice")))
    same = F.col("a.content") == F.col("b.content")
    both = first.alias("a").join(second.alias("b"), "package").select("package", "a.manifest", same.alias("same"))
    return both.select("package", F.inline("manifest"), "same")


@query(
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '/found/' || doc_id
ELSE '/old/' || doc_id END AS path FROM documents"""
)
def repaired_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("bid_no"),
        F.col("n_chars").alias("bytes"), F.sha2(F.concat_ws("/", "text", "doc_id"), 256).alias("sha256"))
    found = d.where("doc_id % 3 = 0").select("bid_no", "bytes", "sha256", F.concat(F.lit("/found/"), F.col("doc_id").cast("string")).alias("path"))
    later = found.withColumn("path", F.concat(F.lit("/zz"), "path"))
    return tables.repair_paths(d.withColumn("path", F.concat(F.lit("/old/"), F.col("doc_id").cast("string"))), found.union(later)).select("doc_id", "path")


@query(
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'container' WHEN 2 THEN 'no extension'
ELSE 'format not read' END AS exclusion, CASE p_partkey % 4 WHEN 0 THEN 'BOQ' ELSE '' END AS types FROM part"""
)
def nested_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    name = F.concat(key.cast("string"), F.when(key % 4 == 0, "/boq é.pdf").when(key % 4 == 1, "/in.ZIP").when(key % 4 == 2, "/none").otherwise("/x.odt"))
    nested = t(spark, sf_dir, "part").select("p_partkey", name.alias("source_file"))
    index = nested.where("p_partkey % 4 = 0").select(F.replace("source_file", F.lit("é"), F.lit("é")).alias("source_file"))
    got = tables.nested_inventory(nested.withColumn("source_file", F.replace("source_file", F.lit("é"), F.lit("é"))), index.union(index))
    return got.select("p_partkey", "exclusion", F.array_join("types", " | ").alias("types"))


# ---- collection ----


@query("SELECT o_orderkey, o_orderkey % 4 = 0 AS first_run FROM orders WHERE o_orderkey % 4 < 2")
def collected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a folder that grows: the second adds only keys that the first did not see."""
    path = scratch.folder(spark, "collect")
    source, target, state = (f"{path}/{n}" for n in ("source", "target", "state"))
    o = t(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 4 == 0).alias("first_run"))
    o.where("o_orderkey % 4 = 0").write.parquet(source)
    incremental.collect_incrementally(spark, source, o.schema, target, state, "o_orderkey").awaitTermination()
    o.where("o_orderkey % 4 < 2").withColumn("first_run", F.lit(False)).write.mode("append").parquet(source)
    incremental.collect_incrementally(spark, source, o.schema, target, state, "o_orderkey").awaitTermination()
    return spark.read.parquet(target)


@query(
    """SELECT CAST(n_nationkey AS INTEGER) AS page, 'total changed from 250 to 251' AS violation
FROM nation WHERE n_nationkey IN (7, 9) UNION ALL SELECT NULL, 'expected 250 rows, got ' || CAST(sum(CASE WHEN n_nationkey = 3 THEN 9
ELSE 10 END) AS VARCHAR) FROM nation"""
)
def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    pages = t(spark, sf_dir, "nation").select(key.cast("int").alias("page"), F.when(key.isin(7, 9), 251).otherwise(250).alias("total"),
        F.when(key == 3, 9).otherwise(10).alias("rows"))
    return incremental.page_violations(pages)


@query(
    """WITH a AS (SELECT l_orderkey AS g, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
l_extendedprice) AS step, l_quantity > 25 AS ok FROM lineitem),
s AS (SELECT a.g, min(a.step) AS stop FROM a JOIN a b ON b.g = a.g AND b.step = a.step - 1 WHERE NOT a.ok AND NOT b.ok GROUP BY 1)
SELECT a.g, a.step, a.ok FROM a LEFT JOIN s USING (g) WHERE stop IS NULL OR step <= stop"""
)
def attempts_until_stopped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as attempts: after the second failure in a row nothing is tried."""
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    a = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("g"), F.row_number().over(order).cast("long").alias("step"),
        (F.col("l_quantity") > 25).alias("ok"))
    return incremental.until_stopped(a, "g", 2)


@query("SELECT doc_id, CAST(1 AS BIGINT) AS page_count FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) WHERE length(text) > 0")
def document_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as one-page files: pages by document."""
    return evidence.page_metrics(t(spark, sf_dir, "documents").where("length(text) > 0"), "doc_id").select("doc_id", "page_count")
