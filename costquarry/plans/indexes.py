"""Queries by indexes and joins on parts of texts: full-text search, linked names, many markers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costquarry import scratch
from costquarry.operators import fulltext, linking, partitioned, quality, search, titles
from costquarry.plans.queries import _STAR, findings, query, t
from costquarry.streaming import markers

_SEARCHES = {"all": "the and", "any": "eaux OR thnd", "without": "the -and", "phrase": '"on the it" OR "is and"', "neither": "-en -an", "either_not": "ring -the OR eau",
    "letter": "x", "blank": " "}


@query(
    """WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS s FROM documents)
SELECT 'all' AS form, doc_id FROM d WHERE contains(s, 'the') AND contains(s, 'and') UNION ALL
SELECT 'any', doc_id FROM d WHERE contains(s, 'eaux') OR contains(s, 'thnd') UNION ALL
SELECT 'without', doc_id FROM d WHERE contains(s, 'the') AND NOT contains(s, 'and') UNION ALL
SELECT 'phrase', doc_id FROM d WHERE contains(s, 'on the it') OR contains(s, 'is and') UNION ALL
SELECT 'neither', doc_id FROM d WHERE NOT contains(s, 'en') AND NOT contains(s, 'an') UNION ALL
SELECT 'either_not', doc_id FROM d WHERE contains(s, 'ring') AND (NOT contains(s, 'the') OR contains(s, 'eau')) UNION ALL
SELECT 'letter', doc_id FROM d WHERE contains(s, 'x') UNION ALL SELECT 'blank', doc_id FROM d"""
)
def indexed_text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each form of query over an index of all documents."""
    index = fulltext.Index(spark, fulltext.write_index(t(spark, sf_dir, "documents"), scratch.folder(spark, "index")))
    found = [index.search(q).select(F.lit(form).alias("form"), F.col("key").alias("doc_id")) for form, q in _SEARCHES.items()]
    return reduce(DataFrame.unionByName, found)


@query(
    f"""WITH {_STAR} SELECT finding_id, project_no, report_id, publication_date, category, page AS pdf_page_start
FROM f JOIN m USING (match_id) JOIN p USING (project_no) JOIN r USING (report_id)
WHERE contains(lower(txt), 'low') OR contains(lower(txt), 'not s') ORDER BY publication_date DESC, project_no, page, finding_id LIMIT 100"""
)
def indexed_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings whose text an index finds."""
    o, m, p, r = findings(spark, sf_dir)
    star = search.findings_star(o, m, p, r)
    index = fulltext.Index(spark, fulltext.write_index(o, scratch.folder(spark, "index"), "finding_id", "search_text", buckets=16), 16)
    got = search.search_findings(star, n=100, hits=index.search('low OR "not s"'))
    return got.select("finding_id", "project_no", "report_id", "publication_date", "category", "pdf_page_start")


@query()
def client_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients of the web source as records against all others' names, by nation as country; tests compare it with plain loops."""
    c = t(spark, sf_dir, "clients")
    nation = F.coalesce(F.col("nation_id").cast("string"), F.lit(""))
    rec = c.where("source = 'web'").select(F.col("client_id").alias("record_id"), F.col("name").alias("title"), F.array(nation).alias("countries"))
    cand = c.where("source <> 'web'").select(F.col("client_id").cast("string").alias("project_no"), F.col("name").alias("title"), nation.alias("country"))
    return linking.decide(linking.score_titles(rec, cand), "record_id")


@query(
    """WITH m AS (SELECT doc_id AS label, lower(substr(text, 1, 30)) AS marker FROM documents WHERE text <> '')
SELECT d.doc_id, (SELECT first(label ORDER BY length(marker) DESC, CAST(label AS VARCHAR)) FROM m WHERE contains(lower(d.text), marker)) AS opening FROM documents d"""
)
def longest_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The openings of all documents as markers: of which document the longest opening stands in each text."""
    d = t(spark, sf_dir, "documents")
    markers = d.select(F.col("doc_id").cast("string").alias("label"), F.substring("text", 1, 30).alias("marker"))
    return titles.longest_marker(d.select("doc_id", "text"), "text", markers, "opening").select("doc_id", F.col("opening").cast("long").alias("opening"))


def client_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Clients before and after the last hours of changes: the latest change of each gives segment and balance, or deletes it."""
    c, ch = t(spark, sf_dir, "clients").where("client_id is not null"), t(spark, sf_dir, "client_changes")
    order = ["updated_at", *(x for x in c.columns if x not in ("client_id", "updated_at"))]
    before = c.groupBy("client_id").agg(F.max_by(F.struct("source", "segment", "balance"), F.struct(*order)).alias("c")).select("client_id", "c.*")
    last = ch.where("valid_at >= timestamp '2024-04-29 18:00:00' and client_id is not null").groupBy("client_id").agg(
        F.max(F.struct("valid_at", "seq", "change_id", "op", "segment", "balance")).alias("h"))
    after = before.join(last, "client_id", "left").where("h is null or h.op is null or h.op <> 'D'")
    return before, after.select("client_id", "source", F.coalesce("h.segment", "segment").alias("segment"), F.coalesce("h.balance", "balance").alias("balance"))


def merged_twice(spark: SparkSession, sf_dir: str) -> tuple[partitioned.PartitionedTable, DataFrame]:
    """A table after both states and the second once more, and the counts of each merge by part."""
    table = partitioned.PartitionedTable(spark, scratch.folder(spark, "clients"), ["client_id"], parts=32)
    before, after = client_states(spark, sf_dir)
    runs = [("1 load", before, "2024-05-30"), ("2 changes", after, "2024-06-01"), ("3 again", after, "2024-06-02")]
    counts = [table.merge(df, stamp).select(F.lit(name).alias("run"), "*") for name, df, stamp in runs]
    return table, reduce(DataFrame.unionByName, counts)


_STATES = """before AS (SELECT client_id, source, segment, balance FROM clients WHERE client_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY client_id
ORDER BY updated_at DESC NULLS LAST, master_id DESC NULLS LAST, source DESC NULLS LAST, name DESC NULLS LAST, email DESC NULLS LAST, city DESC NULLS LAST,
nation_id DESC NULLS LAST, segment DESC NULLS LAST, balance DESC NULLS LAST) = 1),
last AS (SELECT client_id, op, segment AS s, balance AS b FROM client_changes WHERE valid_at >= TIMESTAMP '2024-04-29 18:00:00' AND client_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY valid_at DESC NULLS LAST, seq DESC NULLS LAST, change_id DESC NULLS LAST, op DESC NULLS LAST,
segment DESC NULLS LAST, balance DESC NULLS LAST) = 1),
both_states AS (SELECT b.*, coalesce(op, '') = 'D' AS gone, coalesce(s, segment) AS new_segment, coalesce(l.b, balance) AS new_balance,
('0x' || substr(md5('{"client_id":' || client_id || '}'), 1, 8))::BIGINT % 32 AS part FROM before b LEFT JOIN last l USING (client_id)),
acts AS (SELECT *, CASE WHEN gone THEN 'deleted' WHEN new_segment IS NOT DISTINCT FROM segment AND new_balance IS NOT DISTINCT FROM balance
THEN 'kept' ELSE 'updated' END AS act FROM both_states)"""


@query(
    f"""WITH {_STATES} SELECT '1 load' AS run, count(*) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS kept, CAST(0 AS BIGINT) AS deleted,
count(DISTINCT part) AS parts_written FROM acts
UNION ALL SELECT '2 changes', 0, count(*) FILTER (act = 'updated'), count(*) FILTER (act = 'kept'), count(*) FILTER (act = 'deleted'),
count(DISTINCT part) FILTER (act <> 'kept') FROM acts
UNION ALL SELECT '3 again', 0, 0, count(*) FILTER (act <> 'deleted'), 0, 0 FROM acts"""
)
def merged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three merges of the clients did, and how many parts each wrote: of the third, which brings nothing new, none."""
    _, counts = merged_twice(spark, sf_dir)
    written = F.col("inserted") + F.col("updated") + F.col("deleted") > 0
    return counts.groupBy("run").agg(*(F.sum(a).alias(a) for a in partitioned.ACTIONS), F.count_if(written).alias("parts_written"))


@query(
    f"""WITH {_STATES} SELECT client_id, source, new_segment AS segment, new_balance AS balance,
CASE act WHEN 'kept' THEN TIMESTAMP '2024-05-30' ELSE TIMESTAMP '2024-06-01' END AS synced_at FROM acts WHERE NOT gone"""
)
def merged_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table behind the merges: rows that didn't change keep the time of the first."""
    return merged_twice(spark, sf_dir)[0].read()


_LISTED = """SELECT {run} AS run, client_id, CAST(floor(balance) AS BIGINT) AS size, valid_at AS mtime FROM (SELECT * FROM client_changes
WHERE client_id IS NOT NULL AND valid_at < TIMESTAMP '{until}' QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY valid_at DESC NULLS LAST, seq DESC NULLS LAST,
change_id DESC NULLS LAST, op DESC NULLS LAST, floor(balance) DESC NULLS LAST) = 1) WHERE op IS NULL OR op <> 'D'"""
_LISTINGS = (("2024-03-01", 1), ("2024-06-01", 2), ("2024-06-01", 3), ("2024-03-01", 4))


@query(
    f"""WITH l AS ({" UNION ALL ".join(_LISTED.format(run=run, until=until) for until, run in _LISTINGS)}),
b AS (SELECT *, lag(size) OVER w AS old_size, lag(mtime) OVER w AS old_mtime, row_number() OVER w AS k FROM l WINDOW w AS (PARTITION BY client_id ORDER BY run))
SELECT run, client_id, size, mtime, CASE WHEN k = 1 THEN 'new' ELSE 'changed' END AS action FROM b
WHERE k = 1 OR old_size IS DISTINCT FROM size OR old_mtime IS DISTINCT FROM mtime"""
)
def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients as files that grow by their changes, listed as of March, of June, again, and as of March: what each listing hands out."""
    ch = t(spark, sf_dir, "client_changes").where("client_id is not null")
    last = F.max(F.struct("valid_at", "seq", "change_id", "op", F.floor("balance").alias("size"))).alias("h")
    watched = markers.WatchedFiles(spark, scratch.folder(spark, "watched"))
    for until, _ in _LISTINGS:
        state = ch.where(F.col("valid_at") < F.lit(until).cast("timestamp")).groupBy("client_id").agg(last).where("h.op is null or h.op <> 'D'")
        watched.update(state.select(F.col("client_id").cast("string").alias("path"), "h.size", F.col("h.valid_at").alias("mtime")))
    return watched.changed().select("run", F.col("path").cast("long").alias("client_id"), "size", F.col("mtime").cast("timestamp_ntz").alias("mtime"), "action")


def sales_rules() -> dict[str, quality.Rules]:
    """What should hold of sales and their lines."""
    col = F.col
    lines = quality.Rules(
        {"quantity": col("quantity") > 0, "amount": col("amount") >= 0, "discount": col("discount").between(0, 1), "shipped": col("shipped_at").isNotNull()},
        unique={"line": ("sale_id", "line_no"), "whole line": ("sale_id", "line_no", "item_id", "vendor_id")},
        foreign={"sale": (("sale_id",), "sales", ("sale_id",)), "item": (("item_id",), "items", ("item_id",)), "vendor": (("vendor_id",), "vendors", ("vendor_id",))},
        least=1)
    sales = quality.Rules({"total": col("total") >= 0, "arrival": col("arrived_at") >= col("sold_at"), "client id": col("client_id").isNotNull()},
        unique={"sale": ("sale_id",)}, foreign={"client": (("client_id",), "clients", ("client_id",))}, most=1)
    return {"lines": lines, "sales": sales}


def sales_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = {"lines": "sale_lines", "sales": "sales", "items": "items", "vendors": "vendors", "clients": "clients"}
    return {n: t(spark, sf_dir, table) for n, table in names.items()}


_SALES_CHECKS = """SELECT 'lines' AS "table", 'quantity' AS name, count(*) FILTER (NOT quantity > 0) AS n FROM sale_lines
UNION ALL SELECT 'lines', 'amount', count(*) FILTER (NOT amount >= 0) FROM sale_lines
UNION ALL SELECT 'lines', 'discount', count(*) FILTER (NOT discount BETWEEN 0 AND 1) FROM sale_lines
UNION ALL SELECT 'lines', 'shipped', count(*) FILTER (shipped_at IS NULL) FROM sale_lines
UNION ALL SELECT 'lines', 'number of rows', CAST(count(*) < 1 AS BIGINT) FROM sale_lines
UNION ALL SELECT 'lines', 'line', count(*) FROM (SELECT 1 FROM sale_lines GROUP BY sale_id, line_no HAVING count(*) > 1)
UNION ALL SELECT 'lines', 'whole line', count(*) FROM (SELECT 1 FROM sale_lines GROUP BY sale_id, line_no, item_id, vendor_id HAVING count(*) > 1)
UNION ALL SELECT 'lines', 'sale', count(*) FROM sale_lines l WHERE sale_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sales s WHERE s.sale_id = l.sale_id)
UNION ALL SELECT 'lines', 'item', count(*) FROM sale_lines l WHERE item_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM items i WHERE i.item_id = l.item_id)
UNION ALL SELECT 'lines', 'vendor', count(*) FROM sale_lines l WHERE vendor_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM vendors v WHERE v.vendor_id = l.vendor_id)
UNION ALL SELECT 'sales', 'total', count(*) FILTER (NOT total >= 0) FROM sales UNION ALL SELECT 'sales', 'arrival', count(*) FILTER (NOT arrived_at >= sold_at) FROM sales
UNION ALL SELECT 'sales', 'client id', count(*) FILTER (client_id IS NULL) FROM sales
UNION ALL SELECT 'sales', 'number of rows', CAST(count(*) > 1 AS BIGINT) FROM sales
UNION ALL SELECT 'sales', 'sale', count(*) FROM (SELECT 1 FROM sales GROUP BY sale_id HAVING count(*) > 1)
UNION ALL SELECT 'sales', 'client', count(*) FROM sales s WHERE client_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM clients c WHERE c.client_id = s.client_id)"""


@query(_SALES_CHECKS)
def sales_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen checks of sales and their lines, each table read once for conditions and once for keys."""
    return quality.check_tables(sales_tables(spark, sf_dir), sales_rules())


@query(f"""SELECT "table" || ': ' || name AS name, n FROM ({_SALES_CHECKS})""")
def sales_written_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same checks, conditions as metrics of the write, keys in the written files."""
    counts = quality.write_checked(sales_tables(spark, sf_dir), f"{scratch.folder(spark, 'checked')}/tables", sales_rules())
    return spark.createDataFrame(list(counts.items()), "name string, n long")
