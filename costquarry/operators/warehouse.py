"""Analytic views of the warehouse: coverage, inventories, queues, duplicates and price-index coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_WARNING = "권고단가 아님: 가격·범위 보정 후 현지견적과 교차검증"
READY_WARNING = "A/B는 BOQ 준비도, C는 초기 스크리닝; 현지단가·물가·환율·범위 보정 필요"
READY = ("A", "B", "C")
FOLLOW_UP = ("C?", "U")


def sample_coverage(cases: DataFrame, keys: list[str] | None = None, grade: str = "evidence_grade", day: str = "notice_date",
    unit: str = "unit_usd_m2_nominal") -> DataFrame:
    """Cases, grade-A cases, first and last date, lowest and highest unit cost by country, facility and work."""
    keys = keys or ["country", "facility_type", "work_type"]
    return cases.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("reviewed_case_count"),
        F.count_if(F.col(grade) == "A").alias("grade_a_count"),
        F.min(day).alias("earliest_notice_date"),
        F.max(day).alias("latest_notice_date"),
        F.min(unit).alias("nominal_unit_min"),
        F.max(unit).alias("nominal_unit_max"),
        F.first(F.lit(SAMPLE_WARNING)).alias("use_warning"),
    )


def yearly_inventory(cases: DataFrame, day: str = "notice_date", grade: str = "evidence_grade", open_case: Column | None = None) -> DataFrame:
    """Cases by the year of a date (or of text that begins with it)."""
    open_case = F.col("normalization_status") == "미보정" if open_case is None else open_case
    year = F.substring(F.col(day).cast("string"), 1, 4).alias("notice_year")
    return cases.groupBy(year).agg(F.count(F.lit(1)).alias("reviewed_case_count"), F.count_if(F.col(grade) == "A").alias("grade_a_count"),
        F.count_if(open_case).alias("unnormalized_count"))


def ready_projects(projects: DataFrame, grade: str = "compact_grade") -> DataFrame:
    return projects.where(F.col(grade).isin(*READY)).withColumn("use_warning", F.lit(READY_WARNING))


def follow_up_queue(projects: DataFrame, grade: str = "compact_grade") -> DataFrame:
    return projects.where(F.col(grade).isin(*FOLLOW_UP))


def accepted_findings(findings: DataFrame, matches: DataFrame, screening: DataFrame, reports: DataFrame) -> DataFrame:
    """Accepted findings of accepted matches with the project's screening and the report."""
    m = matches.where("review_status = 'accepted'").drop("review_status")
    f = findings.where("review_status = 'accepted'").drop("review_status")
    return f.join(m, "match_id").join(screening.drop("review_status"), "project_no").join(reports.drop("review_status"), "report_id")


def duplicate_attachments(files: DataFrame, digest: str = "sha256", size: str = "bytes") -> DataFrame:
    """Digests that stand on more than one row, with copies and bytes in total; blank digests don't count."""
    known = files.where(F.col(digest).isNotNull() & (F.col(digest) != ""))
    return known.groupBy(digest).agg(F.count(F.lit(1)).alias("copies"), F.sum(size).alias("total_bytes")).where("copies > 1")


def index_coverage(sources: DataFrame, values: DataFrame) -> DataFrame:
    """Per index source with a priority: observations, first and last period, status of the last, latest retrieval; sources without any stay."""
    seen = values.where("is_actual").groupBy("source_id").agg(
        F.count("period").alias("actual_observation_count"),
        F.min("period").alias("earliest_period"),
        F.max("period").alias("latest_period"),
        F.max_by("observation_status", F.struct("period", "observation_status")).alias("latest_observation_status"),
        F.max("retrieved_at").alias("latest_retrieved_at"),
    )
    out = sources.where(F.col("priority").isNotNull()).join(seen, "source_id", "left")
    return out.withColumn("actual_observation_count", F.coalesce("actual_observation_count", F.lit(0)))


def best_index(coverage: DataFrame, least: int = 2) -> DataFrame:
    """The sources of the lowest priority with at least two observations, for each country; ties all stay."""
    enough = coverage.where(F.col("actual_observation_count") >= least)
    lowest = enough.groupBy("country").agg(F.min("priority").alias("_least"))
    return enough.join(lowest, "country").where("priority = _least").drop("_least")


def index_coverage_report(countries: DataFrame, best: DataFrame, audit: DataFrame) -> DataFrame:
    """Per country of the list: best priority and what is known about its official source."""
    b = best.groupBy("country").agg(F.min("priority").alias("best_priority"), F.max("actual_observation_count").alias("observations"))
    a = audit.groupBy("country").agg(F.max("status").alias("audit_status"))
    state = F.when(F.col("best_priority").isNotNull(), "observed").when(F.col("audit_status").isNotNull(), "source known").otherwise("no source")
    return countries.select("country").distinct().join(b, "country", "left").join(a, "country", "left").withColumn("coverage_status", state)


def country_readiness(projects: DataFrame, country: str = "country_ko", grade: str = "grade", status: str = "technical_status") -> DataFrame:
    """Projects by grade and status letter per country, its best grade and what its sample suffices for."""
    counts = projects.groupBy(F.coalesce(F.nullif(F.col(country), F.lit("")), F.lit("미상")).alias(country)).agg(
        F.count(F.lit(1)).alias("candidate_project_count"),
        *(F.count_if(F.col(grade) == g).alias(f"grade_{g.lower()}_projects") for g in "ABC"),
        F.count_if(F.col(status).startswith("C")).alias("screening_c_projects"),
        F.count_if(F.col(status).startswith("U")).alias("unresolved_u_projects"),
    )
    a, b = F.col("grade_a_projects"), F.col("grade_b_projects")
    enough = (
        F.when(a >= 3, "초기 국가모형 가능(독립성·시설유형 추가검증 필요)")
        .when(a > 0, "가격사례 부족: 사업별 기준점만 가능")
        .when(b > 0, "수량사례만 있음: 현지단가 필요")
        .otherwise("직접 산정근거 없음: 문서추적·원단위 스크리닝만")
    )
    best = F.when(a > 0, "A").when(b > 0, "B").otherwise("C")
    return counts.withColumn("country_best_project_grade", best).withColumn("country_sample_sufficiency", enough)


def unit_cost_summary(cases: DataFrame, country: str = "country", unit: str = "unit_usd_m2_nominal", include: str = "summary_include") -> DataFrame:
    """Mean, lowest and highest unit cost of the included cases per country, and how far they go: one case, up to four, more."""
    out = cases.where(F.col(include)).groupBy(country).agg(F.count(F.lit(1)).alias("cases"), F.avg(unit).alias("mean_unit"),
        F.min(unit).alias("min_unit"), F.max(unit).alias("max_unit"))
    return out.withColumn("interpretation", F.when(F.col("cases") <= 1, "단일 사례").when(F.col("cases") <= 4, "소표본").otherwise("비교 가능"))


def grade_counts(projects: DataFrame, *by: str) -> DataFrame:
    """Rows by grade, status or both."""
    return projects.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def evidence_counts(evidence: DataFrame, projects: DataFrame, key: str = "bid_no") -> DataFrame:
    """Evidence records by notice and category, with the notice's project, country and name (empty where unknown)."""
    out = evidence.groupBy(key, "category").agg(F.count(F.lit(1)).alias("evidence_records")).join(projects.select(key, "project_no",
        "country_ko", "project_name"), key, "left")
    return out.select(key, *(F.coalesce(c, F.lit("")).alias(c) for c in ("project_no", "country_ko", "project_name")), "category", "evidence_records")


def source_stats(rows: DataFrame) -> DataFrame:
    """Seven counters of a source's rows; flags are 0, 1 or null."""
    on = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0)) != 0
    return rows.agg(
        F.count(F.lit(1)).alias("normalized_row_count"), F.count_if(on("construction_related")).alias("construction_related_count"),
        F.count_if(on("is_uganda")).alias("uganda_row_count"),
        F.count_if(on("is_uganda") & on("construction_related")).alias("uganda_construction_related_count"),
        F.count_if(F.coalesce("project_no_linked", F.lit("")) != "").alias("linked_project_no_count"),
        F.count_if(on("existing_db_project_match")).alias("existing_db_project_match_count"),
        F.count_if(on("unit_cost_potential")).alias("unit_cost_potential_count"),
    )


def numbered(df: DataFrame, *order: str | Column, out: str = "audit_no") -> DataFrame:
    """Rows with their number from 1 in a total order, by a range sort and the sizes of its parts; no task sees all rows."""
    placed = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).persist()
    part, within = F.shiftright("_id", 33).cast("int"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, seen = [], 0
    for p in sorted(sizes):
        before += [F.lit(p), F.lit(seen).cast("long")]
        seen += sizes[p]
    first = F.element_at(F.create_map(*before), part) if before else F.lit(0).cast("long")
    return placed.withColumn(out, first + within + 1).drop("_id")


def evidence_in_order(evidence: DataFrame, key: str = "bid_no") -> DataFrame:
    """Evidence by the order of categories, then the latest notice number, then the file."""
    from costquarry.functions.rules import category_rank

    return evidence.withColumn("category_rank", category_rank(F.col("category"))).orderBy("category_rank", F.desc(key), "source_file")


def corpus_digest(files: DataFrame, name: str, digest: str, size: str) -> DataFrame:
    """One SHA-256 over the sorted lines `name NUL digest NUL size LF`. One row gathers all lines: for file lists, not for contents."""
    line = F.concat_ws("\0", F.col(name), F.col(digest), F.col(size).cast("string"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(name).alias("n"), line.alias("l")))),
        lambda x: F.concat(x["l"], F.lit("\n"))), "")
    return files.agg(F.count(F.lit(1)).alias("file_count"), F.sha2(joined, 256).alias("corpus_sha256"))


def attachment_stats(files: DataFrame, key: str = "bid_no") -> DataFrame:
    """Per notice: files, distinct contents, bytes, workbooks, files named as bills and blank bills."""
    from costquarry.functions.rules import BLANK_BOQ_FILE, BOQ_FILE

    name = F.col("source_file")
    return files.groupBy(key).agg(
        F.count(F.lit(1)).alias("files"),
        F.countDistinct("sha256").alias("distinct_files"),
        F.sum("bytes").alias("bytes"),
        F.count_if(F.lower(name).rlike(r"\.(xlsx|xlsm|xls)$")).alias("workbooks"),
        F.count_if(name.rlike(BOQ_FILE)).alias("boq_files"),
        F.count_if(name.rlike(BLANK_BOQ_FILE)).alias("blank_boq_files"),
    )
