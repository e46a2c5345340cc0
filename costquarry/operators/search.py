"""Scored case search, document-style lookups, findings search and status over the published tables.

Search arguments are ranking signals, never filters: each published case has a score. Lookups and
findings search filter. Every table that takes part must be published by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costquarry.functions.rules import stage_label
from costquarry.functions.scalars import area_closeness, contains_ci, either_contains, label_list, to_json_with_nulls

GRADE_POINTS = {"A": 5, "B": 4, "C": 3, "C?": 2, "U": 1}
#: Columns that stay inside.
PRIVATE = ("is_published", "synced_at")
NOTICE_DOC = ("related_bid_base_no", "representative_bid_no", "relation_type", "display_name", "contract_type", "amount_usd",
    "amount_stage_code", "notice_date", "procurement_url", "note")


def blank_to_none(x: str | None) -> str | None:
    return x.strip() or None if x else None


def clamp(n: int | None, default: int, most: int) -> int:
    """Result limit: the default where none is given, at least 1, at most `most`."""
    return min(max(default if n is None else n, 1), most)


#: A query as groups that are all needed; of a group's (word, excluded) one has to hold.
Terms = list[list[tuple[str, bool]]]


def parsed(query: str | None) -> Terms:
    """Words are all needed; OR between words is either; a leading minus excludes; quotes hold a phrase."""
    if not blank_to_none(query):
        return []
    import shlex

    try:
        words = shlex.split(query)
    except ValueError:
        words = query.split()
    groups: Terms = []
    joined = False
    for w in words:
        if w == "OR":
            joined = bool(groups)
            continue
        minus = len(w) > 1 and w[0] == "-"
        term = (w[1:] if minus else w, minus)
        if joined:
            groups[-1].append(term)
        else:
            groups.append([term])
        joined = False
    return groups


def text_query(text: Column, query: str | None) -> Column:
    """Whether a text meets a query (see parsed), by looking through it; case does not matter. `fulltext` answers the same by an index."""
    out = F.lit(True)
    for g in parsed(query):
        any_of = F.lit(False)
        for word, minus in g:
            hit = contains_ci(text, F.lit(word))
            any_of = any_of | (~hit if minus else hit)
        out = out & any_of
    return F.coalesce(out, F.lit(False))


def published(df: DataFrame) -> DataFrame:
    return df.where("is_published") if "is_published" in df.columns else df


def public(df: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Published rows with whitelisted columns, or all but the private ones."""
    return published(df).select(*(columns or [c for c in df.columns if c not in PRIVATE]))


def nested(df: DataFrame, key: str, order: list[Column], fields: list[str] | tuple[str, ...], out: str) -> DataFrame:
    """Per key the array of structs of `fields`, in the given order (compared as one struct, so ascending)."""
    keys = F.struct(*(c.alias(f"k{i}") for i, c in enumerate(order)), F.struct(*fields).alias("doc"))
    return df.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(keys)), lambda x: x["doc"]).alias(out))


def newest_first(day: Column) -> list[Column]:
    """Sort keys for a date, latest first and null last."""
    return [day.isNull(), -F.unix_date(day.cast("date"))]


def score_cases(cases: DataFrame, text: str | None = None, country: str | None = None, facility: str | None = None, work: str | None = None,
    area: float | None = None) -> DataFrame:
    """Adds match_score (decimal) and match_reason to published cases: country 40, facility 30, text 15, work 10, area up to 5, grade up to 5."""
    text, country, facility, work = map(blank_to_none, (text, country, facility, work))
    area = area if area and area > 0 else None
    c = F.col

    def like(column: str, wanted: str | None) -> Column:
        return F.lit(False) if wanted is None else either_contains(c(column),
            F.lit(wanted)) | F.coalesce(contains_ci(c("search_text"), F.lit(wanted)), F.lit(False))

    same_country = F.lit(False) if country is None else F.lower(F.coalesce(c("country_ko"), F.lit(""))) == country.lower()
    same_facility, same_work = like("facility_type", facility), like("work_type", work)
    same_text = F.lit(False) if text is None else text_query(c("search_text"), text)
    gfa = c("gross_floor_area_m2")
    near = F.lit(0).cast("decimal(10,2)") if area is None else area_closeness(gfa, area)
    close = F.lit(False) if area is None else F.coalesce(F.abs(gfa.cast("decimal(20,4)") - F.lit(area).cast("decimal(20,4)")) / F.lit(area).cast("decimal(20,4)") <= 0.25, F.lit(False))
    grade = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in GRADE_POINTS.items() for x in pair)),
        F.coalesce(c("evidence_grade"), F.lit(""))), F.lit(0))
    points = sum((F.when(hit, p).otherwise(0) for hit, p in ((same_country, 40), (same_facility, 30), (same_work, 10), (same_text, 15))), F.lit(0))
    labels = ((same_country, "동일 국가"), (same_facility, "동일·유사 시설기능"), (same_work, "동일 공종"), (same_text, "검색어 일치"), (close, "연면적 ±25%"))
    reason = label_list(*(F.when(hit, label) for hit, label in labels), default="근거등급 기준")
    return published(cases).withColumn("match_score", (points + grade + near).cast("decimal(10,2)")).withColumn("match_reason", reason)


def search_cases(cases: DataFrame, notices: DataFrame | None = None, n: int | None = None, **signals) -> DataFrame:
    """The best n cases (10, at most 50) with dense rank by score, amount label and related notices.

    Order: score, then notice date with null last, then case id. The rank needs only the scores of the
    rows that are shown and all above them, so the top n are cut out before the ranking window.
    """
    top = score_cases(cases, **signals).orderBy(F.desc("match_score"), F.desc_nulls_last("notice_date"), "case_id").limit(clamp(n, 10, 50))
    top = top.withColumn("priority", F.dense_rank().over(Window.orderBy(F.desc("match_score"))).cast("long"))
    if "amount_stage_code" in top.columns:
        top = top.withColumn("amount_basis_label", stage_label(F.col("amount_stage_code")))
    if notices is not None:
        top = with_notices(top, notices)
    return top.orderBy("priority", F.desc_nulls_last("notice_date"), "case_id")


def with_notices(cases: DataFrame, notices: DataFrame, fields: tuple[str, ...] = NOTICE_DOC) -> DataFrame:
    """Adds related_notices, an array in order of date (latest first) and group number; none: empty."""
    own = published(notices).join(cases.select("case_id").distinct(), "case_id", "left_semi")
    docs = nested(own, "case_id", [*newest_first(F.col("notice_date")), F.col("related_bid_base_no")], fields, "related_notices")
    out = cases.join(docs, "case_id", "left")
    kind = docs.schema["related_notices"].dataType
    return out.withColumn("related_notices", F.coalesce("related_notices", F.array().cast(kind)))


def with_evaluation(cases: DataFrame, projects: DataFrame, matches: DataFrame, findings: DataFrame) -> DataFrame:
    """Cases with the match status of their project's published evaluation (null without one) and the count of its published findings."""
    p = published(projects).select("project_no", F.col("match_status").alias("evaluation_match_status"))
    n = published(matches).select("match_id", "project_no").join(published(findings).select("match_id"),
        "match_id").groupBy("project_no").agg(F.count(F.lit(1)).alias("_n"))
    out = cases.join(p, "project_no", "left").join(n, "project_no", "left")
    return out.withColumn("evaluation_finding_count", F.coalesce("_n", F.lit(0))).drop("_n")


def get_case(cases: DataFrame, notices: DataFrame, case_id: str) -> DataFrame:
    """The published case of an id with its notices, or no row."""
    return with_notices(public(cases.where(F.col("case_id") == case_id)), notices, tuple(c for c in notices.columns if c not in (*PRIVATE, "case_id")))


def get_related(notices: DataFrame, case_id: str) -> DataFrame:
    return public(notices).where(F.col("case_id") == case_id).orderBy(F.desc_nulls_last("notice_date"), "related_bid_base_no")


def status(cases: DataFrame, notices: DataFrame, metadata: DataFrame | None = None, by_metadata: bool = True) -> DataFrame:
    """One row of counts and dates of the published cases.

    by_metadata: the counts are grouped by the snapshot's metadata, so that without a published case
    there is no row; otherwise there always is one.
    """
    counts = published(cases).agg(
        F.count(F.lit(1)).alias("case_count"),
        F.count_if(F.col("evidence_grade").isin("A", "B", "C")).alias("graded_case_count"),
        F.min("notice_date").alias("earliest_notice_date"),
        F.max("notice_date").alias("latest_notice_date"),
        F.max("audit_date").alias("audit_date"),
    )
    out = counts.crossJoin(published(notices).agg(F.count(F.lit(1)).alias("related_notice_count")))
    if metadata is not None:
        out = out.join(metadata.limit(1), F.lit(True), "left")
    return out.where("case_count > 0") if by_metadata else out


def findings_star(findings: DataFrame, matches: DataFrame, projects: DataFrame, reports: DataFrame) -> DataFrame:
    """Published findings joined to their published match, project and report; the latter three are small and shared by many."""
    drop = lambda df, *more: published(df).drop(*PRIVATE, *more)
    return drop(findings).join(drop(matches, "data_version"), "match_id").join(drop(projects, "data_version"),
        "project_no").join(drop(reports, "data_version"), "report_id")


def search_findings(star: DataFrame, query: str | None = None, project_no: str | None = None, country: str | None = None,
    category: str | None = None, n: int | None = None, hits: DataFrame | None = None) -> DataFrame:
    """Findings that meet all given conditions (blank ones are left out), the latest publications first; 20, at most 100.

    hits: keys (finding_id as key) that an index found for a query, instead of a query that looks through the texts.
    """
    query, project_no, country, category = map(blank_to_none, (query, project_no, country, category))
    if hits is not None:
        star = star.join(hits.withColumnRenamed("key", "finding_id"), "finding_id", "left_semi")
    if query:
        star = star.where(text_query(F.col("search_text"), query))
    if project_no:
        star = star.where(F.col("project_no") == project_no)
    if country:
        star = star.where(contains_ci(F.col("country_ko"), F.lit(country)))
    if category:
        star = star.where(F.col("category") == category.lower())
    return star.orderBy(F.desc_nulls_first("publication_date"), "project_no", "pdf_page_start", "finding_id").limit(clamp(n, 20, 100))


def project_document(projects: DataFrame, matches: DataFrame, reports: DataFrame, findings: DataFrame, project_no: str | None = None) -> DataFrame:
    """Per published project: counts, and arrays of its reports and findings.

    report_count counts distinct published reports; finding_count does not ask whether the report is
    published, while the findings array does, so it may exceed the array's length.
    """
    p = public(projects)
    if project_no is not None:
        p = p.where(F.col("project_no") == project_no.strip())
    m = published(matches).drop(*PRIVATE)
    r, f = published(reports).drop(*PRIVATE), published(findings).drop(*PRIVATE)
    mr = m.join(r, "report_id")
    text_desc = F.transform(F.split(F.coalesce("publication_date", F.lit("9999-99")), ""), lambda ch: -F.ascii(ch))
    report_docs = nested(mr, "project_no", [text_desc, F.col("report_id")], [c for c in mr.columns if c != "project_no"], "reports")
    mrf = mr.select("match_id", "report_id", "project_no", "publication_date").join(f.drop("report_id", "project_no", "publication_date"), "match_id")
    finding_docs = nested(mrf, "project_no", [text_desc, F.col("pdf_page_start"), F.col("finding_id")],
        [c for c in mrf.columns if c != "project_no"], "findings")
    n_reports = mr.groupBy("project_no").agg(F.countDistinct("report_id").alias("report_count"))
    n_findings = m.select("match_id", "project_no").join(f.select("match_id"), "match_id").groupBy("project_no").agg(F.count(F.lit(1)).alias("finding_count"))
    out = p
    for part in (n_reports, n_findings, report_docs, finding_docs):
        out = out.join(part, "project_no", "left")
    empty = lambda c, d: F.coalesce(c, F.array().cast(d.schema[c].dataType)).alias(c)
    return out.select(*p.columns, F.coalesce("report_count", F.lit(0)).alias("report_count"),
        F.coalesce("finding_count", F.lit(0)).alias("finding_count"), empty("reports", report_docs), empty("findings", finding_docs))


def as_json(df: DataFrame, out: str = "doc") -> DataFrame:
    """Each row as one JSON text, nulls kept."""
    return df.select(to_json_with_nulls(F.struct(*df.columns)).alias(out))
