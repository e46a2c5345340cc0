"""Entity resolution: direct ids, containment and fuzzy titles, canonical rows, screening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costquarry.operators.occurrences import occurrences
from costquarry.operators.titles import score_titles, title_score
from costquarry.scratch import stage

__all__ = ["score_titles", "title_score"]


def decide(scores: DataFrame, key: str, sure: float = 0.98, apart: float = 0.005, fuzzy: float = 0.86, margin: float = 0.04,
    prefix: str = "official_report") -> DataFrame:
    """Per record the best project if it is sure and alone at the top, or good with a margin to the second; else none, with the best score kept.

    A second that score_titles doesn't tell is further below than any margin asked for here.
    """
    gap = F.col("score") - F.coalesce("second", F.lit(0.0))
    method = F.when((F.col("score") >= sure) & (gap > apart),
        f"{prefix}_title_containment").when((F.col("score") >= fuzzy) & (gap >= margin), f"{prefix}_title_fuzzy")
    return scores.select(key, F.when(method.isNotNull(), F.col("project_no")).alias("project_no"), method.alias("method"), "score")


def link(records: DataFrame, official: DataFrame, existing: DataFrame, key: str = "record_id") -> DataFrame:
    """Project of each record: its own id (score 1), else by official titles, else by existing projects' titles; the best score is kept, if it is told."""
    open_rows = records.where(F.coalesce("project_no", F.lit("")) == "")
    a = decide(score_titles(open_rows, official, key), key)
    b = decide(score_titles(open_rows, existing, key), key, fuzzy=0.88, margin=0.05, prefix="existing_db")
    direct = F.nullif(F.col("r.project_no"), F.lit(""))
    out = records.alias("r").join(a.alias("a"), key, "left").join(b.alias("b"), key, "left")
    return out.select(
        key, direct.alias("project_no_source"), F.coalesce(direct, "a.project_no", "b.project_no").alias("project_no_linked"),
        F.when(direct.isNotNull(), "source_direct").otherwise(F.coalesce("a.method", "b.method")).alias("project_link_method"),
        F.round(F.when(direct.isNotNull(), F.lit(1.0)).otherwise(F.greatest("a.score", "b.score")), 3).alias("project_link_score"),
    )


def project_key(project_no: Column, alias: Column, record_id: Column) -> Column:
    """Linked project, else the verified alias, else an unlinked key of its own."""
    return F.coalesce(F.nullif(F.trim(project_no), F.lit("")), F.nullif(alias, F.lit("")), F.concat(F.lit("UNLINKED:"), record_id))


def canonical_projects(rows: DataFrame, key: str = "project_no") -> DataFrame:
    """One row per project: with country before without, with name, longest name, latest notice; flags hold if any row's do."""
    order = F.struct(F.coalesce("country_ko", F.lit("")) != "", F.coalesce("project_name", F.lit("")) != "",
        F.length(F.coalesce("project_name", F.lit(""))), "bid_no")
    return rows.groupBy(key).agg(
        F.max_by("country_ko", order).alias("country_ko"), F.max_by("project_name", order).alias("project_name"),
        F.bool_or(F.col("contract_type") == "공사").alias("has_works_contract"), F.bool_or("construction_candidate").alias("has_construction_candidate"),
    )


def canonical_file(files: DataFrame, digest: str = "sha256", name: str = "file_name") -> DataFrame:
    """Adds canonical_name: of the files of one content the one without a copy number, then the first by name."""
    numbered = F.col(name).rlike(r"\(\d+\)\.[^.]+$")
    w = Window.partitionBy(digest)
    return files.withColumn("canonical_name", F.min(F.struct(numbered,
        F.col(name).alias("n"))).over(w).getField("n")).withColumn("is_canonical", F.col(name) == F.col("canonical_name"))


def cyclic_parents(files: DataFrame, key: str = "file_id", parent: str = "duplicate_of") -> DataFrame:
    """Rows whose chain of parents never ends: violations.

    The step to the parent is doubled each round, and rows whose chain has ended are left out; after as many
    steps as there are rows only those of cycles, or that lead into one, remain.
    """
    now = files.select(F.col(key).alias("k"), F.col(parent).alias("p")).where("p is not null")
    now = stage(now, "parents")
    left, steps = now.count(), 1
    rows = left
    while left and steps < rows + 1:
        now = stage(now.alias("a").join(now.alias("b"), F.col("a.p") == F.col("b.k")).select("a.k", "b.p"), "parents")
        left, steps = now.count(), 2 * steps
    return now.select(F.col("k").alias(key))


def screening(universe: DataFrame, matches: DataFrame, key: str = "project_no") -> DataFrame:
    """Every project with accepted, reviewed_not_accepted or no_candidate, by its matches."""
    seen = matches.groupBy(key).agg(F.bool_or(F.col("review_status") == "accepted").alias("ok"))
    state = F.when(F.col("ok"), "accepted").when(F.col("ok").isNotNull(), "reviewed_not_accepted").otherwise("no_candidate")
    return universe.join(seen, key, "left").withColumn("match_status", state).drop("ok")


def crosswalk(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many keys two universes share and how many each has alone."""
    both = left.select(key).distinct().withColumn("l", F.lit(1)).join(right.select(key).distinct().withColumn("r", F.lit(1)), key, "full")
    return both.agg(F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("shared"),
        F.count_if(F.col("r").isNull()).alias("left_only"), F.count_if(F.col("l").isNull()).alias("right_only"))


def match_violations(matches: DataFrame, reports: DataFrame, least: float = 0.85) -> DataFrame:
    """Accepted matches with a low score, a name that the report's text lacks, or a report that has several and isn't marked for it.

    matches: (match_id, report_id, review_status, match_score, report_project_name); reports: (report_id, text, multi_project).
    """
    ok = matches.where("review_status = 'accepted'")
    many = ok.groupBy("report_id").agg(F.count(F.lit(1)).alias("_n"))
    texts = stage(reports.withColumn("_r", F.monotonically_increasing_id()), "reports")
    names, scope = F.lower("report_project_name"), F.col("report_id").cast("string")
    found = occurrences(texts.select(F.col("_r").alias("id"), scope.alias("scope"), F.lower("text").alias("text")), ok.select(scope.alias("scope"), names.alias("marker")))
    found = found.select(F.col("id").alias("_r"), F.col("marker").alias("_name"), F.lit(True).alias("_found"))
    # The texts themselves stay behind: a match goes on with whether there is one.
    j = ok.join(texts.select("report_id", "multi_project", "_r", F.col("text").isNotNull().alias("_read")), "report_id").join(many, "report_id")
    j = j.withColumn("_name", names).join(found, ["_r", "_name"], "left")
    lost = F.col("_read") & (F.col("_name") != "") & F.col("_found").isNull()
    why = F.array_compact(
        F.array(
            F.when(F.coalesce("match_score", F.lit(0.0)) < least, "score"),
            F.when(lost, "name not in report"),
            F.when((F.col("_n") > 1) & ~F.coalesce("multi_project", F.lit(False)), "several projects"),
        )
    )
    return j.select("match_id", F.explode(why).alias("violation"))


#: Pages that are met by one key.
PAGES_A_STRETCH = 8


def finding_violations(findings: DataFrame, pages: DataFrame, units: list[str]) -> DataFrame:
    """Findings whose excerpt stands on none of their pages, whose value isn't in the excerpt, or whose unit is unknown.

    findings: (finding_id, report_id, pdf_page_start, pdf_page_end, evidence_excerpt, value_numeric, unit); pages: (report_id, page, text).
    """
    from costquarry.functions.scalars import clean_or_empty, number_in_text

    excerpt = clean_or_empty(F.col("evidence_excerpt"))
    # Ranges and pages meet by report and stretch of pages, so that a finding is held against the pages near its own alone.
    stretch = lambda c: F.floor(F.col(c) / PAGES_A_STRETCH)
    ranges = findings.where("pdf_page_start <= pdf_page_end").select("finding_id", "report_id", "pdf_page_start", "pdf_page_end",
        excerpt.alias("_excerpt"), F.explode(F.sequence(stretch("pdf_page_start"), stretch("pdf_page_end"))).alias("_stretch"))
    texts = pages.where("report_id is not null").select("report_id", "page", stretch("page").alias("_stretch"), clean_or_empty(F.col("text")).alias("_text"))
    scope = F.concat_ws("/", F.col("report_id").cast("string"), F.col("_stretch").cast("string"))
    found = occurrences(texts.select(F.struct("report_id", "page").alias("id"), scope.alias("scope"), F.col("_text").alias("text")),
        ranges.where("report_id is not null").select(scope.alias("scope"), F.col("_excerpt").alias("marker")))
    within = F.col("page").between(F.col("pdf_page_start"), F.col("pdf_page_end"))
    held = found.select("id.report_id", "id.page", F.col("marker").alias("_excerpt")).distinct()
    on_page = ranges.join(held, ["report_id", "_excerpt"]).where(within).select("finding_id")
    # An empty excerpt stands on any page.
    blank = ranges.where("_excerpt = ''").join(texts.select("report_id", "page", "_stretch"), ["report_id", "_stretch"]).where(within).select("finding_id")
    on_page = on_page.union(blank).distinct()
    lost = findings.join(on_page, "finding_id", "left_anti").select("finding_id", F.lit("excerpt not on pages").alias("violation"))
    value = findings.where(F.col("value_numeric").isNotNull() & ~number_in_text(F.col("value_numeric"), excerpt)).select("finding_id",
        F.lit("value not in excerpt").alias("violation"))
    unit = findings.where(F.col("unit").isNotNull() & ~F.col("unit").isin(*units)).select("finding_id", F.lit("unit").alias("violation"))
    return lost.union(value).union(unit)
