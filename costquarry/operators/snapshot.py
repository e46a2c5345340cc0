"""The sanitized read model: published cases with precedence from notice over group over project over raw rows, and related notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costquarry.functions.rules import compact_grade, facility_family, family_aliases, relation
from costquarry.functions.scalars import clean, money, ratio, usd_ceiling

NOTICE, REFERENCE = "CONSTRUCTION_NOTICE", "DESIGN_SUPERVISION_REFERENCE"
RAW_STAGE = "NOTICE_EXECUTION_CEILING_RAW"


def first_text(*xs: Column) -> Column:
    """First that is not blank."""
    return F.coalesce(*map(clean, xs))


def first_value(*xs: Column) -> Column:
    """First that is not null; zero counts as a value."""
    return F.coalesce(*xs)


def first_true(*xs: Column) -> Column:
    """First that is neither null nor zero."""
    return F.coalesce(*(F.nullif(x, F.lit(0).cast("double")) for x in xs))


def latest_rows(rows: DataFrame, key: str) -> DataFrame:
    """Per key the row of the latest date, then number."""
    order = F.struct(F.coalesce(clean(F.col("notice_date")), F.lit("")), F.coalesce(clean(F.col("bid_no")), F.lit("")))
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("r")).select(key, "r.*")


def contract(prefix: str = "") -> Column:
    return first_text(F.col(f"{prefix}contract_type"), F.col(f"{prefix}source_contract_type"))


def title(prefix: str = "") -> Column:
    return first_text(F.col(f"{prefix}bid_title_ko"), F.col(f"{prefix}source_bid_title"))


def case_groups(rows: DataFrame, projects: DataFrame) -> DataFrame:
    """Published groups (bid_base_no, case_kind): those with a works contract, and the representative design or supervision notice of a graded project that has none."""
    works = rows.where(contract() == "공사").select("bid_base_no").distinct()
    works_projects = rows.join(works, "bid_base_no",
        "left_semi").where(clean(F.col("project_no")).isNotNull()).select(clean(F.col("project_no")).alias("project_no")).distinct()
    ready = projects.where(
        F.col("compact_grade").isin("A", "B", "C") & F.col("representative_amount_stage").isin("DESIGN_ESTIMATE",
            "CONSTRUCTION_BUDGET") & (F.col("representative_area_m2") != 0) & (F.col("representative_construction_cost_usd") != 0)
    ).join(works_projects, "project_no", "left_anti")
    rep = ready.select(F.col("display_representative_bid").alias("bid_no")).join(rows,
        "bid_no").where(relation(title(), contract()).isin("DESIGN", "SUPERVISION"))
    return works.withColumn("case_kind", F.lit(NOTICE)).union(rep.select("bid_base_no").distinct().join(works, "bid_base_no",
        "left_anti").withColumn("case_kind", F.lit(REFERENCE)))


def _cleaned(df: DataFrame, *columns: str) -> list[Column]:
    return [clean(df[x]).alias(x) for x in columns]


def _notes(several: str, one: str) -> Column:
    """Cleaned notes of an array, which may be null, and of a column: the distinct ones joined, as by join_notes."""
    every = F.concat(F.coalesce(several, F.array().cast("array<string>")), F.array(one))
    return F.nullif(F.array_join(F.array_distinct(F.array_compact(every)), " | "), F.lit(""))


def build_cases(rows: DataFrame, notices: DataFrame, groups: DataFrame, projects: DataFrame, data_version: str) -> DataFrame:
    """One case per published group, its columns taken by precedence; see first_text, first_value and first_true."""
    kinds = case_groups(rows, projects)
    latest = latest_rows(rows.join(kinds, "bid_base_no", "left_semi"), "bid_base_no")
    sizes = rows.groupBy("bid_base_no").agg(F.count(F.lit(1)).alias("_n"))
    wanted = latest.select("bid_base_no", F.col("bid_no").alias("_latest")).join(groups.select("bid_base_no",
        clean(F.col("representative_bid_no")).alias("_rep")), "bid_base_no", "left")
    known = rows.select(F.col("bid_no").alias("_known")).distinct()
    wanted = wanted.join(known, F.col("_rep") == F.col("_known"), "left").select("bid_base_no",
        F.coalesce("_rep", "_latest").alias("_chosen"), F.coalesce("_known", "_latest").alias("_row"))
    # Texts are cleaned and amounts read once a row, before the joins: what is taken by precedence is then a plain column.
    r = rows.select("bid_no", usd_ceiling(F.col("ceiling_usd_raw")).alias("raw"), *_cleaned(rows, "project_no", "bid_title_ko", "source_bid_title",
        "project_name", "country_ko", "facility_type", "work_type", "notice_date", "detail_url")).alias("r")
    n = notices.select("bid_no", "selected_area_m2", "selected_construction_cost_usd", "compact_grade",
        F.array(*_cleaned(notices, "scope_role", "record_scope_status", "same_scope_status")).alias("scope"),
        F.array(*_cleaned(notices, "grade_detail", "manual_note", "area_quote")).alias("note"), *_cleaned(notices, "project_no", "title", "country_ko",
            "amount_stage", "notice_date", "verification_level", "unit_cost_allowed_use", "source_url", "audit_date")).alias("n")
    g = groups.select("bid_base_no", "area_m2", "construction_cost_usd", "best_grade", "notice_count",
        *_cleaned(groups, "project_no", "representative_title", "country_ko", "latest_notice_date")).alias("g")
    p = projects.select(F.col("project_no").alias("_key"), "representative_area_m2", "representative_construction_cost_usd", "compact_grade",
        *_cleaned(projects, "project_name", "country_ko", "representative_amount_stage", "verification_level", "unit_cost_allowed_use",
            "duplicate_and_scope_warning", "grade_detail")).alias("p")
    j = wanted.join(r, F.col("_row") == F.col("r.bid_no"))
    j = j.join(n, F.col("_chosen") == F.col("n.bid_no"), "left").join(g, "bid_base_no", "left").join(kinds, "bid_base_no").join(sizes, "bid_base_no")
    j = j.withColumn("_project", F.coalesce("n.project_no", "g.project_no", "r.project_no")).join(p, F.col("_project") == F.col("p._key"), "left")
    c = F.col
    taken = j.select(
        c("bid_base_no").alias("case_id"), c("case_kind"), c("_project").alias("project_no"), c("_chosen").alias("representative_bid_no"),
        F.coalesce("n.title", "g.representative_title", "r.bid_title_ko", "r.source_bid_title", "r.project_name", "bid_base_no").alias("display_name"),
        F.coalesce("p.project_name", "r.project_name").alias("official_project_name"),
        F.coalesce("n.country_ko", "g.country_ko", "p.country_ko", "r.country_ko").alias("country_ko"), c("r.facility_type"), c("r.work_type"),
        F.coalesce("n.notice_date", "g.latest_notice_date", "r.notice_date").alias("notice_date"),
        money(first_value(c("n.selected_area_m2"), c("g.area_m2"), c("p.representative_area_m2"))).alias("gross_floor_area_m2"),
        money(first_value(c("n.selected_construction_cost_usd"), c("g.construction_cost_usd"), c("p.representative_construction_cost_usd"))).alias("_curated"),
        c("r.raw").alias("_raw"), F.coalesce("n.amount_stage", "p.representative_amount_stage").alias("_stage"),
        F.coalesce("n.compact_grade", "g.best_grade", "p.compact_grade").alias("_grade"),
        F.coalesce("n.verification_level", "p.verification_level").alias("verification_level"),
        c("n.scope").alias("_scope"), c("p.duplicate_and_scope_warning").alias("_warning"), c("n.note").alias("_note"), c("p.grade_detail").alias("_detail"),
        F.coalesce("n.unit_cost_allowed_use", "p.unit_cost_allowed_use").alias("allowed_use"),
        F.coalesce(F.nullif(c("g.notice_count"), F.lit(0)), c("_n")).cast("int").alias("notice_count"),
        F.coalesce("n.source_url", "r.detail_url").alias("procurement_url"), c("n.audit_date"),
    )
    family = facility_family(c("facility_type"), c("display_name"), c("official_project_name"))
    stage = F.when(c("_curated").isNull() & c("_raw").isNotNull(), RAW_STAGE).otherwise(c("_stage"))
    out = taken.select(
        "case_id", "case_kind", "project_no", "representative_bid_no", "display_name", "official_project_name", "country_ko", "facility_type",
        family.alias("facility_family"), "work_type", "notice_date", "gross_floor_area_m2", F.coalesce("_curated", "_raw").alias("construction_cost_usd"),
        stage.alias("amount_stage_code"), compact_grade(c("_grade")).alias("evidence_grade"), "verification_level",
        _notes("_scope", "_warning").alias("scope_note"), _notes("_note", "_detail").alias("evidence_note"), "allowed_use", "notice_count",
        "procurement_url", F.lit(data_version).alias("data_version"), "audit_date",
    )
    out = out.withColumn("nominal_unit_usd_m2", F.round(ratio(c("construction_cost_usd"), c("gross_floor_area_m2")), 2))
    words = ["display_name", "official_project_name", "country_ko", "facility_type", "facility_family"]
    text = F.concat_ws(" ", *words, F.nullif(family_aliases(c("facility_family")), F.lit("")), "work_type", "scope_note", "evidence_note",
        "project_no", "case_id")
    return out.withColumn("search_text", text).withColumn("is_published", F.lit(True))


def related_notices(cases: DataFrame, rows: DataFrame, note: str = "동일 사업번호의 관련 공고") -> DataFrame:
    """Per case the other groups of its project, each by its latest notice: a self join on the project."""
    own = cases.where(F.col("project_no").isNotNull()).select("case_id", "project_no")
    used = ("bid_base_no", "bid_no", "bid_title_ko", "source_bid_title", "project_name", "ceiling_usd_raw", "contract_type", "source_contract_type",
        "notice_date", "detail_url")
    found = rows.select(*used, clean(F.col("project_no")).alias("_p")).where("_p is not null")
    others = latest_rows(found.withColumn("_k", F.struct("_p", "bid_base_no")), "_k")
    j = own.join(others, F.col("project_no") == F.col("_p")).where("bid_base_no <> case_id")
    name = F.coalesce(title(), clean(F.col("project_name")), F.col("bid_base_no"))
    amount = usd_ceiling(F.col("ceiling_usd_raw"))
    return j.select(
        "case_id", F.col("bid_base_no").alias("related_bid_base_no"), F.col("bid_no").alias("representative_bid_no"),
        relation(name, contract()).alias("relation_type"), name.alias("display_name"), contract().alias("contract_type"),
        amount.alias("amount_usd"), F.when(amount != 0, RAW_STAGE).alias("amount_stage_code"),
        clean(F.col("notice_date")).alias("notice_date"), clean(F.col("detail_url")).alias("procurement_url"), F.lit(note).alias("note"),
        F.lit(True).alias("is_published"),
    )
