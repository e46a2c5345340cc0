"""Decisions at three grains: notice, notice group and project.

Curated decisions (overrides, verified prices, reviews) are tables that are joined in, never constants
in code. A unit cost is only ever given where area and cost are of one scope.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costquarry.functions.rules import compact_grade, cost_stage, grade_rank, scope_role
from costquarry.functions.scalars import amount, clean, clean_or_empty, gap_percent, ratio

USABLE = ("WORKS", "DESIGN_BUILD_WORKS")
SERVICES = ("DESIGN_SERVICE", "DESIGN_OR_SUPERVISION_SERVICE", "OTHER_SERVICE")
BUDGET_STAGES = ("CONSTRUCTION_BUDGET", "DESIGN_ESTIMATE", "ADVERTISED_ESTIMATED_BUDGET")
REJECTED_AREAS = ("SITE_AREA", "QUALIFICATION", "WORK_ITEM_AREA", "AMBIGUOUS_AREA")


def candidate_universe(bids: DataFrame, projects: DataFrame, evidence: DataFrame) -> DataFrame:
    """Construction candidates with area evidence and a ceiling."""
    with_area = evidence.where(F.trim(F.coalesce("area_mentions", F.lit(""))) != "").select("bid_no").distinct()
    ceiling = F.trim(F.coalesce("ceiling_usd_raw", F.lit(""))) != ""
    return bids.where("construction_candidate").join(projects.where(ceiling), "bid_no").join(with_area, "bid_no", "left_semi")


def select_area(notices: DataFrame, best: DataFrame, reviewed: DataFrame, overrides: DataFrame, rejections: DataFrame) -> DataFrame:
    """Adds area columns: a curated value, else a reviewed case's, else none where curated so, else the best found if it measures a building.

    overrides: (bid_no, value, semantic); rejections: (bid_no, semantic); best: of evidence.best_area().
    """
    o = overrides.select("bid_no", F.struct(F.col("value").cast("double").alias("area"), "semantic",
        F.lit("MANUAL_CONTEXT_REVIEW").alias("confidence")).alias("o"))
    basis = clean_or_empty(F.col("area_basis"))
    semantic = F.when(basis.rlike("캠퍼스|시설 면적|동별 면적|대상 시설"), "FACILITY_OR_CAMPUS_AREA").when(basis.rlike("연면적|공간계획"), "GFA").otherwise("GFA_OR_CURATED_AREA")
    r = reviewed.where("gross_floor_area_m2 <> 0").select("bid_no", F.struct(F.col("gross_floor_area_m2").cast("double").alias("area"),
        semantic.alias("semantic"), F.lit("MANUAL_CURATED").alias("confidence")).alias("r"))
    x = rejections.select("bid_no", F.struct(F.lit(None).cast("double").alias("area"), "semantic", F.lit("MANUAL_REJECTED").alias("confidence")).alias("x"))
    bad = F.col("semantic").isin(*REJECTED_AREAS)
    b = best.select(
        "bid_no", F.struct(F.when(~bad, F.col("value")).alias("area"), "semantic",
            F.when(bad, "LOW").when(F.col("score") >= 100, "AUTO_HIGH").otherwise("AUTO_MEDIUM").alias("confidence")).alias("b")
    )
    none = F.struct(F.lit(None).cast("double").alias("area"), F.lit("NO_PARSEABLE_AREA").alias("semantic"), F.lit("LOW").alias("confidence"))
    out = notices
    for part in (o, r, x, b):
        out = out.join(part, "bid_no", "left")
    out = out.withColumn("_a", F.coalesce("o", "r", "x", "b", none)).drop("o", "r", "x", "b")
    return out.withColumn("selected_area_m2", F.col("_a.area")).withColumn("area_semantics",
        F.col("_a.semantic")).withColumn("area_confidence", F.col("_a.confidence")).drop("_a")


def select_cost(notices: DataFrame, reviewed: DataFrame, verified: DataFrame) -> DataFrame:
    """Adds cost columns to notices with scope_role and ceiling: a verified base price, else a reviewed cost of a usable scope or budget stage, else a works ceiling, else none."""
    v = verified.select("bid_no", F.struct(F.col("amount").cast("double").alias("cost"), "stage",
        F.lit("MANUAL_SOURCE_VERIFIED").alias("confidence")).alias("v"))
    r = reviewed.where("cost_usd_nominal <> 0 and gross_floor_area_m2 <> 0").select("bid_no",
        F.col("cost_usd_nominal").cast("double").alias("_rc"), cost_stage(F.col("cost_stage")).alias("_rs"))
    usable, ceiling = F.col("scope_role").isin(*USABLE), F.nullif(F.col("ceiling"), F.lit(0.0))
    one = lambda c, s, f: F.struct(c.alias("cost"), s.alias("stage"), F.lit(f).alias("confidence"))
    none = F.lit(None).cast("double")
    out = notices.join(v, "bid_no", "left").join(r, "bid_no", "left")
    got = F.coalesce(
        F.col("v"),
        F.when(F.col("_rc").isNotNull() & (usable | F.col("_rs").isin(*BUDGET_STAGES)), one(F.col("_rc"), F.col("_rs"), "MANUAL_CURATED")),
        F.when(usable & ceiling.isNotNull(), one(ceiling, F.lit("NOTICE_EXECUTION_CEILING"), "METADATA_PLUS_SCOPE_REVIEW")),
        F.when(ceiling.isNotNull(), one(none, F.lit("SERVICE_OR_GOODS_CEILING"), "SCOPE_REJECTED")),
        one(none, F.lit("NO_USABLE_CONSTRUCTION_AMOUNT"), "NONE"),
    )
    out = out.withColumn("_c", got).drop("v", "_rc", "_rs")
    return out.withColumn("selected_construction_cost_usd", F.col("_c.cost")).withColumn("amount_stage",
        F.col("_c.stage")).withColumn("amount_confidence", F.col("_c.confidence")).drop("_c")


def record_scope(role: Column, curated: Column) -> Column:
    """Whether the notice's own amount is for works; a curated status goes first."""
    return F.when(role.isin(*SERVICES, "GOODS"), F.coalesce(curated, F.lit("NO_MATCH"))).otherwise(F.coalesce(curated, F.lit("MATCH")))


def evidence_scope(record: Column, role: Column, is_reviewed: Column, area: Column, cost: Column, stage: Column, caution: Column) -> Column:
    """A service notice may hold a construction budget in an attachment: that is another scope than its own amount."""
    holds = (record == "NO_MATCH") & role.isin(*SERVICES) & is_reviewed & (area != 0) & (cost != 0) & stage.isin(*BUDGET_STAGES)
    partial = clean_or_empty(caution).rlike("원문 재확인|해석|약식값|다른 단계|부분")
    return F.when(F.coalesce(holds, F.lit(False)),
        F.when(partial, "PARTIAL_ATTACHMENT_CONSTRUCTION_BUDGET").otherwise("MATCH_ATTACHMENT_CONSTRUCTION_BUDGET")).otherwise(record)


def final_grade(role: Column, scope: Column, area: Column, cost: Column, is_reviewed: Column, strict: Column) -> Column:
    """Struct (grade, verification): strict reviews first, then X for other scopes, U where area and cost don't go together, C if reviewed, else C?."""
    has = F.coalesce((area != 0) & (cost != 0), F.lit(False))
    no_cost = F.coalesce(cost, F.lit(0.0)) == 0
    partial = scope.startswith("PARTIAL")
    tail = F.when(partial, "-부분").otherwise("")
    one = lambda g, v: F.struct(g.alias("grade"), F.lit(v).alias("verification"))
    x, u = F.lit("X"), F.lit("U")
    return (
        F.when(strict.isNotNull(), one(strict, "V3_ORIGINAL_MANUAL"))
        .when(role.isin("GOODS", "NONBUILDING_OR_FALSE_AREA") | (role.isin(*SERVICES) & no_cost), one(x, "V3_SCOPE_REVIEW"))
        .when(partial & ~has, one(u, "V3_SCOPE_REVIEW"))
        .when(scope == "NO_MATCH", F.when(role.isin(*USABLE, "MIXED_FITOUT_WORKS"), one(u, "V3_SCOPE_REVIEW")).otherwise(one(x, "V3_SCOPE_REVIEW")))
        .when(has & is_reviewed, one(F.concat(F.lit("C"), tail), "V3_CURATED_AREA_COST_RECHECK"))
        .when(has, one(F.concat(F.lit("C?"), tail), "V2R_HUMAN_REVIEWED_EXTRACTION"))
        .otherwise(one(u, "V2R_HUMAN_REVIEWED_EXTRACTION"))
    )


def allowed_use(grade: Column) -> Column:
    return (
        F.when(grade == "A", "품목·검증범위 산정")
        .when(grade.startswith("A-"), "검증된 부분 Bill만")
        .when(grade.startswith("B"), "현지단가 결합 수량모델")
        .when(grade.startswith("C"), "초기 스크리닝만")
        .otherwise("계산 금지")
    )


def grade_notices(notices: DataFrame, best: DataFrame, reviewed: DataFrame, curated: dict[str, DataFrame]) -> DataFrame:
    """Notices (bid_no, bid_base_no, project_no, title, contract_type, ceiling_usd_raw, notice_date) with area, cost, scope, grade and screening unit cost.

    curated: tables roles (bid_no, role), overrides, rejections, verified, scopes (bid_no, scope), strict (bid_no, grade).
    """
    n = notices.join(curated["roles"].select("bid_no", F.col("role").alias("_role")), "bid_no", "left")
    n = n.withColumn("scope_role", scope_role(clean(F.col("contract_type")), clean(F.col("title")), F.col("_role"))).withColumn("ceiling",
        amount(F.col("ceiling_usd_raw"))).drop("_role")
    n = select_cost(select_area(n, best, reviewed, curated["overrides"], curated["rejections"]), reviewed, curated["verified"])
    n = n.join(curated["scopes"].select("bid_no", F.col("scope").alias("_scope")), "bid_no",
        "left").join(curated["strict"].select("bid_no", F.col("grade").alias("_strict")), "bid_no", "left")
    n = n.join(reviewed.select("bid_no", F.lit(True).alias("_reviewed"), F.col("scope_caution").alias("_caution")), "bid_no", "left")
    known = F.coalesce("_reviewed", F.lit(False))
    area, cost = F.col("selected_area_m2"), F.col("selected_construction_cost_usd")
    n = n.withColumn("record_scope_status", record_scope(F.col("scope_role"), F.col("_scope")))
    n = n.withColumn("same_scope_status", evidence_scope(F.col("record_scope_status"), F.col("scope_role"), known, area, cost,
        F.col("amount_stage"), F.col("_caution")))
    n = n.withColumn("_g", final_grade(F.col("scope_role"), F.col("same_scope_status"), area, cost, known, F.col("_strict")))
    n = n.withColumn("final_grade", F.col("_g.grade")).withColumn("verification_level",
        F.col("_g.verification")).withColumn("compact_grade", compact_grade(F.col("_g.grade"), "X"))
    n = n.withColumn("screening_unit_usd_m2", ratio(cost, area))
    n = n.withColumn("notice_ceiling_to_selected_gap_pct", gap_percent(F.col("ceiling"), cost,
        F.col("scope_role").isin(*USABLE) & (F.col("amount_stage") != "NOTICE_EXECUTION_CEILING")))
    n = n.withColumn("unit_cost_allowed_use", allowed_use(F.col("final_grade"))).withColumn("direct_future_estimate_ready",
        (F.col("final_grade") == "A").cast("int"))
    return n.drop("_g", "_scope", "_strict", "_reviewed", "_caution")


def group_representatives(notices: DataFrame) -> DataFrame:
    """Per notice group its best notice by grade, date and number, with the group's size and notices."""
    order = F.struct(grade_rank(F.col("final_grade")), "notice_date", "bid_no")
    cols = ["project_no", "bid_no", "title", "final_grade", "scope_role", "same_scope_status", "selected_area_m2",
        "selected_construction_cost_usd", "screening_unit_usd_m2"]
    got = notices.groupBy("bid_base_no").agg(
        F.count(F.lit(1)).alias("notice_count"), F.array_join(F.sort_array(F.collect_set("bid_no")), ";").alias("bid_nos"),
        F.max("notice_date").alias("latest_notice_date"), F.max_by(F.struct(*cols), order).alias("r")
    )
    return got.select("bid_base_no", "notice_count", "bid_nos", "latest_notice_date", F.col("r.bid_no").alias("representative_bid_no"),
        F.col("r.title").alias("representative_title"), F.col("r.final_grade").alias("best_grade"),
        *(f"r.{c}" for c in cols if c not in ("bid_no", "title", "final_grade")))


def project_representatives(notices: DataFrame) -> DataFrame:
    """Per project its notice by grade, matching scope, verification, date and number, and counts of its notices."""
    order = F.struct(grade_rank(F.col("final_grade")), F.col("same_scope_status") == "MATCH", F.col("verification_level").startswith("V3"),
        "notice_date", "bid_no")
    valid = F.col("compact_grade").isin("A", "B", "C", "C?")
    cols = ["bid_no", "final_grade", "compact_grade", "verification_level", "same_scope_status", "selected_area_m2",
        "selected_construction_cost_usd", "amount_stage", "screening_unit_usd_m2", "unit_cost_allowed_use", "direct_future_estimate_ready"]
    got = notices.groupBy("project_no").agg(
        F.max_by("title", F.struct(F.length("title"), "title")).alias("project_name"), F.count(F.lit(1)).alias("notice_count"),
        F.countDistinct(F.coalesce(F.nullif("bid_base_no", F.lit("")), "bid_no")).alias("bid_base_group_count"),
        F.count_if(valid).alias("valid_area_cost_notice_count"), F.max_by(F.struct(*cols), order).alias("r"),
    )
    got = got.select("project_no", "project_name", "notice_count", "bid_base_group_count", "valid_area_cost_notice_count",
        "r.*").withColumnRenamed("bid_no", "display_representative_bid").withColumnRenamed("final_grade", "best_grade")
    return got.withColumn("screening_sample_weight",
        (F.col("valid_area_cost_notice_count") > 0).cast("int")).withColumn("direct_estimate_sample_weight", (F.col("best_grade") == "A").cast("int"))


def mark_representatives(notices: DataFrame) -> DataFrame:
    """Adds is_bid_base_representative, is_project_display_representative and sample_weight_notice to notices."""
    rank = grade_rank(F.col("final_grade"))
    base = Window.partitionBy("bid_base_no").orderBy(rank.desc(), F.desc("notice_date"), F.desc("bid_no"))
    proj = Window.partitionBy("project_no").orderBy(rank.desc(), (F.col("same_scope_status") == "MATCH").desc(),
        F.col("verification_level").startswith("V3").desc(), F.desc("notice_date"), F.desc("bid_no"))
    n = notices.withColumn("is_bid_base_representative",
        (F.row_number().over(base) == 1).cast("int")).withColumn("is_project_display_representative", (F.row_number().over(proj) == 1).cast("int"))
    return n.withColumn("sample_weight_notice", F.when(F.col("compact_grade").isin("A", "B", "C", "C?"),
        F.col("is_project_display_representative")).otherwise(0))


def attachment_grade(files: DataFrame, records: DataFrame, manual: DataFrame, key: str = "project_key") -> DataFrame:
    """Project grade from scanned attachments: a manual one, else A? with a priced table, B? with quantities, else C or U by the best source hint.

    files: (key, sha256, source_file, cost_relevant, quantity_rows, priced_rows, strong_priced); each content
    counts once. records: (key, unit_cost_potential, gross_floor_area_m2, amount_value, linked). The best hint
    is the first in text order.
    """
    relevant = files.where("cost_relevant").withColumn("_d", F.coalesce(F.nullif("sha256", F.lit("")), "source_file"))
    once = relevant.groupBy(key, "_d").agg(F.max("quantity_rows").alias("q"), F.max("priced_rows").alias("p"), F.bool_or("strong_priced").alias("s"))
    scan = once.groupBy(key).agg(F.count_if("s").alias("priced_files"), F.count_if(F.col("q") >= 3).alias("quantity_files"),
        F.max("q").alias("max_quantity_rows"), F.max("p").alias("max_priced_rows"))
    filled = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) != 0
    hint = (
        F.when(F.coalesce(F.col("unit_cost_potential").cast("string"), F.lit("")) == "1", "C1")
        .when(filled("gross_floor_area_m2") & filled("amount_value"), "U1")
        .when(filled("amount_value"), "C2")
        .when(F.coalesce("linked", F.lit(False)), "C3")
        .otherwise("C4")
    )
    hints = records.groupBy(key).agg(F.min(hint).alias("hint"), F.count(F.lit(1)).alias("record_count"))
    out = hints.join(scan, key, "left").join(manual.select(key, F.col("grade").alias("_mg"), F.col("technical_status").alias("_ms")), key, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    status = F.when(F.col("_ms").isNotNull(), F.col("_ms")).when(zero("priced_files") > 0, "A?").when(zero("quantity_files") > 0,
        "B?").when(F.col("hint") == "C1", "C?").otherwise("U")
    grade = F.coalesce("_mg", F.when(zero("priced_files") > 0, "A").when(zero("quantity_files") > 0, "B").otherwise("C"))
    out = out.withColumn("grade", grade).withColumn("technical_status", status)
    return out.withColumn("direct_project_estimate_ready", F.col("technical_status").isin("A",
        "A-부분").cast("int")).withColumn("needs_local_rates", (F.col("grade") == "B").cast("int")).drop("_mg", "_ms")


def record_status(source: Column, category: Column, title: Column, technical_status: Column, potential: Column) -> Column:
    """Whether an official record is itself a cost sample: X by kind, U for whole projects, the attachments' A or B, C? for works with area and amount."""
    from costquarry.functions.rules import OTHER_TITLE

    works = title.rlike(r"(?i)(시공\s*용역|construction\s+works)")
    return (
        F.when(source == "aid_procurement_contracts", "X-용역계약")
        .when(source == "country_project_reports", "U-전체사업정보")
        .when(category == "물품", "X-물품")
        .when((category == "용역") & title.rlike(OTHER_TITLE) & ~works, "X-설계·감리·기타용역")
        .when(technical_status.isin("A", "A-부분", "B", "B-부분"), technical_status)
        .when((potential.cast("string") == "1") & (category == "공사"), "C?")
        .otherwise("U-근거부족")
    )
