"""The SQL surface: analytic and public views as temporary views, lookups as SQL table functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from costquarry.operators import search, warehouse

Tables = dict[str, DataFrame]

#: View name -> the tables it needs and how it is made of them.
ANALYTIC: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "v_sample_coverage": (("reviewed_cases",), warehouse.sample_coverage),
    "v_yearly_inventory": (("reviewed_cases",), warehouse.yearly_inventory),
    "v_area_cost_ready_projects": (("area_cost_project_review",), warehouse.ready_projects),
    "v_area_cost_followup_queue": (("area_cost_project_review",), warehouse.follow_up_queue),
    "v_project_evaluation_findings": (("evaluation_findings", "evaluation_project_matches", "evaluation_project_screening",
        "evaluation_reports"), warehouse.accepted_findings),
    "v_duplicate_attachments": (("attachments",), warehouse.duplicate_attachments),
    "v_price_index_coverage": (("price_index_sources", "price_index_values"), warehouse.index_coverage),
    "v_best_available_price_index": (("price_index_sources", "price_index_values"), lambda s, v: warehouse.best_index(warehouse.index_coverage(s, v))),
}
#: A full-text query over a text, both columns: all words, OR, a leading minus, quoted phrases; see search.text_query().
MATCHES = """aggregate(regexp_extract_all({query}, '-?"[^"]*"|\\\\S+', 0), named_struct('every', true, 'one', CAST(NULL AS BOOLEAN), 'joined', false),
  (a, w) -> CASE WHEN w = 'OR' THEN named_struct('every', a.every, 'one', a.one, 'joined', a.one IS NOT NULL)
    ELSE named_struct('every', a.every AND (a.joined OR coalesce(a.one, true)),
      'one', (a.joined AND a.one) OR (contains(lower(coalesce({text}, '')), lower(replace(ltrim('-', w), '"', ''))) <> (length(w) > 1 AND startswith(w, '-'))), 'joined', false) END,
  a -> a.every AND coalesce(a.one, true))"""
SEARCH = f"""CREATE OR REPLACE TEMPORARY FUNCTION search_cases(query STRING, country STRING, facility STRING, work STRING, area DOUBLE, n INT)
RETURNS TABLE (case_id STRING, display_name STRING, match_score DECIMAL(10, 2), priority BIGINT)
RETURN SELECT case_id, display_name, match_score, priority FROM (
  SELECT *, dense_rank() OVER (ORDER BY match_score DESC) AS priority, row_number() OVER (ORDER BY match_score DESC, notice_date DESC NULLS LAST,
case_id) AS place FROM (
    SELECT *, CAST(if(lower(coalesce(country_ko, '')) = lower(nullif(trim(search_cases.country), '')), 40, 0)
      + if(like_either(facility_type, search_text, search_cases.facility), 30, 0) + if(like_either(work_type, search_text, search_cases.work), 10, 0)
      + if(nullif(trim(search_cases.query), '') IS NOT NULL AND {MATCHES.format(query="search_cases.query", text="search_text")}, 15, 0)
      + CASE evidence_grade WHEN 'A' THEN 5 WHEN 'B' THEN 4 WHEN 'C' THEN 3 WHEN 'C?' THEN 2 WHEN 'U' THEN 1 ELSE 0 END
      + if(search_cases.area > 0, coalesce(round(5.0BD * greatest(0BD, 1BD - abs(CAST(gross_floor_area_m2 AS DECIMAL(20, 4)) - CAST(search_cases.area AS DECIMAL(20, 4))) / CAST(search_cases.area AS DECIMAL(20, 4))), 2), 0), 0) AS DECIMAL(10, 2)) AS match_score
    FROM public_cases)) WHERE place <= least(greatest(coalesce(search_cases.n, 10), 1), 50)"""
#: One holds the other, or the search text holds it, whatever the case.
EITHER = """CREATE OR REPLACE TEMPORARY FUNCTION like_either(held STRING, whole STRING, wanted STRING) RETURNS BOOLEAN
RETURN nullif(trim(wanted), '') IS NOT NULL AND coalesce(contains(lower(held), lower(trim(wanted))) OR contains(lower(trim(wanted)), lower(held)), false) OR coalesce(contains(lower(whole), lower(trim(wanted))), false)"""
SEARCHED = ("display_name", "country_ko", "facility_type", "work_type", "notice_date", "gross_floor_area_m2", "evidence_grade", "search_text")
PUBLIC = ("cases", "related_notices", "evaluation_projects", "evaluation_reports", "evaluation_findings")


def register(spark: SparkSession, tables: Tables) -> list[str]:
    """Create the views whose tables are there, and lookups over the public ones; returns the names."""
    made = []
    for name, (needs, make) in ANALYTIC.items():
        if all(n in tables for n in needs):
            make(*(tables[n] for n in needs)).createOrReplaceTempView(name)
            made.append(name)
    for name in PUBLIC:
        if name in tables:
            df = search.public(tables[name])
            df.createOrReplaceTempView(f"public_{name}")
            made.append(f"public_{name}")
            if "case_id" in df.columns:
                fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
                spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}_of(wanted STRING) RETURNS TABLE ({fields}) RETURN SELECT * FROM public_{name} WHERE case_id = wanted")
                made.append(f"{name}_of")
            if name == "cases" and set(SEARCHED) <= set(df.columns):
                spark.sql(EITHER)
                spark.sql(SEARCH)
                made.append("search_cases")
    return made
