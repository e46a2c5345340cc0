"""Price normalization with observed index values only: nothing is interpolated or carried forward."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costquarry.functions.scalars import period_key

NO_INDEX, SCENARIO, UNCONFIRMED = "실제지수 관측기간 부족", "대체지수 시나리오 산출", "통화구성 확인필요"


def both_periods(keyed: DataFrame, sources: DataFrame, values: DataFrame, on: str) -> DataFrame:
    """Per row of `keyed` (id, on, from_day, to_day) and source: the observed values of both periods, each null where there is none."""
    seen = values.where("is_actual").groupBy("source_id", "period").agg(F.max("value").alias("value"))
    pairs = keyed.join(sources, on).withColumn("from_period", period_key(F.col("from_day"), F.col("frequency"))).withColumn("to_period",
        period_key(F.col("to_day"), F.col("frequency")))
    at = lambda p: seen.select("source_id", F.col("period").alias(f"{p}_period"), F.col("value").alias(f"{p}_value"))
    return pairs.join(at("from"), ["source_id", "from_period"], "left").join(at("to"), ["source_id", "to_period"], "left")


def select_source(cases: DataFrame, sources: DataFrame, values: DataFrame, target_day: str) -> DataFrame:
    """Per case the first source of its country, by priority, construction-specific first, then id, that has both periods."""
    keyed = cases.select("bid_no", "country", F.col("notice_date").alias("from_day"), F.lit(target_day).alias("to_day"))
    found = both_periods(keyed, sources.where(F.col("priority").isNotNull()).drop("iso3"), values,
        "country").where("from_value is not null and to_value is not null")
    order = F.struct("priority", (~F.col("construction_specific").cast("boolean")).alias("other"), "source_id")
    best = found.groupBy("bid_no").agg(F.min_by(F.struct("source_id", "priority", "from_period", "to_period", "from_value", "to_value"), order).alias("s"))
    return best.select("bid_no", "s.*")


def exchange_rates(cases: DataFrame, sources: DataFrame, values: DataFrame, target_day: str) -> DataFrame:
    """Per case the official exchange rates at both dates, from the first source of its country code; either may be null."""
    first = sources.where("index_class = 'official_exchange_rate'").withColumn("_n",
        F.row_number().over(Window.partitionBy("iso3").orderBy(F.desc("construction_specific"), "source_id"))).where("_n = 1")
    keyed = cases.select("bid_no", "iso3", F.col("notice_date").alias("from_day"), F.lit(target_day).alias("to_day"))
    got = both_periods(keyed, first.select("iso3", "source_id", "frequency"), values, "iso3")
    return got.select("bid_no", F.col("from_value").alias("fx_source"), F.col("to_value").alias("fx_target"))


def normalize(cases: DataFrame, sources: DataFrame, values: DataFrame, target_day: str, assume_local_cost: bool = False) -> DataFrame:
    """Per case up to the target day: index factor, exchange factor, adjusted unit cost and status.

    adjusted = nominal * index ratio * exchange ratio, given only under the assumption of local cost and
    with both rates; a case without both index periods has a status and no numbers.
    """
    iso = sources.groupBy("country").agg(F.min("iso3").alias("iso3"))
    due = cases.where(F.col("notice_date").cast("date") <= F.lit(target_day).cast("date")).join(iso, "country", "left")
    out = due.join(select_source(due, sources, values, target_day), "bid_no", "left").join(exchange_rates(due, sources, values, target_day), "bid_no", "left")
    index, fx = F.try_divide("to_value", "from_value"), F.try_divide("fx_source", "fx_target")
    sure = F.col("source_id").isNotNull() & fx.isNotNull() & F.lit(assume_local_cost)
    return out.select(
        "bid_no", "country", "notice_date", "source_id", "from_period", "to_period", index.alias("index_factor"), fx.alias("fx_factor"),
        F.when(sure, F.col("unit_usd_m2_nominal") * index * fx).alias("adjusted_unit_usd_m2"),
        F.when(F.col("source_id").isNull(), NO_INDEX).when(sure, SCENARIO).otherwise(UNCONFIRMED).alias("status"),
    )


def run_summary(runs: DataFrame) -> DataFrame:
    return runs.agg(
        F.count(F.lit(1)).alias("case_count"),
        F.count("index_factor").alias("indexed_count"),
        F.count("adjusted_unit_usd_m2").alias("adjusted_count"),
        F.count_if(F.col("status") == NO_INDEX).alias("no_index_count"),
    )


def weighted_factor(items: DataFrame, key: str = "project_no") -> DataFrame:
    """Fixed share plus weighted index ratios of the parts: fixed + sum(weight * to / from); null if a part has no ratio."""
    part = F.col("weight") * F.try_divide("to_value", "from_value")
    return items.groupBy(key).agg(F.when(F.count_if(part.isNull()) == 0, F.max("fixed_share") + F.sum(part)).alias("factor"))


def with_tiers(sources: DataFrame, tiers: DataFrame) -> DataFrame:
    """Index sources with the label, use and requirements of their policy tier; without a tier: nulls."""
    return sources.join(tiers.select("priority", F.col("label").alias("tier_label"), F.col("use").alias("tier_use"),
        F.col("requirements").alias("tier_requirements")), "priority", "left")


def log_runs(runs: DataFrame, path: str, created_at: str) -> None:
    """Append the results of a normalization to the log; earlier runs stay."""
    runs.withColumn("created_at", F.lit(created_at).cast("timestamp")).write.mode("append").parquet(path)


def unit_records(cases: DataFrame) -> DataFrame:
    """Adds unit_usd_m2: the unit cost that the source gives, else cost by area; none without both."""
    from costquarry.functions.scalars import ratio

    return cases.withColumn("unit_usd_m2", F.coalesce("direct_unit_usd_m2", F.round(ratio(F.col("construction_cost_usd"), F.col("gross_floor_area_m2")), 2)))


def fee_rates(fees: DataFrame) -> DataFrame:
    """Design and supervision fees as shares of the construction cost and by area, and both together."""
    from costquarry.functions.scalars import ratio

    cost, area = F.col("construction_cost_usd"), F.col("gross_floor_area_m2")
    both = F.coalesce("design_fee_usd", F.lit(0.0)) + F.coalesce("supervision_fee_usd", F.lit(0.0))
    out = fees
    for name, fee in (("design", F.col("design_fee_usd")), ("supervision", F.col("supervision_fee_usd")), ("combined", both)):
        out = out.withColumn(f"{name}_rate", F.round(ratio(fee, cost), 6)).withColumn(f"{name}_fee_usd_m2", F.round(ratio(fee, area), 2))
    return out
