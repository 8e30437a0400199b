"""Catalog entries: marts, windows, aggregates, tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkretail.functions import scalar as S
from sparkretail.operators import marts
from sparkretail.plans import builds
from sparkretail.plans import oracle as O
from sparkretail.plans.catalog import query

W = O.with_ctes


@query("mart_inventory_risk", W("select * from mart_inventory_risk", "mart_inventory_risk"))
def q_mart_inventory_risk(spark, sf):
    return builds.inventory_risk(spark, sf)


@query("mart_inventory_risk_quarterly",
       W("select * from mart_inventory_risk", "mart_inventory_risk", grain="quarter"))
def q_mart_inventory_risk_quarterly(spark, sf):
    return builds.inventory_risk(spark, sf, grain="quarter")


@query("mart_weekly_sales", W("select * from mart_weekly_sales", "mart_weekly_sales"))
def q_mart_weekly_sales(spark, sf):
    return marts.mart_weekly_sales(builds.weekly_table(spark, sf))


@query("mart_demand_features", W("select * from mart_demand_features", "mart_demand_features"))
def q_mart_demand_features(spark, sf):
    return builds.demand_features(spark, sf)


@query("mart_demand_incremental", W("select * from mart_demand_features", "mart_demand_features"))
def q_mart_demand_incremental(spark, sf):
    """The feature mart grown by refreshes that read no history."""
    return builds.incremental_demand(spark, sf)


@query("mart_store_features", W("select * from mart_store_features", "mart_store_features"))
def q_mart_store_features(spark, sf):
    return marts.mart_store_features(builds.weekly_table(spark, sf))


@query("mart_promotion_lift", W("select * from mart_promotion_lift", "mart_promotion_lift"))
def q_mart_promotion_lift(spark, sf):
    return marts.mart_promotion_lift(builds.daily_table(spark, sf))


# ---- windows (§2.5): each exposed with a small projection of the series
_KEYS = "store_id, dept_id, sale_date, weekly_sales"
_SER = "partition by store_id, dept_id order by sale_date"


def _series(spark, sf):
    return builds.weekly_table(spark, sf).select("store_id", "dept_id", "sale_date",
                                                   "weekly_sales")


for _n in (1, 4, 52):
    def _mk(n):
        @query(f"win_lag_{n}", W(f"select {_KEYS}, lag(weekly_sales, {n}) over ({_SER}) as sales_lag "
                                 "from stg_weekly_sales", "stg_weekly_sales"))
        def _q(spark, sf):
            return _series(spark, sf).withColumn("sales_lag", marts.lag_rows("weekly_sales", n))
        return _q
    _mk(_n)


@query("win_yoy", W("select store_id, dept_id, sale_date, sales_same_week_last_year "
                    "from mart_weekly_sales", "mart_weekly_sales"))
def q_win_yoy(spark, sf):
    return marts.mart_weekly_sales(builds.weekly_table(spark, sf)).select(
        "store_id", "dept_id", "sale_date", "sales_same_week_last_year")


@query("win_rolling_4", W("select store_id, dept_id, sale_date, rolling_4wk_avg "
                          "from mart_demand_features", "mart_demand_features"))
def q_win_rolling_4(spark, sf):
    return builds.demand_features(spark, sf).select("store_id", "dept_id", "sale_date",
                                                    "rolling_4wk_avg")


@query("win_rolling_13", W("select store_id, dept_id, sale_date, rolling_13wk_avg "
                           "from mart_demand_features", "mart_demand_features"))
def q_win_rolling_13(spark, sf):
    return builds.demand_features(spark, sf).select("store_id", "dept_id", "sale_date",
                                                    "rolling_13wk_avg")


# ---- aggregates (§2.4)
@query("agg_store_summary", W(
    f"""select store_id, store_type, store_size, avg_weekly_sales, total_sales, min_weekly_sales,
               max_weekly_sales, stddev_weekly_sales from mart_store_features""",
    "mart_store_features"))
def q_agg_store_summary(spark, sf):
    return marts.mart_store_features(builds.weekly_table(spark, sf)).select(
        "store_id", "store_type", "store_size", "avg_weekly_sales", "total_sales",
        "min_weekly_sales", "max_weekly_sales", "stddev_weekly_sales")


@query("agg_conditional_avg", W(
    "select store_id, avg_holiday_sales, avg_non_holiday_sales from mart_store_features",
    "mart_store_features"))
def q_agg_conditional_avg(spark, sf):
    return marts.mart_store_features(builds.weekly_table(spark, sf)).select(
        "store_id", "avg_holiday_sales", "avg_non_holiday_sales")


@query("agg_count_distinct", W(
    "select store_id, num_weeks, num_depts from mart_store_features", "mart_store_features"))
def q_agg_count_distinct(spark, sf):
    return builds.weekly_table(spark, sf).groupBy("store_id").agg(
        marts.distinct_count("sale_date").alias("num_weeks"),
        marts.distinct_count("dept_id").alias("num_depts"))


@query("agg_external_avg", W(
    "select store_id, avg_temperature, avg_fuel_price, avg_cpi, avg_unemployment "
    "from mart_store_features", "mart_store_features"))
def q_agg_external_avg(spark, sf):
    return marts.mart_store_features(builds.weekly_table(spark, sf)).select(
        "store_id", "avg_temperature", "avg_fuel_price", "avg_cpi", "avg_unemployment")


@query("agg_volatility", W("select * from sales_stats", "sales_stats"))
def q_agg_volatility(spark, sf):
    return marts.sales_volatility(builds.weekly_table(spark, sf))


@query("agg_cv", W("select store_id, dept_id, coeff_of_variation from mart_inventory_risk",
                   "mart_inventory_risk"))
def q_agg_cv(spark, sf):
    return builds.inventory_risk(spark, sf).select("store_id", "dept_id", "coeff_of_variation")


@query("flt_post_agg", W("select store_id, dept_id, avg_weekly_sales from sales_stats "
                         "where avg_weekly_sales > 0", "sales_stats"))
def q_flt_post_agg(spark, sf):
    return (marts.sales_volatility(builds.weekly_table(spark, sf))
            .where(F.col("avg_weekly_sales") > 0)
            .select("store_id", "dept_id", "avg_weekly_sales"))


@query("cse_tier", W("select store_id, dept_id, coeff_of_variation, demand_risk_tier "
                     "from mart_inventory_risk", "mart_inventory_risk", grain="quarter"))
def q_cse_tier(spark, sf):
    return builds.inventory_risk(spark, sf, grain="quarter").select(
        "store_id", "dept_id", "coeff_of_variation", "demand_risk_tier")


@query("agg_promo_lift", W(
    "select store_id, promo_lift_pct from mart_promotion_lift", "mart_promotion_lift"))
def q_agg_promo_lift(spark, sf):
    return marts.mart_promotion_lift(builds.daily_table(spark, sf)).select(
        "store_id", "promo_lift_pct")


@query("agg_count_if", W(
    "select store_id, promo_days, non_promo_days from mart_promotion_lift",
    "mart_promotion_lift"))
def q_agg_count_if(spark, sf):
    return marts.mart_promotion_lift(builds.daily_table(spark, sf)).select(
        "store_id", "promo_days", "non_promo_days")


@query("agg_promo_total", W(
    "select store_id, competition_distance, total_sales from mart_promotion_lift",
    "mart_promotion_lift"))
def q_agg_promo_total(spark, sf):
    return marts.mart_promotion_lift(builds.daily_table(spark, sf)).select(
        "store_id", "competition_distance", "total_sales")


@query("cse_flag", W(
    "select store_id, dept_id, sale_date, is_holiday, is_holiday_season, has_markdown1, "
    "has_markdown2, has_markdown3, has_markdown4, has_markdown5 from mart_demand_features",
    "mart_demand_features"))
def q_cse_flag(spark, sf):
    return builds.demand_features(spark, sf).select(
        "store_id", "dept_id", "sale_date", "is_holiday", "is_holiday_season",
        *[f"has_markdown{i}" for i in range(1, 6)])


@query("fn_extract", W(
    "select store_id, dept_id, sale_date, year, month, quarter from mart_demand_features",
    "mart_demand_features"))
def q_fn_extract(spark, sf):
    return builds.demand_features(spark, sf).select("store_id", "dept_id", "sale_date", "year",
                                                    "month", "quarter")


@query("fn_week_sunday", W(
    f"select distinct sale_date, {O.week_sunday('sale_date')} as week_of_year from stg_weekly_sales",
    "stg_weekly_sales"))
def q_fn_week_sunday(spark, sf):
    return (builds.weekly_table(spark, sf).select("sale_date").distinct()
            .select("sale_date", S.week_sunday("sale_date").alias("week_of_year")))


@query("fn_coalesce_sum", W(
    "select store_id, dept_id, sale_date, total_markdown from mart_demand_features",
    "mart_demand_features"))
def q_fn_coalesce_sum(spark, sf):
    return builds.demand_features(spark, sf).select("store_id", "dept_id", "sale_date",
                                                    "total_markdown")


@query("fn_safe_divide", W(
    "select store_id, dept_id, stddev_weekly_sales / nullif(avg_weekly_sales, 0) as ratio "
    "from sales_stats", "sales_stats"))
def q_fn_safe_divide(spark, sf):
    return marts.sales_volatility(builds.weekly_table(spark, sf)).select(
        "store_id", "dept_id", S.safe_div("stddev_weekly_sales", "avg_weekly_sales").alias("ratio"))


@query("fn_round", W(
    f"select store_id, dept_id, {O.r('weekly_sales / 3.0')} as r2, "
    f"{O.r('weekly_sales / 7.0', 4)} as r4 from stg_weekly_sales", "stg_weekly_sales"))
def q_fn_round(spark, sf):
    return builds.weekly_table(spark, sf).select(
        "store_id", "dept_id",
        S.round_half_away(F.col("weekly_sales") / F.lit(3.0)).alias("r2"),
        S.round_half_away(F.col("weekly_sales") / F.lit(7.0), 4).alias("r4"))


@query("win_lag_52_calendar", W(
    "select a.store_id, a.dept_id, a.sale_date, b.weekly_sales as sales_lag_52wk from stg_weekly_sales a "
    "left join stg_weekly_sales b on a.store_id = b.store_id and a.dept_id = b.dept_id "
    "and b.sale_date = a.sale_date - 364", "stg_weekly_sales"))
def q_win_lag_52_calendar(spark, sf):
    return builds.weekly_table(spark, sf).select("store_id", "dept_id", "sale_date",
                                                 marts.lag_weeks("weekly_sales", 52).alias("sales_lag_52wk"))
