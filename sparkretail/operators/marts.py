"""Marts: windows, aggregates and tiers over the staging tables.

All series windows share ``PARTITION BY store_id, dept_id ORDER BY sale_date``
so Catalyst plans one exchange + sort + window node for every lag and rolling
mean. A series holds one row per week, so a window partition is bounded by
the number of weeks, not by the data volume.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkretail.functions.scalar import (exact_avg, exact_sum, flag, holiday_season,
                                          positive_flag, risk_tier, round_half_away, safe_div,
                                          to_money, week_sunday)

SERIES_KEYS = ("store_id", "dept_id")


def series_window(keys=SERIES_KEYS, order: str = "sale_date"):
    return Window.partitionBy(*keys).orderBy(order)


def lag_rows(col: str, n: int, keys=SERIES_KEYS, order: str = "sale_date") -> Column:
    """Value ``n`` rows earlier in the series (by row, not by calendar)."""
    return F.lag(col, n).over(series_window(keys, order))


def lag_weeks(col: str, weeks: int, keys=SERIES_KEYS, order: str = "sale_date") -> Column:
    """Value exactly ``weeks`` weeks earlier, NULL where the series has a gap
    there (the calendar form of ``lag_rows``); a range window, no join."""
    day = F.datediff(F.col(order), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*keys).orderBy(day).rangeBetween(-7 * weeks, -7 * weeks)
    return F.max(col).over(w)


def rolling_mean(col: str, rows: int, keys=SERIES_KEYS, order: str = "sale_date",
                 leak_free: bool = False) -> Column:
    """Mean over the current row and ``rows - 1`` preceding rows (partial
    frames at the start of a series still give a value). ``leak_free=True``
    uses the ``rows`` rows before the current one instead."""
    w = series_window(keys, order)
    w = w.rowsBetween(-rows, -1) if leak_free else w.rowsBetween(-(rows - 1), 0)
    return F.try_divide(F.sum(to_money(col)).over(w).cast("double"),
                        F.count(F.col(col)).over(w).cast("double"))


def calendar_parts(d: str = "sale_date") -> list[Column]:
    return [F.year(d).alias("year"), F.month(d).alias("month"),
            week_sunday(d).alias("week_of_year")]


def mart_weekly_sales(stg: DataFrame) -> DataFrame:
    """Staging columns + year, month, Sunday week, 4-row rolling mean and the
    value 52 rows back."""
    return stg.select(
        "store_id", "dept_id", "sale_date", "weekly_sales", "is_holiday", "store_type",
        "store_size", "temperature", "fuel_price", "markdown1", "markdown2", "markdown3",
        "markdown4", "markdown5", "cpi", "unemployment",
        *calendar_parts(),
        rolling_mean("weekly_sales", 4).alias("rolling_4wk_avg_sales"),
        lag_rows("weekly_sales", 52).alias("sales_same_week_last_year"))


def total_markdown(cols=("markdown1", "markdown2", "markdown3", "markdown4", "markdown5")) -> Column:
    expr = None
    for c in cols:
        term = F.coalesce(F.col(c), F.lit(0.0))
        expr = term if expr is None else expr + term
    return expr


def mart_demand_features(stg: DataFrame, leak_free: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """27-column ML feature table, one row per store, department and week;
    ``keep`` names further columns to carry along."""
    return stg.select(
        *keep, "store_id", "dept_id", "sale_date", "weekly_sales",
        *calendar_parts(),
        F.quarter("sale_date").alias("quarter"),
        holiday_season("sale_date").alias("is_holiday_season"),
        flag(F.col("is_holiday")).alias("is_holiday"),
        "store_type", "store_size", "temperature", "fuel_price", "cpi", "unemployment",
        *[positive_flag(f"markdown{i}").alias(f"has_markdown{i}") for i in range(1, 6)],
        total_markdown().alias("total_markdown"),
        lag_rows("weekly_sales", 1).alias("sales_lag_1wk"),
        lag_rows("weekly_sales", 4).alias("sales_lag_4wk"),
        lag_rows("weekly_sales", 52).alias("sales_lag_52wk"),
        rolling_mean("weekly_sales", 4, leak_free=leak_free).alias("rolling_4wk_avg"),
        rolling_mean("weekly_sales", 13, leak_free=leak_free).alias("rolling_13wk_avg"))


#: rows of a series that its next row's lags and rolling means look back on, and the columns they read
TAIL_ROWS = 52
TAIL_COLUMNS = (*SERIES_KEYS, "sale_date", "weekly_sales")


def series_tail(stg: DataFrame, rows: int = TAIL_ROWS, keys=SERIES_KEYS) -> DataFrame:
    """The last rows of each series. Ordered as the other series windows, so
    they share one sort."""
    w = series_window(keys)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    back = F.count(F.lit(1)).over(whole) - F.row_number().over(w)
    return stg.withColumn("_back", back).where(F.col("_back") < rows).drop("_back")


@dataclass(frozen=True)
class Refresh:
    """What arrivals add: new mart rows, the next tail (``TAIL_COLUMNS``), and
    arrivals that are not later than their series (their weeks are history and
    need a rebuild)."""

    rows: DataFrame
    tail: DataFrame
    late: DataFrame


def refresh_demand_features(tail: DataFrame, arrivals: DataFrame, leak_free: bool = False,
                            parts: int | None = None) -> Refresh:
    """The feature rows of new weeks from the tail (``series_tail`` of what was
    there before, of which ``TAIL_COLUMNS`` are read) and the arrivals alone, which
    have the staging columns; history is not read. A series without a tail
    starts with its arrivals. Each result is one exchange (to ``parts`` parts, if
    given) and one sort: all windows are those of the series in order of its dates."""
    whole = series_window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.max(F.when(~F.col("_new"), F.col("sale_date"))).over(whole)

    def told_apart(new: DataFrame) -> DataFrame:
        both = tail.select(*TAIL_COLUMNS, F.lit(False).alias("_new")).unionByName(
            new.withColumn("_new", F.lit(True)), allowMissingColumns=True)
        both = both.repartition(parts, *SERIES_KEYS) if parts else both
        return both.withColumn("_late", F.col("_new") & (F.coalesce(F.col("sale_date") <= last, F.lit(False))))

    both = told_apart(arrivals)
    rows = mart_demand_features(both.where(~F.col("_late")), leak_free, keep=("_new",)).where("_new").drop("_new")
    narrow = told_apart(arrivals.select(*TAIL_COLUMNS)).where(~F.col("_late")).select(*TAIL_COLUMNS)
    return Refresh(rows, series_tail(narrow), both.where("_late").select(*arrivals.columns))


EXTERNAL_SCALE = 10  # decimals kept of prices, rates and indices that are not money


def distinct_count(col: str) -> Column:
    """Exact number of distinct values without expanding the rows: the sets
    are merged partially. For columns that have few values per group (weeks and
    departments of a store)."""
    return F.size(F.collect_set(col)).cast("bigint")


def mart_store_features(stg: DataFrame) -> DataFrame:
    """One row per store: sales statistics, holiday split, distinct weeks and
    departments, mean external features (all rounded to 2 places)."""
    hol = F.col("is_holiday")
    sales = F.col("weekly_sales")
    return stg.groupBy("store_id", "store_type", "store_size").agg(
        round_half_away(exact_avg(sales)).alias("avg_weekly_sales"),
        round_half_away(exact_sum(sales)).alias("total_sales"),
        round_half_away(F.min(sales)).alias("min_weekly_sales"),
        round_half_away(F.max(sales)).alias("max_weekly_sales"),
        round_half_away(F.stddev_samp(sales)).alias("stddev_weekly_sales"),
        round_half_away(exact_avg(F.when(hol, sales))).alias("avg_holiday_sales"),
        round_half_away(exact_avg(F.when(~hol, sales))).alias("avg_non_holiday_sales"),
        distinct_count("sale_date").alias("num_weeks"),
        distinct_count("dept_id").alias("num_depts"),
        round_half_away(exact_avg("temperature", EXTERNAL_SCALE)).alias("avg_temperature"),
        round_half_away(exact_avg("fuel_price", EXTERNAL_SCALE)).alias("avg_fuel_price"),
        round_half_away(exact_avg("cpi", EXTERNAL_SCALE)).alias("avg_cpi"),
        round_half_away(exact_avg("unemployment", EXTERNAL_SCALE)).alias("avg_unemployment"))


def sales_volatility(stg: DataFrame) -> DataFrame:
    """Per (store, dept, type): rounded mean/stddev/min/max/sum and count."""
    sales = F.col("weekly_sales")
    return stg.groupBy("store_id", "dept_id", "store_type").agg(
        round_half_away(exact_avg(sales)).alias("avg_weekly_sales"),
        round_half_away(F.stddev_samp(sales)).alias("stddev_weekly_sales"),
        round_half_away(F.min(sales)).alias("min_weekly_sales"),
        round_half_away(F.max(sales)).alias("max_weekly_sales"),
        F.count(F.lit(1)).alias("num_weeks"),
        round_half_away(exact_sum(sales)).alias("total_sales"))


def mart_inventory_risk(stg: DataFrame) -> DataFrame:
    """Coefficient of variation of the *rounded* stddev and mean, tiered on
    the unrounded quotient; groups whose rounded mean is not > 0 are dropped.
    Order is left to the reader (``serving.risk_ordered``)."""
    stats = sales_volatility(stg).where(F.col("avg_weekly_sales") > 0)
    cv = safe_div("stddev_weekly_sales", "avg_weekly_sales")
    return stats.select("*", round_half_away(cv, 4).alias("coeff_of_variation"),
                        risk_tier(cv).alias("demand_risk_tier"))


def mart_promotion_lift(stg_daily: DataFrame) -> DataFrame:
    """Promo vs non-promo mean daily sales per store; lift in percent (NULL
    when the base is 0 or absent). A NULL competition distance is its own
    group, as in SQL."""
    promo = F.col("is_promo")
    sales = F.col("daily_sales")
    avg_p = exact_avg(F.when(promo == 1, sales))
    avg_n = exact_avg(F.when(promo == 0, sales))
    return stg_daily.groupBy("store_id", "store_type", "assortment", "competition_distance").agg(
        round_half_away(avg_p).alias("avg_promo_sales"),
        round_half_away(avg_n).alias("avg_non_promo_sales"),
        round_half_away(safe_div(avg_p - avg_n, avg_n) * F.lit(100.0)).alias("promo_lift_pct"),
        F.count_if(promo == 1).alias("promo_days"),
        F.count_if(promo == 0).alias("non_promo_days"),
        round_half_away(exact_sum(sales)).alias("total_sales"))
