"""Evaluation helpers: WMAE, time split, holdout tails.

Everything works on all stores at once (group-bys and windows keyed by
store), never in a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkretail.functions.scalar import exact_sum, holiday_weight, round_half_away, to_money

FORECAST_HORIZON = 12  # weeks
MIN_HISTORY = 52  # weeks a store needs to be forecast


def wmae(actual: str | Column, predicted: str | Column, is_holiday: str | Column,
         weight: int = 5) -> Column:
    """``sum(w * |a - p|) / sum(w)``, w = 5 on holidays else 1 (aggregate)."""
    a = F.col(actual) if isinstance(actual, str) else actual
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    w = holiday_weight(is_holiday, weight)
    return F.try_divide(F.sum(w * F.abs(a - p)), F.sum(w))


def exact_wmae(actual: str, predicted: str, is_holiday: str, weight: int = 5) -> Column:
    """``wmae`` of columns in cents, summed in decimal: the same in any order."""
    w = F.when(F.col(is_holiday) == 1, F.lit(weight)).otherwise(F.lit(1))
    return F.try_divide(F.sum(F.abs(to_money(actual) - to_money(predicted)) * w).cast("double"),
                        F.sum(w).cast("double"))


def with_cutoff(df: DataFrame, date_col: str = "sale_date",
                weeks: int = FORECAST_HORIZON) -> DataFrame:
    """Adds ``cutoff_date = max(date) - weeks`` as an uncorrelated scalar
    subquery (evaluated once, no cross join)."""
    cutoff = F.date_sub(df.select(F.max(date_col)).scalar(), 7 * weeks)
    return df.withColumn("cutoff_date", cutoff)


def time_split(df: DataFrame, date_col: str = "sale_date",
               weeks: int = FORECAST_HORIZON) -> DataFrame:
    """Adds ``is_test``: rows after ``max(date) - weeks`` are the test set."""
    return with_cutoff(df, date_col, weeks).withColumn(
        "is_test", F.col(date_col) > F.col("cutoff_date")).drop("cutoff_date")


def store_week(df: DataFrame, keys: Sequence[str] = ("store_id",), date_col: str = "sale_date",
               value: str = "weekly_sales", holiday: str = "is_holiday") -> DataFrame:
    """Store totals per week over departments: ``y = sum`` (exact, in
    decimal), holiday = max."""
    return (df.groupBy(*keys, F.col(date_col).alias("ds"))
            .agg(exact_sum(value).alias("y"),
                 F.max(F.col(holiday).cast("int")).alias("is_holiday")))


def holdout_tail(series: DataFrame, keys: Sequence[str] = ("store_id",), order: str = "ds",
                 horizon: int = FORECAST_HORIZON, min_rows: int = MIN_HISTORY) -> DataFrame:
    """Adds ``pos`` (1-based position in the series), ``n_rows`` and
    ``is_holdout`` (the last ``horizon`` rows); series shorter than
    ``min_rows`` are dropped. One window spec, one sort."""
    w = Window.partitionBy(*keys).orderBy(order)
    wall = Window.partitionBy(*keys)
    out = (series.withColumn("pos", F.row_number().over(w))
           .withColumn("n_rows", F.count(F.lit(1)).over(wall)))
    return (out.where(F.col("n_rows") >= min_rows)
            .withColumn("is_holdout", F.col("pos") > F.col("n_rows") - horizon))


def first_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` smallest distinct key values (the reference's PoC store cap)."""
    return df.select(key).distinct().orderBy(key).limit(n)


def restrict_to_first(df: DataFrame, key: str, n: int | None) -> DataFrame:
    if n is None:
        return df
    return df.join(F.broadcast(first_keys(df, key, n)), key, "left_semi")


def score_summary(scores: DataFrame, key: str = "store_id", metric: str = "wmae") -> DataFrame:
    """Mean, best and worst of a per-key score table."""
    return scores.agg(F.count(F.lit(1)).alias("n_scored"),
                      round_half_away(F.avg(metric), 2).alias("mean_wmae"),
                      F.min_by(key, metric).alias("best_store"),
                      F.min(metric).alias("best_wmae"),
                      F.max_by(key, metric).alias("worst_store"),
                      F.max(metric).alias("worst_wmae"))
