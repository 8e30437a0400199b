"""Read queries over the forecast table and the risk mart (the service's
endpoints and the dashboard's roll-ups, SURVEY §2.6 / 2.11).

Endpoint queries take their parameters as DataFrame predicates (nothing is
spliced into SQL text); "not found" is an empty DataFrame. Set-wide variants
(all stores at once) use windows instead of per-store subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkretail.functions.scalar import exact_sum, round_half_away

MAX_WEEKS = 52
ROWS_PER_WEEK = 100  # the endpoint bounds rows, not weeks


def _check_weeks(weeks: int) -> None:
    if not 1 <= weeks <= MAX_WEEKS:
        raise ValueError(f"weeks must be within 1..{MAX_WEEKS}, got {weeks}")


def serve_stores(table: DataFrame) -> DataFrame:
    """Distinct store ids (sorted) with the store count on every row."""
    ids = table.select("store_id").distinct()
    count = ids.agg(F.count(F.lit(1))).scalar()  # scalar subquery, no single-partition window
    return ids.withColumn("store_count", count).orderBy("store_id")


def model_is(model: str) -> F.Column:
    return F.lower(F.col("model")) == F.lower(F.lit(model))


def latest_run(table: DataFrame, store_id: int, model: str) -> DataFrame:
    """Rows of one store and model whose ``run_ts`` is the latest for them."""
    sel = table.where((F.col("store_id") == store_id) & model_is(model))
    latest = sel.agg(F.max("run_ts")).scalar()
    return sel.where(F.col("run_ts") == latest)


def latest_runs(table: DataFrame) -> DataFrame:
    """Set-wide form: every (store, model) keeps its latest run. The maxima
    are a small aggregate joined back; no window holds a store's whole history."""
    name = F.lower(F.col("model"))
    latest = table.groupBy(F.col("store_id").alias("_store"), name.alias("_model")).agg(
        F.max("run_ts").alias("_latest"))
    on = ((F.col("store_id") == F.col("_store")) & (name == F.col("_model"))
          & (F.col("run_ts") == F.col("_latest")))
    return table.join(latest, on, "left_semi")


def forecast_columns(df: DataFrame) -> DataFrame:
    return df.select("store_id", "dept_id", F.col("ds").alias("forecast_date"),
                     F.col("yhat").alias("forecast_sales"),
                     F.col("yhat_lower").alias("forecast_lower"),
                     F.col("yhat_upper").alias("forecast_upper"), "model", "run_id", "run_ts")


def serve_forecast(table: DataFrame, store_id: int, model: str = "gbt", weeks: int = 12,
                   bound: str = "weeks") -> DataFrame:
    """Latest forecast of one store and model ordered by date (dept_id breaks
    ties). ``bound="weeks"`` keeps the first ``weeks`` dates;
    ``bound="rows"`` keeps the first ``weeks * 100`` rows, the endpoint's own
    rule, which drops late dates of a store with more than 100 departments."""
    _check_weeks(weeks)
    out = forecast_columns(latest_run(table, store_id, model))
    if bound == "weeks":
        first = out.select("forecast_date").distinct().orderBy("forecast_date").limit(weeks)
        return out.join(F.broadcast(first), "forecast_date", "left_semi").orderBy(
            "forecast_date", "dept_id")
    return out.orderBy("forecast_date", "dept_id").limit(weeks * ROWS_PER_WEEK)


RISK_COLUMNS = ["store_id", "dept_id", "store_type", "avg_weekly_sales", "stddev_weekly_sales",
                "coeff_of_variation", "demand_risk_tier"]


def risk_ordered(risk: DataFrame) -> DataFrame:
    """The risk mart as readers see it: CV descending, NULLs last."""
    return risk.orderBy(F.desc_nulls_last("coeff_of_variation"), "store_id", "dept_id")


def serve_risk(risk: DataFrame, store_id: int) -> DataFrame:
    """Departments of one store, most volatile first."""
    return risk.where(F.col("store_id") == store_id).select(*RISK_COLUMNS).orderBy(
        F.desc_nulls_last("coeff_of_variation"), "dept_id")


def tier_counts(risk: DataFrame) -> DataFrame:
    """HIGH / MEDIUM / LOW department counts per store, all stores at once."""
    t = F.col("demand_risk_tier")
    return risk.groupBy("store_id").agg(F.count_if(t == "HIGH").alias("high"),
                                        F.count_if(t == "MEDIUM").alias("medium"),
                                        F.count_if(t == "LOW").alias("low"))


def tier_shares(counts: DataFrame) -> DataFrame:
    """Tier count / total * 100 rounded to whole percent; 0 when no total."""
    total = F.col("high") + F.col("medium") + F.col("low")

    def pct(c):
        return F.coalesce(round_half_away(F.try_divide(F.col(c) * F.lit(100.0), total), 0),
                          F.lit(0.0))

    return counts.select("store_id", "high", "medium", "low", pct("high").alias("pct_high"),
                         pct("medium").alias("pct_medium"), pct("low").alias("pct_low"))


def top_departments(risk: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most volatile departments of every store (dept_id breaks ties)."""
    w = Window.partitionBy("store_id").orderBy(F.desc_nulls_last("coeff_of_variation"), "dept_id")
    return (risk.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("store_id", "rank", "dept_id", "avg_weekly_sales", "coeff_of_variation",
                    "demand_risk_tier"))


def forecast_by_date(forecasts: DataFrame) -> DataFrame:
    """Store totals per forecast date over departments (the table holds
    cents), rounded to units."""
    return forecasts.groupBy("store_id", "model", "ds").agg(
        *[round_half_away(exact_sum(c), 0).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])


def dashboard(table: DataFrame, risk: DataFrame, actuals: DataFrame, n: int = 10) -> DataFrame:
    """The page of every store and model of the latest runs, a row per line.

    Each row has the page's head: number of forecast rows, dates covered, run,
    tier counts and shares. Lines of ``kind`` 'date' are the by-date roll-up of
    the forecasts joined to actual sales on (store, dept, date), those of kind
    'department' the store's ``n`` most volatile departments; ``position``
    numbers them by date and by rank."""
    latest = latest_runs(table)
    fc = latest.groupBy("store_id", "model").agg(
        F.count(F.lit(1)).alias("forecast_rows"), F.countDistinct("ds").alias("forecast_dates"),
        F.min("ds").alias("first_date"), F.max("ds").alias("last_date"),
        F.max("run_id").alias("run_id"))
    head = fc.join(tier_shares(tier_counts(risk)), "store_id", "left")
    # one actual per key, so that none counts a forecast twice
    once = actuals.groupBy("store_id", "dept_id", "ds").agg(exact_sum("actual").alias("actual"))
    page = Window.partitionBy("store_id", "model").orderBy("ds")
    dates = (latest.join(once, ["store_id", "dept_id", "ds"], "left").groupBy("store_id", "model", "ds")
             .agg(*[round_half_away(exact_sum(c), 0).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper", "actual")])
             .withColumn("kind", F.lit("date")).withColumn("position", F.row_number().over(page)))
    departments = top_departments(risk, n).withColumnRenamed("rank", "position").withColumn("kind", F.lit("department"))
    departments = fc.select("store_id", "model").join(departments, "store_id")
    lines = dates.unionByName(departments, allowMissingColumns=True).select(
        F.col("store_id").alias("_store"), F.col("model").alias("_model"), "kind", "position", "ds", "yhat", "yhat_lower",
        "yhat_upper", "actual", "dept_id", "avg_weekly_sales", "coeff_of_variation", "demand_risk_tier")
    on = F.col("store_id").eqNullSafe(F.col("_store")) & F.col("model").eqNullSafe(F.col("_model"))
    return head.join(lines, on).drop("_store", "_model")


def forecast_vs_actual(table: DataFrame, actuals: DataFrame) -> DataFrame:
    """Latest forecasts joined to actual sales on (store, dept, date)."""
    return latest_runs(table).join(actuals, ["store_id", "dept_id", "ds"], "left").select(
        "store_id", "dept_id", "ds", "model", "yhat", "actual")
