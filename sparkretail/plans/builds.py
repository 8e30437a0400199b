"""Composite builds: driver tables -> raw proxies -> staging -> marts.

These are the end-to-end models of SURVEY §2.11 as functions of
``(spark, sf_dir)``; every query in the catalog starts from one of them.
Staging and the feature mart are written once per application and input, in
the shared folder and bucketed by store; whatever builds on them reads the
columns it needs, without an exchange for work by store or series.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.operators import marts, staging
from sparkretail.session import bucketed_once, parts_for, pin_time_zone, scratch_path, stored_once
from sparkretail.sources import committed, proxy


def weekly_staging(spark: SparkSession, sf_dir: str, grain: str = "week") -> DataFrame:
    pin_time_zone(spark)
    return staging.stg_weekly_sales(*proxy.weekly_inputs(spark, sf_dir, grain))


def daily_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_time_zone(spark)
    return staging.stg_daily_sales(*proxy.daily_inputs(spark, sf_dir))


def transactions_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_time_zone(spark)
    return staging.stg_transactions(proxy.raw_transactions(spark, sf_dir))


def weekly_table(spark: SparkSession, sf_dir: str, grain: str = "week") -> DataFrame:
    """The staging model, bucketed by store: every mart reads it without an exchange."""
    return bucketed_once(spark, f"stg_weekly_{grain}", sf_dir, lambda: weekly_staging(spark, sf_dir, grain),
                         "store_id", ("store_id", "dept_id", "sale_date"), rows=lambda: proxy.most_rows(spark, sf_dir))


def daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_once(spark, "stg_daily", sf_dir, lambda: daily_staging(spark, sf_dir))


def demand_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_demand_features(weekly_table(spark, sf_dir))


def demand_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucketed_once(spark, "mart_demand_features", sf_dir, lambda: demand_features(spark, sf_dir),
                         "store_id", ("store_id", "dept_id", "sale_date"), rows=lambda: proxy.most_rows(spark, sf_dir))


def incremental_demand(spark: SparkSession, sf_dir: str, cuts: tuple[float, ...] = (0.5, 0.75, 0.9)) -> DataFrame:
    """The feature mart built up to a first cut of the weeks and refreshed to
    each next one: rows appended and tails replaced as committed runs. A run
    reads the tail that belongs to the mart's last run, so one that broke off
    between its two commits is simply run again."""
    stg = weekly_table(spark, sf_dir)
    days = stg.agg(F.min("sale_date").alias("a"), F.datediff(F.max("sale_date"), F.min("sale_date")).alias("n")).first()
    ends = [days.a + timedelta(days=int(days.n * c)) for c in (*cuts, 1.0)]
    mart, tails = scratch_path(spark, "demand_mart"), scratch_path(spark, "demand_tails")
    start = None
    for end in ends:
        arrivals = stg.where((F.col("sale_date") <= F.lit(end)) & (F.lit(True) if start is None else F.col("sale_date") > F.lit(start)))
        refresh_run(spark, mart, tails, str(end), arrivals)
        start = end
    return committed.read(spark, mart, demand_features(spark, sf_dir).schema)


def refresh_run(spark: SparkSession, mart: str, tails: str, run_id: str, arrivals: DataFrame) -> None:
    """One refresh of the mart at a path, under a run id."""
    runs = committed.commits(spark, mart)
    history = {c.run_id: c for c in committed.commits(spark, tails)}
    kept = arrivals.select(*marts.TAIL_COLUMNS).schema
    tail = committed.read(spark, tails, kept, history[runs[-1].run_id].version if runs else 0)
    # parts by rows: the tail's rows are narrow when written, so parts of equal bytes would hold too many to sort
    rows = arrivals.count() + (history[runs[-1].run_id].rows if runs else 0)
    new = marts.refresh_demand_features(tail, arrivals, parts=parts_for(spark, rows))
    committed.write(new.tail, tails, run_id, "overwrite")
    committed.write(new.rows, mart, run_id)

def positive_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature mart as every model reads it: ``weekly_sales > 0``
    (filter stays above the windows, as in the reference)."""
    return demand_table(spark, sf_dir).where(F.col("weekly_sales") > 0)


def inventory_risk(spark: SparkSession, sf_dir: str, grain: str = "week") -> DataFrame:
    return marts.mart_inventory_risk(weekly_table(spark, sf_dir, grain))


def drift_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive-sales feature mart split at ``max(date) - 12 weeks``, pruned to
    the drift features and written once: the numeric, categorical and summary
    jobs all read it."""
    from sparkretail.operators import drift

    def build() -> DataFrame:
        cols = ["sale_date", "cutoff_date", "is_recent", *drift.NUMERIC_FEATURES,
                *[c for c in drift.CATEGORICAL_FEATURES if c not in drift.NUMERIC_FEATURES]]
        return drift.split_recent(positive_demand(spark, sf_dir)).select(*cols)

    return stored_once(spark, "drift_split", sf_dir, build)
