"""Catalog entries: split, WMAE, forecasting, drift (SURVEY §2.9 and the
model-side rows of §2.2-2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkretail.functions import scalar as S
from sparkretail.operators import drift, drift_sketch, forecast, metrics, season_trend
from sparkretail.plans import builds
from sparkretail.plans import oracle as O
from sparkretail.plans import oracle_ml  # noqa: F401  (registers the CTEs)
from sparkretail.plans.catalog import query
from sparkretail.session import kept_once, scratch_path
from sparkretail.sources import committed

W = O.with_ctes
KEYS = "store_id, dept_id, sale_date"


def _positive(spark, sf):
    return builds.positive_demand(spark, sf)


def _split(spark, sf):
    return builds.drift_input(spark, sf)


def _frame(spark, sf):
    return forecast.seasonal_frame(_positive(spark, sf))


def _sunday(spark, sf):
    return forecast.seasonal_frame(_positive(spark, sf), anchor="sunday")


# ---- predicates, split, encodings
@query("flt_positive_target", W(f"select {KEYS}, weekly_sales from positive_demand",
                                "positive_demand"))
def q_flt_positive_target(spark, sf):
    return _positive(spark, sf).select("store_id", "dept_id", "sale_date", "weekly_sales")


@query("flt_dropna_subset", W(
    f"select {KEYS}, sales_lag_52wk from positive_demand where sales_lag_1wk is not null "
    "and sales_lag_4wk is not null and rolling_4wk_avg is not null", "positive_demand"))
def q_flt_dropna_subset(spark, sf):
    return (_positive(spark, sf).dropna(subset=forecast.REQUIRED_LAGS)
            .select("store_id", "dept_id", "sale_date", "sales_lag_52wk"))


@query("jn_split_cutoff", W("select distinct cutoff_date from drift_split", "drift_split"))
def q_jn_split_cutoff(spark, sf):
    return metrics.with_cutoff(_positive(spark, sf)).select("cutoff_date").distinct()


@query("ml_time_split", W(f"select {KEYS}, is_recent as is_test from drift_split", "drift_split"))
def q_ml_time_split(spark, sf):
    return metrics.time_split(_positive(spark, sf)).select("store_id", "dept_id", "sale_date",
                                                           "is_test")


@query("fn_weeks_delta", W("select max(sale_date) as last_date, "
                           "cast(max(sale_date) - 84 as date) as cutoff_date from positive_demand",
                           "positive_demand"))
def q_fn_weeks_delta(spark, sf):
    return _positive(spark, sf).agg(F.max("sale_date").alias("last_date")).select(
        "last_date", S.weeks_before("last_date", 12).alias("cutoff_date"))


@query("prj_encode_category", W(
    "select store_id, dept_id, sale_date, case store_type when 'A' then 0 when 'B' then 1 "
    "when 'C' then 2 else -1 end as store_type_code from positive_demand", "positive_demand"))
def q_prj_encode_category(spark, sf):
    return _positive(spark, sf).select("store_id", "dept_id", "sale_date",
                                       S.encode_store_type("store_type").alias("store_type_code"))


@query("prj_available_columns", W(
    "select " + ", ".join(forecast.GBT_FEATURES) + " from positive_demand", "positive_demand"))
def q_prj_available_columns(spark, sf):
    df = _positive(spark, sf)
    return df.select(*[c for c in forecast.GBT_FEATURES if c in df.columns])


@query("fn_log_abs", W(
    f"select store_id, dept_id, sale_date, {O.r('ln(weekly_sales)', 9)} as log_sales, "
    "abs(weekly_sales - sales_lag_1wk) as abs_change from positive_demand", "positive_demand"))
def q_fn_log_abs(spark, sf):
    return _positive(spark, sf).select(
        "store_id", "dept_id", "sale_date",
        S.round_half_away(F.log("weekly_sales"), 9).alias("log_sales"),
        F.abs(F.col("weekly_sales") - F.col("sales_lag_1wk")).alias("abs_change"))


# ---- per-store series, holdout, calendar, future frame
@query("agg_store_week", W("select * from store_week", "store_week"))
def q_agg_store_week(spark, sf):
    return metrics.store_week(_positive(spark, sf))


@query("win_holdout_tail", W(
    "select store_id, ds, pos, n_rows, pos > n_rows - 12 as is_holdout from holdout_rows",
    "holdout_rows"))
def q_win_holdout_tail(spark, sf):
    return metrics.holdout_tail(metrics.store_week(_positive(spark, sf))).select(
        "store_id", "ds", "pos", "n_rows", "is_holdout")


@query("ml_holiday_calendar", W(
    "select s.store_id, s.ds, exists (select 1 from store_week h where h.store_id = s.store_id "
    "and h.is_holiday = 1 and s.ds - h.ds in (0, 1)) as in_calendar from store_week s", "store_week"))
def q_ml_holiday_calendar(spark, sf):
    return forecast.with_calendar(metrics.store_week(_positive(spark, sf)), F.col("is_holiday")).select(
        "store_id", "ds", "in_calendar")


@query("ml_future_frame", W("select store_id, ds, step from seasonal_frame where kind = 'future'",
                            "seasonal_frame"))
def q_ml_future_frame(spark, sf):
    return _frame(spark, sf).where(F.col("kind") == "future").select("store_id", "ds", "step")


@query("ml_forecast_ahead", W("select store_id, ds, step, yhat, yhat_lower, yhat_upper from seasonal_ahead "
                              "where kind = 'future'", "seasonal_ahead"))
def q_ml_forecast_ahead(spark, sf):
    """Twelve weeks beyond the end of the data, fitted on the whole history."""
    return forecast.seasonal_frame(_positive(spark, sf), horizon_from="data_end").where(
        F.col("kind") == "future").select("store_id", "ds", "step", "yhat", "yhat_lower", "yhat_upper")


@query("ml_future_frame_sunday", W("select store_id, ds, step from seasonal_sunday where kind = 'future'",
                                   "seasonal_sunday"))
def q_ml_future_frame_sunday(spark, sf):
    """The future rows on Sundays, whatever the series' own weekday."""
    return _sunday(spark, sf).where(F.col("kind") == "future").select("store_id", "ds", "step")


@query("ml_store_seasonal", W("select * from bend_frame", "bend_frame"))
def q_ml_store_seasonal(spark, sf):
    """Change points, smooth season, holidays: history, holdout and future rows."""
    return season_trend.changepoint_frame(_positive(spark, sf))


@query("ml_seasonal_gram", W("select * from bend_gram", "bend_gram"))
def q_ml_seasonal_gram(spark, sf):
    """The exact sums that each store's fit rests on."""
    sums = season_trend.gram(season_trend.design(forecast.history_and_future(_positive(spark, sf))))
    return sums.select("store_id", "i", F.posexplode("products").alias("j", "product"))


@query("ml_seasonal_band")
def q_ml_seasonal_band(spark, sf):
    """The future rows with the simulated band, which widens with the step."""
    return season_trend.changepoint_forecast(_positive(spark, sf))


@query("ml_store_seasonal_line", W("select * from seasonal_frame", "seasonal_frame"))
def q_ml_store_seasonal_line(spark, sf):
    """One straight line, mean ratio per week of the year, constant band."""
    return _frame(spark, sf)


@query("jn_holdout_dates", W(
    "select h.store_id, h.ds from seasonal_frame h where h.kind = 'holdout' and exists "
    "(select 1 from seasonal_frame f where f.kind = 'future' and f.store_id = h.store_id "
    "and f.ds = h.ds)", "seasonal_frame"))
def q_jn_holdout_dates(spark, sf):
    frame = _frame(spark, sf)
    hold = frame.where(F.col("kind") == "holdout").select("store_id", "ds")
    fut = frame.where(F.col("kind") == "future").select("store_id", "ds")
    return hold.join(fut, ["store_id", "ds"], "left_semi")


@query("jn_align_position", W("select * from sunday_pairs", "sunday_pairs"))
def q_jn_align_position(spark, sf):
    """Forecasts on Sundays never fall on the holdout's dates: pairs go by position."""
    return forecast.holdout_pairs(_sunday(spark, sf))


@query("jn_align_date", W("select * from holdout_pairs", "holdout_pairs"))
def q_jn_align_date(spark, sf):
    return forecast.holdout_pairs(_frame(spark, sf))


@query("jn_top_stores", W(
    "select * from store_week where store_id in "
    "(select distinct store_id from store_week order by store_id limit 10)", "store_week"))
def q_jn_top_stores(spark, sf):
    return metrics.restrict_to_first(metrics.store_week(_positive(spark, sf)), "store_id", 10)


@query("ml_score_table", W("select * from store_scores", "store_scores"))
def q_ml_score_table(spark, sf):
    return forecast.store_scores(_frame(spark, sf))


@query("agg_extremes", W(
    f"select count(*) as n_scored, {O.r('avg(wmae)')} as mean_wmae, arg_min(store_id, wmae) as best_store, "
    "min(wmae) as best_wmae, arg_max(store_id, wmae) as worst_store, max(wmae) as worst_wmae "
    "from store_scores", "store_scores"))
def q_agg_extremes(spark, sf):
    return metrics.score_summary(forecast.store_scores(_frame(spark, sf)))


@query("ml_wmae", W(
    f"select {O.r('sum(w * abs(weekly_sales - sales_lag_1wk)) / sum(w)', 4)} as wmae_lag1, "
    f"{O.r('sum(w * abs(weekly_sales - sales_lag_52wk)) filter (where sales_lag_52wk is not null) / sum(w) filter (where sales_lag_52wk is not null)', 4)} as wmae_lag52 "
    "from (select *, case when is_holiday = 1 then 5.0 else 1.0 end as w from drift_split "
    "where is_recent and sales_lag_1wk is not null)", "drift_split"))
def q_ml_wmae(spark, sf):
    test = metrics.time_split(_positive(spark, sf)).where(
        F.col("is_test") & F.col("sales_lag_1wk").isNotNull())
    has52 = F.col("sales_lag_52wk").isNotNull()
    return test.agg(
        S.round_half_away(metrics.wmae("weekly_sales", "sales_lag_1wk", "is_holiday"), 4)
        .alias("wmae_lag1"),
        S.round_half_away(F.try_divide(
            F.sum(F.when(has52, S.holiday_weight("is_holiday")
                         * F.abs(F.col("weekly_sales") - F.col("sales_lag_52wk")))),
            F.sum(F.when(has52, S.holiday_weight("is_holiday")))), 4).alias("wmae_lag52"))


@query("prj_clip", W("select store_id, ds, greatest(yhat, 0.0) as yhat from seasonal_frame "
                     "where kind = 'future'", "seasonal_frame"))
def q_prj_clip(spark, sf):
    return _frame(spark, sf).where(F.col("kind") == "future").select(
        "store_id", "ds", S.clip_at_zero("yhat").alias("yhat"))


@query("prj_band", W("select store_id, ds, yhat * 0.9 as yhat_lower, yhat * 1.1 as yhat_upper "
                     "from seasonal_frame where kind = 'future'", "seasonal_frame"))
def q_prj_band(spark, sf):
    return _frame(spark, sf).where(F.col("kind") == "future").select(
        "store_id", "ds", (F.col("yhat") * F.lit(0.9)).alias("yhat_lower"),
        (F.col("yhat") * F.lit(1.1)).alias("yhat_upper"))


# ---- drift
@query("ml_psi_numeric", W("select * from psi_numeric", "psi_numeric"))
def q_ml_psi_numeric(spark, sf):
    return drift.psi_numeric(_split(spark, sf))


@query("ml_psi_sketch")
def q_ml_psi_sketch(spark, sf):
    """``ml_psi_numeric`` from stored sketches, one per feature and week: the
    sketches of the baseline and of each recent week are runs of their own."""
    path = scratch_path(spark, "drift_sketches")
    split = _split(spark, sf)
    for name, part in (("baseline", ~F.col("is_recent")), ("recent", F.col("is_recent"))):
        committed.write(drift_sketch.sketch_periods(split.where(part)), f"{path}/{name}", name)
    base, recent = (committed.read(spark, f"{path}/{n}", drift_sketch.SKETCH_STRUCT) for n in ("baseline", "recent"))
    return drift_sketch.psi_numeric(base, recent)


@query("ml_psi_categorical", W("select * from psi_categorical", "psi_categorical"))
def q_ml_psi_categorical(spark, sf):
    return drift.psi_categorical(_split(spark, sf))


@query("ml_drift_report", W("select * from drift_features", "drift_features"))
def q_ml_drift_report(spark, sf):
    return drift.drift_features(_split(spark, sf))


@query("cse_drift_tier", W("select feature, tier from drift_features", "drift_features"))
def q_cse_drift_tier(spark, sf):
    return drift.drift_features(_split(spark, sf)).select("feature", "tier")


@query("agg_drift_summary", W(
    "select max(cutoff_date) as cutoff_date, 12 as recent_weeks, "
    "count(*) filter (where not is_recent) as baseline_rows, "
    "count(*) filter (where is_recent) as recent_rows, "
    "(select count(*) from drift_features where tier = 'HIGH') as high, "
    "(select count(*) from drift_features where tier = 'MEDIUM') as medium, "
    "(select count(*) from drift_features where tier = 'LOW') as low from drift_split",
    "drift_split", "drift_features"))
def q_agg_drift_summary(spark, sf):
    split = _split(spark, sf)
    return drift.drift_summary(split, drift.drift_features(split))


@query("agg_value_counts", W(
    "select feature, value, count(*) filter (where not is_recent) / sum(count(*) filter "
    "(where not is_recent)) over (partition by feature) as base_share from cat_long "
    "group by feature, value having count(*) filter (where not is_recent) > 0", "cat_long"))
def q_agg_value_counts(spark, sf):
    lv = drift.long_values(_split(spark, sf), drift.CATEGORICAL_FEATURES, "string")
    base = lv.where(~F.col("is_recent")).groupBy("feature", "value").count()
    tot = base.groupBy("feature").agg(F.sum("count").alias("n"))
    return base.join(F.broadcast(tot), "feature").select(
        "feature", "value", (F.col("count") / F.col("n")).alias("base_share"))


@query("set_category_union", W(
    "select feature, value, count(*) filter (where not is_recent) as baseline_count, "
    "count(*) filter (where is_recent) as recent_count from cat_long group by 1, 2", "cat_long"))
def q_set_category_union(spark, sf):
    lv = drift.long_values(_split(spark, sf), drift.CATEGORICAL_FEATURES, "string")
    return lv.groupBy("feature", "value").agg(
        F.count_if(~F.col("is_recent")).alias("baseline_count"),
        F.count_if(F.col("is_recent")).alias("recent_count"))


# ---- global boosted trees (Spark ML): one fit per application and input,
# shared by every query that reads the model
def boosted(spark, sf) -> forecast.BoostedTrees:
    return kept_once(spark, "boosted_trees", sf, lambda: forecast.gbt_backtest(_positive(spark, sf)))


@query("ml_global_gbt")
def q_ml_global_gbt(spark, sf):
    return forecast.gbt_score(boosted(spark, sf))


@query("ml_backtest_output")
def q_ml_backtest_output(spark, sf):
    return boosted(spark, sf).backtest.select(*forecast.FORECAST_COLUMNS)


@query("ml_backtest_keys", W(
    f"select store_id, dept_id, sale_date as ds, is_holiday, weekly_sales as actual, 'gbt' as model "
    "from drift_split where is_recent and sales_lag_1wk is not null and sales_lag_4wk is not null "
    "and rolling_4wk_avg is not null", "drift_split"))
def q_ml_backtest_keys(spark, sf):
    """What SQL can check of the tree rows: which they are and their actuals."""
    return boosted(spark, sf).backtest.select("store_id", "dept_id", "ds", "is_holiday", "actual", "model")


@query("ml_tree_nodes")
def q_ml_tree_nodes(spark, sf):
    """The fitted trees, node by node."""
    return boosted(spark, sf).nodes


@query("ml_feature_importance")
def q_ml_feature_importance(spark, sf):
    return boosted(spark, sf).importances


@query("srt_importance")
def q_srt_importance(spark, sf):
    return forecast.top_importances(boosted(spark, sf).importances, 10)
