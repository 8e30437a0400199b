"""Catalog entries: forecast table, endpoints and dashboard roll-ups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from sparkretail.operators import forecast, forecast_table, serving
from sparkretail.plans import builds
from sparkretail.plans import oracle as O
from sparkretail.plans.catalog import query
from sparkretail.session import kept_once, materialize, scratch_path

W = O.with_ctes

# Injected run stamps (two runs, the second is the latest) and the endpoint
# parameters used by the catalog queries.
RUNS = (("a1b2c3d4", datetime(2024, 1, 1, 6, 0, 0)), ("e5f6a7b8", datetime(2024, 1, 8, 6, 0, 0)))
STORE = 1
MODEL_ARG = "SEASONAL"

O.register("seasonal_fc", """
select store_id, cast(-1 as bigint) as dept_id, ds, yhat, yhat_lower, yhat_upper,
       'seasonal' as model
from seasonal_frame where kind = 'future'
""", ("seasonal_frame",))

O.register("lag52_fc", """
select store_id, dept_id, sale_date as ds, greatest(sales_lag_52wk, 0.0) as yhat,
       greatest(sales_lag_52wk, 0.0) * 0.9 as yhat_lower, greatest(sales_lag_52wk, 0.0) * 1.1 as yhat_upper,
       'lag52' as model
from drift_split where is_recent and sales_lag_52wk is not null
""", ("drift_split",))
O.register("model_fc", "select * from seasonal_fc union all by name select * from lag52_fc",
           ("seasonal_fc", "lag52_fc"))

_RUN_SQL = " union all ".join(
    f"select '{rid}' as run_id, timestamp '{ts:%Y-%m-%d %H:%M:%S}' as run_ts, store_id, dept_id, ds, "
    f"{O.r('yhat')} as yhat, {O.r('yhat_lower')} as yhat_lower, {O.r('yhat_upper')} as yhat_upper, "
    "model from model_fc" for rid, ts in RUNS)
O.register("forecast_log", _RUN_SQL, ("model_fc",))
O.register("latest_runs", """
select * from forecast_log f
where run_ts = (select max(run_ts) from forecast_log g
                where g.store_id = f.store_id and lower(g.model) = lower(f.model))
""", ("forecast_log",))
O.register("risk_tiers", """
select store_id, count(*) filter (where demand_risk_tier = 'HIGH') as high,
       count(*) filter (where demand_risk_tier = 'MEDIUM') as medium,
       count(*) filter (where demand_risk_tier = 'LOW') as low
from mart_inventory_risk group by store_id
""", ("mart_inventory_risk",))


def seasonal_output(spark, sf):
    frame = forecast.seasonal_frame(builds.positive_demand(spark, sf))
    return forecast_table.with_default_dept(forecast.seasonal_forecast(frame))


def model_outputs(spark, sf):
    """The outputs of both SQL-checkable models, one table."""
    return forecast_table.union_models(
        [seasonal_output(spark, sf), forecast.lag_baseline(builds.positive_demand(spark, sf))])


def forecast_log(spark, sf):
    """The appended forecast table: both models, every run, written once per
    application and input; all readers read the table."""
    def write() -> str:
        path = scratch_path(spark, "mart_demand_forecast")
        out = materialize(model_outputs(spark, sf), "model_outputs")
        for rid, ts in RUNS:
            forecast_table.append_run(forecast_table.stamp(out, rid, ts), path, rid)
        return path

    return forecast_table.read_table(spark, kept_once(spark, "forecast_log", sf, write))


def _fc_cols(prefix=""):
    return (f"select store_id, dept_id, ds as forecast_date, yhat as forecast_sales, "
            f"yhat_lower as forecast_lower, yhat_upper as forecast_upper, model, run_id, run_ts "
            f"from {prefix}")


@query("mart_demand_forecast", W("select * from forecast_log", "forecast_log"))
def q_mart_demand_forecast(spark, sf):
    return forecast_log(spark, sf)


@query("prj_default_column", W("select * from seasonal_fc", "seasonal_fc"))
def q_prj_default_column(spark, sf):
    return seasonal_output(spark, sf).select(*forecast.FORECAST_COLUMNS)


@query("prj_run_stamp", W("select distinct run_id, run_ts from forecast_log", "forecast_log"))
def q_prj_run_stamp(spark, sf):
    return forecast_log(spark, sf).select("run_id", "run_ts").distinct()


@query("prj_cast_round_output", W(
    "select store_id, dept_id, ds, yhat, yhat_lower, yhat_upper from forecast_log "
    f"where run_id = '{RUNS[0][0]}'", "forecast_log"))
def q_prj_cast_round_output(spark, sf):
    return forecast_table.stamp(model_outputs(spark, sf), *RUNS[0]).select(
        "store_id", "dept_id", "ds", "yhat", "yhat_lower", "yhat_upper")


@query("jn_latest_run", W("select * from latest_runs", "latest_runs"))
def q_jn_latest_run(spark, sf):
    return serving.latest_runs(forecast_log(spark, sf))


@query("fn_lower_ci", W(f"select * from forecast_log where lower(model) = lower('{MODEL_ARG}')",
                        "forecast_log"))
def q_fn_lower_ci(spark, sf):
    return forecast_log(spark, sf).where(serving.model_is(MODEL_ARG))


@query("serve_forecast", W(
    _fc_cols(f"forecast_log where store_id = {STORE} and lower(model) = lower('{MODEL_ARG}') "
             f"and run_ts = (select max(run_ts) from forecast_log where store_id = {STORE} "
             f"and lower(model) = lower('{MODEL_ARG}')) order by forecast_date, dept_id "
             "limit 1200"), "forecast_log"))
def q_serve_forecast(spark, sf):
    return serving.serve_forecast(forecast_log(spark, sf), STORE, MODEL_ARG, weeks=12, bound="rows")


@query("srt_limit_forecast", W(
    _fc_cols(f"forecast_log where store_id = {STORE} and lower(model) = lower('{MODEL_ARG}') "
             f"and run_ts = (select max(run_ts) from forecast_log where store_id = {STORE} "
             f"and lower(model) = lower('{MODEL_ARG}')) order by forecast_date, dept_id "
             "limit 100"), "forecast_log"))
def q_srt_limit_forecast(spark, sf):
    return serving.serve_forecast(forecast_log(spark, sf), STORE, MODEL_ARG, weeks=1, bound="rows")


@query("serve_forecast_weeks", W(
    _fc_cols("latest_runs where store_id = 2 and model = 'lag52' and ds in (select distinct ds from latest_runs "
             "where store_id = 2 and model = 'lag52' order by ds limit 4)"), "latest_runs"))
def q_serve_forecast_weeks(spark, sf):
    return serving.serve_forecast(forecast_log(spark, sf), 2, "lag52", weeks=4)


@query("serve_stores", W(
    "select store_id, (select count(distinct store_id) from forecast_log) as store_count "
    "from (select distinct store_id from forecast_log)", "forecast_log"))
def q_serve_stores(spark, sf):
    return serving.serve_stores(forecast_log(spark, sf))


@query("srt_stores", W("select distinct store_id from forecast_log order by store_id",
                       "forecast_log"))
def q_srt_stores(spark, sf):
    return forecast_log(spark, sf).select("store_id").distinct().orderBy("store_id")


@query("set_distinct", W("select distinct store_id from forecast_log", "forecast_log"))
def q_set_distinct(spark, sf):
    return forecast_log(spark, sf).select("store_id").distinct()


@query("serve_risk", W(
    f"select store_id, dept_id, store_type, avg_weekly_sales, stddev_weekly_sales, "
    f"coeff_of_variation, demand_risk_tier from mart_inventory_risk where store_id = {STORE}",
    "mart_inventory_risk"))
def q_serve_risk(spark, sf):
    return serving.serve_risk(builds.inventory_risk(spark, sf), STORE)


@query("srt_risk_desc", W("select * from mart_inventory_risk order by coeff_of_variation desc "
                          "nulls last", "mart_inventory_risk"))
def q_srt_risk_desc(spark, sf):
    return serving.risk_ordered(builds.inventory_risk(spark, sf))


@query("agg_tier_counts", W("select * from risk_tiers", "risk_tiers", grain="quarter"))
def q_agg_tier_counts(spark, sf):
    return serving.tier_counts(builds.inventory_risk(spark, sf, grain="quarter"))


def _pct(c):
    return (f"coalesce({O.r(f'({c} * 100.0) / nullif(high + medium + low, 0)', 0)}, 0.0)")


@query("agg_tier_share", W(
    f"select store_id, high, medium, low, {_pct('high')} as pct_high, "
    f"{_pct('medium')} as pct_medium, {_pct('low')} as pct_low from risk_tiers",
    "risk_tiers", grain="quarter"))
def q_agg_tier_share(spark, sf):
    return serving.tier_shares(serving.tier_counts(builds.inventory_risk(spark, sf, "quarter")))


@query("srt_top10_departments", W(
    "select * from (select store_id, row_number() over (partition by store_id order by "
    "coeff_of_variation desc nulls last, dept_id) as rank, dept_id, avg_weekly_sales, "
    "coeff_of_variation, demand_risk_tier from mart_inventory_risk) where rank <= 10",
    "mart_inventory_risk", grain="quarter"))
def q_srt_top10_departments(spark, sf):
    return serving.top_departments(builds.inventory_risk(spark, sf, grain="quarter"), 10)


@query("agg_forecast_by_date", W(
    "select store_id, model, ds, " + ", ".join(
        f"{O.r(O.from_cents('sum(' + O.cents(c) + ')'), 0)} as {c}" for c in ("yhat", "yhat_lower", "yhat_upper"))
    + " from latest_runs group by store_id, model, ds", "latest_runs"))
def q_agg_forecast_by_date(spark, sf):
    return serving.forecast_by_date(serving.latest_runs(forecast_log(spark, sf)))


def actuals(spark, sf):
    """Sales per store, department and date; store totals as department -1."""
    from sparkretail.operators.metrics import store_week
    sales = builds.positive_demand(spark, sf)
    return (store_week(sales)
            .select("store_id", F.lit(-1).cast("bigint").alias("dept_id"), "ds", F.col("y").alias("actual"))
            .union(sales.select("store_id", "dept_id", F.col("sale_date").alias("ds"),
                                F.col("weekly_sales").alias("actual"))))


O.register("dashboard_lines", f"""
select store_id, model, 'date' as kind, row_number() over (partition by store_id, model order by ds) as position, ds,
       {", ".join(f"{O.r(O.from_cents('sum(' + O.cents(c) + ')'), 0)} as {c}" for c in ('yhat', 'yhat_lower', 'yhat_upper', 'actual'))},
       null as dept_id, null as avg_weekly_sales, null as coeff_of_variation, null as demand_risk_tier
from (select l.*, a.y as actual from latest_runs l left join (
          select store_id, -1 as dept_id, ds, y from store_week union all
          select store_id, dept_id, sale_date, sum(weekly_sales) from positive_demand group by all) a
      on l.store_id = a.store_id and l.dept_id = a.dept_id and l.ds = a.ds)
group by store_id, model, ds
union all
select p.store_id, p.model, 'department', d.position, null, null, null, null, null,
       d.dept_id, d.avg_weekly_sales, d.coeff_of_variation, d.demand_risk_tier
from (select distinct store_id, model from latest_runs) p
join (select *, row_number() over (partition by store_id order by coeff_of_variation desc nulls last, dept_id) as position
      from mart_inventory_risk) d on p.store_id = d.store_id and d.position <= 10
""", ("latest_runs", "store_week", "mart_inventory_risk"))


@query("report_dashboard", W(
    f"""select f.*, t.high, t.medium, t.low, {_pct('t.high')} as pct_high,
               {_pct('t.medium')} as pct_medium, {_pct('t.low')} as pct_low,
               l.kind, l.position, l.ds, l.yhat, l.yhat_lower, l.yhat_upper, l.actual,
               l.dept_id, l.avg_weekly_sales, l.coeff_of_variation, l.demand_risk_tier
        from (select store_id, model, count(*) as forecast_rows,
                     count(distinct ds) as forecast_dates, min(ds) as first_date,
                     max(ds) as last_date, max(run_id) as run_id
              from latest_runs group by store_id, model) f
        left join risk_tiers t on f.store_id = t.store_id
        join dashboard_lines l on f.store_id is not distinct from l.store_id
                              and f.model is not distinct from l.model""".replace(
        "high + medium + low", "t.high + t.medium + t.low"),
    "latest_runs", "risk_tiers", "dashboard_lines"))
def q_report_dashboard(spark, sf):
    return serving.dashboard(forecast_log(spark, sf), builds.inventory_risk(spark, sf), actuals(spark, sf))


@query("report_forecast_vs_actual", W(
    "select l.store_id, l.dept_id, l.ds, l.model, l.yhat, a.y as actual from latest_runs l "
    "left join (select store_id, -1 as dept_id, ds, y from store_week union all "
    "select store_id, dept_id, sale_date, weekly_sales from positive_demand) a "
    "on l.store_id = a.store_id and l.dept_id = a.dept_id and l.ds = a.ds",
    "latest_runs", "store_week"))
def q_report_forecast_vs_actual(spark, sf):
    return serving.forecast_vs_actual(forecast_log(spark, sf), actuals(spark, sf))


@query("set_union_models", W("select * from model_fc", "model_fc"))
def q_set_union_models(spark, sf):
    return model_outputs(spark, sf).select(*forecast.FORECAST_COLUMNS)


@query("mart_demand_forecast_trees")
def q_mart_demand_forecast_trees(spark, sf):
    """The forecast table with the seasonal and the tree model, appended and
    read back."""
    from sparkretail.plans.q_ml import boosted
    out = forecast_table.union_models(
        [seasonal_output(spark, sf), boosted(spark, sf).backtest.select(*forecast.FORECAST_COLUMNS)])
    path = scratch_path(spark, "mart_demand_forecast_trees")
    forecast_table.append_run(forecast_table.stamp(out, *RUNS[0]), path, RUNS[0][0])
    return forecast_table.read_table(spark, path)
