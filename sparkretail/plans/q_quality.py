"""Catalog entries: load-time checks and declared column tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from sparkretail.operators import marts, quality
from sparkretail.plans import builds
from sparkretail.plans import oracle as O
from sparkretail.plans.catalog import query
from sparkretail.session import scratch_path
from sparkretail.sources import committed, proxy

W = O.with_ctes

# (check list, oracle source CTE) per raw table
_TABLES = [
    ("weekly_train", quality.WEEKLY_TRAIN_CHECKS, "raw_sales"),
    ("weekly_stores", quality.WEEKLY_STORES_CHECKS, "raw_stores"),
    ("daily_train", quality.DAILY_TRAIN_CHECKS, "raw_daily"),
    ("daily_stores", quality.DAILY_STORES_CHECKS, "raw_daily_stores"),
    ("transactions", quality.TRANSACTION_CHECKS, "raw_transactions"),
]


def _raw(spark, sf, name):
    return {"weekly_train": lambda: proxy.raw_weekly_train(spark, sf),
            "weekly_stores": lambda: proxy.raw_weekly_stores(spark, sf),
            "daily_train": lambda: proxy.raw_daily_train(spark, sf),
            "daily_stores": lambda: proxy.raw_daily_stores(spark, sf),
            "transactions": lambda: proxy.raw_transactions(spark, sf)}[name]()


def _metric_sql(c: quality.Check) -> str:
    return {"rows": "count(*)", "nulls": f"count(*) filter (where {c.column} is null)",
            "distinct": f"count(distinct {c.column})"}[c.metric]


def _passed_sql(c: quality.Check, v: str) -> str:
    return {"min": f"{v} >= {c.bound}", "max": f"{v} <= {c.bound}",
            "exact": f"{v} = {c.bound}"}[c.kind]


def _checks_sql(metrics: set[str] | None) -> tuple[str, list[str]]:
    parts, ctes = [], []
    for _, checks, cte in _TABLES:
        for i, c in enumerate(checks):
            if metrics and (c.metric, c.kind) not in metrics:
                continue
            v = f"cast({_metric_sql(c)} as bigint)"
            parts.append(f"select '{c.name}' as check_name, {v} as observed, '{c.kind}' as "
                         f"bound_kind, cast({c.bound} as bigint) as bound, "
                         f"{_passed_sql(c, v)} as passed, {i} as ord from {cte}")
            ctes.append(cte)
    return " union all ".join(parts), sorted(set(ctes))


def _checks_df(spark, sf, metrics: set[str] | None):
    frames = []
    for name, checks, _ in _TABLES:
        sel = [(i, c) for i, c in enumerate(checks) if not metrics or (c.metric, c.kind) in metrics]
        if sel:
            frames.append(quality.evaluate(_raw(spark, sf, name), [c for _, c in sel], [i for i, _ in sel]))
    return reduce(lambda a, b: a.unionByName(b), frames)


def _register(key: str, metrics: set[tuple[str, str]] | None):
    sql, ctes = _checks_sql(metrics)

    @query(key, W(sql, *ctes))
    def _q(spark, sf):
        return _checks_df(spark, sf, metrics)

    return _q


_register("dq_evaluate", None)


def _gate_checks(checks):
    """The load gate that the test tables can pass: their own row counts are far
    below the bounds of the declared checks, so the bounds become 1."""
    return tuple(quality.Check(c.name, "min" if c.kind == "exact" else c.kind, min(c.bound, 1), c.metric, c.column) for c in checks)


@query("dq_load_gate", W(" union all ".join(
    f"select '{name}' as source, count(*) as rows from {cte}" for name, _, cte in _TABLES), *[cte for _, _, cte in _TABLES]))
def q_dq_load_gate(spark, sf):
    """Every raw table loaded with its checks observed by the write; the commit,
    and so the rows that readers see, depends on them."""
    out = []
    for name, checks, _ in _TABLES:
        df = _raw(spark, sf, name)
        path = scratch_path(spark, f"load-{name}")
        committed.write(df, path, "load", "overwrite", _gate_checks(checks))
        out.append(committed.read(spark, path, df.schema).agg(F.count(F.lit(1)).alias("rows"))
                   .select(F.lit(name).alias("source"), "rows"))
    return reduce(lambda a, b: a.unionByName(b), out)


_register("dq_min_rows", {("rows", "min")})
_register("dq_max_nulls", {("nulls", "max")})
_register("dq_exact_rows", {("rows", "exact")})
_register("dq_min_distinct", {("distinct", "min")})

# declared column tests: model -> (builder, oracle CTE)
_MODEL_CTE = {
    "stg_walmart_sales": "stg_weekly_sales", "stg_rossmann_sales": "stg_daily_sales",
    "stg_online_retail": "stg_transactions", "mart_weekly_sales": "mart_weekly_sales",
    "mart_store_features": "mart_store_features", "mart_promotion_lift": "mart_promotion_lift",
    "mart_inventory_risk": "mart_inventory_risk", "mart_demand_features": "mart_demand_features"}


def _model_df(spark, sf, model):
    weekly, daily = builds.weekly_table, builds.daily_table
    return {"stg_walmart_sales": lambda: weekly(spark, sf), "stg_rossmann_sales": lambda: daily(spark, sf),
            "stg_online_retail": lambda: builds.transactions_staging(spark, sf),
            "mart_weekly_sales": lambda: marts.mart_weekly_sales(weekly(spark, sf)),
            "mart_store_features": lambda: marts.mart_store_features(weekly(spark, sf)),
            "mart_promotion_lift": lambda: marts.mart_promotion_lift(daily(spark, sf)),
            "mart_inventory_risk": lambda: builds.inventory_risk(spark, sf),
            "mart_demand_features": lambda: builds.demand_table(spark, sf)}[model]()


_NN_SQL = " union all ".join(
    f"select '{m}' as model, '{c}' as column_name, count(*) filter (where {c} is null) as "
    f"failing_rows, 'not_null' as test, count(*) filter (where {c} is null) = 0 as passed "
    f"from {_MODEL_CTE[m]}" for m, cols in quality.NOT_NULL_TESTS.items() for c in cols)


@query("dq_not_null", W(_NN_SQL, *_MODEL_CTE.values()))
def q_dq_not_null(spark, sf):
    frames = [quality.not_null(_model_df(spark, sf, m), m, cols)
              for m, cols in quality.NOT_NULL_TESTS.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


_UQ_SQL = " union all ".join(
    f"select '{m}' as model, '{c}' as column_name, (select count(*) from (select {c} from "
    f"{_MODEL_CTE[m]} group by {c} having count(*) > 1)) as failing_rows, 'unique' as test, "
    f"(select count(*) from (select {c} from {_MODEL_CTE[m]} group by {c} having count(*) > 1))"
    f" = 0 as passed" for m, c in quality.UNIQUE_TESTS.items())


@query("dq_unique", W(_UQ_SQL, *[_MODEL_CTE[m] for m in quality.UNIQUE_TESTS]))
def q_dq_unique(spark, sf):
    frames = [quality.unique(_model_df(spark, sf, m), m, c)
              for m, c in quality.UNIQUE_TESTS.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)
