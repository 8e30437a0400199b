"""DuckDB oracle CTEs for the metrics, forecasting and drift queries."""

from __future__ import annotations

import math

from sparkretail.operators import season_trend
from sparkretail.operators.drift import CATEGORICAL_FEATURES as CATEGORICAL
from sparkretail.operators.drift import NUMERIC_FEATURES as NUMERIC
from sparkretail.plans.oracle import cents, from_cents, r, register, week_sunday

POSITIVE = "select * from mart_demand_features where weekly_sales > 0"

SPLIT = """
select *, cast((select max(sale_date) from positive_demand) - 84 as date) as cutoff_date,
       sale_date > cast((select max(sale_date) from positive_demand) - 84 as date) as is_recent
from positive_demand
"""

def _long(features, typ):
    casts = ", ".join(f"cast({c} as {typ}) as {c}" for c in features)
    return (f"select feature, value, is_recent from (select is_recent, {casts} from drift_split) "
            f"unpivot (value for feature in ({', '.join(features)}))")


NUM_LONG = _long(NUMERIC, "double")
CAT_LONG = _long(CATEGORICAL, "varchar")

NUM_EDGES = """
with t as (select feature, n, i, ((n - 1) * i) // 10 as lo_rank, ((n - 1) * i) % 10 as rem
           from (select distinct feature, n from num_ranked) cross join range(0, 11) q(i)),
tg as (select feature, i, rem, lo_rank as rank, 'lo' as side from t
       union all
       select feature, i, rem, lo_rank + case when rem > 0 then 1 else 0 end as rank, 'hi' as side
       from t),
picked as (select tg.feature, tg.i, tg.rem, tg.side, r.value
           from tg join num_ranked r on r.feature = tg.feature and r.rk = tg.rank),
edge as (select feature, i,
                max(case when side = 'lo' then value end)
                + (max(case when side = 'hi' then value end) - max(case when side = 'lo' then value end))
                  * (max(rem) / 10.0) as edge
         from picked group by feature, i)
select feature, list_sort(list_distinct(list(edge))) as edges from edge group by feature
"""

NUM_RANKED = """
select feature, value, row_number() over (partition by feature order by value) - 1 as rk,
       count(*) over (partition by feature) as n
from num_long where not is_recent
"""

NUM_COUNTS = """
select feature, count(*) filter (where not is_recent) as n_base,
       count(*) filter (where is_recent) as n_recent
from num_long group by feature
having count(*) filter (where not is_recent) > 0 and count(*) filter (where is_recent) > 0
"""

PSI_NUMERIC = f"""
select e.feature,
       {r("coalesce(p.raw, 0.0)", 4)} as psi
from num_edges e join num_counts c on e.feature = c.feature
left join (
  select b.feature,
         sum((cs - bs) * ln(cs / bs)) as raw
  from (select a.feature,
               case when coalesce(x.c, 0) > 0 then coalesce(x.c, 0) / a.n_recent else 1e-6 end as cs,
               case when coalesce(x.b, 0) > 0 then coalesce(x.b, 0) / a.n_base else 1e-6 end as bs
        from (select e.feature, c.n_base, c.n_recent, unnest(range(0, len(e.edges) - 1)) as bin
              from num_edges e join num_counts c on e.feature = c.feature
              where len(e.edges) >= 3) a
        left join (select l.feature,
                          case when l.value = e.edges[len(e.edges)] then len(e.edges) - 2
                               else len(list_filter(e.edges, lambda x: x <= l.value)) - 1 end as bin,
                          count(*) filter (where not l.is_recent) as b,
                          count(*) filter (where l.is_recent) as c
                   from num_long l join num_edges e on l.feature = e.feature
                   where l.value >= e.edges[1] and l.value <= e.edges[len(e.edges)]
                   group by 1, 2) x
          on a.feature = x.feature and a.bin = x.bin) b
  group by b.feature) p on e.feature = p.feature
"""

PSI_CATEGORICAL = f"""
select feature, {r("sum((cs - bs) * ln(cs / bs))", 4)} as psi
from (select p.feature,
             case when c > 0 then c / n_recent else 1e-6 end as cs,
             case when b > 0 then b / n_base else 1e-6 end as bs
      from (select feature, value, count(*) filter (where not is_recent) as b,
                   count(*) filter (where is_recent) as c
            from cat_long group by 1, 2) p
      join (select feature, count(*) filter (where not is_recent) as n_base,
                   count(*) filter (where is_recent) as n_recent
            from cat_long group by 1) t on p.feature = t.feature)
group by feature
"""

DRIFT_FEATURES = """
select feature, psi,
       case when psi < 0.1 then 'LOW' when psi < 0.2 then 'MEDIUM' else 'HIGH' end as tier, type
from (select feature, psi, 'numeric' as type from psi_numeric
      union all select feature, psi, 'categorical' as type from psi_categorical)
"""

# ---------------------------------------------------------------- seasonal
STORE_WEEK = """
select store_id, sale_date as ds, cast(sum(cast(weekly_sales as decimal(18,2))) as double) as y,
       max(is_holiday) as is_holiday
from positive_demand group by 1, 2
"""

HOLDOUT = """
select * from (select *, row_number() over (partition by store_id order by ds) as pos,
                      count(*) over (partition by store_id) as n_rows
               from store_week) where n_rows >= 52
"""

def store_rows(held: int, anchor: str = "own") -> str:
    """CTEs ``hist``, ``fut``, ``cal``, ``f0``: history with the last ``held``
    rows of each store kept out, twelve future rows, holidays."""
    first = "ds + 7" if anchor == "own" else "ds + cast(7 - dayofweek(ds) as integer)"
    return f"""
hist as (
  select store_id, ds, y, is_holiday,
         case when pos > n_rows - {held} then 'holdout' else 'train' end as kind,
         case when pos > n_rows - {held} then pos - (n_rows - {held}) end as step
  from holdout_rows),
fut as (
  select store_id, cast({first} + cast(7 * k as integer) as date) as ds, cast(null as double) as y,
         0 as is_holiday, 'future' as kind, cast(k + 1 as bigint) as step
  from holdout_rows cross join range(0, 12) q(k) where pos = n_rows - {held}),
cal as (
  select distinct store_id, d as ds
  from (select store_id, ds as d from hist where is_holiday = 1
        union all select store_id, cast(ds + 1 as date) from hist where is_holiday = 1)),
f0 as (
  select u.*, c.store_id is not null as in_calendar
  from (select * from hist union all select * from fut) u
  left join cal c on u.store_id = c.store_id and u.ds = c.ds)"""


def seasonal(held: int, anchor: str = "own") -> str:
    return f"""
with {store_rows(held, anchor)},
f1 as (
  select *, case when {week_sunday('ds')} in (0, 53) then 52 else {week_sunday('ds')} end as woy,
         datediff('day', min(ds) over (partition by store_id), ds) / 7.0 as t,
         case when kind = 'train' then y end as y_train
  from f0),
f2 as (
  select *, regr_intercept(y_train, t) over (partition by store_id) as b0,
         regr_slope(y_train, t) over (partition by store_id) as b1 from f1),
f3 as (select *, b0 + b1 * t as trend, y_train / nullif(b0 + b1 * t, 0) as ratio from f2),
f4 as (select *, coalesce(avg(case when not in_calendar then ratio end)
                          over (partition by store_id, woy), 1.0) as season from f3),
f5 as (select *, coalesce(avg(case when in_calendar then ratio / nullif(season, 0) end)
                          over (partition by store_id), 1.0) as holiday_factor from f4),
f6 as (select *, trend * season * case when in_calendar then holiday_factor else 1.0 end as yhat
       from f5),
f7 as (select *, coalesce(stddev_samp(case when kind = 'train' then y - yhat end)
                          over (partition by store_id), 0.0) as resid_sd from f6)
select store_id, ds, kind, step, y, is_holiday, {r('yhat')} as yhat,
       {r('yhat - 1.2816 * resid_sd')} as yhat_lower, {r('yhat + 1.2816 * resid_sd')} as yhat_upper
from f7
"""

def pairs(frame: str) -> str:
    """Holdout rows with the future row of their date, or else of their step."""
    return f"""
with hold as (select store_id, step, ds, y as actual, is_holiday from {frame}
              where kind = 'holdout'),
fut as (select store_id, step as fstep, ds as fds, yhat as predicted from {frame}
        where kind = 'future'),
bydate as (select h.*, f.predicted from hold h join fut f on h.store_id = f.store_id and h.ds = f.fds),
full_match as (select b.store_id from (select store_id, count(*) as c from bydate group by 1) b
               join (select store_id, count(*) as n from hold group by 1) h
                 on b.store_id = h.store_id where b.c = h.n)
select store_id, ds, actual, is_holiday, predicted from bydate
where store_id in (select store_id from full_match)
union all
select h.store_id, h.ds, h.actual, h.is_holiday, f.predicted
from hold h join fut f on h.store_id = f.store_id and h.step = f.fstep
where h.store_id not in (select store_id from full_match)
"""

# ------------------------------------------- change points, smooth season
def _bend_columns() -> list[tuple[str, str]]:
    step = int(season_trend.CHANGEPOINT_RANGE * season_trend.MICRO / season_trend.CHANGEPOINTS)
    cols = [("one", "1000000"), ("t", "t")]
    cols += [(f"bend{j}", f"greatest(t - {step * j}, 0)") for j in range(1, season_trend.CHANGEPOINTS + 1)]
    for n in range(1, season_trend.FOURIER_ORDER + 1):
        angle = f"{2 * math.pi * n / season_trend.YEAR_DAYS!r} * epoch_days"
        cols += [(f"{f}{n}", f"cast(floor({f}({angle}) * 1000000.0 + 0.5) as bigint)") for f in ("sin", "cos")]
    return [*cols, ("holiday", "case when in_calendar then 1000000 else 0 end")]


def bend_design(held: int, anchor: str = "own") -> str:
    cols = ", ".join(f"cast({e} as bigint) as {c}" for c, e in _bend_columns())
    return f"""
with {store_rows(held, anchor)},
d1 as (
  select *, datediff('day', min(ds) over (partition by store_id), ds) as days,
         datediff('day', min(ds) over (partition by store_id),
                  max(case when kind = 'train' then ds end) over (partition by store_id)) as span,
         datediff('day', date '1970-01-01', ds) as epoch_days
  from f0),
d2 as (select *, (2 * days * 1000000 + span) // (2 * span) as t from d1)
select store_id, ds, kind, step, y, is_holiday, {cols},
       case when kind = 'train' then cast(floor(ln(y) * 1000000.0 + 0.5) as bigint) end as log_y
from d2
"""


#: one row per (store, i, j): sums of products of design columns, j = p the target
BEND_GRAM = f"""
with x as (select store_id, [{", ".join(c for c, _ in _bend_columns())}, log_y] as v
           from bend_design where kind = 'train'),
p as (select x.store_id, i, j, x.v[i + 1] as a, x.v[j + 1] as b
      from x cross join range(0, {len(_bend_columns())}) q(i) cross join range(0, {len(_bend_columns()) + 1}) r(j))
select store_id, cast(i as integer) as i, cast(j as integer) as j, cast(sum(a * b) as bigint) as product
from p group by 1, 2, 3
"""

BEND_NOISE = f"""
select store_id, greatest(sum(d * d) / (6 * count(d)) / 1e12, {season_trend.Priors().least_noise ** 2!r}::double) as noise
from (select store_id, log_y - 2 * lag(log_y, 1) over w + lag(log_y, 2) over w as d
      from bend_design where kind = 'train' window w as (partition by store_id order by ds)) group by store_id
"""

#: elimination column by column, in rows of lists
BEND_WEIGHTS = f"""
with recursive start as (
  select g.store_id, i, list(product / 1e12 + case when i = j then pen[i + 1] * noise else 0.0 end order by j) as r
  from bend_gram g join bend_noise n on g.store_id = n.store_id,
       (select {season_trend.Priors().penalties()!r}::double[] as pen) group by g.store_id, i),
el as (
  select store_id, 0 as k, list(r order by i) as m from start group by store_id
  union all
  select store_id, k + 1, list_transform(m, lambda r, i: case when i = k + 1 then r else
         list_transform(r, lambda a, j: a - r[k + 1] / m[k + 1][k + 1] * m[k + 1][j]) end)
  from el where k < {len(_bend_columns())})
select store_id, list_transform(m, lambda r, i: r[{len(_bend_columns()) + 1}] / r[i]) as w
from el where k = {len(_bend_columns())}
"""


def bend_frame(design: str) -> str:
    dot = " + ".join(f"w[{i + 1}] * {c}" for i, (c, _) in enumerate(_bend_columns()))
    return (f"select d.store_id, ds, kind, step, y, is_holiday, {r(f'exp(({dot}) / 1000000.0)')} as yhat "
            f"from {design} d join bend_weights w on d.store_id = w.store_id")


STORE_SCORES = f"""
select store_id, {r(from_cents(f"sum(w * abs({cents('actual')} - {cents('predicted')}))") + ' / sum(w)')} as wmae
from (select *, case when is_holiday = 1 then 5 else 1 end as w from holdout_pairs)
group by store_id
"""

for _name, _body, _deps in [
    ("positive_demand", POSITIVE, ("mart_demand_features",)),
    ("drift_split", SPLIT, ("positive_demand",)),
    ("num_long", NUM_LONG, ("drift_split",)),
    ("cat_long", CAT_LONG, ("drift_split",)),
    ("num_ranked", NUM_RANKED, ("num_long",)),
    ("num_edges", NUM_EDGES, ("num_ranked",)),
    ("num_counts", NUM_COUNTS, ("num_long",)),
    ("psi_numeric", PSI_NUMERIC, ("num_edges", "num_counts")),
    ("psi_categorical", PSI_CATEGORICAL, ("cat_long",)),
    ("drift_features", DRIFT_FEATURES, ("psi_numeric", "psi_categorical")),
    ("store_week", STORE_WEEK, ("positive_demand",)),
    ("holdout_rows", HOLDOUT, ("store_week",)),
    ("seasonal_frame", seasonal(12), ("holdout_rows",)),
    ("seasonal_ahead", seasonal(0), ("holdout_rows",)),
    ("holdout_pairs", pairs("seasonal_frame"), ("seasonal_frame",)),
    ("seasonal_sunday", seasonal(12, "sunday"), ("holdout_rows",)),
    ("sunday_pairs", pairs("seasonal_sunday"), ("seasonal_sunday",)),
    ("bend_design", bend_design(12), ("holdout_rows",)),
    ("bend_gram", BEND_GRAM, ("bend_design",)),
    ("bend_noise", BEND_NOISE, ("bend_design",)),
    ("bend_weights", BEND_WEIGHTS, ("bend_gram", "bend_noise")),
    ("bend_frame", bend_frame("bend_design"), ("bend_design", "bend_weights")),
    ("store_scores", STORE_SCORES, ("holdout_pairs",)),
]:
    register(_name, _body, _deps)
