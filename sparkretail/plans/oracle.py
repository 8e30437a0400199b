"""Independent DuckDB SQL for every query that SQL can express.

The driver registers the test tables as DuckDB views and runs these texts
next to the Spark queries (row count + schema + value hash). The texts are
written from the model definitions, not generated from the Spark plans, and
take another way where there is one: lags and rolling means by a self-join on
row numbers, marks by a long table, conditional means by a grouped pivot,
money in whole cents, plain means for what is not money. Shared pieces are CTE bodies; ``with_ctes`` stitches the ones a query needs.
"""

from __future__ import annotations


def r(expr: str, digits: int = 2) -> str:
    """Round half away from zero, the same formula as ``round_half_away``."""
    s = float(10 ** digits)
    return f"(sign({expr}) * floor(abs({expr}) * {s} + 0.5) / {s})"


def cents(expr: str) -> str:
    """A cents-valued double as a whole number of cents."""
    return f"cast(round({expr} * 100) as bigint)"


def from_cents(total: str) -> str:
    return f"({total} / 100.0::double)"


def week_sunday(expr: str) -> str:
    return f"cast(strftime({expr}, '%U') as integer)"


# ---------------------------------------------------------------- proxies
RAW_SALES = """
select cast(l_suppkey as bigint) as Store,
       cast(case p_type when 'ECONOMY' then 1 when 'LARGE' then 2 when 'MEDIUM' then 3
                        when 'PROMO' then 4 when 'SMALL' then 5 else 6 end as bigint) as Dept,
       cast(date_trunc('{grain}', l_shipdate) as date) as Date,
       cast(sum(cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
                     as decimal(18,2))) as double) as Weekly_Sales,
       weekofyear(cast(date_trunc('{grain}', l_shipdate) as date)) in (6, 36, 47, 52) as IsHoliday
from lineitem join part on l_partkey = p_partkey where l_suppkey in (select s_suppkey from supplier)
group by 1, 2, 3, 5
"""

RAW_STORES = """
select cast(s_suppkey as bigint) as Store,
       case when s_nationkey = 24 then 'D' when s_suppkey % 3 = 0 then 'A'
            when s_suppkey % 3 = 1 then 'B' else 'C' end as Type,
       cast(10000 + 100 * s_suppkey + 1000 * s_nationkey as bigint) as Size
from supplier
"""

RAW_FEATURES = """
select cast(store as varchar) as Store, cast(d as varchar) as Date,
       cast(n as varchar) as Temperature, cast(lo as varchar) as Fuel_Price,
       case when d >= date '1998-01-01' and n1 > 0 then cast(m1 as varchar) else 'NA' end as MarkDown1,
       case when d >= date '1998-01-01' and n2 > 0 then cast(m2 as varchar) else 'NA' end as MarkDown2,
       case when d >= date '1999-01-01' and n3 > 0 then cast(m3 as varchar) else 'NA' end as MarkDown3,
       case when d >= date '1999-01-01' and n4 > 0 then cast(m4 as varchar) else 'NA' end as MarkDown4,
       case when d >= date '2000-01-01' and n5 > 0 then cast(m5 as varchar) else 'NA' end as MarkDown5,
       case when n % 5 = 0 then 'NA' else cast(hi as varchar) end as CPI,
       case when n % 7 = 0 then 'NA' else cast(n as varchar) end as Unemployment,
       case when weekofyear(d) in (6, 36, 47, 52) then 'TRUE' else 'FALSE' end as IsHoliday
from (select o_custkey % (select count(*) from supplier) as store, cast(date_trunc('week', o_orderdate) as date) as d, count(*) as n,
             min(cast(o_totalprice as decimal(14,2))) as lo, max(cast(o_totalprice as decimal(14,2))) as hi,
             sum(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as n1,
             sum(case when o_orderpriority = '2-HIGH' then 1 else 0 end) as n2,
             sum(case when o_orderpriority = '3-MEDIUM' then 1 else 0 end) as n3,
             sum(case when o_orderpriority = '4-NOT SPECIFIED' then 1 else 0 end) as n4,
             sum(case when o_orderpriority = '5-LOW' then 1 else 0 end) as n5,
             sum(case when o_orderpriority = '1-URGENT' then cast(o_totalprice as decimal(14,2)) end) as m1,
             sum(case when o_orderpriority = '2-HIGH' then cast(o_totalprice as decimal(14,2)) end) as m2,
             sum(case when o_orderpriority = '3-MEDIUM' then cast(o_totalprice as decimal(14,2)) end) as m3,
             sum(case when o_orderpriority = '4-NOT SPECIFIED' then cast(o_totalprice as decimal(14,2)) end) as m4,
             sum(case when o_orderpriority = '5-LOW' then cast(o_totalprice as decimal(14,2)) end) as m5
      from orders group by 1, 2) x
"""

RAW_DAILY = """
select cast(o_custkey % (select count(*) from supplier) as bigint) as Store, cast(isodow(o_orderdate) as bigint) as DayOfWeek,
       cast(o_orderdate as date) as Date,
       case when o_custkey % 50 = 0 then 0 else cast(floor(o_totalprice) as bigint) end as Sales,
       cast(o_custkey % 100 as bigint) as Customers,
       cast(case when o_orderstatus = 'P' then 0 else 1 end as bigint) as Open,
       cast(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1 else 0 end as bigint) as Promo,
       case when o_orderkey % 40 = 0 then 'a' else '0' end as StateHoliday,
       cast(case when o_orderkey % 6 = 0 then 1 else 0 end as bigint) as SchoolHoliday
from orders
"""

RAW_DAILY_STORES = """
select cast(s_suppkey as bigint) as Store,
       case s_suppkey % 4 when 0 then 'a' when 1 then 'b' when 2 then 'c' else 'd' end as StoreType,
       case s_suppkey % 3 when 0 then 'a' when 1 then 'b' else 'c' end as Assortment,
       case when s_suppkey % 7 = 0 then 'NA' else cast(110 * (s_suppkey % 25) as varchar) end as CompetitionDistance,
       case when s_suppkey % 5 = 0 then null else cast(1 + s_suppkey % 12 as varchar) end as CompetitionOpenSinceMonth,
       case when s_suppkey % 5 = 0 then null else cast(1990 + s_suppkey % 25 as varchar) end as CompetitionOpenSinceYear,
       cast(s_suppkey % 2 as bigint) as Promo2,
       case when s_suppkey % 2 = 0 then null else cast(1 + 2 * (s_suppkey % 25) as varchar) end as Promo2SinceWeek,
       case when s_suppkey % 2 = 0 then null else cast(1995 + s_suppkey % 5 as varchar) end as Promo2SinceYear,
       case when s_suppkey % 2 = 0 then null else 'Jan,Apr,Jul,Oct' end as PromoInterval
from supplier
"""

RAW_TRANSACTIONS = """
select case when l_returnflag = 'R' then 'C' || cast(l_orderkey as varchar) else cast(l_orderkey as varchar) end as Invoice,
       cast(l_partkey as varchar) as StockCode,
       case when l_linenumber = 7 then null else '  ' || p_name || ' ' end as Description,
       cast((case when l_returnflag = 'R' then -l_quantity else l_quantity end)
            + (case when l_linenumber = 3 then 0.5 else 0.0 end) as double) as Quantity,
       cast(cast(l_shipdate as timestamp) as varchar) as InvoiceDate,
       case when l_quantity = 50 then cast(0 as double) else l_extendedprice end as Price,
       case when o_custkey % 10 = 0 then null else cast(o_custkey as varchar) end as Customer_ID,
       n_name as Country
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
     join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey
"""

RAW_WEEKLY_TEST = """
select Store, Dept, cast(Date + 84 as date) as Date,
       weekofyear(cast(Date + 84 as date)) in (6, 36, 47, 52) as IsHoliday
from raw_sales where Date > (select max(Date) from raw_sales) - 84
"""

RAW_DAILY_TEST = """
select cast(o_orderkey as bigint) as Id, cast(o_custkey % (select count(*) from supplier) as bigint) as Store,
       cast(isodow(o_orderdate) as bigint) as DayOfWeek, cast(cast(o_orderdate as date) + 42 as date) as Date,
       case when o_orderkey % 11 = 0 then null when o_orderstatus = 'P' then 0.0::double else 1.0::double end as Open,
       cast(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1 else 0 end as bigint) as Promo,
       case when o_orderkey % 40 = 0 then 'a' else '0' end as StateHoliday,
       cast(case when o_orderkey % 6 = 0 then 1 else 0 end as bigint) as SchoolHoliday
from orders where cast(o_orderdate as date) > (select max(cast(o_orderdate as date)) from orders) - 42
"""

# ---------------------------------------------------------------- staging
_MEASURES = {"temperature": "Temperature", "fuel_price": "Fuel_Price", "markdown1": "MarkDown1",
             "markdown2": "MarkDown2", "markdown3": "MarkDown3", "markdown4": "MarkDown4",
             "markdown5": "MarkDown5", "cpi": "CPI", "unemployment": "Unemployment"}

# the text measures as a long table, parsed there, spread again per key
FEATURES_TYPED = f"""
select cast(Store as bigint) as store_id, cast(Date as date) as sale_date,
       {", ".join(f"max(try_cast(v as double)) filter (where k = '{raw}') as {name}"
                  for name, raw in _MEASURES.items())},
       bool_or(upper(v) = 'TRUE') filter (where k = 'IsHoliday') as is_holiday_feature
from (unpivot raw_features on {", ".join(_MEASURES.values())}, IsHoliday into name k value v)
group by Store, Date
"""

# sales, features and stores stacked; windows carry the attributes to the sales rows
STG_WEEKLY = f"""
select store_id, dept_id, sale_date, weekly_sales, is_holiday, store_type, store_size,
       {", ".join(_MEASURES)}
from (select * replace ({", ".join(f"max({m}) over (partition by store_id, sale_date) as {m}" for m in _MEASURES)},
                        max(store_type) over (partition by store_id) as store_type,
                        max(store_size) over (partition by store_id) as store_size)
      from (select Store as store_id, Dept as dept_id, Date as sale_date, Weekly_Sales as weekly_sales,
                   IsHoliday as is_holiday, true as sold from raw_sales
            union all by name select * exclude (is_holiday_feature) from features_typed
            union all by name select Store as store_id, Type as store_type, Size as store_size from raw_stores))
where sold
"""

STG_DAILY = """
select store_id, sale_date, day_of_week, daily_sales, customers, is_promo, state_holiday, school_holiday,
       a[1] as store_type, a[2] as assortment, try_cast(a[3] as double) as competition_distance,
       try_cast(a[4] as double) as competition_open_since_month,
       try_cast(a[5] as double) as competition_open_since_year, try_cast(a[6] as bigint) as promo2,
       try_cast(a[7] as double) as promo2_since_week, try_cast(a[8] as double) as promo2_since_year,
       a[9] as promo_interval
from (select Store as store_id, Date as sale_date, DayOfWeek as day_of_week, Sales as daily_sales,
             Customers as customers, Promo as is_promo, StateHoliday as state_holiday,
             SchoolHoliday as school_holiday,
             (select [StoreType, Assortment, CompetitionDistance, CompetitionOpenSinceMonth,
                      CompetitionOpenSinceYear, cast(Promo2 as varchar), Promo2SinceWeek, Promo2SinceYear,
                      PromoInterval] from raw_daily_stores s where s.Store = d.Store) as a
      from raw_daily d where Open = 1 and Sales > 0)
"""

STG_TRANSACTIONS = """
select invoice_id, stock_code, description, quantity, stamped as invoice_timestamp, stamped::date as invoice_date,
       unit_price, customer_id, country, quantity * unit_price as revenue, left(invoice_id, 1) = 'C' as is_cancellation
from (select Invoice as invoice_id, StockCode as stock_code,
             regexp_replace(Description, '^ +| +$', '', 'g') as description,
             cast(sign(Quantity) * floor(abs(Quantity) + 0.5) as bigint) as quantity,
             InvoiceDate::timestamp as stamped, Price::double as unit_price, Customer_ID as customer_id, Country as country
      from raw_transactions
      where StockCode is not null and Description is not null and Quantity is not null and Price is not null)
where unit_price > 0
"""

# ---------------------------------------------------------------- marts
# rows numbered within their series; everything that looks back joins on the number
SERIES = f"""
select *, {cents('weekly_sales')} as c,
       row_number() over (partition by store_id, dept_id order by sale_date) as rn
from stg_weekly_sales
"""

ROLLS = f"""
select a.store_id, a.dept_id, a.rn,
       {from_cents('sum(b.c) filter (where a.rn - b.rn < 4)')} / count(*) filter (where a.rn - b.rn < 4) as avg4,
       {from_cents('sum(b.c)')} / count(*) as avg13,
       max(b.weekly_sales) filter (where b.rn = a.rn - 1) as lag1,
       max(b.weekly_sales) filter (where b.rn = a.rn - 4) as lag4
from series a join series b
  on a.store_id = b.store_id and a.dept_id = b.dept_id and b.rn between a.rn - 12 and a.rn
group by a.store_id, a.dept_id, a.rn
"""

YEAR_BACK = """
select a.store_id, a.dept_id, a.rn, b.weekly_sales as lag52
from series a join series b on a.store_id = b.store_id and a.dept_id = b.dept_id and a.rn = b.rn + 52
"""

MARKS = """
select store_id, dept_id, rn, sum(coalesce(v, 0.0) order by i) as total_markdown,
       max((i = 1 and coalesce(v, 0) > 0)::int) as has_markdown1,
       max((i = 2 and coalesce(v, 0) > 0)::int) as has_markdown2,
       max((i = 3 and coalesce(v, 0) > 0)::int) as has_markdown3,
       max((i = 4 and coalesce(v, 0) > 0)::int) as has_markdown4,
       max((i = 5 and coalesce(v, 0) > 0)::int) as has_markdown5
from (select store_id, dept_id, rn, unnest([1, 2, 3, 4, 5]) as i,
             unnest([markdown1, markdown2, markdown3, markdown4, markdown5]) as v from series)
group by store_id, dept_id, rn
"""

MART_WEEKLY = f"""
select s.* exclude (c, rn), datepart('year', sale_date)::int as year, datepart('month', sale_date)::int as month,
       {week_sunday('sale_date')} as week_of_year, avg4 as rolling_4wk_avg_sales,
       lag52 as sales_same_week_last_year
from series s join rolls using (store_id, dept_id, rn) left join year_back using (store_id, dept_id, rn)
"""

MART_DEMAND = f"""
select s.store_id, s.dept_id, s.sale_date, s.weekly_sales,
       datepart('year', sale_date)::int as year, datepart('month', sale_date)::int as month,
       {week_sunday('sale_date')} as week_of_year, quarter(sale_date)::int as quarter,
       (month(sale_date) in (11, 12))::int as is_holiday_season,
       coalesce(is_holiday, false)::int as is_holiday, store_type, store_size, temperature, fuel_price, cpi, unemployment,
       has_markdown1, has_markdown2, has_markdown3, has_markdown4, has_markdown5, total_markdown,
       lag1 as sales_lag_1wk, lag4 as sales_lag_4wk, lag52 as sales_lag_52wk,
       avg4 as rolling_4wk_avg, avg13 as rolling_13wk_avg
from series s join rolls using (store_id, dept_id, rn) join marks using (store_id, dept_id, rn)
     left join year_back using (store_id, dept_id, rn)
"""

_STORE = "store_id, store_type, store_size"
MART_STORE = f"""
with part as (
  select {_STORE}, is_holiday, sum({cents('weekly_sales')}) as c, count(*) as n
  from stg_weekly_sales group by all),
sides as (
  select {_STORE}, {from_cents('sum(c)')} as total, sum(n) as n,
         {from_cents('max(c) filter (where is_holiday)')} / max(n) filter (where is_holiday) as hol,
         {from_cents('max(c) filter (where not is_holiday)')} / max(n) filter (where not is_holiday) as other
  from part group by {_STORE}),
spread as (
  select {_STORE}, min(weekly_sales) as low, max(weekly_sales) as high, stddev_samp(weekly_sales) as sd,
         favg(temperature) as t, favg(fuel_price) as f, favg(cpi) as cpi, favg(unemployment) as u
  from stg_weekly_sales group by {_STORE}),
weeks as (select store_id, count(*) as n from (select distinct store_id, sale_date from stg_weekly_sales) group by 1),
depts as (select store_id, count(*) as n from (select distinct store_id, dept_id from stg_weekly_sales) group by 1)
select s.store_id, s.store_type, s.store_size,
       {r('s.total / s.n')} as avg_weekly_sales, {r('s.total')} as total_sales, {r('p.low')} as min_weekly_sales,
       {r('p.high')} as max_weekly_sales, {r('p.sd')} as stddev_weekly_sales,
       {r('s.hol')} as avg_holiday_sales, {r('s.other')} as avg_non_holiday_sales,
       w.n as num_weeks, d.n as num_depts, {r('p.t')} as avg_temperature, {r('p.f')} as avg_fuel_price,
       {r('p.cpi')} as avg_cpi, {r('p.u')} as avg_unemployment
from sides s join spread p on s.store_id = p.store_id join weeks w on s.store_id = w.store_id
     join depts d on s.store_id = d.store_id
"""

SALES_STATS = f"""
select store_id, dept_id, store_type, {r(from_cents('c') + ' / n')} as avg_weekly_sales,
       {r('sd')} as stddev_weekly_sales, {r('low')} as min_weekly_sales, {r('high')} as max_weekly_sales,
       n as num_weeks, {r(from_cents('c'))} as total_sales
from (select store_id, dept_id, store_type, sum({cents('weekly_sales')}) as c, count(*) as n,
             stddev_samp(weekly_sales) as sd, min(weekly_sales) as low, max(weekly_sales) as high
      from stg_weekly_sales group by all)
"""

# tiers from a table of half-open ranges
MART_RISK = f"""
with q as (select *, stddev_weekly_sales / avg_weekly_sales as cv from sales_stats where avg_weekly_sales > 0),
tier(name, above, upto) as (values ('HIGH', 0.5::double, 'infinity'::double), ('MEDIUM', 0.25::double, 0.5::double))
select q.* exclude (cv), {r('q.cv', 4)} as coeff_of_variation, coalesce(t.name, 'LOW') as demand_risk_tier
from q left join tier t on q.cv > t.above and q.cv <= t.upto
"""

_SITE = "store_id, store_type, assortment, competition_distance"
MART_PROMO = f"""
with part as (select {_SITE}, is_promo, sum(daily_sales) as s, count(*) as n from stg_daily_sales group by all),
sides as (
  select {_SITE}, sum(s)::double as total,
         max(s) filter (where is_promo = 1)::double / max(n) filter (where is_promo = 1) as p,
         max(s) filter (where is_promo = 0)::double / max(n) filter (where is_promo = 0) as b,
         coalesce(max(n) filter (where is_promo = 1), 0) as np,
         coalesce(max(n) filter (where is_promo = 0), 0) as nb
  from part group by {_SITE})
select {_SITE}, {r('p')} as avg_promo_sales, {r('b')} as avg_non_promo_sales,
       {r('((p - b) / nullif(b, 0)) * 100.0')} as promo_lift_pct, np as promo_days, nb as non_promo_days,
       {r('total')} as total_sales
from sides
"""

# name -> (body, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_sales": (RAW_SALES, ()),
    "raw_stores": (RAW_STORES, ()),
    "raw_features": (RAW_FEATURES, ()),
    "raw_daily": (RAW_DAILY, ()),
    "raw_daily_stores": (RAW_DAILY_STORES, ()),
    "raw_transactions": (RAW_TRANSACTIONS, ()),
    "raw_weekly_test": (RAW_WEEKLY_TEST, ("raw_sales",)),
    "raw_daily_test": (RAW_DAILY_TEST, ()),
    "features_typed": (FEATURES_TYPED, ("raw_features",)),
    "stg_weekly_sales": (STG_WEEKLY, ("raw_sales", "raw_stores", "features_typed")),
    "stg_daily_sales": (STG_DAILY, ("raw_daily", "raw_daily_stores")),
    "stg_transactions": (STG_TRANSACTIONS, ("raw_transactions",)),
    "series": (SERIES, ("stg_weekly_sales",)),
    "rolls": (ROLLS, ("series",)),
    "year_back": (YEAR_BACK, ("series",)),
    "marks": (MARKS, ("series",)),
    "mart_weekly_sales": (MART_WEEKLY, ("series", "rolls", "year_back")),
    "mart_demand_features": (MART_DEMAND, ("series", "rolls", "marks", "year_back")),
    "mart_store_features": (MART_STORE, ("stg_weekly_sales",)),
    "sales_stats": (SALES_STATS, ("stg_weekly_sales",)),
    "mart_inventory_risk": (MART_RISK, ("sales_stats",)),
    "mart_promotion_lift": (MART_PROMO, ("stg_daily_sales",)),
}


def register(name: str, body: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (body, deps)


def with_ctes(query: str, *names: str, grain: str = "week", extra: dict[str, str] | None = None) -> str:
    """``WITH`` the named CTEs (and their dependencies, in order) + query."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} as ({CTES[n][0].format(grain=grain) if n == 'raw_sales' else CTES[n][0]})"
             for n in order]
    for n, body in (extra or {}).items():
        parts.append(f"{n} as ({body})")
    if not parts:
        return query
    return "with " + ",\n".join(parts) + "\n" + query
