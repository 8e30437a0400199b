"""Catalog entries: staging models, projections, predicates, joins, casts
(SURVEY §2.2, 2.3, 2.8, 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkretail.functions import scalar as S
from sparkretail.operators import staging
from sparkretail.operators.joins import join_dimension
from sparkretail.plans import builds
from sparkretail.plans import oracle as O
from sparkretail.plans.catalog import query
from sparkretail.sources import proxy

W = O.with_ctes


@query("stg_weekly_sales", W("select * from stg_weekly_sales", "stg_weekly_sales"))
def q_stg_weekly_sales(spark, sf):
    return builds.weekly_staging(spark, sf)


@query("stg_daily_sales", W("select * from stg_daily_sales", "stg_daily_sales"))
def q_stg_daily_sales(spark, sf):
    return builds.daily_staging(spark, sf)


@query("stg_transactions", W("select * from stg_transactions", "stg_transactions"))
def q_stg_transactions(spark, sf):
    return builds.transactions_staging(spark, sf)


@query("prj_rename", W("select Store as store_id, Dept as dept_id, Date as sale_date, "
                       "Weekly_Sales as weekly_sales, IsHoliday as is_holiday from raw_sales",
                       "raw_sales"))
def q_prj_rename(spark, sf):
    t = proxy.raw_weekly_train(spark, sf)
    return t.select(F.col("Store").alias("store_id"), F.col("Dept").alias("dept_id"),
                    F.col("Date").alias("sale_date"), F.col("Weekly_Sales").alias("weekly_sales"),
                    F.col("IsHoliday").alias("is_holiday"))


@query("flt_open_selling", W("select Store, Date, Sales, Promo from raw_daily "
                             "where Open = 1 and Sales > 0", "raw_daily"))
def q_flt_open_selling(spark, sf):
    return staging.open_selling_days(proxy.raw_daily_train(spark, sf)).select(
        "Store", "Date", "Sales", "Promo")


@query("flt_txn_clean", W("select invoice_id, stock_code, quantity, unit_price "
                          "from stg_transactions", "stg_transactions"))
def q_flt_txn_clean(spark, sf):
    return builds.transactions_staging(spark, sf).select("invoice_id", "stock_code", "quantity",
                                                         "unit_price")


@query("jn_sales_stores", W("select t.Store as store_id, t.Dept as dept_id, t.Date as sale_date, "
                            "s.Type as store_type, s.Size as store_size "
                            "from raw_sales t left join raw_stores s on t.Store = s.Store",
                            "raw_sales", "raw_stores"))
def q_jn_sales_stores(spark, sf):
    t = proxy.raw_weekly_train(spark, sf).select(
        F.col("Store").alias("store_id"), F.col("Dept").alias("dept_id"),
        F.col("Date").alias("sale_date"))
    s = proxy.raw_weekly_stores(spark, sf).select(
        F.col("Store").alias("store_id"), F.col("Type").alias("store_type"),
        F.col("Size").alias("store_size"))
    return join_dimension(t, s, "store_id", "left")


@query("jn_sales_features", W("select store_id, dept_id, sale_date, temperature, cpi "
                              "from stg_weekly_sales", "stg_weekly_sales"))
def q_jn_sales_features(spark, sf):
    return builds.weekly_staging(spark, sf).select("store_id", "dept_id", "sale_date",
                                                   "temperature", "cpi")


@query("jn_daily_stores", W("select store_id, sale_date, daily_sales, store_type, assortment, "
                            "competition_distance from stg_daily_sales", "stg_daily_sales"))
def q_jn_daily_stores(spark, sf):
    return builds.daily_staging(spark, sf).select("store_id", "sale_date", "daily_sales",
                                                  "store_type", "assortment",
                                                  "competition_distance")


@query("fn_nullif_na", W("select store_id, sale_date, markdown1, markdown2, markdown3, markdown4, "
                         "markdown5, cpi, unemployment from features_typed", "features_typed"))
def q_fn_nullif_na(spark, sf):
    return staging.weekly_features(proxy.raw_weekly_features(spark, sf)).select(
        "store_id", "sale_date", *[f"markdown{i}" for i in range(1, 6)], "cpi", "unemployment")


@query("fn_safe_cast", W(
    "select Store as store_id, try_cast(CompetitionDistance as double) as competition_distance, "
    "try_cast(CompetitionOpenSinceMonth as double) as competition_open_since_month, "
    "try_cast(Promo2SinceYear as double) as promo2_since_year from raw_daily_stores",
    "raw_daily_stores"))
def q_fn_safe_cast(spark, sf):
    return staging.daily_stores(proxy.raw_daily_stores(spark, sf)).select(
        "store_id", "competition_distance", "competition_open_since_month", "promo2_since_year")


@query("fn_cast_int_round", W(
    "select Invoice as invoice_id, StockCode as stock_code, Quantity as raw_quantity, "
    "cast(round(Quantity) as bigint) as quantity from raw_transactions", "raw_transactions"))
def q_fn_cast_int_round(spark, sf):
    return proxy.raw_transactions(spark, sf).select(
        F.col("Invoice").alias("invoice_id"), F.col("StockCode").alias("stock_code"),
        F.col("Quantity").alias("raw_quantity"), S.to_int_rounded("Quantity").alias("quantity"))


@query("fn_cast_key", W("select store_id, sale_date from features_typed", "features_typed"))
def q_fn_cast_key(spark, sf):
    return staging.weekly_features(proxy.raw_weekly_features(spark, sf)).select(
        "store_id", "sale_date")


@query("fn_parse_date", W("select Store, cast(strptime(Date, '%Y-%m-%d') as date) as sale_date "
                          "from raw_features", "raw_features"))
def q_fn_parse_date(spark, sf):
    return proxy.raw_weekly_features(spark, sf).select(
        "Store", S.strict_date("Date").alias("sale_date"))


@query("fn_parse_timestamp", W("select invoice_id, stock_code, invoice_timestamp, invoice_date "
                               "from stg_transactions", "stg_transactions"))
def q_fn_parse_timestamp(spark, sf):
    return builds.transactions_staging(spark, sf).select("invoice_id", "stock_code",
                                                         "invoice_timestamp", "invoice_date")


@query("fn_trim", W("select invoice_id, stock_code, description from stg_transactions",
                    "stg_transactions"))
def q_fn_trim(spark, sf):
    return builds.transactions_staging(spark, sf).select("invoice_id", "stock_code",
                                                         "description")


@query("fn_starts_with", W("select Invoice as invoice_id, starts_with(Invoice, 'C') as "
                           "is_cancellation from raw_transactions", "raw_transactions"))
def q_fn_starts_with(spark, sf):
    return proxy.raw_transactions(spark, sf).select(
        F.col("Invoice").alias("invoice_id"),
        F.startswith(F.col("Invoice"), F.lit("C")).alias("is_cancellation"))


@query("fn_eq_true", W("select store_id, sale_date, is_holiday_feature from features_typed",
                       "features_typed"))
def q_fn_eq_true(spark, sf):
    return staging.weekly_features(proxy.raw_weekly_features(spark, sf)).select(
        "store_id", "sale_date", "is_holiday_feature")


@query("fn_multiply", W("select invoice_id, stock_code, quantity, unit_price, revenue "
                        "from stg_transactions", "stg_transactions"))
def q_fn_multiply(spark, sf):
    return builds.transactions_staging(spark, sf).select("invoice_id", "stock_code", "quantity",
                                                         "unit_price", "revenue")
