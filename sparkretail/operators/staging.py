"""Staging models: type, rename and join the raw tables.

Each takes raw-shaped DataFrames (the reference's CSV column names) and
returns the cleaned, snake_case table. Dimensions (stores, weekly features)
are joined on keys that must be unique; a repeated one fails the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.functions.scalar import (na_to_double, safe_double, strict_cast, strict_date,
                                          strict_timestamp, to_int_rounded)
from sparkretail.operators.joins import join_dimension, unique_dimension

WEEKLY_STAGING_COLUMNS = [
    "store_id", "dept_id", "sale_date", "weekly_sales", "is_holiday", "store_type", "store_size",
    "temperature", "fuel_price", "markdown1", "markdown2", "markdown3", "markdown4", "markdown5",
    "cpi", "unemployment"]


def weekly_features(features: DataFrame) -> DataFrame:
    """Raw text features -> typed (store_id, sale_date, 9 measures)."""
    return features.select(
        strict_cast("Store", "bigint", "Store").alias("store_id"),
        strict_date("Date").alias("sale_date"),
        safe_double("Temperature").alias("temperature"),
        safe_double("Fuel_Price").alias("fuel_price"),
        *[na_to_double(f"MarkDown{i}").alias(f"markdown{i}") for i in range(1, 6)],
        na_to_double("CPI").alias("cpi"),
        na_to_double("Unemployment").alias("unemployment"),
        (F.col("IsHoliday") == F.lit("TRUE")).alias("is_holiday_feature"))


def stg_weekly_sales(train: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """Weekly sales LEFT JOIN stores LEFT JOIN features (unmatched weeks keep
    NULL features)."""
    t = train.select(F.col("Store").alias("store_id"), F.col("Dept").alias("dept_id"),
                     F.col("Date").alias("sale_date"), F.col("Weekly_Sales").alias("weekly_sales"),
                     F.col("IsHoliday").alias("is_holiday"))
    s = stores.select(F.col("Store").alias("store_id"), F.col("Type").alias("store_type"),
                      F.col("Size").alias("store_size"))
    f = weekly_features(features).drop("is_holiday_feature")
    out = join_dimension(t, unique_dimension(s, ["store_id"]), "store_id", "left")
    keys = ["store_id", "sale_date"]
    out = join_dimension(out, unique_dimension(f, keys), keys, "left")
    return out.select(*WEEKLY_STAGING_COLUMNS)


def open_selling_days(train: DataFrame) -> DataFrame:
    """``Open = 1 AND Sales > 0``."""
    return train.where((F.col("Open") == 1) & (F.col("Sales") > 0))


def daily_stores(stores: DataFrame) -> DataFrame:
    return stores.select(
        F.col("Store").alias("store_id"),
        F.col("StoreType").alias("store_type"),
        F.col("Assortment").alias("assortment"),
        safe_double("CompetitionDistance").alias("competition_distance"),
        safe_double("CompetitionOpenSinceMonth").alias("competition_open_since_month"),
        safe_double("CompetitionOpenSinceYear").alias("competition_open_since_year"),
        F.col("Promo2").alias("promo2"),
        safe_double("Promo2SinceWeek").alias("promo2_since_week"),
        safe_double("Promo2SinceYear").alias("promo2_since_year"),
        F.col("PromoInterval").alias("promo_interval"))


def stg_daily_sales(train: DataFrame, stores: DataFrame) -> DataFrame:
    """Open selling days LEFT JOIN store attributes."""
    t = open_selling_days(train).select(
        F.col("Store").alias("store_id"), F.col("Date").alias("sale_date"),
        F.col("DayOfWeek").alias("day_of_week"), F.col("Sales").alias("daily_sales"),
        F.col("Customers").alias("customers"), F.col("Promo").alias("is_promo"),
        F.col("StateHoliday").alias("state_holiday"),
        F.col("SchoolHoliday").alias("school_holiday"))
    return join_dimension(t, unique_dimension(daily_stores(stores), ["store_id"]), "store_id", "left")


def stg_transactions(raw: DataFrame) -> DataFrame:
    """Typed invoice lines; cancellations, returns and NULL customers are
    kept and only flagged. Lines without stock code, description, quantity or
    a positive price are dropped."""
    qty = to_int_rounded("Quantity")
    price = F.col("Price").cast("double")
    ts = strict_timestamp("InvoiceDate")
    return (raw.where(F.col("StockCode").isNotNull() & F.col("Description").isNotNull()
                      & F.col("Quantity").isNotNull() & F.col("Price").isNotNull()
                      & (price > 0))
            .select(F.col("Invoice").alias("invoice_id"),
                    F.col("StockCode").alias("stock_code"),
                    F.trim("Description").alias("description"),
                    qty.alias("quantity"),
                    ts.alias("invoice_timestamp"),
                    F.to_date(ts).alias("invoice_date"),
                    price.alias("unit_price"),
                    F.col("Customer_ID").alias("customer_id"),
                    F.col("Country").alias("country"),
                    (qty * price).alias("revenue"),
                    F.startswith(F.col("Invoice"), F.lit("C")).alias("is_cancellation")))
