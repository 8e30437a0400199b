"""Raw-shaped retail inputs derived from the driver's TPC-H-style tables.

The reference ingests three CSV datasets (weekly store x department sales,
daily store sales, invoice lines). The test data instead holds TPC-H-style
tables; these functions derive tables with the reference's raw column names
and types from them, as lazy Spark plans, so every query's work grows with
the input (FIXTURES.md §3 gives the same definitions as SQL for the oracle).

Mapping: store = supplier key (an order belongs to the store of its customer
key modulo the number of suppliers), so the number of series grows with the
data; department = part type, sales = discounted line price; orders give the daily and feature
tables, line items the invoice lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretail.operators.joins import join_dimension
from sparkretail.session import parts_for

# Fixed values of the proxy definition (FIXTURES.md §3).
DEPT_BY_PART_TYPE = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5}
DEPT_OTHER = 6
HOLIDAY_ISO_WEEKS = (6, 36, 47, 52)
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
MARKDOWN_START = ("1998-01-01", "1998-01-01", "1999-01-01", "1999-01-01", "2000-01-01")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def period_start(ts: Column, grain: str) -> Column:
    """Start date of the week (Monday), month or quarter of a timestamp,
    computed on dates so the result does not depend on the session zone."""
    d = F.to_date(ts)
    if grain == "week":
        return F.date_sub(d, F.weekday(d))
    if grain in ("month", "quarter"):
        return F.trunc(d, grain)
    raise ValueError(f"unknown grain {grain!r}")


def most_rows(spark: SparkSession, sf_dir: str) -> int:
    """No weekly table has more rows than there are line items; their number
    stands in the files' footers."""
    return table(spark, sf_dir, "lineitem").count()


def _dept(p_type: Column) -> Column:
    expr = F.lit(DEPT_OTHER)
    for name, code in reversed(list(DEPT_BY_PART_TYPE.items())):
        expr = F.when(p_type == name, F.lit(code)).otherwise(expr)
    return expr.cast("bigint")


def raw_weekly_train(spark: SparkSession, sf_dir: str, grain: str = "week") -> DataFrame:
    """Store, Dept, Date, Weekly_Sales, IsHoliday at the given grain."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_extendedprice", "l_discount", "l_shipdate")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    j = join_dimension(li, sup, li.l_suppkey == sup.s_suppkey, "left_semi")
    j = join_dimension(j, part, j.l_partkey == part.p_partkey, "inner")
    amount = (F.col("l_extendedprice").cast("decimal(12,2)")
              * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,2)")
    start = period_start(F.col("l_shipdate"), grain)
    keyed = j.select(
        F.col("l_suppkey").cast("bigint").alias("Store"),
        _dept(F.col("p_type")).alias("Dept"),
        start.alias("Date"),
        amount.alias("amount"))
    if grain == "week":
        # line items hardly share a week: dealt by the keys first, they are summed in parts of bounded
        # size, where a map-side sum would hold (and spill) a group per row of its split
        keyed = keyed.repartition(parts_for(spark, most_rows(spark, sf_dir)), "Store", "Dept", "Date")
    return (keyed.groupBy("Store", "Dept", "Date")
            .agg(F.sum("amount").cast("double").alias("Weekly_Sales"))
            .withColumn("IsHoliday", F.weekofyear("Date").isin(*HOLIDAY_ISO_WEEKS)))


def raw_weekly_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store, Type, Size."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    store_type = (F.when(n == 24, "D").when(k % 3 == 0, "A").when(k % 3 == 1, "B").otherwise("C"))
    return table(spark, sf_dir, "supplier").select(
        k.cast("bigint").alias("Store"), store_type.alias("Type"),
        (F.lit(10000) + F.lit(100) * k + F.lit(1000) * n).cast("bigint").alias("Size"))


def _orders_with_store(spark: SparkSession, sf_dir: str, cols: list[str]) -> DataFrame:
    stores = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    o = table(spark, sf_dir, "orders").select("o_custkey", *cols)
    return o.withColumn("store", F.pmod(F.col("o_custkey"), stores).cast("bigint"))


def raw_weekly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store, Date, Temperature, Fuel_Price, MarkDown1..5, CPI, Unemployment,
    IsHoliday - all strings, 'NA' for missing (as the CSV arrives)."""
    j = _orders_with_store(spark, sf_dir, ["o_orderdate", "o_totalprice", "o_orderpriority"])
    price = F.col("o_totalprice").cast("decimal(14,2)")
    pri = F.col("o_orderpriority")
    aggs = [F.count(F.lit(1)).alias("n"), F.min(price).alias("lo"), F.max(price).alias("hi")]
    for i, p in enumerate(PRIORITIES, start=1):
        aggs.append(F.sum(F.when(pri == p, 1).otherwise(0)).alias(f"n{i}"))
        aggs.append(F.sum(F.when(pri == p, price)).alias(f"m{i}"))
    x = j.groupBy("store",
                  period_start(F.col("o_orderdate"), "week").alias("d")).agg(*aggs)
    cols = [F.col("store").cast("string").alias("Store"), F.col("d").cast("string").alias("Date"),
            F.col("n").cast("string").alias("Temperature"),
            F.col("lo").cast("string").alias("Fuel_Price")]
    for i, start in enumerate(MARKDOWN_START, start=1):
        cols.append(F.when((F.col("d") >= F.lit(start).cast("date")) & (F.col(f"n{i}") > 0),
                           F.col(f"m{i}").cast("string")).otherwise(F.lit("NA"))
                    .alias(f"MarkDown{i}"))
    cols += [F.when(F.col("n") % 5 == 0, F.lit("NA")).otherwise(F.col("hi").cast("string")).alias("CPI"),
             F.when(F.col("n") % 7 == 0, F.lit("NA")).otherwise(F.col("n").cast("string"))
             .alias("Unemployment"),
             F.when(F.weekofyear("d").isin(*HOLIDAY_ISO_WEEKS), F.lit("TRUE")).otherwise(F.lit("FALSE"))
             .alias("IsHoliday")]
    return x.select(*cols)


def raw_daily_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store, DayOfWeek, Date, Sales, Customers, Open, Promo, StateHoliday,
    SchoolHoliday - one row per order (several per store and day)."""
    j = _orders_with_store(spark, sf_dir, ["o_orderkey", "o_orderdate", "o_totalprice",
                                           "o_orderstatus", "o_orderpriority"])
    d = F.to_date("o_orderdate")
    return j.select(
        F.col("store").alias("Store"),
        (F.weekday(d) + 1).cast("bigint").alias("DayOfWeek"),
        d.alias("Date"),
        F.when(F.col("o_custkey") % 50 == 0, F.lit(0))
        .otherwise(F.floor("o_totalprice")).cast("bigint").alias("Sales"),
        (F.col("o_custkey") % 100).cast("bigint").alias("Customers"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).cast("bigint").alias("Open"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0)
        .cast("bigint").alias("Promo"),
        F.when(F.col("o_orderkey") % 40 == 0, "a").otherwise("0").alias("StateHoliday"),
        F.when(F.col("o_orderkey") % 6 == 0, 1).otherwise(0).cast("bigint").alias("SchoolHoliday"))


def raw_daily_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store, StoreType, Assortment, CompetitionDistance, ... PromoInterval
    (numeric attributes arrive as text, 'NA' or NULL when missing)."""
    k = F.col("s_suppkey")
    odd = k % 2 == 1
    return table(spark, sf_dir, "supplier").select(
        k.cast("bigint").alias("Store"),
        F.when(k % 4 == 0, "a").when(k % 4 == 1, "b").when(k % 4 == 2, "c").otherwise("d")
        .alias("StoreType"),
        F.when(k % 3 == 0, "a").when(k % 3 == 1, "b").otherwise("c").alias("Assortment"),
        F.when(k % 7 == 0, "NA").otherwise((110 * (k % 25)).cast("string")).alias("CompetitionDistance"),
        F.when(k % 5 == 0, F.lit(None)).otherwise((1 + k % 12).cast("string"))
        .alias("CompetitionOpenSinceMonth"),
        F.when(k % 5 == 0, F.lit(None)).otherwise((1990 + k % 25).cast("string"))
        .alias("CompetitionOpenSinceYear"),
        (k % 2).cast("bigint").alias("Promo2"),
        F.when(odd, (1 + 2 * (k % 25)).cast("string")).alias("Promo2SinceWeek"),
        F.when(odd, (1995 + k % 5).cast("string")).alias("Promo2SinceYear"),
        F.when(odd, F.lit("Jan,Apr,Jul,Oct")).alias("PromoInterval"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice, StockCode, Description, Quantity, InvoiceDate, Price,
    Customer_ID, Country - one row per line item."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    j = join_dimension(j, c, j.o_custkey == c.c_custkey, "inner")
    j = join_dimension(j, n, j.c_nationkey == n.n_nationkey, "inner")
    j = join_dimension(j, p, j.l_partkey == p.p_partkey, "inner")
    ret = F.col("l_returnflag") == "R"
    return j.select(
        F.when(ret, F.concat(F.lit("C"), F.col("l_orderkey").cast("string")))
        .otherwise(F.col("l_orderkey").cast("string")).alias("Invoice"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("Description"),
        ((F.when(ret, -F.col("l_quantity")).otherwise(F.col("l_quantity")))
         + F.when(F.col("l_linenumber") == 3, 0.5).otherwise(0.0)).cast("double").alias("Quantity"),
        F.col("l_shipdate").cast("timestamp_ntz").cast("string").alias("InvoiceDate"),
        F.when(F.col("l_quantity") == 50, F.lit(0.0)).otherwise(F.col("l_extendedprice"))
        .alias("Price"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string")).alias("Customer_ID"),
        F.col("n_name").alias("Country"))


def raw_weekly_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store, Dept, Date, IsHoliday of the weeks to forecast: the last 12
    weeks of the training file moved on by 12 weeks."""
    train = raw_weekly_train(spark, sf_dir)
    start = F.date_sub(raw_weekly_train(spark, sf_dir).select(F.max("Date")).scalar(), 84)
    later = F.date_add("Date", 84)
    return train.where(F.col("Date") > start).select(
        "Store", "Dept", later.alias("Date"), F.weekofyear(later).isin(*HOLIDAY_ISO_WEEKS).alias("IsHoliday"))


def raw_daily_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id, Store, DayOfWeek, Date, Open, Promo, StateHoliday, SchoolHoliday:
    the orders of the last six weeks moved on by six weeks."""
    j = _orders_with_store(spark, sf_dir, ["o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    d = F.to_date("o_orderdate")
    start = F.date_sub(table(spark, sf_dir, "orders").select(F.max(F.to_date("o_orderdate"))).scalar(), 42)
    return j.where(d > start).select(
        F.col("o_orderkey").cast("bigint").alias("Id"), F.col("store").alias("Store"),
        (F.weekday(d) + 1).cast("bigint").alias("DayOfWeek"), F.date_add(d, 42).alias("Date"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).when(F.col("o_orderstatus") == "P", 0.0).otherwise(1.0)
        .cast("double").alias("Open"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0).cast("bigint").alias("Promo"),
        F.when(F.col("o_orderkey") % 40 == 0, "a").otherwise("0").alias("StateHoliday"),
        F.when(F.col("o_orderkey") % 6 == 0, 1).otherwise(0).cast("bigint").alias("SchoolHoliday"))


def weekly_inputs(spark: SparkSession, sf_dir: str, grain: str = "week"):
    """(train, stores, features) raw weekly tables."""
    return (raw_weekly_train(spark, sf_dir, grain), raw_weekly_stores(spark, sf_dir),
            raw_weekly_features(spark, sf_dir))


def daily_inputs(spark: SparkSession, sf_dir: str):
    """(train, stores) raw daily tables."""
    return raw_daily_train(spark, sf_dir), raw_daily_stores(spark, sf_dir)
