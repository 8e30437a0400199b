"""Data-quality operators.

Checks of one table are fused into a single aggregation pass and returned as
a tidy DataFrame ``(check_name, observed, bound_kind, bound, passed)``;
``assert_passed`` raises on the first failing row (it reads the tiny check
table only, never the data).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    name: str
    kind: str  # "min" | "max" | "exact"
    bound: int
    metric: str  # "rows" | "nulls" | "distinct"
    column: str | None = None

    def expr(self) -> Column:
        if self.metric == "rows":
            return F.count(F.lit(1))
        if self.metric == "nulls":
            return F.count_if(F.col(self.column).isNull())
        if self.metric == "distinct":
            return F.countDistinct(F.col(self.column))
        raise ValueError(self.metric)

    def sign(self) -> str:
        """How an observed value that fails compares with the bound."""
        return {"min": "<", "max": ">", "exact": "!="}[self.kind]


def passes(check: Check, observed: int) -> bool:
    return {"min": observed >= check.bound, "max": observed <= check.bound, "exact": observed == check.bound}[check.kind]


# The load-time assertions of the three ingests.
WEEKLY_TRAIN_CHECKS = (Check("walmart_train row count", "min", 400000, "rows"),
                       Check("walmart_train null sales", "max", 0, "nulls", "Weekly_Sales"))
WEEKLY_STORES_CHECKS = (Check("walmart_stores count", "exact", 45, "rows"),)
DAILY_TRAIN_CHECKS = (Check("rossmann_train row count", "min", 1000000, "rows"),
                      Check("rossmann_train null sales", "max", 0, "nulls", "Sales"))
DAILY_STORES_CHECKS = (Check("rossmann_stores count", "exact", 1115, "rows"),)
TRANSACTION_CHECKS = (Check("online_retail row count", "min", 500000, "rows"),
                      Check("online_retail has invoices", "min", 10000, "distinct", "Invoice"),
                      Check("online_retail has countries", "min", 30, "distinct", "Country"))


def passed_expr(observed: Column, kind: Column, bound: Column) -> Column:
    return (F.when(kind == "min", observed >= bound)
            .when(kind == "max", observed <= bound)
            .otherwise(observed == bound))


def evaluate(df: DataFrame, checks: Sequence[Check], ords: Sequence[int] | None = None) -> DataFrame:
    """The given checks of one table in one pass -> one row per check, with its
    place (``ords``) in the declared list."""
    ords = list(range(len(checks))) if ords is None else list(ords)
    row = df.agg(*[c.expr().cast("bigint").alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("observed"),
                              F.lit(c.kind).alias("bound_kind"),
                              F.lit(c.bound).cast("bigint").alias("bound"),
                              F.lit(ords[i]).alias("ord"))
                     for i, c in enumerate(checks)])
    out = row.select(F.inline(rows))
    return out.select("check_name", "observed", "bound_kind", "bound",
                      passed_expr(F.col("observed"), F.col("bound_kind"), F.col("bound"))
                      .alias("passed"), "ord")


def assert_passed(results: DataFrame) -> None:
    """Raise on the first failing check (in declaration order)."""
    for r in results.orderBy("ord").collect():
        if not r["passed"]:
            op = {"min": "<", "max": ">", "exact": "!="}[r["bound_kind"]]
            raise ValueError(f"Check failed [{r['check_name']}]: {r['observed']} {op} {r['bound']}")


# Declared column tests (model, column).
NOT_NULL_TESTS = {
    "stg_walmart_sales": ("store_id", "dept_id", "sale_date", "weekly_sales"),
    "stg_rossmann_sales": ("store_id", "sale_date", "daily_sales"),
    "stg_online_retail": ("invoice_id", "stock_code"),
    "mart_weekly_sales": ("store_id", "dept_id", "sale_date", "weekly_sales"),
    "mart_store_features": ("store_id",),
    "mart_promotion_lift": ("store_id",),
    "mart_inventory_risk": ("store_id", "dept_id"),
    "mart_demand_features": ("store_id", "dept_id", "sale_date", "weekly_sales"),
}
UNIQUE_TESTS = {"mart_store_features": "store_id", "mart_promotion_lift": "store_id"}


def not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """``(model, column_name, failing_rows, passed)`` for every column, one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                              F.col(f"n{i}").cast("bigint").alias("failing_rows"))
                     for i, c in enumerate(columns)])
    return (row.select(F.inline(rows))
            .withColumn("test", F.lit("not_null"))
            .withColumn("passed", F.col("failing_rows") == 0))


def observed_row(checks: Sequence[Check], observed: Sequence[int], ords: Sequence[int] | None = None) -> list[tuple]:
    """``evaluate``'s rows from values observed while the data was written."""
    ords = list(range(len(checks))) if ords is None else list(ords)
    return [(c.name, int(v), c.kind, c.bound, passes(c, v), o) for c, v, o in zip(checks, observed, ords)]


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of key values that occur more than once (distributed group-by;
    the key count per group is partially aggregated before the shuffle)."""
    dups = df.groupBy(column).count().where(F.col("count") > 1)
    return (dups.agg(F.count(F.lit(1)).cast("bigint").alias("failing_rows"))
            .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    "failing_rows", F.lit("unique").alias("test"),
                    (F.col("failing_rows") == 0).alias("passed")))
