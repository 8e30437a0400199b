"""Catalog entries: file sources, sinks and the streaming staging model
(SURVEY §2.1, 2.12).

Each query writes Spark-derived raw data in the reference's file dialect to
a fresh folder under the shared checkpoint folder, then reads it back with
the declared schema, so the round trip is what is checked.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import functions as F

from sparkretail.operators import drift, forecast, marts
from sparkretail.operators.forecast_table import append_run, read_table, stamp, union_models
from sparkretail.plans import builds
from sparkretail.plans import oracle as O
from sparkretail.plans.catalog import query
from sparkretail.plans.q_serving import RUNS, model_outputs, seasonal_output
from sparkretail.session import scratch_path
from sparkretail.sources import committed, files, proxy
from sparkretail.streaming.staging import run_available, stream_weekly_staging

W = O.with_ctes
log = logging.getLogger(__name__)


def _landed(spark, base, frames, read):
    """Every file landed as CSV and read back type-strict."""
    for name, df in frames.items():
        files.write_csv(df, f"{base}/{name}")
    return read(spark, base)


def _stacked(read, as_text):
    """The files one below the other; columns whose types differ as text."""
    out = None
    for name, df in read.items():
        df = df.select(F.lit(name).alias("file"), *[F.col(c).cast(as_text.get(c, t)).alias(c) for c, t in df.dtypes])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


@query("src_weekly", W(
    "select 'train.csv' as file, cast(Store as varchar) as Store, Dept, cast(Date as varchar) as Date, Weekly_Sales, "
    "cast(IsHoliday as varchar) as IsHoliday from raw_sales union all by name "
    "select 'test.csv' as file, cast(Store as varchar) as Store, Dept, cast(Date as varchar) as Date, "
    "cast(IsHoliday as varchar) as IsHoliday from raw_weekly_test union all by name "
    "select 'stores.csv' as file, cast(Store as varchar) as Store, Type, Size from raw_stores union all by name "
    "select 'features.csv' as file, * from raw_features",
    "raw_sales", "raw_weekly_test", "raw_stores", "raw_features"))
def q_src_weekly(spark, sf):
    frames = {"train.csv": proxy.raw_weekly_train(spark, sf), "test.csv": proxy.raw_weekly_test(spark, sf),
              "stores.csv": proxy.raw_weekly_stores(spark, sf), "features.csv": proxy.raw_weekly_features(spark, sf)}
    read = _landed(spark, scratch_path(spark, "weekly"), frames, files.read_weekly)
    return _stacked(read, {"Store": "string", "Date": "string", "IsHoliday": "string"})


@query("src_daily", W(
    "select 'train.csv' as file, * replace (cast(Open as double) as Open) from raw_daily union all by name "
    "select 'test.csv' as file, * from raw_daily_test union all by name "
    "select 'store.csv' as file, * replace (try_cast(CompetitionDistance as double) as CompetitionDistance, "
    "try_cast(CompetitionOpenSinceMonth as double) as CompetitionOpenSinceMonth, "
    "try_cast(CompetitionOpenSinceYear as double) as CompetitionOpenSinceYear, "
    "try_cast(Promo2SinceWeek as double) as Promo2SinceWeek, "
    "try_cast(Promo2SinceYear as double) as Promo2SinceYear) from raw_daily_stores",
    "raw_daily", "raw_daily_test", "raw_daily_stores"))
def q_src_daily(spark, sf):
    # the declared schema has numbers where the proxy writes 'NA': such fields land empty
    stores = proxy.raw_daily_stores(spark, sf)
    stores = stores.withColumn("CompetitionDistance", F.nullif("CompetitionDistance", F.lit("NA")))
    frames = {"train.csv": proxy.raw_daily_train(spark, sf), "test.csv": proxy.raw_daily_test(spark, sf),
              "store.csv": stores}
    read = _landed(spark, scratch_path(spark, "daily"), frames, files.read_daily)
    return _stacked(read, {"Open": "double"})


@query("src_transactions", W("select * from raw_transactions", "raw_transactions"))
def q_src_transactions(spark, sf):
    path = f"{scratch_path(spark, 'transactions')}/online_retail_II.csv"
    files.write_csv(proxy.raw_transactions(spark, sf), path)
    return files.read_transactions(spark, path)


_DAMAGE = "case l_linenumber when 4 then 'price' when 5 then 'extra' when 6 then 'short' when 7 then 'quantity' else 'none' end"


def _damaged_lines(spark, sf):
    """Invoice lines as CSV text, some of them damaged by their line number:
    text in a number, a field too many, missing trailing fields."""
    li = proxy.table(spark, sf, "lineitem")
    kind = F.expr(_DAMAGE)
    price = F.when(kind == "price", "n/a").otherwise(F.col("l_extendedprice").cast("string"))
    amount = F.when(kind == "quantity", "a few").otherwise(F.col("l_quantity").cast("string"))
    head = [F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), F.lit('"item, ""quoted"""'), amount,
            F.col("l_shipdate").cast("string"), price]
    tail = F.when(kind == "short", "").when(kind == "extra", ",1,Nowhere,beyond").otherwise(",1,Nowhere")
    return li.select(F.concat(F.concat_ws(",", *head), tail).alias("value"))


def _damaged_load(spark, sf):
    path = scratch_path(spark, "damaged")
    _damaged_lines(spark, sf).write.text(path)
    return files.load_csv(spark, path, files.TRANSACTIONS, jagged=True, header=False)


@query("src_rejects", f"""
select reason, field, value, count(*) as records from (
  select case damage when 'extra' then 'too_many_fields' else 'bad_value' end as reason,
         case damage when 'price' then 'Price' when 'quantity' then 'Quantity' end as field,
         case damage when 'price' then 'n/a' when 'quantity' then 'a few' end as value
  from (select {_DAMAGE} as damage from lineitem) where damage in ('price', 'quantity', 'extra')) group by all
""")
def q_src_rejects(spark, sf):
    """The reject table of a load with damaged lines, by reason and bad field."""
    rejected = _damaged_load(spark, sf).rejected
    return (rejected.select("reason", F.get("fields", F.lit(0)).alias("field"), F.get("values", F.lit(0)).alias("value"))
            .groupBy("reason", "field", "value").agg(F.count("*").alias("records")))


@query("src_accepted", f"""
select cast(l_orderkey as varchar) as Invoice, 'item, "quoted"' as Description, cast(l_quantity as double) as Quantity,
       cast(l_extendedprice as double) as Price, case when damage = 'short' then null else 'Nowhere' end as Country
from (select *, {_DAMAGE} as damage from lineitem) where damage in ('none', 'short')
""")
def q_src_accepted(spark, sf):
    """The rows that the same load accepts: short ones padded with NULL."""
    return _damaged_load(spark, sf).accepted.select("Invoice", "Description", "Quantity", "Price", "Country")


@query("src_table", W("select store_id, dept_id, sale_date, weekly_sales, is_holiday "
                      "from positive_demand", "positive_demand"))
def q_src_table(spark, sf):
    path = scratch_path(spark, "mart_demand_features")
    files.write_parquet(builds.demand_features(spark, sf), path)
    return (spark.read.parquet(path).where(F.col("weekly_sales") > 0)
            .select("store_id", "dept_id", "sale_date", "weekly_sales", "is_holiday"))


@query("src_parquet_optional", W("select * from seasonal_fc", "seasonal_fc"))
def q_src_parquet_optional(spark, sf):
    base = scratch_path(spark, "forecasts")
    files.write_parquet(seasonal_output(spark, sf), f"{base}/seasonal")
    found = files.read_parquet_optional(spark, [f"{base}/seasonal", f"{base}/gbt"])
    return union_models(found).select(*forecast.FORECAST_COLUMNS)


@query("src_manifest_check", W("""
select file_name, case when rows > 0 then 'ok' else 'missing_or_empty' end as status, rows > 1 as has_rows from (
  select 'train.csv' as file_name, 1 + count(*) as rows from raw_sales union all
  select 'stores.csv', 1 + count(*) from raw_stores union all
  select 'features.csv', 1 + count(*) from raw_features union all
  select 'test.csv', 0)
""", "raw_sales", "raw_stores", "raw_features"))
def q_src_manifest_check(spark, sf):
    """Names, and whether a file holds more than its header, from the files
    themselves: test.csv was never landed."""
    base = scratch_path(spark, "manifest")
    frames = dict(zip(("train.csv", "stores.csv", "features.csv"), proxy.weekly_inputs(spark, sf)))
    for name, df in frames.items():
        files.write_csv(df, f"{base}/{name}")
    found = files.manifest(spark, base, [*files.WEEKLY_FILES])
    header = F.lit(0)
    for name, df in frames.items():
        header = F.when(F.col("file_name") == name, len(",".join(df.columns)) + 1).otherwise(header)
    return found.select("file_name", "status", (F.coalesce("size_bytes", F.lit(0)) > header).alias("has_rows"))


@query("snk_truncate", W("select * from stg_daily_sales", "stg_daily_sales"))
def q_snk_truncate(spark, sf):
    """An overwriting load that is run again, also under the same run_id."""
    path = scratch_path(spark, "stg_daily_sales")
    df = builds.daily_staging(spark, sf)
    committed.write(df.limit(1), path, "first", "overwrite")
    for _ in range(2):
        committed.write(df, path, "second", "overwrite")
    return committed.read(spark, path, df.schema)


@query("snk_append", W("select * from forecast_log", "forecast_log"))
def q_snk_append(spark, sf):
    """Two runs, the first one sent twice: it is in the table once."""
    path = scratch_path(spark, "mart_demand_forecast")
    out = model_outputs(spark, sf)
    for rid, ts in (RUNS[0], *RUNS):
        append_run(stamp(out, rid, ts), path, rid)
    return read_table(spark, path)


@query("snk_mart_table", W("select * from mart_store_features", "mart_store_features"))
def q_snk_mart_table(spark, sf):
    name = f"mart_store_features_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, name)  # an external table: the shared folder holds its files
    marts.mart_store_features(builds.weekly_table(spark, sf)).write.mode("overwrite").option("path", path).saveAsTable(name)
    return spark.table(name)


@query("snk_staging_view", W("select * from stg_weekly_sales", "stg_weekly_sales"))
def q_snk_staging_view(spark, sf):
    builds.weekly_staging(spark, sf).createOrReplaceTempView("stg_weekly_sales")
    return spark.table("stg_weekly_sales")


@query("snk_parquet", W("select * from seasonal_fc", "seasonal_fc"))
def q_snk_parquet(spark, sf):
    path = scratch_path(spark, "seasonal_forecasts")
    files.write_parquet(seasonal_output(spark, sf).select(*forecast.FORECAST_COLUMNS), path)
    return spark.read.parquet(path)


@query("snk_csv")
def q_snk_csv(spark, sf):
    from sparkretail.plans.q_ml import boosted
    imp = boosted(spark, sf).importances
    path = scratch_path(spark, "feature_importance.csv")
    files.write_csv(imp.orderBy(F.desc("importance")).coalesce(1), path)
    return files.read_csv(spark, path, imp.schema)


@query("snk_json", W("select * from drift_features", "drift_features"))
def q_snk_json(spark, sf):
    path = scratch_path(spark, "drift_report")
    split = builds.drift_input(spark, sf)
    files.json_lines(drift.drift_features(split)).write.mode("overwrite").text(path)
    return spark.read.schema("feature string, psi double, tier string, type string").json(path)


@query("load_count", W("select * from raw_daily", "raw_daily"))
def q_load_count(spark, sf):
    path = scratch_path(spark, "daily_load")
    df = proxy.raw_daily_train(spark, sf)
    done = committed.write(df, path, "load", "overwrite")
    log.info("loaded %d rows -> %s", done.rows, path)  # observed during the write
    return committed.read(spark, path, df.schema)


@query("stream_stg_weekly_sales", W("select * from stg_weekly_sales", "stg_weekly_sales"))
def q_stream_stg_weekly_sales(spark, sf):
    base = scratch_path(spark, "stream")
    files.write_parquet(proxy.raw_weekly_train(spark, sf).repartition(4), f"{base}/landing")
    stream = stream_weekly_staging(spark, f"{base}/landing", proxy.raw_weekly_stores(spark, sf),
                                   proxy.raw_weekly_features(spark, sf))
    run_available(stream, f"{base}/out", f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/out")


@query("snk_json_document")
def q_snk_json_document(spark, sf):
    """The nested drift report document written as one JSON text file."""
    path = scratch_path(spark, "drift_report_document")
    split = builds.drift_input(spark, sf)
    doc = drift.report_document(split, drift.drift_features(split), "2024-01-08T06:00:00")
    doc.coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path)
