"""Rules that hold at every size: no job while a plan is built, no silent
fan-out, no private folder on a cluster."""

import pytest
from pyspark.errors import PySparkException

from sparkretail import session
from sparkretail.operators import marts, staging
from sparkretail.operators.joins import unique_dimension
from sparkretail.plans import builds


def test_building_a_plan_starts_no_job(spark, sf_small):
    from sparkretail.sources import proxy

    tracker = spark.sparkContext.statusTracker()
    proxy.table(spark, sf_small, "lineitem")  # the footer read below is one job a table
    spark.sparkContext.setJobGroup("plan-only", "plan")
    builds.weekly_staging(spark, sf_small)
    builds.daily_staging(spark, sf_small)
    jobs = tracker.getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # parquet footers only: one task each, one job a table read
    assert all(tracker.getJobInfo(j) is None or all(
        tracker.getStageInfo(s) is None or tracker.getStageInfo(s).numTasks == 1
        for s in tracker.getJobInfo(j).stageIds) for j in jobs) and len(jobs) <= 12


def test_repeated_dimension_key_fails(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "store_id long, t string")
    with pytest.raises(PySparkException, match="duplicate dimension key"):
        unique_dimension(dim, ["store_id"]).collect()
    assert unique_dimension(dim.where("t <> 'b'"), ["store_id"]).count() == 4


def test_checkpoint_folder_must_be_set_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_external_means_keep_their_decimals(spark):
    rows = [(1, 1, 10.0, 2.514, 8.104), (1, 2, 10.0, 2.5159, 8.1059)]
    stg = spark.createDataFrame(rows, "store_id long, dept_id long, weekly_sales double, fuel_price double, unemployment double")
    stg = stg.selectExpr("*", "'A' as store_type", "1L as store_size", "date'2010-02-05' as sale_date",
                         "false as is_holiday", "1.0D as temperature", "1.0D as cpi")
    r = marts.mart_store_features(stg).first()
    assert (r.avg_fuel_price, r.avg_unemployment) == (2.51, 8.1)


def test_keys_are_64_bit(spark):
    raw = spark.createDataFrame([("3000000000", "2010-02-05", *["1.0"] * 9, "TRUE")],
                                "Store string, Date string, Temperature string, Fuel_Price string, MarkDown1 string, "
                                "MarkDown2 string, MarkDown3 string, MarkDown4 string, MarkDown5 string, CPI string, "
                                "Unemployment string, IsHoliday string")
    assert staging.weekly_features(raw).first().store_id == 3_000_000_000
