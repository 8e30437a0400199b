from sparkretail.operators import marts, metrics
from sparkretail.plans import builds
from sparkretail.session import forget_stored, materialize
from sparkretail.sources import proxy


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_mart_one_window_exchange(spark, sf_small):
    stg = materialize(builds.weekly_staging(spark, sf_small), "plain_staging")  # not bucketed
    plan = _plan(marts.mart_demand_features(stg))
    assert plan.count("Window [") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_pruning_and_pushdown(spark, sf_small):
    df = builds.transactions_staging(spark, sf_small)
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int" in txt


def test_bucketed_staging_needs_no_exchange(spark, sf_small):
    stg = builds.weekly_table(spark, sf_small)
    for df in (marts.mart_demand_features(stg), marts.mart_inventory_risk(stg), marts.mart_weekly_sales(stg),
               marts.mart_store_features(stg), metrics.store_week(stg)):
        assert "Exchange" not in _plan(df)


def test_distinct_counts_do_not_expand(spark, sf_small):
    plan = _plan(marts.mart_store_features(builds.weekly_staging(spark, sf_small)))
    assert "Expand" not in plan
    own = spark.range(10).selectExpr("id % 2 as store_id", "id as sale_date", "id as dept_id")
    plan = _plan(own.groupBy("store_id").agg(marts.distinct_count("sale_date"), marts.distinct_count("dept_id")))
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" not in plan


def test_buckets_grow_with_the_rows(spark, sf_small, monkeypatch):
    """F16, F17, F18, F24: a bucket holds a bounded number of rows, whatever
    the cores and shuffle partitions."""
    forget_stored()
    monkeypatch.setattr("sparkretail.session.BUCKET_ROWS", 100)
    try:
        many = -(-spark.read.parquet(f"{sf_small}/lineitem.parquet").count() // 100)
        for table in (builds.weekly_table(spark, sf_small), builds.demand_table(spark, sf_small)):
            assert table.groupBy("store_id").count().rdd.getNumPartitions() == many
        assert "Exchange" not in _plan(marts.mart_demand_features(builds.weekly_table(spark, sf_small)))
        # sums by week are made after the exchange only, in as many parts
        plan = _plan(proxy.raw_weekly_train(spark, sf_small))
        assert f", {many}), REPARTITION_BY_NUM" in plan and plan.index("partial_sum") < plan.index("REPARTITION_BY_NUM")
    finally:
        forget_stored()
