import datetime as dt

from pyspark.sql import functions as F

from sparkretail.operators import marts
from sparkretail.plans import builds
from sparkretail.sources import committed

STG = ("store_id long, dept_id long, sale_date date, weekly_sales double, is_holiday boolean, "
       "store_type string, store_size long, temperature double, fuel_price double, "
       "markdown1 double, markdown2 double, markdown3 double, markdown4 double, markdown5 double, "
       "cpi double, unemployment double")


def _row(store, dept, d, sales, hol=False, stype="A"):
    return (store, dept, d, sales, hol, stype, 100, 50.0, 3.0, None, 10.0, None, 0.0, None, 200.0, 7.0)


def _series(n, store=1, dept=1, start=dt.date(2010, 1, 1), gap_at=None):
    rows, d = [], start
    for i in range(n):
        if gap_at is not None and i == gap_at:
            d += dt.timedelta(days=14)
        rows.append(_row(store, dept, d, float(i + 1)))
        d += dt.timedelta(days=7)
    return rows


def test_lags_and_rolling_by_row(spark):
    rows = _series(53, gap_at=10) + _series(3, dept=2) + _series(1, dept=3)
    df = marts.mart_demand_features(spark.createDataFrame(rows, STG))
    got = {(r.dept_id, r.weekly_sales): r for r in df.collect()}
    last = got[(1, 53.0)]
    assert last.sales_lag_1wk == 52.0 and last.sales_lag_4wk == 49.0 and last.sales_lag_52wk == 1.0
    assert last.rolling_4wk_avg == (50 + 51 + 52 + 53) / 4
    assert got[(1, 2.0)].rolling_13wk_avg == 1.5  # partial frame
    assert got[(2, 1.0)].sales_lag_1wk is None and got[(3, 1.0)].rolling_4wk_avg == 1.0
    # gap: row lag ignores the calendar (S8)
    assert got[(1, 11.0)].sales_lag_1wk == 10.0
    assert last.has_markdown2 == 1 and last.has_markdown4 == 0 and last.total_markdown == 10.0
    assert df.count() == 57


def test_leak_free_window(spark):
    df = marts.mart_demand_features(spark.createDataFrame(_series(6), STG), leak_free=True)
    r = {x.weekly_sales: x for x in df.collect()}
    assert r[5.0].rolling_4wk_avg == 2.5 and r[1.0].rolling_4wk_avg is None


def test_inventory_risk_division_and_filters(spark):
    rows = [_row(1, 1, dt.date(2010, 1, 1), 5.0)]  # one row: NULL stddev
    rows += [_row(1, 2, dt.date(2010, 1, d), v) for d, v in [(1, 1.0), (8, -1.0)]]  # mean 0
    rows += [_row(1, 3, dt.date(2010, 1, d), v) for d, v in [(1, 0.004), (8, 0.004)]]  # mean rounds to 0
    rows += [_row(1, 4, dt.date(2010, 1, d), v) for d, v in [(1, 10.0), (8, 30.0)]]  # cv of rounded stats: 14.14 / 20
    out = {r.dept_id: r for r in marts.mart_inventory_risk(spark.createDataFrame(rows, STG)).collect()}
    assert set(out) == {1, 4}
    assert out[1].stddev_weekly_sales is None and out[1].coeff_of_variation is None
    assert out[1].demand_risk_tier == "LOW"
    assert out[4].coeff_of_variation == 0.707 and out[4].demand_risk_tier == "HIGH"


def test_store_features_distincts(spark):
    rows = _series(4) + _series(4, dept=2)
    rows[0] = _row(1, 1, rows[0][2], 1.0, hol=True)
    out = marts.mart_store_features(spark.createDataFrame(rows, STG)).first()
    assert out.num_weeks == 4 and out.num_depts == 2
    assert out.avg_holiday_sales == 1.0 and out.avg_weekly_sales == 2.5 and out.total_sales == 20.0


DAILY = ("store_id long, sale_date date, daily_sales long, is_promo long, store_type string, "
         "assortment string, competition_distance double")


def test_promotion_lift(spark):
    d = dt.date(2015, 1, 1)
    rows = [(1, d, 100, 1, "a", "a", 10.0), (1, d, 50, 0, "a", "a", 10.0),  # +100 %
            (2, d, 80, 1, "b", "a", None),  # only promo days -> NULL lift, NULL group key kept
            (3, d, 10, 1, "c", "a", 5.0), (3, d, 0, 0, "c", "a", 5.0)]  # base 0 -> NULL
    out = {r.store_id: r for r in marts.mart_promotion_lift(spark.createDataFrame(rows, DAILY)).collect()}
    assert out[1].promo_lift_pct == 100.0 and out[1].promo_days == 1 and out[1].non_promo_days == 1
    assert out[2].promo_lift_pct is None and out[2].competition_distance is None
    assert out[3].promo_lift_pct is None and out[3].total_sales == 10.0


def test_calendar_lag_leaves_gaps(spark):
    d0 = dt.date(2012, 1, 2)
    rows = [(1, 1, d0 + dt.timedelta(days=7 * i), float(i)) for i in (0, 1, 3, 4)]
    df = spark.createDataFrame(rows, "store_id long, dept_id long, sale_date date, weekly_sales double")
    got = df.select("weekly_sales", marts.lag_weeks("weekly_sales", 1).alias("x"),
                    marts.lag_rows("weekly_sales", 1).alias("y")).orderBy("weekly_sales").collect()
    assert [(r.x, r.y) for r in got] == [(None, None), (0.0, 0.0), (None, 1.0), (3.0, 3.0)]


def _stg(spark, rows):
    return spark.createDataFrame([(*r, False, "A", 1, 1.0, 1.0, None, 0.0, -1.0, 2.0, 3.5, 1.0, 1.0) for r in rows], STG)


def test_week_by_week_refresh_equals_the_rebuild(spark, tmp_path):
    day = lambda w: dt.date(2010, 1, 3) + dt.timedelta(days=7 * w)
    # a gap, a series that ends and one that starts late
    rows = [(s, d, day(w), float(10 * s + d + w % 7)) for s, d, a, b in ((1, 1, 0, 70), (1, 2, 0, 60), (2, 1, 58, 70))
            for w in range(a, b) if (s, d, w) != (1, 1, 20)]
    whole = marts.mart_demand_features(_stg(spark, rows))
    mart, tails = str(tmp_path / "mart"), str(tmp_path / "tails")
    for a, b in ((0, 56), *((w, w + 1) for w in range(56, 62)), (62, 70)):
        batch = _stg(spark, [r for r in rows if day(a) <= r[2] < day(b)])
        builds.refresh_run(spark, mart, tails, f"w{b}", batch)
        builds.refresh_run(spark, mart, tails, f"w{b}", batch)  # repeated: nothing changes
    got = committed.read(spark, mart, whole.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and len(rows) == got.count()


def test_refresh_after_a_run_that_broke_off(spark, tmp_path):
    """The tail was committed, the mart was not: the run is repeated from the
    tail that belongs to the mart's last run."""
    day = lambda w: dt.date(2010, 1, 3) + dt.timedelta(days=7 * w)
    rows = [(1, 1, day(w), float(w)) for w in range(6)]
    mart, tails = str(tmp_path / "mart"), str(tmp_path / "tails")
    builds.refresh_run(spark, mart, tails, "a", _stg(spark, rows[:3]))
    first = marts.series_tail(_stg(spark, rows[:3]))
    new = marts.refresh_demand_features(first, _stg(spark, rows[3:]))
    committed.write(new.tail, tails, "b", "overwrite")
    builds.refresh_run(spark, mart, tails, "b", _stg(spark, rows[3:]))
    whole = marts.mart_demand_features(_stg(spark, rows))
    assert sorted(map(str, committed.read(spark, mart, whole.schema).collect())) == sorted(map(str, whole.collect()))


def test_late_arrivals_are_told_apart(spark):
    tail = _stg(spark, [(1, 1, dt.date(2010, 2, 7), 5.0)])
    new = marts.refresh_demand_features(tail, _stg(spark, [(1, 1, dt.date(2010, 1, 3), 1.0), (1, 1, dt.date(2010, 2, 14), 2.0),
                                                           (2, 1, dt.date(2010, 1, 3), 3.0)]))
    assert sorted((r.store_id, r.weekly_sales, r.sales_lag_1wk) for r in new.rows.collect()) == [(1, 2.0, 5.0), (2, 3.0, None)]
    assert [r.weekly_sales for r in new.late.collect()] == [1.0] and new.tail.count() == 3
    plan = new.rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_a_refresh_sorts_each_series_once(spark, tmp_path):
    """windows over the series in date order share one exchange and sort,
    and the tail holds what lags and means read."""
    day = lambda w: dt.date(2010, 1, 3) + dt.timedelta(days=7 * w)
    _stg(spark, [(1, 1, day(w), float(w)) for w in range(60)] + [(None, 2, None, 1.0)]).write.parquet(str(tmp_path / "old"))
    _stg(spark, [(1, 1, day(60), 60.0), (1, 1, day(60), 61.0), (1, 1, day(3), 9.0)]).write.parquet(str(tmp_path / "new"))
    old, new = (spark.read.parquet(str(tmp_path / p)) for p in ("old", "new"))
    got = marts.refresh_demand_features(marts.series_tail(old), new)
    for df in (got.rows, got.tail):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Union")[0].count("Sort [") == 1 and plan.split("Union")[0].count("Exchange hashpartitioning") == 1
    assert got.tail.columns == list(marts.TAIL_COLUMNS)
    assert sorted(r.sales_lag_52wk for r in got.rows.collect()) == [8.0, 9.0]
    assert sorted(r.weekly_sales for r in got.tail.where("store_id = 1").collect()) == [float(w) for w in range(10, 62)]
    assert got.late.columns == new.columns and [r.weekly_sales for r in got.late.collect()] == [9.0]
