"""The page of a store and model: head, by-date lines with actuals, departments."""

from datetime import date, datetime

from sparkretail.operators import serving

EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 1, 8)
D1, D2 = date(2024, 2, 5), date(2024, 2, 12)


def page(spark):
    table = spark.createDataFrame(
        [("r1", EARLY, 1, 1, D1, 99.0, 98.0, 100.0, "lag52"),
         *[("r2", LATE, 1, dept, ds, y, y - 1, y + 1, "lag52") for dept, ds, y in ((1, D1, 10.4), (2, D1, 20.2), (1, D2, 7.0))],
         ("r2", LATE, 1, -1, D1, 50.0, 40.0, 60.0, "seasonal"), ("r2", LATE, 2, 1, D1, 5.0, 4.0, 6.0, "lag52")],
        "run_id string, run_ts timestamp, store_id bigint, dept_id bigint, ds date, yhat double, yhat_lower double, "
        "yhat_upper double, model string")
    risk = spark.createDataFrame(
        [(1, d, "A", 100.0 * d, 1.0, None if d == 12 else 0.1 * d, "HIGH" if d > 5 else "LOW") for d in range(1, 13)],
        "store_id bigint, dept_id bigint, store_type string, avg_weekly_sales double, stddev_weekly_sales double, "
        "coeff_of_variation double, demand_risk_tier string")
    actuals = spark.createDataFrame([(1, 1, D1, 11.0), (1, 2, D1, 10.0), (1, 2, D1, 9.5), (1, -1, D1, 44.0), (1, 1, date(2024, 3, 4), 3.0)],
                                    "store_id bigint, dept_id bigint, ds date, actual double")
    return serving.dashboard(table, risk, actuals).collect()


def test_every_line_has_the_head_of_its_page(spark):
    rows = page(spark)
    lag = [r for r in rows if (r.store_id, r.model) == (1, "lag52")]
    assert {(r.forecast_rows, r.forecast_dates, r.first_date, r.last_date, r.run_id) for r in lag} == {(3, 2, D1, D2, "r2")}
    assert {(r.high, r.medium, r.low, r.pct_high, r.pct_low) for r in lag} == {(7, 0, 5, 58.0, 42.0)}
    assert len({(r.store_id, r.model, r.kind, r.position) for r in rows}) == len(rows) == 12 + 11 + 1


def test_dates_are_rolled_up_and_meet_their_actuals(spark):
    got = {(r.store_id, r.model, r.position): (r.ds, r.yhat, r.yhat_lower, r.yhat_upper, r.actual)
           for r in page(spark) if r.kind == "date"}
    # two actuals of one key are summed and count the forecast once; a date without any has none
    assert got == {(1, "lag52", 1): (D1, 31.0, 29.0, 33.0, 31.0), (1, "lag52", 2): (D2, 7.0, 6.0, 8.0, None),
                   (1, "seasonal", 1): (D1, 50.0, 40.0, 60.0, 44.0), (2, "lag52", 1): (D1, 5.0, 4.0, 6.0, None)}


def test_the_ten_most_volatile_departments(spark):
    rows = [r for r in page(spark) if r.kind == "department"]
    assert {r.store_id for r in rows} == {1} and {r.model for r in rows} == {"lag52", "seasonal"}
    assert sorted((r.position, r.dept_id) for r in rows if r.model == "seasonal") == [(i, 12 - i) for i in range(1, 11)]
    assert all(r.avg_weekly_sales == 100.0 * r.dept_id and r.demand_risk_tier for r in rows)
