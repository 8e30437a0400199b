import datetime as dt

from sparkretail.operators import forecast_table as ft
from sparkretail.operators import serving

OUT = "store_id long, ds date, yhat double, yhat_lower double, yhat_upper double, model string"


def test_default_dept_latest_run_and_case(spark):
    d = dt.date(2012, 1, 1)
    store_level = spark.createDataFrame([(1, d, 10.123, 9.0, 11.0, "Seasonal")], OUT)
    dept_level = spark.createDataFrame([(1, 5, d, 3.0, 2.7, 3.3, "gbt")],
                                       "store_id long, dept_id long, ds date, yhat double, "
                                       "yhat_lower double, yhat_upper double, model string")
    u = ft.union_models([store_level, dept_level])
    assert sorted(r.dept_id for r in u.collect()) == [-1, 5]
    old = ft.stamp(u, "r1", dt.datetime(2024, 1, 1))
    new = ft.stamp(u, "r2", dt.datetime(2024, 2, 1))
    table = old.unionByName(new)
    rows = serving.serve_forecast(table, 1, "SEASONAL").collect()
    assert [r.run_id for r in rows] == ["r2"] and rows[0].forecast_sales == 10.12
    assert serving.serve_forecast(table, 99, "gbt").count() == 0  # not found -> empty
    assert serving.latest_runs(table).count() == 2


def test_append_and_read(spark, tmp_path):
    d = dt.date(2012, 1, 1)
    out = ft.with_default_dept(spark.createDataFrame([(1, d, 1.0, 0.9, 1.1, "seasonal")], OUT))
    path = str(tmp_path / "fc")
    ft.append_run(ft.stamp(out, "a", dt.datetime(2024, 1, 1)), path, "a")
    ft.append_run(ft.stamp(out, "b", dt.datetime(2024, 1, 2)), path, "b")
    t = ft.read_table(spark, path)
    assert t.count() == 2 and t.columns == ft.FORECAST_SCHEMA.fieldNames()


def test_union_requires_input():
    import pytest
    with pytest.raises(FileNotFoundError):
        ft.union_models([])
