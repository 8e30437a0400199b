import pytest

from sparkretail.operators import quality


def test_checks_min_max_exact(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 6.0)], "Store long, Weekly_Sales double")
    checks = [quality.Check("rows", "min", 3, "rows"), quality.Check("nulls", "max", 0, "nulls", "Weekly_Sales"),
              quality.Check("exact", "exact", 2, "rows"), quality.Check("distinct", "min", 3, "distinct", "Store")]
    res = {r.check_name: r for r in quality.evaluate(df, checks).collect()}
    assert res["rows"].passed and not res["nulls"].passed and not res["exact"].passed
    assert res["distinct"].observed == 3 and res["distinct"].passed
    with pytest.raises(ValueError, match=r"nulls\]: 1 > 0"):
        quality.assert_passed(quality.evaluate(df, checks))


def test_not_null_and_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "store_id long, x string")
    nn = {r.column_name: r for r in quality.not_null(df, "m", ["store_id", "x"]).collect()}
    assert nn["store_id"].passed and nn["x"].failing_rows == 1
    u = quality.unique(df, "m", "store_id").first()
    assert u.failing_rows == 1 and not u.passed
