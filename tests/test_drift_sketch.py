import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkretail.operators import drift, drift_sketch
from sparkretail.sources import committed

DAY = dt.date(2012, 1, 2)


@pytest.fixture(scope="module")
def rows(spark):
    """Twenty weeks: a smooth feature, one full of ties, one that shifts."""
    rnd = random.Random(3)
    out = []
    for i in range(20_000):
        w = i % 20
        smooth = rnd.gauss(100, 15)
        ties = float(rnd.choice([0, 0, 0, 0, 1, 2, 5])) if w < 16 else float(rnd.choice([0, 0, 1, 2, 5, 5]))
        shifted = rnd.expovariate(1.0) * (1 if w < 16 else 1.6)
        out.append((DAY + dt.timedelta(days=7 * w + i % 7), smooth, ties, None if i % 50 == 0 else shifted, w >= 16))
    return spark.createDataFrame(out, "sale_date date, smooth double, ties double, shifted double, is_recent boolean")


FEATURES = ["smooth", "ties", "shifted"]


def test_rank_error_is_bounded(spark, rows):
    sketches = drift_sketch.sketch_periods(rows, FEATURES)
    one = drift_sketch.merged(sketches).where("feature = 'smooth'")
    got = one.select(*[F.kll_sketch_get_quantile_double("sketch", F.lit(i / 20)).alias(f"q{i}") for i in range(1, 20)]).first()
    values = np.sort([r.smooth for r in rows.select("smooth").collect()])
    ranks = [np.searchsorted(values, got[f"q{i}"], "right") / len(values) - i / 20 for i in range(1, 20)]
    assert max(map(abs, ranks)) < 0.006


def test_near_the_exact_report(spark, rows):
    exact = {r.feature: r.psi for r in drift.psi_numeric(rows, FEATURES).collect()}
    sketch = lambda c: drift_sketch.sketch_periods(rows.where(c), FEATURES)
    got = {r.feature: r.psi for r in drift_sketch.psi_numeric(sketch("not is_recent"), sketch("is_recent")).collect()}
    assert set(got) == set(exact) and all(abs(got[f] - exact[f]) < 0.01 for f in exact)
    assert got["shifted"] > 0.1 > got["smooth"]


def test_a_daily_run_reads_new_rows_only(spark, rows, tmp_path):
    """Periods are sketched once as they arrive; their runs merge to what one
    pass over all rows gives."""
    path = str(tmp_path / "sketches")
    for w in range(16):
        week = rows.where(F.col("sale_date").between(DAY + dt.timedelta(days=7 * w), DAY + dt.timedelta(days=7 * w + 6)))
        committed.write(drift_sketch.sketch_periods(week, FEATURES), path, f"w{w}")
    base = committed.read(spark, path, drift_sketch.SKETCH_STRUCT)
    assert base.count() == 16 * 3 and base.agg(F.sum("n")).first()[0] == rows.where("not is_recent").select(
        *[F.count(c).alias(c) for c in FEATURES]).select(sum(F.col(c) for c in FEATURES)).first()[0]
    recent = drift_sketch.sketch_periods(rows.where("is_recent"), FEATURES)
    got = {r.feature: r.psi for r in drift_sketch.psi_numeric(base, recent).collect()}
    exact = {r.feature: r.psi for r in drift.psi_numeric(rows, FEATURES).collect()}
    assert all(abs(got[f] - exact[f]) < 0.01 for f in exact)


def test_edges(spark, rows):
    empty = drift_sketch.sketch_periods(rows.where("false"), FEATURES)
    some = drift_sketch.sketch_periods(rows.where("is_recent"), FEATURES)
    assert drift_sketch.psi_numeric(empty, some).count() == 0 and drift_sketch.psi_numeric(some, empty).count() == 0
    flat = drift_sketch.sketch_periods(rows.withColumn("smooth", F.lit(4.0)), ["smooth"])
    assert [r.psi for r in drift_sketch.psi_numeric(flat, flat).collect()] == [0.0]


def test_rows_are_not_multiplied_by_features(spark):
    """what is sorted for the sketches has a row per row of the input;
    NULL, NaN and features without values of a week leave no trace."""
    nan = float("nan")
    own = spark.createDataFrame([(DAY, 1.0, None), (DAY, nan, None), (DAY + dt.timedelta(days=7), 3.0, 4.0), (None, None, 5.0)],
                                "sale_date date, a double, b double")
    got = drift_sketch.sketch_periods(own, ["a", "b", "c"])
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.feature, r.n, r.low, r.top, r.period is None) for r in got.collect()) == [
        ("a", 1, 1.0, 1.0, False), ("a", 1, 3.0, 3.0, False), ("b", 1, 4.0, 4.0, False), ("b", 1, 5.0, 5.0, True)]
    assert got.schema.names == drift_sketch.SKETCH_STRUCT.names
