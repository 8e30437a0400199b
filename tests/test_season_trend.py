import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkretail.operators import forecast, season_trend
from sparkretail.operators.metrics import exact_wmae

D0 = dt.date(2010, 2, 5)


def series(n, start_level, slopes, noise, rng, season=0.0, holiday=0.0):
    """Log of n weekly totals: slope changes at (week, new slope), a yearly wave."""
    level, slope, out = math.log(start_level), 0.0, []
    changes = dict(slopes)
    for i in range(n):
        slope = changes.get(i, slope)
        level += slope
        day = (D0 + dt.timedelta(days=7 * i) - dt.date(1970, 1, 1)).days
        mu = level + season * math.sin(2 * math.pi * day / 365.25) + (holiday if i % 13 == 0 else 0)
        out.append(math.exp(mu + noise * rng.normal()))
    return out


def features(spark, stores):
    rows = [(s, 1, D0 + dt.timedelta(days=7 * i), round(float(v), 2), int(i % 13 == 0))
            for s, ys in stores.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "store_id long, dept_id long, sale_date date, weekly_sales double, is_holiday int")


@pytest.fixture(scope="module")
def broken():
    """Growth that turns into decline at week 90 of 160, with season and holidays."""
    rng = np.random.default_rng(4)
    return {1: series(160, 5000, [(0, 0.012), (90, -0.015)], 0.03, rng, 0.25, 0.3), 2: series(160, 800, [(0, 0.0)], 0.05, rng)}


def test_weights_equal_a_dense_solution(spark, broken):
    designed = season_trend.design(forecast.history_and_future(features(spark, broken)))
    got = {r.store_id: np.array(r.weights) for r in season_trend.solve(season_trend.gram(designed)).collect()}
    rows = designed.where("kind = 'train'").collect()
    names, penalty = season_trend.column_names(), np.diag(season_trend.Priors().penalties())
    assert len(names) == len(penalty) == 48
    for s in broken:
        x = np.array([[r[c] for c in names] for r in rows if r.store_id == s]) / 1e6
        y = np.array([r["log_y"] for r in rows if r.store_id == s]) / 1e6
        bend = np.diff(y, 2)
        noise = max((bend ** 2).sum() / 6 / len(bend), 1e-4)
        want = np.linalg.solve(x.T @ x + noise * penalty, x.T @ y)
        assert np.allclose(got[s], want, rtol=1e-6, atol=1e-8)
        assert x[:, 1].min() == 0 and x[:, 1].max() == 1 and np.allclose(x[:, 2], np.maximum(x[:, 1] - 0.032, 0), atol=1e-6)


def test_gram_is_exact_in_any_order(spark, broken):
    frame = forecast.history_and_future(features(spark, broken))
    a = sorted(map(str, season_trend.gram(season_trend.design(frame)).collect()))
    b = sorted(map(str, season_trend.gram(season_trend.design(frame.repartition(5).orderBy(F.desc("ds")))).collect()))
    assert a == b


def test_a_known_break_is_followed(spark, broken):
    """Holdout error well below that of one straight line."""
    data = features(spark, broken)
    new, line = season_trend.changepoint_frame(data), forecast.seasonal_frame(data)

    def error(frame):
        pairs = forecast.holdout_pairs(frame)
        return {r.store_id: r.e for r in pairs.groupBy("store_id").agg(exact_wmae("actual", "predicted", "is_holiday").alias("e")).collect()}

    a, b = error(new), error(line)
    assert a[1] < 0.5 * b[1] and a[2] < 1.3 * b[2]
    rows = new.where("kind = 'future'").orderBy("store_id", "step").collect()
    assert [r.step for r in rows] == [*range(1, 13)] * 2 and rows[0].ds == D0 + dt.timedelta(days=7 * 148)


def test_band(spark):
    """Draws of the model's own kind: about 80 % fall into the band, which
    widens; reruns agree."""
    rng, stores = np.random.default_rng(9), {}
    for s in range(120):
        slopes, slope = [], rng.normal() * 0.003
        for i in range(160):  # at the model's places, and at their rate after the end of the training period
            if i == 0 or (i < 0.8 * 148 and i % 5 == 0) or (i >= 148 and rng.random() < 25 / 148):
                slope += rng.laplace() * 0.1 / 147
                slopes.append((i, slope))
        stores[s] = series(160, 2000, slopes, 0.03, rng, 0.2)
    data = features(spark, stores)
    rows = season_trend.changepoint_forecast(data).collect()
    assert sorted(map(str, rows)) == sorted(map(str, season_trend.changepoint_forecast(data).collect()))
    inside = [r.yhat_lower <= stores[r.store_id][147 + r.step] <= r.yhat_upper for r in rows]
    assert len(inside) == 120 * 12 and abs(np.mean(inside) - 0.8) <= 0.05
    width = [np.mean([math.log(r.yhat_upper / r.yhat_lower) for r in rows if r.step == k]) for k in range(1, 13)]
    assert width[11] > 1.02 * width[0] and sum(b > a for a, b in zip(width, width[1:])) >= 9
    assert all(r.yhat_lower < r.yhat < r.yhat_upper for r in rows)


def test_sunday_anchor(spark, broken):
    frame = forecast.seasonal_frame(features(spark, broken), anchor="sunday")
    future = [r.ds for r in frame.where("kind = 'future' and store_id = 1").orderBy("step").collect()]
    assert all(d.weekday() == 6 for d in future) and future[0] == D0 + dt.timedelta(days=7 * 147 + 2)
    pairs = forecast.holdout_pairs(frame).where("store_id = 1").orderBy("ds").collect()
    yhat = [r.yhat for r in frame.where("kind = 'future' and store_id = 1").orderBy("step").collect()]
    assert [r.predicted for r in pairs] == yhat
    with pytest.raises(ValueError):
        forecast.seasonal_frame(features(spark, broken), anchor="monday")


def test_no_python_and_one_exchange_of_the_rows(spark, broken):
    data = features(spark, broken)
    plan = season_trend.changepoint_frame(data)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Broadcast" not in plan.replace("BroadcastHint", "")


def test_the_band_fits_once(spark, broken):
    """One fit serves the future rows and their band, and each draw's hashes are computed once."""
    plan = season_trend.changepoint_forecast(features(spark, broken))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate posexplode") == 1
    assert plan.count("xxhash64(") == 4


def test_edges(spark):
    assert season_trend.changepoint_frame(features(spark, {1: [10.0] * 51})).count() == 0
    rows = season_trend.changepoint_forecast(features(spark, {1: [10.0] * 52, 2: [0.01] * 60})).collect()
    assert len(rows) == 24 and all(math.isfinite(r.yhat) and r.yhat > 0 for r in rows if r.store_id == 1)
