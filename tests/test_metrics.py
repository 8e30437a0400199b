import datetime as dt

from sparkretail.operators import forecast, metrics


def _store_week(spark, n, store):
    d0 = dt.date(2010, 2, 5)
    rows = [(store, d0 + dt.timedelta(days=7 * i), 100.0 + i, 1 if i % 13 == 0 else 0)
            for i in range(n)]
    return spark.createDataFrame(rows, "store_id long, ds date, y double, is_holiday int")


def test_holdout_tail_min_history(spark):
    sw = _store_week(spark, 51, 1).unionByName(_store_week(spark, 52, 2))
    h = metrics.holdout_tail(sw)
    assert {r.store_id for r in h.collect()} == {2}
    assert h.where("is_holdout").count() == 12


def test_wmae_weights(spark):
    df = spark.createDataFrame([(10.0, 8.0, 1), (10.0, 9.0, 0)], "a double, p double, h int")
    assert df.agg(metrics.wmae("a", "p", "h").alias("w")).first().w == (5 * 2 + 1) / 6


def _features(spark, dates):
    return spark.createDataFrame(
        [(1, 1, d, 1000.0 + 10 * i, int(i % 13 == 0)) for i, d in enumerate(dates)],
        "store_id long, dept_id long, sale_date date, weekly_sales double, is_holiday int")


def _weeks(n, start=dt.date(2010, 2, 5)):
    return [start + dt.timedelta(days=7 * i) for i in range(n)]


def test_holdout_pairs_by_date_and_by_position(spark):
    regular = forecast.holdout_pairs(forecast.seasonal_frame(_features(spark, _weeks(80)))).collect()
    assert len(regular) == 12
    # one week missing in the holdout: its dates run past the forecast's, so pairs go by position
    gap = forecast.seasonal_frame(_features(spark, [d for i, d in enumerate(_weeks(81)) if i != 75]))
    fut = {r.step: r.yhat for r in gap.where("kind = 'future'").collect()}
    hold = {r.ds: r.step for r in gap.where("kind = 'holdout'").collect()}
    pairs = forecast.holdout_pairs(gap).collect()
    assert len(pairs) == 12 and all(r.predicted == fut[hold[r.ds]] for r in pairs)


def test_seasonal_backtest_shapes(spark):
    frame = forecast.seasonal_frame(_features(spark, _weeks(80)))
    fut = frame.where("kind = 'future'").orderBy("step").collect()
    assert [r.ds for r in fut] == _weeks(80)[68:]  # the series' own weekday, on the holdout dates
    assert fut[0].ds > dt.date(2010, 2, 5) + dt.timedelta(days=7 * 67)
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in fut)
    scores = forecast.store_scores(frame).collect()
    assert len(scores) == 1 and scores[0].wmae >= 0


def test_forecast_ahead_follows_the_data(spark):
    frame = forecast.seasonal_frame(_features(spark, _weeks(80)), horizon_from="data_end")
    fut = frame.where("kind = 'future'").orderBy("step").collect()
    assert [r.ds for r in fut] == _weeks(92)[80:] and frame.where("kind = 'train'").count() == 80
