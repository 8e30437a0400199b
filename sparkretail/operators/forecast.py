"""Forecasters, evaluated as backtests on the last weeks of each series.

``seasonal_backtest`` is the per-store forecaster re-expressed in closed form
(SURVEY §7.4): per store a linear trend, a multiplicative week-of-year
season, a multiplicative holiday factor and an 80 % band from the training
residuals. Every store is fitted at once with window aggregates partitioned
by ``store_id`` (one exchange), never in a loop over stores; a store's
partition holds one row per week.

``gbt_backtest`` trains one global model of Spark ML boosted trees on the
feature mart (the trees are built by the executors), moves their leaves to least
absolute error and scores the last 12 weeks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkretail.functions.scalar import (clip_at_zero, encode_store_type, round_half_away,
                                          week_sunday)
from sparkretail.operators import trees
from sparkretail.operators.metrics import (FORECAST_HORIZON, MIN_HISTORY, exact_wmae, holdout_tail,
                                           restrict_to_first, store_week, wmae)
from sparkretail.session import BUCKET_ROWS, checkpoint_dir, materialize

BAND_Z = 1.2816  # two-sided 80 % normal band
FORECAST_COLUMNS = ["store_id", "dept_id", "ds", "yhat", "yhat_lower", "yhat_upper", "model"]


def season_week(ds) -> F.Column:
    """Sunday week number with the partial weeks 0 and 53 merged into 52."""
    w = week_sunday(ds)
    return F.when(w.isin(0, 53), F.lit(52)).otherwise(w)


def with_calendar(series: DataFrame, is_holiday: Column) -> DataFrame:
    """Adds ``in_calendar``: a holiday of the store falls on the row's date or
    the day before. A range window over the store, no join."""
    day = F.datediff("ds", F.lit("1970-01-01").cast("date"))
    covered = Window.partitionBy("store_id").orderBy(day).rangeBetween(-1, 0)
    return series.withColumn("in_calendar", F.coalesce(F.max(is_holiday).over(covered) == 1, F.lit(False)))


def history_and_future(features: DataFrame, horizon: int = FORECAST_HORIZON,
                       min_weeks: int = MIN_HISTORY, max_stores: int | None = None,
                       horizon_from: str = "training_end", anchor: str = "own") -> DataFrame:
    """Store totals per week and the ``horizon`` rows to forecast: store_id,
    ds, kind ('train' | 'holdout' | 'future'), step (1..h for holdout and future
    rows), y, is_holiday, in_calendar.

    Future rows follow the last training row (``horizon_from="training_end"``,
    the backtest) or the last row of the whole history (``"data_end"``, the
    forecast ahead). They fall on the series' own weekday (``anchor="own"``) or
    on the Sundays after that row (``"sunday"``).
    """
    sw = restrict_to_first(store_week(features), "store_id", max_stores)
    h = holdout_tail(sw, horizon=horizon, min_rows=min_weeks)
    if horizon_from not in ("training_end", "data_end"):
        raise ValueError(f"unknown horizon_from {horizon_from!r}")
    if anchor not in ("own", "sunday"):
        raise ValueError(f"unknown anchor {anchor!r}")
    ahead = horizon_from == "data_end"
    if ahead:
        h = h.withColumn("is_holdout", F.lit(False))
    last = F.col("n_rows") - (0 if ahead else horizon)
    # History rows and the future dates hanging off each store's last training
    # row come out of one generator over ``h``: a single pass, no union.
    is_hold = F.col("is_holdout")
    this_row = F.struct(F.col("ds").alias("ds"), F.col("y").cast("double").alias("y"),
                        F.col("is_holiday").cast("int").alias("is_holiday"),
                        F.when(is_hold, "holdout").otherwise("train").alias("kind"),
                        F.when(is_hold, F.col("pos") - last)
                        .cast("bigint").alias("step"))
    first = F.date_add(F.col("ds"), 7) if anchor == "own" else F.next_day(F.col("ds"), "Sun")
    future_rows = F.transform(
        F.sequence(F.lit(0), F.lit(horizon - 1)),
        lambda k: F.struct(F.date_add(first, k * 7).alias("ds"),
                           F.lit(None).cast("double").alias("y"),
                           F.lit(0).alias("is_holiday"), F.lit("future").alias("kind"),
                           (k + 1).cast("bigint").alias("step")))
    rows = F.when(F.col("pos") == last,
                  F.concat(F.array(this_row), future_rows)).otherwise(F.array(this_row))
    frame = h.select("store_id", F.inline(rows))
    return with_calendar(frame, F.when(F.col("kind") != "future", F.col("is_holiday")))


def seasonal_frame(features: DataFrame, horizon: int = FORECAST_HORIZON,
                   min_weeks: int = MIN_HISTORY, z: float = BAND_Z,
                   max_stores: int | None = None,
                   horizon_from: str = "training_end", anchor: str = "own") -> DataFrame:
    """``history_and_future`` with the fitted components: store_id, ds, kind,
    step, y, is_holiday, yhat, yhat_lower, yhat_upper."""
    frame = history_and_future(features, horizon, min_weeks, max_stores, horizon_from, anchor)
    store = Window.partitionBy("store_id")
    store_week_w = Window.partitionBy("store_id", "woy")
    is_train = F.col("kind") == "train"
    frame = (frame
             .withColumn("woy", season_week("ds"))
             .withColumn("t", F.datediff("ds", F.min("ds").over(store)) / F.lit(7.0))
             .withColumn("y_train", F.when(is_train, F.col("y")))
             .withColumn("b0", F.regr_intercept("y_train", "t").over(store))
             .withColumn("b1", F.regr_slope("y_train", "t").over(store))
             .withColumn("trend", F.col("b0") + F.col("b1") * F.col("t"))
             .withColumn("ratio", F.try_divide(F.col("y_train"), F.col("trend")))
             .withColumn("season", F.coalesce(
                 F.avg(F.when(~F.col("in_calendar"), F.col("ratio"))).over(store_week_w),
                 F.lit(1.0)))
             .withColumn("holiday_factor", F.coalesce(
                 F.avg(F.when(F.col("in_calendar"),
                              F.try_divide(F.col("ratio"), F.col("season")))).over(store),
                 F.lit(1.0)))
             .withColumn("yhat", F.col("trend") * F.col("season")
                         * F.when(F.col("in_calendar"), F.col("holiday_factor")).otherwise(1.0))
             .withColumn("resid_sd", F.coalesce(
                 F.stddev_samp(F.when(is_train, F.col("y") - F.col("yhat"))).over(store),
                 F.lit(0.0)))
             .withColumn("yhat_lower", F.col("yhat") - F.lit(z) * F.col("resid_sd"))
             .withColumn("yhat_upper", F.col("yhat") + F.lit(z) * F.col("resid_sd")))
    # forecasts in cents: the fitted values carry summation-order noise in
    # their last bits, rounding makes them reproducible across engines
    return frame.select("store_id", "ds", "kind", "step", "y", "is_holiday",
                        *[round_half_away(c, 2).alias(c) for c in ("yhat", "yhat_lower",
                                                                   "yhat_upper")])


def seasonal_forecast(frame: DataFrame, model_name: str = "seasonal") -> DataFrame:
    """The future rows in the forecast-table layout (store level: dept_id -1
    is added by ``forecast_table.with_default_dept``)."""
    return (frame.where(F.col("kind") == "future")
            .select("store_id", "ds", "yhat", "yhat_lower", "yhat_upper",
                    F.lit(model_name).alias("model")))


def holdout_pairs(frame: DataFrame) -> DataFrame:
    """Pair each holdout actual with a prediction: by date when every holdout
    date of the store has a future row on the same date, else by position
    (step i of the holdout with step i of the future). Windows over the
    frame's own store_id partitioning; no self-join."""
    fut = F.col("kind") == "future"
    hold = F.col("kind") == "holdout"
    by_date = Window.partitionBy("store_id", "ds")
    by_step = Window.partitionBy("store_id", "step")
    store = Window.partitionBy("store_id")
    out = (frame.where(fut | hold)
           .withColumn("date_pred", F.max(F.when(fut, F.col("yhat"))).over(by_date))
           .withColumn("date_hit", F.max(F.when(fut, F.lit(1))).over(by_date))
           .withColumn("step_pred", F.max(F.when(fut, F.col("yhat"))).over(by_step))
           .withColumn("all_dates", F.min(F.when(hold, F.coalesce(F.col("date_hit"), F.lit(0))))
                       .over(store) == 1)
           .where(hold))
    pred = F.when(F.col("all_dates"), F.col("date_pred")).otherwise(F.col("step_pred"))
    return out.select("store_id", "ds", F.col("y").alias("actual"), "is_holiday",
                      pred.alias("predicted")).where(F.col("predicted").isNotNull())


def store_scores(frame: DataFrame) -> DataFrame:
    """(store_id, wmae) over the holdout."""
    return (holdout_pairs(frame).groupBy("store_id")
            .agg(round_half_away(exact_wmae("actual", "predicted", "is_holiday"), 2).alias("wmae")))


# ------------------------------------------------------------------ GBT
# The global model's feature list and target.
GBT_FEATURES = ["store_id", "dept_id", "year", "month", "week_of_year", "quarter", "is_holiday",
                "is_holiday_season", "store_size", "has_markdown1", "has_markdown2",
                "has_markdown3", "has_markdown4", "has_markdown5", "total_markdown",
                "sales_lag_1wk", "sales_lag_4wk", "sales_lag_52wk", "rolling_4wk_avg",
                "rolling_13wk_avg"]
TARGET = "weekly_sales"
REQUIRED_LAGS = ["sales_lag_1wk", "sales_lag_4wk", "rolling_4wk_avg"]
MISSING_SENTINEL = -1.0


def gbt_dataset(features: DataFrame, horizon: int = FORECAST_HORIZON,
                validation_weeks: int = FORECAST_HORIZON) -> tuple[DataFrame, list[str]]:
    """Encoded, NULL-imputed rows with ``is_test`` / ``is_valid`` flags and
    ``label = log1p(target)``.

    Spark trees reject NULL/NaN: each nullable feature becomes
    ``coalesce(x, -1)`` plus an ``x_missing`` indicator. The validation slice
    for early stopping is the tail of the *training* period, so the holdout
    stays unseen.
    """
    from sparkretail.operators.metrics import with_cutoff

    df = features.withColumn("store_type", encode_store_type("store_type")) \
        .dropna(subset=REQUIRED_LAGS)
    df = with_cutoff(df, "sale_date", horizon)
    df = (df.withColumn("is_test", F.col("sale_date") > F.col("cutoff_date"))
          .withColumn("is_valid", (~F.col("is_test")) & (
              F.col("sale_date") > F.date_sub("cutoff_date", 7 * validation_weeks))))
    present = [c for c in GBT_FEATURES if c in df.columns]
    nullable = [c for c in ("sales_lag_52wk", "store_size") if c in present]
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(MISSING_SENTINEL)).alias(f"f_{c}") for c in present]
    cols += [F.col(c).isNull().cast("double").alias(f"f_{c}_missing") for c in nullable]
    names = [f"f_{c}" for c in present] + [f"f_{c}_missing" for c in nullable]
    out = df.select("store_id", "dept_id", "sale_date", "is_holiday", TARGET, "is_test",
                    "is_valid", F.log1p(F.greatest(F.col(TARGET), F.lit(0.0))).alias("label"), *cols)
    return out, names


@dataclass
class BoostedTrees:
    """A fitted backtest: holdout rows, node table, split counts, the rounds."""

    backtest: DataFrame
    nodes: DataFrame
    importances: DataFrame
    rounds: int
    losses: list[float]
    errors: list[float]  # validation error after each block of re-estimated leaves


def gbt_backtest(features: DataFrame, max_iter: int = 500, patience: int = 50, seed: int = 42,
                 horizon: int = FORECAST_HORIZON, model_name: str = "gbt", stop_on: str = "tail") -> BoostedTrees:
    """Train on rows up to ``max(date) - horizon`` and score the rest. The
    trees are grown by squared loss on ``log1p(target)``, their number is the
    best on the validation tail of the training period; then their leaves are
    re-estimated for least absolute error of the target itself.

    ``stop_on="holdout"`` chooses on the scored rows themselves and trains on
    the tail too: for comparison with models that were stopped so, its score is
    not that of unseen rows."""
    from pyspark.ml.feature import VectorAssembler

    if stop_on not in ("tail", "holdout"):
        raise ValueError(f"unknown stop_on {stop_on!r}")
    spark = features.sparkSession
    checkpoint_dir(spark)
    rows, names = gbt_dataset(features, horizon)
    vec = VectorAssembler(inputCols=names, outputCol="features",
                          handleInvalid="error").transform(materialize(rows, "gbt_rows", BUCKET_ROWS))
    chosen_on = F.col("is_valid") if stop_on == "tail" else F.col("is_test")
    vec = vec.withColumn("is_valid", chosen_on)
    used = F.col("is_valid") | ~F.col("is_test")
    ensemble = trees.boost(vec.where(used), max_iter, patience, seed)
    # all trees are summed in one pass; leaf numbers are kept of those only whose leaves may move
    held = sorted(t for chosen in trees.chosen_trees(ensemble.rounds) for t in chosen)
    kept = materialize(ensemble.leaves(vec, only=held).select(
        "store_id", "dept_id", "sale_date", "is_holiday", TARGET, "is_test", "is_valid", "leaves",
        ensemble.value().alias("value")), "gbt_leaves")
    ensemble, errors = trees.reestimate(ensemble, kept.where(used), TARGET, F.expm1, held=held)
    out = kept.where("is_test").withColumn("yhat", clip_at_zero(F.expm1("value") + trees.shift(ensemble, held))).select(
        "store_id", "dept_id", F.col("sale_date").alias("ds"), "is_holiday",
        F.col(TARGET).alias("actual"), "yhat", (F.col("yhat") * F.lit(0.9)).alias("yhat_lower"),
        (F.col("yhat") * F.lit(1.1)).alias("yhat_upper"), F.lit(model_name).alias("model"))
    nodes = materialize(ensemble.node_table(spark), "gbt_nodes")
    importances = trees.split_counts(nodes, [n[2:] for n in names])
    return BoostedTrees(materialize(out, "gbt_backtest"), nodes, importances, ensemble.rounds, ensemble.losses, errors)


def gbt_score(model: BoostedTrees) -> DataFrame:
    """Holdout WMAE, rows and the number of trees."""
    return model.backtest.agg(wmae("actual", "yhat", "is_holiday").alias("wmae"),
                              F.count(F.lit(1)).alias("test_rows")).withColumn("rounds", F.lit(model.rounds))


def lag_baseline(features: DataFrame, lag: str = "sales_lag_52wk", horizon: int = FORECAST_HORIZON,
                 model_name: str = "lag52") -> DataFrame:
    """The holdout rows forecast by their own lag, in the backtest layout."""
    from sparkretail.operators.metrics import time_split

    rows = time_split(features, weeks=horizon).where(F.col("is_test") & F.col(lag).isNotNull())
    pred = clip_at_zero(lag)
    return rows.select("store_id", "dept_id", F.col("sale_date").alias("ds"), pred.alias("yhat"),
                       (pred * F.lit(0.9)).alias("yhat_lower"), (pred * F.lit(1.1)).alias("yhat_upper"),
                       F.lit(model_name).alias("model"))


def top_importances(importances: DataFrame, n: int = 10) -> DataFrame:
    """Importances, descending; ``n`` rows (the reference's top-10 log)."""
    return importances.orderBy(F.desc("importance"), "feature").limit(n)
