"""Per-store forecaster with change points, a smooth yearly season and a band
that widens with the horizon.

The log of a store's weekly total is a piecewise linear trend (slope changes at
``CHANGEPOINTS`` places in the first 80 % of the training period), a Fourier
series of the year and a holiday effect, so season and holiday scale with the
trend. The weights are those of the maximum a posteriori fit with normal
priors, one penalty per column, solved for all stores at once:

* ``design`` gives each row its columns as integers of millionths, so that sums
  of their products are exact and do not depend on the order of rows;
* ``gram`` sums the products per store in one aggregation, and the squared
  second differences, which give the store's noise;
* ``solve`` eliminates the penalised normal equations of each store (symmetric
  and positive definite: no pivoting) in array functions.

``band`` simulates the future per store: slope changes come at the rate and of
the mean size of the fitted ones, plus the residual noise and the uncertainty of
the weights (from the inverse of the store's matrix). The draws are hashes
of (seed, store, draw, step), so reruns agree. Everything is keyed by store; a
store's rows and its matrix are bounded by its weeks and by the columns. Stores
with fewer than ``min_weeks`` weeks have no forecast, an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkretail.functions.scalar import round_half_away
from sparkretail.operators.forecast import history_and_future
from sparkretail.operators.metrics import FORECAST_HORIZON, MIN_HISTORY

MICRO = 1_000_000
CHANGEPOINTS, CHANGEPOINT_RANGE = 25, 0.8
FOURIER_ORDER, YEAR_DAYS = 10, 365.25


@dataclass(frozen=True)
class Priors:
    """Standard deviations of the weights in units of the log target over the
    training period. ``changepoint`` is that of a Laplace prior of scale 0.05;
    ``least_noise`` bounds the spread of a week from below."""

    slope: float = 5.0
    changepoint: float = 0.0707
    season: float = 1.0
    holiday: float = 10.0
    least_noise: float = 0.01

    def penalties(self) -> list[float]:
        """Per column, to be multiplied by the squared noise of the store."""
        spread = [self.slope, *[self.changepoint] * CHANGEPOINTS, *[self.season] * (2 * FOURIER_ORDER), self.holiday]
        return [0.0, *[1 / s ** 2 for s in spread]]


def column_names() -> list[str]:
    waves = [f"{f}{n}" for n in range(1, FOURIER_ORDER + 1) for f in ("sin", "cos")]
    return ["one", "t", *[f"bend{j}" for j in range(1, CHANGEPOINTS + 1)], *waves, "holiday"]


def micro(x: Column) -> Column:
    return F.floor(x * F.lit(float(MICRO)) + F.lit(0.5))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body
    names it: an expression within a lambda is otherwise computed at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def design(frame: DataFrame) -> DataFrame:
    """``frame`` with the model's columns and ``log_y`` (training rows), in
    millionths. ``t`` runs from 0 to 1 over the training period."""
    store = Window.partitionBy("store_id")
    start = F.min("ds").over(store)
    span = F.datediff(F.max(F.when(F.col("kind") == "train", F.col("ds"))).over(store), start)
    frame = frame.withColumn("span", span).withColumn("days", F.datediff("ds", start))
    frame = frame.withColumn("t", F.expr(f"(2L * days * {MICRO} + span) div (2L * span)"))
    bend = CHANGEPOINT_RANGE * MICRO / CHANGEPOINTS
    epoch = F.datediff("ds", F.lit("1970-01-01").cast("date"))
    waves = [f(F.lit(2 * math.pi * n / YEAR_DAYS) * epoch) for n in range(1, FOURIER_ORDER + 1) for f in (F.sin, F.cos)]
    values = [F.lit(MICRO).cast("long"), F.col("t"),
              *[F.greatest(F.col("t") - F.lit(int(bend * j)), F.lit(0).cast("long")) for j in range(1, CHANGEPOINTS + 1)],
              *[micro(w) for w in waves], F.when(F.col("in_calendar"), F.lit(MICRO)).otherwise(F.lit(0)).cast("long")]
    kept = ["store_id", "ds", "kind", "step", "y", "is_holiday", "span"]
    log_y = F.when(F.col("kind") == "train", micro(F.ln("y")))
    return frame.select(*kept, *[v.alias(c) for c, v in zip(column_names(), values)], log_y.alias("log_y"))


def gram(designed: DataFrame) -> DataFrame:
    """``store_id, i, products, rough, n_rough``: sums over the training rows
    of column i times each column and the target (square millionths, exact);
    the sum and number of squared second differences of the target."""
    names = [*column_names(), "log_y"]
    week = Window.partitionBy("store_id").orderBy("ds")
    bend = F.col("log_y") - 2 * F.lag("log_y", 1).over(week) + F.lag("log_y", 2).over(week)
    rows = designed.where(F.col("kind") == "train").select("store_id", *names, bend.alias("bend")).select(
        "store_id", "bend", *names, F.posexplode(F.array(*column_names())).alias("i", "x_i"))
    return rows.groupBy("store_id", "i").agg(F.array(*[F.sum(F.col("x_i") * F.col(c)) for c in names]).alias("products"),
                                             F.sum(F.col("bend") * F.col("bend")).alias("rough"), F.count("bend").alias("n_rough"))


def solve(sums: DataFrame, priors: Priors = Priors(), inverse: bool = False) -> DataFrame:
    """``store_id, weights`` in the order of ``column_names()``; with
    ``inverse`` also the rows of the inverse matrix."""
    p = len(column_names())
    # the noise of a week from second differences, whose variance is six times as large
    noise = F.greatest(F.col("rough") / (6 * F.col("n_rough")) / F.lit(float(MICRO) ** 2), F.lit(priors.least_noise ** 2))
    penalty = F.array(*[F.lit(v) for v in priors.penalties()])
    row = F.transform("products", lambda v, j: v.cast("double") / F.lit(float(MICRO) ** 2) + F.when(
        j == F.col("i"), F.get(penalty, j) * noise).otherwise(F.lit(0.0)))
    if inverse:
        unit = F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda j: F.when(j == F.col("i"), 1.0).otherwise(0.0))
        row = F.concat(row, unit)
    matrix = (sums.select("store_id", "i", row.alias("row")).groupBy("store_id")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "row"))), lambda s: s["row"]).alias("m")))

    def eliminate(m: Column, k: Column) -> Column:
        return _let(F.get(m, k), lambda pivot: F.transform(m, lambda r, i: F.when(i == k, r).otherwise(_let(
            F.get(r, k) / F.get(pivot, k), lambda f: F.zip_with(r, pivot, lambda a, b: a - f * b)))))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(p - 1)), F.col("m").cast("array<array<double>>"), eliminate)
    out = [F.transform("m", lambda r, i: F.get(r, F.lit(p)) / F.get(r, i)).alias("weights")]
    if inverse:
        out.append(F.transform("m", lambda r, i: F.transform(F.slice(r, p + 2, p), lambda v: v / F.get(r, i))).alias("inverse"))
    return matrix.select("store_id", done.alias("m")).select("store_id", *out)


def _dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def fitted(designed: DataFrame, weights: DataFrame) -> DataFrame:
    """The design rows with ``weights`` and ``mu``, the fitted log."""
    mu = F.lit(0.0)  # the terms one by one: compiled, unlike a function of arrays
    for j, c in enumerate(column_names()):
        mu = mu + F.get("weights", F.lit(j)) * F.col(c).cast("double")
    return designed.join(weights, "store_id").withColumn("mu", mu / F.lit(float(MICRO)))


def _uniform(seed: int, *key) -> Column:
    """A number in (0, 1) that depends on the key alone."""
    h = F.xxhash64(F.lit(seed), *key)
    return (F.pmod(h, F.lit(1 << 52)).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def band(fit: DataFrame, horizon: int = FORECAST_HORIZON, level: float = 0.8, draws: int = 300, seed: int = 11,
         least_change: float = 0.05) -> DataFrame:
    """``store_id, ahead, low, high``: the future rows (step, doubt, ds, mu) in
    order and per step of the horizon the quantiles of the simulated deviation
    from the fitted log; ``fit`` has the inverse matrix and is read once.
    Slope changes have the mean size of the fitted ones, ``least_change`` at
    least. A draw has one noise for all steps, so that the quantiles of
    neighbouring steps differ by their spread and not by chance."""
    n_season = 2 * FOURIER_ORDER + 3
    train = F.col("kind") == "train"
    error = F.when(train, F.col("log_y") / F.lit(float(MICRO)) - F.col("mu"))
    n = F.count(error)
    bends = F.slice(F.first("weights"), 3, CHANGEPOINTS)
    x = F.array(*[F.col(c) / F.lit(float(MICRO)) for c in column_names()])
    # the fit's own uncertainty at a row, in units of the noise
    doubt = _let(x, lambda v: _dot(F.transform("inverse", lambda r: _dot(r, v)), v))
    ahead = F.when(~train, F.struct("step", doubt.alias("doubt"), "ds", "mu"))
    fit = fit.where(train | (F.col("kind") == "future")).withColumn("ahead", ahead)
    stores = fit.groupBy("store_id").agg(
        F.array_sort(F.collect_list("ahead")).alias("ahead"),
        F.sqrt(F.sum(error * error) / F.greatest(n - n_season, n / 2)).alias("sigma"),
        F.greatest(F.aggregate(F.transform(bends, F.abs), F.lit(0.0), lambda s, v: s + v) / F.lit(float(CHANGEPOINTS)),
                   F.lit(least_change)).alias("size"),
        (F.lit(7.0) / F.first("span")).alias("dt"))

    def path(draw: Column) -> Column:
        u2, u3 = (_uniform(seed + i, F.col("store_id"), draw) for i in (2, 3))
        normal = F.struct(F.sqrt(F.lit(-2.0) * F.ln(u2)).alias("r"), F.cos(F.lit(2 * math.pi) * u3).alias("c"))

        def one(acc: Column, step: Column, z: Column) -> Column:
            u = [_uniform(seed + i, F.col("store_id"), draw, step) for i in (0, 1)]
            size = _let(u[1], lambda v: F.signum(v - 0.5) * -F.col("size") * F.ln(F.lit(1.0) - F.abs(F.lit(2.0) * v - F.lit(1.0))))
            jump = F.when(u[0] < F.lit(float(CHANGEPOINTS)) * F.col("dt"), size).otherwise(F.lit(0.0))
            noise = F.col("sigma") * F.get(F.col("spread"), step - 1) * z["r"] * z["c"]
            return _let(acc["slope"] + jump, lambda slope: _let(acc["off"] + slope * F.col("dt"), lambda off: F.struct(
                slope.alias("slope"), off.alias("off"), F.concat(acc["out"], F.array(off + noise)).alias("out"))))

        start = F.struct(F.lit(0.0).alias("slope"), F.lit(0.0).alias("off"), F.array().cast("array<double>").alias("out"))
        return _let(normal, lambda z: F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, lambda acc, step: one(acc, step, z),
                                                  lambda acc: acc["out"]))

    def quantile(values: Column, q: float) -> Column:
        at = q * (draws - 1)
        lo = int(at)
        a, b = F.get(values, F.lit(lo)), F.get(values, F.lit(min(lo + 1, draws - 1)))
        return a + (b - a) * F.lit(at - lo)

    spread = F.transform("ahead", lambda s: F.sqrt(s["doubt"] + F.lit(1.0))).alias("spread")
    paths = F.transform(F.sequence(F.lit(1), F.lit(draws)), path)
    steps = _let(paths, lambda ps: F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), lambda s: F.sort_array(
        F.transform(ps, lambda p: F.get(p, s)))))
    tail = (1 - level) / 2
    ends = _let(steps, lambda vs: F.struct(F.transform(vs, lambda v: quantile(v, tail)).alias("low"),
                                           F.transform(vs, lambda v: quantile(v, 1 - tail)).alias("high")))
    return stores.select("*", spread).select("store_id", "ahead", ends.alias("ends")).select("store_id", "ahead", "ends.low", "ends.high")


def changepoint_frame(features: DataFrame, horizon: int = FORECAST_HORIZON, min_weeks: int = MIN_HISTORY,
                      max_stores: int | None = None, horizon_from: str = "training_end", anchor: str = "own",
                      priors: Priors = Priors()) -> DataFrame:
    """History and future rows per store with ``yhat`` in cents: columns
    store_id, ds, kind, step, y, is_holiday, yhat as in
    ``forecast.seasonal_frame``."""
    designed = design(history_and_future(features, horizon, min_weeks, max_stores, horizon_from, anchor))
    fit = fitted(designed, solve(gram(designed), priors))
    return fit.select("store_id", "ds", "kind", "step", "y", "is_holiday", round_half_away(F.exp("mu"), 2).alias("yhat"))


def changepoint_forecast(features: DataFrame, horizon: int = FORECAST_HORIZON, min_weeks: int = MIN_HISTORY,
                         max_stores: int | None = None, horizon_from: str = "training_end", anchor: str = "own",
                         priors: Priors = Priors(), level: float = 0.8, draws: int = 300, seed: int = 11) -> DataFrame:
    """The future rows with their band: store_id, ds, step, yhat, yhat_lower,
    yhat_upper."""
    designed = design(history_and_future(features, horizon, min_weeks, max_stores, horizon_from, anchor))
    fit = fitted(designed, solve(gram(designed), priors, inverse=True))
    at = lambda c: F.get(c, (F.col("step") - 1).cast("int"))
    cents = lambda mu: round_half_away(F.exp(mu), 2)
    return (band(fit, horizon, level, draws, seed).select("store_id", "low", "high", F.inline("ahead"))
            .select("store_id", "ds", "step", cents(F.col("mu")).alias("yhat"),
                    cents(F.col("mu") + at("low")).alias("yhat_lower"), cents(F.col("mu") + at("high")).alias("yhat_upper")))
