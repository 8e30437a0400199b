"""Distribution drift (population stability index) between a baseline and
the most recent weeks (SURVEY §2.9, traps S14-S17).

All features are handled in one job per feature family: the feature columns
are unpivoted into ``(feature, value)`` rows, so the work is partitioned by
feature *and* value, never one feature per task.

Numeric PSI needs exact baseline deciles. ``exact_quantiles`` computes them
without gathering a feature's values in one task: values are counted in bins
that follow their order, and the counts tell which bins hold the rank targets.
Only the values of these are reduced to distinct ``(feature, value, count)``
rows, spread over range buckets if they are many (splitters from a bounded
``approx_percentile`` sketch), ranked inside each bucket with a window, and
offset by the (tiny) per-bucket totals. The rank targets then pick exact order
statistics; edges interpolate linearly between them (the ``linear`` percentile
rule).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkretail.functions.scalar import drift_tier, round_half_away
from sparkretail.session import materialize
from sparkretail.operators.metrics import FORECAST_HORIZON

# Features compared by the drift report and the PSI settings.
NUMERIC_FEATURES = ["store_size", "total_markdown", "sales_lag_1wk", "sales_lag_4wk",
                    "sales_lag_52wk", "rolling_4wk_avg", "rolling_13wk_avg", "weekly_sales"]
CATEGORICAL_FEATURES = ["store_id", "dept_id", "week_of_year", "month", "quarter", "is_holiday",
                        "is_holiday_season", "has_markdown1", "has_markdown2", "has_markdown3",
                        "has_markdown4", "has_markdown5"]
PSI_BINS = 10
EMPTY_SHARE = 1e-6
BUCKET_VALUES = 50_000  # distinct values ranked by one task
BINS, LEAST = 64, 40  # bins while a value grows e-fold, from e^-40 on


def split_recent(df: DataFrame, date_col: str = "sale_date",
                 weeks: int = FORECAST_HORIZON) -> DataFrame:
    """Adds ``is_recent`` (date > max(date) - weeks) and ``cutoff_date``; the
    maximum is an uncorrelated scalar subquery."""
    cutoff = F.date_sub(df.select(F.max(date_col)).scalar(), 7 * weeks)
    return df.withColumn("cutoff_date", cutoff).withColumn(
        "is_recent", F.col(date_col) > F.col("cutoff_date"))


def long_values(df: DataFrame, features: Sequence[str], as_type: str) -> DataFrame:
    """``(feature, value, is_recent)`` for the listed features present in the
    frame; NULL and NaN values are dropped (they count in no share)."""
    present = [c for c in features if c in df.columns]
    cast = df.select("is_recent", *[F.col(c).cast(as_type).alias(c) for c in present])
    return (cast.unpivot(["is_recent"], present, "feature", "value")
            .where(F.col("value").isNotNull() & (~F.isnan("value") if as_type == "double" else F.lit(True))))


def exact_quantiles(values: DataFrame, fractions: Sequence[tuple[int, int]],
                    key: str = "feature", bucket_values: int = BUCKET_VALUES) -> DataFrame:
    """Exact linear-interpolation quantiles per key.

    ``fractions`` are ``(numerator, denominator)`` pairs; the position of
    fraction q in n sorted values is ``q * (n - 1)``, computed in integers.
    Returns ``(key, q_index, quantile)``.
    """
    value = F.col("value")
    # monotone in the value: a bin holds the values within about 1 / BINS of each other, bin 0 those near 0
    size = F.greatest(F.ln(F.greatest(F.abs(value), F.lit(math.exp(-LEAST)))) + F.lit(float(LEAST)), F.lit(0.0))
    at = (F.when(value.isNull(), F.lit(-(1 << 62))).when(F.isnan("value"), F.lit(1 << 62))
          .otherwise(F.floor(F.signum(value) * size * F.lit(float(BINS)))))
    values = values.select(key, "value", at.alias("bin"))
    before = Window.partitionBy(key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (values.groupBy(key, "bin").agg(F.count(F.lit(1)).alias("bin_cnt"))
            .withColumn("offset", F.coalesce(F.sum("bin_cnt").over(before), F.lit(0)))
            .withColumn("n", F.sum("bin_cnt").over(Window.partitionBy(key))))
    # rank targets: lower and upper order statistic of every fraction, in the bin that holds them
    fr = F.array(*[F.struct(F.lit(i).alias("q_index"), F.lit(a).alias("num"),
                            F.lit(b).alias("den")) for i, (a, b) in enumerate(fractions)])
    pos = (F.col("n") - 1) * F.col("num")
    tg = (bins.select(key, "bin", "bin_cnt", "offset", "n", F.inline(fr))
          .withColumn("lo_rank", F.floor(pos / F.col("den")).cast("long"))
          .withColumn("frac", (pos % F.col("den")).cast("double") / F.col("den").cast("double"))
          .withColumn("hi_rank", F.col("lo_rank") + F.when(F.col("frac") > 0, 1).otherwise(0)))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_rank").alias("rank")) for s in ("lo", "hi")])
    tg = tg.select(key, "bin", "bin_cnt", "offset", "q_index", "frac", F.inline(sides)).where(
        (F.col("rank") >= F.col("offset")) & (F.col("rank") < F.col("offset") + F.col("bin_cnt")))
    tg = materialize(tg.select(key, "bin", "q_index", "frac", "side", (F.col("rank") - F.col("offset")).alias("rank")),
                     "rank_targets")
    # only the values of those bins are told apart and ranked; written once:
    # the bucket count, the splits, the totals and the pick read them
    group = [key, "bin"]
    dv = materialize(values.join(F.broadcast(tg.select(*group).distinct()), group)
                     .groupBy(*group, "value").agg(F.count(F.lit(1)).alias("cnt")), "distinct_values")
    most = dv.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    buckets = max(1, -(-most // bucket_values))
    if buckets > 1:  # range buckets from a bounded sketch over the distinct values
        probs = [i / buckets for i in range(1, buckets)]
        splits = dv.groupBy(*group).agg(F.array_sort(F.array_distinct(
            F.percentile_approx("value", probs, max(10000, 100 * buckets)))).alias("splits"))
        dv = (dv.join(F.broadcast(splits), group)
              .withColumn("bucket", F.size(F.filter("splits", lambda s: s < F.col("value"))))
              .drop("splits"))
        dv = materialize(dv, "bucketed_values")
    else:
        dv = dv.withColumn("bucket", F.lit(0))
    within = Window.partitionBy(*group, "bucket").orderBy("value").rowsBetween(
        Window.unboundedPreceding, 0)
    dv = dv.withColumn("upto", F.sum("cnt").over(within))
    if buckets > 1:
        earlier = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        totals = dv.groupBy(*group, "bucket").agg(F.sum("cnt").alias("bucket_cnt")).select(
            *group, "bucket", F.coalesce(F.sum("bucket_cnt").over(earlier), F.lit(0)).alias("bucket_offset"))
        dv = dv.join(F.broadcast(totals), [*group, "bucket"]).withColumn("upto", F.col("upto") + F.col("bucket_offset"))
    picked = dv.join(F.broadcast(tg), group).where(
        (F.col("rank") >= F.col("upto") - F.col("cnt")) & (F.col("rank") < F.col("upto")))
    return (picked.groupBy(key, "q_index", "frac")
            .agg(F.max(F.when(F.col("side") == "lo", F.col("value"))).alias("v_lo"),
                 F.max(F.when(F.col("side") == "hi", F.col("value"))).alias("v_hi"))
            .select(key, "q_index",
                    (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * F.col("frac"))
                    .alias("quantile")))


def _at_most(array: str, i: int, value: str) -> Column:
    """1 if the array has an element ``i`` and it is at most the value, else 0."""
    return F.when(F.get(array, F.lit(i)) <= F.col(value), 1).otherwise(0)


def _psi_sum(cur: Column, base: Column) -> Column:
    return F.sum((cur - base) * F.log(cur / base))


def share(cnt: Column, total: Column) -> Column:
    """Share of a bin / category; an empty one counts as 1e-6."""
    return F.when(cnt > 0, cnt / total).otherwise(F.lit(EMPTY_SHARE))


def psi_numeric(split: DataFrame, features: Sequence[str] = NUMERIC_FEATURES,
                bins: int = PSI_BINS) -> DataFrame:
    """``(feature, psi)`` on the baseline's de-duplicated decile edges; bins
    are half-open except the last; recent values outside the edges count in
    the denominator only; fewer than 3 distinct edges -> 0.0."""
    lv = long_values(split, features, "double")
    counts = lv.groupBy("feature").agg(F.count_if(~F.col("is_recent")).alias("n_base"),
                                       F.count_if(F.col("is_recent")).alias("n_recent"))
    counts = counts.where((F.col("n_base") > 0) & (F.col("n_recent") > 0))
    q = exact_quantiles(lv.where(~F.col("is_recent")), [(i, bins) for i in range(bins + 1)])
    edges = (q.groupBy("feature")
             .agg(F.array_sort(F.array_distinct(F.collect_list("quantile"))).alias("edges")))
    edges = edges.join(counts, "feature")
    m = F.size("edges") - 1  # number of bins
    binned = (lv.join(F.broadcast(edges.select("feature", "edges")), "feature")
              .withColumn("last", F.element_at("edges", -1))
              .where((F.col("value") >= F.element_at("edges", 1)) & (F.col("value") <= F.col("last")))
              .withColumn("bin", F.when(F.col("value") == F.col("last"), F.size("edges") - 2)
                          .otherwise(sum(_at_most("edges", i, "value") for i in range(bins + 1)) - 1))
              .groupBy("feature", "bin")
              .agg(F.count_if(~F.col("is_recent")).alias("b"),
                   F.count_if(F.col("is_recent")).alias("c")))
    all_bins = edges.where(F.size("edges") >= 3).select(
        "feature", "n_base", "n_recent", F.explode(F.sequence(F.lit(0), m - 1)).alias("bin"))
    per_bin = all_bins.join(binned, ["feature", "bin"], "left").fillna(0, ["b", "c"])
    psi = (per_bin.groupBy("feature")
           .agg(_psi_sum(share(F.col("c"), F.col("n_recent")),
                         share(F.col("b"), F.col("n_base"))).alias("raw")))
    out = edges.select("feature").join(psi, "feature", "left")
    return out.select("feature", round_half_away(F.coalesce(F.col("raw"), F.lit(0.0)), 4)
                      .alias("psi"))


def psi_categorical(split: DataFrame, features: Sequence[str] = CATEGORICAL_FEATURES
                    ) -> DataFrame:
    """``(feature, psi)`` on category shares; NULLs are excluded; a category
    seen on one side only gets 1e-6 on the other (no renormalisation)."""
    lv = long_values(split, features, "string")
    per_cat = lv.groupBy("feature", "value").agg(
        F.count_if(~F.col("is_recent")).alias("b"), F.count_if(F.col("is_recent")).alias("c"))
    totals = per_cat.groupBy("feature").agg(F.sum("b").alias("n_base"),
                                            F.sum("c").alias("n_recent"))
    j = per_cat.join(F.broadcast(totals), "feature")
    psi = j.groupBy("feature").agg(_psi_sum(share(F.col("c"), F.col("n_recent")),
                                            share(F.col("b"), F.col("n_base"))).alias("raw"))
    return psi.select("feature", round_half_away("raw", 4).alias("psi"))


def drift_features(split: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES,
                   categorical: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """``(feature, psi, tier, type)``, one row per feature."""
    num = psi_numeric(split, numeric).withColumn("type", F.lit("numeric"))
    cat = psi_categorical(split, categorical).withColumn("type", F.lit("categorical"))
    both = num.unionByName(cat)
    return both.select("feature", "psi", drift_tier("psi").alias("tier"), "type")


def drift_summary(split: DataFrame, features: DataFrame, weeks: int = FORECAST_HORIZON
                  ) -> DataFrame:
    """One row: cutoff, recent weeks, baseline/recent rows, tier counts. The
    features, a few rows, are written once: each count reads them."""
    return _summary(split, materialize(features, "drift_features"), weeks)


def _summary(split: DataFrame, features: DataFrame, weeks: int) -> DataFrame:
    def n_tier(name: str) -> Column:
        return features.agg(F.count_if(F.col("tier") == name)).scalar()

    return split.agg(F.max("cutoff_date").alias("cutoff_date"),
                     F.count_if(~F.col("is_recent")).alias("baseline_rows"),
                     F.count_if(F.col("is_recent")).alias("recent_rows")).select(
        "cutoff_date", F.lit(weeks).alias("recent_weeks"), "baseline_rows", "recent_rows",
        n_tier("HIGH").alias("high"), n_tier("MEDIUM").alias("medium"),
        n_tier("LOW").alias("low"))


def report_document(split: DataFrame, features: DataFrame, run_ts: str,
                    weeks: int = FORECAST_HORIZON) -> DataFrame:
    """The report as one JSON document (``value``): run time, cut-off, recent
    weeks, baseline/recent rows, tier summary and a feature -> {psi, tier,
    type} map. The map gathers one entry per feature (a fixed, small list)."""
    features = materialize(features.withColumn("at", F.monotonically_increasing_id()), "drift_features")
    summary = _summary(split, features, weeks)
    entries = F.array_sort(F.collect_list(F.struct("at", "feature", F.struct("psi", "tier", "type").alias("entry"))))
    fmap = features.agg(F.map_from_entries(F.transform(  # in the order in which they were computed
        entries, lambda e: F.struct(e["feature"], e["entry"]))).alias("features"))
    doc = summary.select(
        F.lit(run_ts).alias("run_timestamp"), F.col("cutoff_date").cast("string").alias("cutoff_date"),
        "recent_weeks", "baseline_rows", "recent_rows",
        F.struct("high", "medium", "low").alias("summary"),
        fmap.select(F.to_json("features")).scalar().alias("features_json"))
    return doc.select(F.to_json(F.struct(
        "run_timestamp", "cutoff_date", "recent_weeks", "baseline_rows", "recent_rows", "summary",
        F.from_json("features_json", "map<string, struct<psi: double, tier: string, type: string>>")
        .alias("features"))).alias("value"))
