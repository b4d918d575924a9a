"""Forecast review and chart data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.functions.columns import as_double, round_half_up
from skuflow.functions.ranking import By, global_running, medians, nth_row
from skuflow.params import ForecastParams

# The featured-SKU MAPE cutoffs, histogram bins and bias band.
FEATURE_CUTOFFS = (25, 50, 100)
HIST_WIDTH, HIST_BINS, HIST_CAP = 5, 20, 100
VOLUME_BINS = 8
BIAS_BAND = 15


def forecast_review(forecasts: DataFrame) -> DataFrame:
    """Rows per grain and confidence, with the median MAPE per grain over
    distinct keys (first row per key)."""
    counts = forecasts.groupBy("grain", "confidence").agg(F.count(F.lit(1)).alias("row_count"))
    first = forecasts.groupBy("grain", "grain_key").agg(F.min_by("mape_pct", "forecast_month").alias("m"))
    med = medians(first, ["grain"], {"m": (F.col("m"), 2)}, few=True).select("grain", F.round("m", 2).cast("decimal(18,2)").alias("median_mape_pct"))
    return counts.join(med, "grain", "left")


def sku_forecast_preview(forecasts: DataFrame, n: int = 12) -> DataFrame:
    """SKU rows with product_id as header, first ``n`` by (SKU, month)."""
    return forecasts.where(F.col("grain") == "sku").select(
        F.col("grain_key").alias("product_id"), "category", "forecast_month", "predicted_units", "lower_bound",
        "upper_bound", "mape_pct", "confidence", "model_used").orderBy("product_id", "forecast_month").limit(n)


def sku_metrics(forecasts: DataFrame) -> DataFrame:
    """One metric row per forecast SKU (values are constant per key)."""
    first = F.min_by(F.struct("category", "mae", "mape_pct", "model_used", "confidence"), "forecast_month")
    return forecasts.where(F.col("grain") == "sku").groupBy("grain_key").agg(first.alias("r")).select(
        F.col("grain_key").alias("product_id"), "r.category", "r.mae", "r.mape_pct", "r.model_used",
        "r.confidence")


def feature_sku(metrics: DataFrame) -> DataFrame:
    """The SKU to feature. Candidates sorted by MAPE (then id); the first
    cutoff with >= 3 SKUs under it picks position n // 3 of that pool. Every pool
    is a prefix of the sorted candidates, so its pick is their n-th row: counts
    say which, and only the value range that holds it is sorted."""
    cand = metrics.where(F.col("mape_pct").isNotNull())
    pools = [F.count_if(F.col("mape_pct") < c) for c in FEATURE_CUTOFFS] + [F.count(F.lit(1))]
    sizes = [n for n in cand.agg(*[c.alias(f"n{i}") for i, c in enumerate(pools)]).first() if n >= 3]
    return nth_row(cand, [By("mape_pct"), By("product_id")], sizes[0] // 3 + 1 if sizes else 1)


def moving_average_segments(filled: DataFrame, p: ForecastParams = ForecastParams()) -> DataFrame:
    """M18 for the moving-average model, for every series: training months,
    holdout actuals, holdout forecast, forward forecast with its band."""
    from skuflow.operators.demand import moving_average_forecast
    h, w = p.holdout, p.ma_window
    f = filled.where(F.col("n") >= p.min_len)
    train = f.where(F.col("t") < F.col("n") - h).select("grain", "grain_key", F.lit("train").alias("segment"),
                                                        "month", as_double("units").alias("value"))
    actual = f.where(F.col("t") >= F.col("n") - h).select("grain", "grain_key", F.lit("holdout_actual").alias("segment"),
                                                          "month", as_double("units").alias("value"))
    tail = f.where((F.col("t") >= F.col("n") - h - w) & (F.col("t") < F.col("n") - h)) \
        .groupBy("grain", "grain_key").agg(F.sum("units").alias("s"))
    bt = f.where(F.col("t") >= F.col("n") - h).select("grain", "grain_key", "month").join(tail, ["grain", "grain_key"]) \
        .select("grain", "grain_key", F.lit("holdout_forecast").alias("segment"), "month",
                (as_double("s") / float(w)).alias("value"))
    fwd = moving_average_forecast(filled, p).select(
        "grain", "grain_key", F.lit("forecast").alias("segment"), F.col("forecast_month").alias("month"),
        as_double("predicted_units").alias("value"), as_double("lower_bound").alias("lo"),
        as_double("upper_bound").alias("hi"))
    none = F.lit(None).cast("double")
    parts = [x.withColumn("lo", none).withColumn("hi", none) for x in (train, actual, bt)] + [fwd]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.select("grain", "grain_key", "segment", "month",
                      round_half_up("value", 2).alias("value"), round_half_up("lo", 2).alias("lo"),
                      round_half_up("hi", 2).alias("hi"))


def mape_histogram(spark: SparkSession, metrics: DataFrame) -> DataFrame:
    """MAPE clipped at 100 in 5-point bins (last bin closed), all 20 bins,
    tier by the bin's left edge."""
    m = metrics.where(F.col("mape_pct").isNotNull())
    b = F.least(F.floor(F.least(F.col("mape_pct"), F.lit(HIST_CAP)) / HIST_WIDTH), F.lit(HIST_BINS - 1))
    counts = m.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("sku_count"))
    bins = spark.range(HIST_BINS).select(F.col("id").cast("int").alias("bin"))   # the 20 fixed bins
    left = F.col("bin") * HIST_WIDTH
    return bins.join(counts, "bin", "left").select(
        left.alias("bin_left"), (left + HIST_WIDTH).alias("bin_right"),
        F.coalesce("sku_count", F.lit(0)).alias("sku_count"),
        F.when(left < 20, "high").when(left < 50, "medium").otherwise("low").alias("tier"))


def mape_summary(metrics: DataFrame) -> DataFrame:
    """M19 (caption): SKU count, median MAPE, share high / medium / low."""
    m = F.col("mape_pct")
    x = metrics.where(m.isNotNull())
    n = F.count(F.lit(1))
    middle = medians(x, [], {"m": (m, 2)}).scalar()
    return x.agg(n.alias("sku_count"), F.max(F.round(middle, 1)).cast("decimal(18,1)").alias("median_mape"),
                 round_half_up(as_double(F.count_if(m < 20)) * 100.0 / as_double(n), 1).alias("pct_high"),
                 round_half_up(as_double(F.count_if((m >= 20) & (m < 50))) * 100.0 / as_double(n), 1)
                 .alias("pct_medium"),
                 round_half_up(as_double(F.count_if(m >= 50)) * 100.0 / as_double(n), 1).alias("pct_low"))


def sku_units(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("product_id").agg(F.sum("units_sold").cast("long").alias("total_units"))


def coverage_pareto(units: DataFrame, metrics: DataFrame) -> DataFrame:
    """SKUs by units (desc, then id) with cumulative share of units and a
    forecast flag (distributed running total)."""
    ran = global_running(units, "total_units", [By("total_units", desc=True), By("product_id")], "cum_units", "sku_rank")
    ran = ran.withColumns({"_tot": units.agg(F.sum("total_units")).scalar(), "_key": F.col("product_id").cast("string")})
    flags = metrics.select(F.col("product_id").alias("_key"), F.lit(True).alias("_f"))
    return ran.join(flags, "_key", "left").withColumn("forecasted", F.coalesce("_f", F.lit(False))).select("sku_rank", "product_id", "total_units",
                      round_half_up(as_double("cum_units") * 100.0 / as_double("_tot"), 4)
                      .alias("cumulative_units_pct"), "forecasted")


def coverage_summary(units: DataFrame, metrics: DataFrame) -> DataFrame:
    """M20 (caption): share of units and of the catalogue that is forecast."""
    flagged = units.join(metrics.select(F.col("product_id").alias("grain_key")).withColumn("_f", F.lit(1)),
                         units["product_id"].cast("string") == F.col("grain_key"), "left")
    f = F.col("_f").isNotNull()
    return flagged.agg(
        F.count_if(f).alias("forecast_skus"), F.count(F.lit(1)).alias("total_skus"),
        round_half_up(as_double(F.sum(F.when(f, F.col("total_units")))) * 100.0 / as_double(F.sum("total_units")), 2)
        .alias("forecast_units_pct"),
        round_half_up(as_double(F.count_if(f)) * 100.0 / as_double(F.count(F.lit(1))), 2).alias("catalogue_pct"))


def quantile_edges(df: DataFrame, value: str, bins: int) -> Column:
    """Scalar subquery: the distinct linear quantiles 0, 1/bins, ..., 1 of a whole-number
    column, from ranked counts: one row per distinct value after partial aggregation, a
    running count over them (by value ranges), and two conditional minima per quantile."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    ranked = global_running(counts, "_c", [By(value)], "_upto")
    n = ranked.agg(F.sum("_c")).scalar()
    marked = ranked.withColumn("_n", n)
    places = [F.lit(i / bins) * (F.col("_n") - 1) for i in range(bins + 1)]
    picks = [F.min(F.when(F.col("_upto") > f(p), as_double(value))) for p in places for f in (F.floor, F.ceil)]
    row = marked.agg(F.max("_n").alias("_n"), *[c.alias(f"_q{i}") for i, c in enumerate(picks)])
    between = []
    for i, p in enumerate(places):
        lo, hi, part = F.col(f"_q{2 * i}"), F.col(f"_q{2 * i + 1}"), p - F.floor(p)
        between.append(lo + (hi - lo) * part)
    return row.select(F.array_distinct(F.array_sort(F.array(*between))).alias("_e")).scalar()


def accuracy_by_volume(units: DataFrame, metrics: DataFrame, bins: int = VOLUME_BINS) -> DataFrame:
    """Forecast SKUs in quantile bins of total units (linear quantiles,
    duplicate edges dropped, right-closed, lowest included); median units and
    median MAPE per bin."""
    df = metrics.where(F.col("mape_pct").isNotNull()).join(
        units.select(F.col("product_id").cast("string").alias("product_id"), "total_units"), "product_id")
    edges = quantile_edges(df, "total_units", bins)
    x = df.withColumn("_e", edges)
    upper = F.slice("_e", 2, F.size("_e"))
    binned = x.withColumn("bin", F.size(F.filter(upper, lambda e: e < as_double("total_units")))) \
        .withColumn("bin_low", F.element_at("_e", F.col("bin") + 1)) \
        .withColumn("bin_high", F.element_at("_e", F.col("bin") + 2))
    counts = binned.groupBy("bin", "bin_low", "bin_high").agg(F.count(F.lit(1)).alias("sku_count"))
    middle = medians(binned, ["bin"], {"u": (F.col("total_units"), 0), "m": (F.col("mape_pct"), 2)}, few=True)
    return counts.join(F.broadcast(middle), "bin").select(
        "bin", "bin_low", "bin_high", "sku_count", F.col("u").cast("decimal(20,1)").alias("median_units"),
        F.round("m", 2).cast("decimal(18,2)").alias("median_mape"))


def category_bias(monthly: DataFrame, forecasts: DataFrame, forecast_skus_only: bool = False) -> DataFrame:
    """Summed SKU forecasts vs units of the last three calendar months,
    per category (inner on both). The actuals are those of all SKUs, so the bias leans
    low; ``forecast_skus_only`` leaves out SKUs without a forecast."""
    last = monthly.agg(F.max("order_month")).scalar()
    if forecast_skus_only:
        skus = forecasts.where(F.col("grain") == "sku").select(
            F.col("grain_key").try_cast(monthly.schema["product_id"].dataType).alias("product_id")).distinct()
        monthly = monthly.join(skus, "product_id", "left_semi")
    cutoff = F.date_format(F.add_months(F.to_date(F.concat(last, F.lit("-01"))), -2), "yyyy-MM")
    recent = monthly.where(F.col("order_month") >= cutoff).groupBy("category").agg(
        F.sum("units_sold").cast("long").alias("recent_actual"))
    fwd = forecasts.where(F.col("grain") == "sku").groupBy("category").agg(
        F.sum("predicted_units").cast("decimal(38,2)").alias("forward_forecast"))
    df = recent.join(fwd, "category")
    r, f = as_double("recent_actual"), as_double("forward_forecast")
    bias = (f - r) / F.nullif(r, F.lit(0.0)) * 100.0
    return df.select("category", "recent_actual", "forward_forecast", round_half_up(bias, 1).alias("bias_pct"),
                     F.when(bias > BIAS_BAND, "over").when(bias < -BIAS_BAND, "under").otherwise("ok")
                     .alias("bias_flag"))


__all__ = ["forecast_review", "sku_forecast_preview", "sku_metrics", "feature_sku", "moving_average_segments",
           "mape_histogram", "mape_summary", "coverage_pareto", "coverage_summary", "accuracy_by_volume",
           "category_bias"]
