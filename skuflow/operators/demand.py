"""Demand features and series preparation (M1-M4, M7, M12, M16) and the
moving-average forecaster.

Series are long-format DataFrames ``(grain, grain_key, category, month, units)``
with one row per month; per-series windows are partitioned by the series key,
so one window partition never holds more than the months of one series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.functions.columns import band, as_double, round_half_up
from skuflow.params import ForecastParams
from skuflow.sources.schemas import FORECAST_NUM

# Confidence bands on backtest MAPE (percent).
CONFIDENCE_CUTS = ((20, "high"), (50, "medium"))
CONFIDENCE_ELSE, CONFIDENCE_NONE = "low", "none"


def pop_sigma(n: Column, s: Column, ss: Column) -> Column:
    """Population standard deviation from exact integer moments:
    sqrt(n*sum(x^2) - sum(x)^2) / n (0 for a single value)."""
    num = n.cast("decimal(38,0)") * ss.cast("decimal(38,0)") - s.cast("decimal(38,0)") * s.cast("decimal(38,0)")
    return F.sqrt(as_double(num)) / as_double(n)


def sku_months(monthly: DataFrame) -> DataFrame:
    """One row per (product, month), dealt by product alone: everything that follows per
    product (M1, M3, M4) needs no further exchange."""
    return monthly.repartition("product_id").groupBy("product_id", "order_month").agg(
        F.max("category").alias("category"), F.sum("units_sold").alias("u"))


def demand_features(monthly: DataFrame) -> DataFrame:
    """M1: per SKU, over months with sales only: active months, total units,
    average and population sigma of monthly units (2 dp)."""
    per_month = sku_months(monthly)
    a = per_month.groupBy("product_id").agg(
        F.max("category").alias("category"), F.count(F.lit(1)).alias("active_months"),
        F.sum("u").alias("total_units"), F.sum(F.col("u") * F.col("u")).alias("uu"))
    n = F.col("active_months")
    return a.select(
        F.lit("sku").alias("grain"), "product_id", "category", "active_months",
        F.col("total_units").cast("long").alias("total_units"),
        round_half_up(as_double("total_units") / as_double(n), 2).alias("past_demand"),
        round_half_up(pop_sigma(n, F.col("total_units"), F.col("uu")), 2).alias("demand_sigma"))


def history_coverage(monthly: DataFrame, thresholds=(3, 4, 6, 8, 12)) -> DataFrame:
    """M2: how much history the SKUs have (one row)."""
    per_sku = monthly.groupBy("product_id").agg(F.count_distinct("order_month").alias("m"))
    m = F.col("m")
    sku_part = per_sku.agg(
        F.count(F.lit(1)).alias("total_skus"), F.count_if(m == 1).alias("skus_1_month"),
        F.count_if(m <= 2).alias("skus_le_2_months"),
        *[F.count_if(m >= t).alias(f"skus_ge_{t}_months") for t in thresholds])
    months = monthly.agg(F.count_distinct("order_month")).scalar()
    return sku_part.withColumn("months_of_history", months).select(
        "total_skus", "months_of_history", "skus_1_month", "skus_le_2_months",
        *[f"skus_ge_{t}_months" for t in thresholds])


def forecastable(features: DataFrame, p: ForecastParams = ForecastParams()) -> DataFrame:
    """M3: SKUs clearing both bars (active months and total units)."""
    return features.where((F.col("active_months") >= p.min_active_months)
                          & (F.col("total_units") >= p.min_total_units)) \
        .select("product_id", "category", "active_months", "total_units")


def first_day(month: str) -> Column:
    return F.to_date(F.concat(F.col(month), F.lit("-01")))


def as_of_month(monthly: DataFrame, p: ForecastParams) -> Column | None:
    """The month all series run up to, if one is asked for."""
    if p.as_of == "last":
        return F.to_date(F.concat(monthly.agg(F.max("order_month")).scalar(), F.lit("-01")))
    return None if p.as_of is None else F.to_date(F.lit(p.as_of + "-01"))


def _fill(series: DataFrame, keys: list[str], as_of: Column | None = None, p: ForecastParams | None = None) -> DataFrame:
    """Rows (keys, category, month, units) -> every month between the first and last of a
    series (or ``as_of``, if that is later), absent ones with 0 units; ``t`` counts months from
    the first, ``n`` all of them. Each row is followed by the empty months up to the next one
    or the end, so nothing is joined back. With ``p``, only series that clear its bars (M3).
    One window, so one sort, has it all."""
    by_month = Window.partitionBy(*keys).orderBy("month")
    w = by_month.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.lead("month").over(by_month)
    able = [] if p is None else [F.count(F.lit(1)).over(w).alias("active"), F.sum("units").over(w).alias("total")]
    rows = series.select(*keys, F.max("category").over(w).alias("category"), "month", "units", F.min("month").over(w).alias("m0"),
                         F.max("month").over(w).alias("last"), following.alias("following"), *able)
    if p is not None:
        rows = rows.where((F.col("active") >= p.min_active_months) & (F.col("total") >= p.min_total_units))
    end = F.col("last") if as_of is None else F.greatest("last", as_of)
    rows = rows.withColumn("m1", end).withColumn("until", F.coalesce(F.add_months("following", -1), "m1"))
    # months are counted per row given, before it is followed by its empty ones
    ahead = (F.year("until") - F.year("month")) * 12 + F.month("until") - F.month("month")
    empty = ahead - F.when(F.add_months("month", ahead) > F.col("until"), 1).otherwise(0)
    each = rows.select(*keys, "category", "units", "month", F.months_between("month", "m0").cast("int").alias("t0"),
                       (F.months_between("m1", "m0").cast("int") + 1).alias("n"), F.explode(F.sequence(F.lit(0), empty, F.lit(1))).alias("i"))
    return each.select(*keys, "category", F.add_months("month", F.col("i")).alias("month"),
                       F.when(F.col("i") == 0, F.col("units")).otherwise(F.lit(0)).cast("long").alias("units"),
                       (F.col("t0") + F.col("i")).alias("t"), "n")


def sku_filled(monthly: DataFrame, p: ForecastParams = ForecastParams()) -> DataFrame:
    """M3 + M4 at SKU grain with one exchange: eligibility, gaps and lengths are one window by product."""
    rows = sku_months(monthly).select("product_id", "category", first_day("order_month").alias("month"), F.col("u").alias("units"))
    return _fill(rows, ["product_id"], as_of_month(monthly, p), p).select(
        F.lit("sku").alias("grain"), F.col("product_id").cast("string").alias("grain_key"), "category", "month", "units", "t", "n")


def category_filled(monthly: DataFrame, p: ForecastParams = ForecastParams()) -> DataFrame:
    """M4 at category grain (NULL categories drop out): summed by (category, month) first, so
    the second exchange moves one row per category and month."""
    per = monthly.where(F.col("category").isNotNull()).groupBy("category", "order_month").agg(F.sum("units_sold").alias("units"))
    rows = per.select(F.col("category").alias("grain_key"), "category", first_day("order_month").alias("month"), "units")
    return _fill(rows, ["grain_key"], as_of_month(monthly, p)).select(F.lit("category").alias("grain"), "grain_key", "category", "month", "units", "t", "n")


def gap_fill(series: DataFrame) -> DataFrame:
    """M4 for given series (grain, grain_key, category, month, units)."""
    return _fill(series, ["grain", "grain_key"]).select("grain", "grain_key", "category", "month", "units", "t", "n")


def confidence_label(mape: Column) -> Column:
    """NULL -> none, < 20 high, < 50 medium, else low."""
    return band(mape, [cut for cut, _ in CONFIDENCE_CUTS], [*[label for _, label in CONFIDENCE_CUTS], CONFIDENCE_ELSE], CONFIDENCE_NONE)


def _holdout_terms(filled: DataFrame, p: ForecastParams) -> DataFrame:
    """Per series: the holdout actuals a1..aH, train sums and trailing sums."""
    w = p.ma_window
    h = p.holdout
    n, t = F.col("n"), F.col("t")
    aggs = [F.max("category").alias("category"), F.max("n").alias("n"), F.max("month").alias("last_month")]
    for i in range(h):  # holdout actuals, oldest first
        aggs.append(F.max(F.when(t == n - h + i, F.col("units"))).alias(f"a{i}"))
    # last value of the training part (naive) and sum of its last w values (moving average)
    aggs.append(F.max(F.when(t == n - h - 1, F.col("units"))).alias("naive_f"))
    aggs.append(F.sum(F.when((t >= n - h - w) & (t < n - h), F.col("units"))).alias("train_tail"))
    aggs.append(F.sum(F.when(t >= n - w, F.col("units"))).alias("full_tail"))
    return filled.groupBy("grain", "grain_key").agg(*aggs)


def _mae_mape(actuals: list[Column], num: list[Column], den: int) -> tuple[Column, Column]:
    """M7 for a flat forecast f = S/den: errors |den*a - S| / den, so every
    term is an exact integer until one final division."""
    abs_err = [F.abs(a * den - s) for a, s in zip(actuals, num)]
    mae_num = abs_err[0]
    for e in abs_err[1:]:
        mae_num = mae_num + e
    mae = as_double(mae_num) / float(den * len(actuals))
    terms = [F.when(a != 0, as_double(e) / (as_double(a) * den)).otherwise(F.lit(0.0))
             for a, e in zip(actuals, abs_err)]
    nz = [F.when(a != 0, F.lit(1)).otherwise(F.lit(0)) for a in actuals]
    tsum, nsum = terms[0], nz[0]
    for x, y in zip(terms[1:], nz[1:]):
        tsum, nsum = tsum + x, nsum + y
    mape = F.when(nsum > 0, F.lit(100.0) * tsum / as_double(nsum))
    return mae, mape


def moving_average_forecast(filled: DataFrame, p: ForecastParams = ForecastParams(),
                            model_name: str = "MA-3") -> DataFrame:
    """Flat forecast = mean of the last ``ma_window`` gap-filled months, for
    each of the ``horizon`` months after the series' own last month.
    Backtest: the same rule on the series without its last ``holdout``
    months. Band: +- z x population sigma of the one-step errors of the
    trailing mean over the series. Output: the forecast table (M9 + M12)."""
    w, h = p.ma_window, p.holdout
    by_t = Window.partitionBy("grain", "grain_key").orderBy("t")
    trailing = F.sum("units").over(by_t.rowsBetween(-w, -1))
    err = filled.where(F.col("n") >= p.min_len).withColumn("e", F.col("units") * w - trailing) \
        .withColumn("e", F.when(F.col("t") >= w, F.col("e")))
    resid = err.groupBy("grain", "grain_key").agg(
        F.count("e").alias("m"), F.sum("e").alias("se"), F.sum(F.col("e") * F.col("e")).alias("see"))
    terms = _holdout_terms(filled.where(F.col("n") >= p.min_len), p).join(resid, ["grain", "grain_key"])
    actuals = [F.col(f"a{i}") for i in range(h)]
    mae, mape = _mae_mape(actuals, [F.col("train_tail")] * h, w)
    sd = pop_sigma(F.col("m"), F.col("se"), F.col("see")) / float(w)
    fc = as_double("full_tail") / float(w)
    lower = F.greatest(fc - F.lit(p.z) * sd, F.lit(0.0))
    upper = fc + F.lit(p.z) * sd
    steps = F.explode(F.sequence(F.lit(1), F.lit(p.horizon))).alias("step")
    out = terms.select("grain", "grain_key", "category", "last_month", steps,
                       round_half_up(fc, 1).alias("predicted_units"), round_half_up(lower, 1).alias("lower_bound"),
                       round_half_up(upper, 1).alias("upper_bound"), round_half_up(mae, 2).alias("mae"),
                       round_half_up(mape, 1).alias("mape_pct"))
    out = out.select("grain", "grain_key", "category",
                     F.add_months("last_month", F.col("step")).alias("forecast_month"),
                     *[F.col(c).cast(FORECAST_NUM).alias(c)
                       for c in ["predicted_units", "lower_bound", "upper_bound", "mae", "mape_pct"]],
                     F.lit(model_name).alias("model_used"))
    return out.withColumn("confidence", confidence_label(F.col("mape_pct")))


def baselines(filled: DataFrame, p: ForecastParams = ForecastParams()) -> DataFrame:
    """Naive last-value and trailing-mean backtests on the same holdout
    as the model: one row per (series, model) with MAE and MAPE."""
    h, w = p.holdout, p.ma_window
    terms = _holdout_terms(filled.where(F.col("n") >= p.min_len), p)
    actuals = [F.col(f"a{i}") for i in range(h)]
    n_mae, n_mape = _mae_mape(actuals, [F.col("naive_f")] * h, 1)
    m_mae, m_mape = _mae_mape(actuals, [F.col("train_tail")] * h, w)
    rows = F.explode(F.array(
        F.struct(F.lit("Naive (last-value)").alias("model"), round_half_up(n_mae, 2).alias("mae"),
                 round_half_up(n_mape, 1).alias("mape_pct")),
        F.struct(F.lit("3-month Moving Average").alias("model"), round_half_up(m_mae, 2).alias("mae"),
                 round_half_up(m_mape, 1).alias("mape_pct")))).alias("r")
    return terms.select("grain", "grain_key", rows).select("grain", "grain_key", "r.*")
